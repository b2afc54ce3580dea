"""Quality rules: figures of each text, and lines that too many documents of one host share.

Per text: words, their characters, symbols, repeated lines and words in repeated 8-word windows. Across documents:
the normalised lines (words joined by one space, A-Z lower-cased) are hashed to 64 bits and counted once per distinct
text of a host; a line in more than ``max(min_docs, share * texts of the host)`` texts is removed, and a document that
loses more than ``depleted`` of its words that way is rejected.

Exact copies count as one document, so a text is not rejected for having been copied. At most ``lines per text / share``
lines of a host can be over the limit, however large the host is. Up to ``max_lines`` such lines (counted first) go to
every task, which judges each text where it is; beyond that the lines of its host are joined to each row. Texts are read
twice and, in the first case, never shuffled.

Defined cases: a null text has no words and fails the base rules; a null host is a host of its own; an empty table gives
an empty result; rows that repeat an id are judged each for itself, equal rows alike; other columns are ignored
(``judge``) or carried along unchanged (``apply_rules``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audience_engine.llm.common import sliced, utf8, window_hashes, word_hashes
from audience_engine.session import cut_lineage

MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED_PERCENT = 30
MIN_DOCS = 10
SHARE = 0.1
DEPLETED = 0.5
MAX_LINES = 1_000_000
SYMBOLS = b"#*$%&|<>"

_FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_COLUMNS = (*_FIGURES, "base_failed", "n_removed_lines", "n_removed_words", "kept")


def line_hash(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words).lower()) - (1 << 63)


def repeated_words(words: list[bytes], n: int = WINDOW) -> int:
    """How many words lie in a window of ``n`` words that the text holds twice or more."""
    windows = window_hashes(word_hashes(words), n)
    ranked = np.sort(windows)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return 0
    hit = np.zeros(len(words) + n, np.int64)
    at = np.flatnonzero(np.isin(windows, twice))
    np.add.at(hit, at, 1)
    np.add.at(hit, at + n, -1)
    return int((np.cumsum(hit[: len(words)]) > 0).sum())


def figures(text: bytes | None) -> tuple[tuple[int, ...], dict[int, list[int]]]:
    """((words, word characters, symbols, repeated lines, repeated words), hash of each normalised line to its [lines, words])."""
    words, lines, tally = [], set(), {}
    n_lines = 0
    for line in (text or b"").split(b"\n"):
        own = line.split()
        if own:
            n_lines += 1
            lines.add(line)
            entry = tally.setdefault(line_hash(own), [0, 0])
            entry[0] += 1
            entry[1] += len(own)
            words += own
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = sum(map((text or b"").count, (bytes([c]) for c in SYMBOLS)))
    return (len(words), chars, symbols, n_lines - len(lines), repeated_words(words)), tally


def host_key(source: str = "source") -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """``_host``, ``_copy`` (a digest of the text) and ``lines`` (hashes): one row per host and distinct text."""

    def run(batches):
        for batch in sliced(batches):
            copies, lines = [], []
            for text in utf8(batch.column("_text")):
                copies.append(xxhash.xxh3_128_digest(text or b""))
                lines.append(list({line_hash(own) for line in (text or b"").split(b"\n") if (own := line.split())}))
            yield pa.RecordBatch.from_arrays([batch.column("_host"), pa.array(copies, pa.binary()), pa.array(lines, pa.list_(pa.int64()))], names=["_host", "_copy", "lines"])

    plain = docs.select(host_key().alias("_host"), F.col("text").alias("_text"))
    return plain.mapInArrow(run, "_host string, _copy binary, lines array<bigint>").dropDuplicates(["_host", "_copy"])


def frequent_lines(docs: DataFrame, min_docs: int, share: float) -> DataFrame:
    """``_host``, ``h`` of the lines over the limit."""
    texts = cut_lineage(distinct_texts(docs))
    counts = texts.select("_host", F.explode("lines").alias("h")).groupBy("_host", "h").agg(F.count("*").alias("n")).filter(F.col("n") > min_docs)
    hosts = cut_lineage(texts.groupBy("_host").agg(F.count("*").alias("texts")))
    return cut_lineage(counts.join(hosts, "_host").filter(F.col("n") > share * F.col("texts")).select("_host", "h"))


def _judging(docs: DataFrame, text: str, min_docs: int, share: float, depleted: float, max_lines: int):
    """(rows with ``_host`` and, for more lines than may be broadcast, ``_drop``; batch to (verdicts, lines that go, per row)).

    The lines over the limit are counted before they are collected.
    """
    named = docs.withColumnsRenamed({text: "text"}) if text != "text" else docs
    frequent = frequent_lines(named, min_docs, share)
    rows = docs.withColumn("_host", host_key())
    number = frequent.count()
    if number <= max_lines:
        own: dict[str, list[int]] = {}
        for r in frequent.collect():
            own.setdefault(r["_host"], []).append(r["h"])
        shared = docs.sparkSession.sparkContext.broadcast(own)
        sets: dict[str, set[int]] = {}

        def drops(batch):
            for host in batch.column("_host").to_pylist():
                if host not in sets:
                    if len(sets) > 10_000:
                        sets.clear()
                    sets[host] = set(shared.value.get(host, ()))
                yield sets[host]
    else:
        by_host = cut_lineage(frequent.groupBy("_host").agg(F.collect_list("h").alias("_drop")))  # at most lines per text / share
        rows = rows.join(by_host, "_host", "left")

        def drops(batch):
            return (set(d or ()) for d in batch.column("_drop").to_pylist())

    def judged(batch):
        for data, drop in zip(utf8(batch.column(text)), drops(batch), strict=True):
            found, tally = figures(data)
            gone = [tally[h] for h in tally.keys() & drop] if drop else []
            n_lines, n_words = sum(g[0] for g in gone), sum(g[1] for g in gone)
            failed = found[0] < MIN_WORDS or 100 * found[4] > MAX_REPEATED_PERCENT * found[0]
            yield data, drop if gone else None, (*found, failed, n_lines, n_words, not failed and n_words <= depleted * found[0])

    return rows, judged


def judge(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, depleted: float = DEPLETED, max_lines: int = MAX_LINES) -> DataFrame:
    """The figures and the verdict of each row of ``docs`` (``doc_id``, ``text``, ``source``)."""
    rows, judged = _judging(docs.select("doc_id", "text", "source"), "text", min_docs, share, depleted, max_lines)
    schema = T.StructType([rows.schema["doc_id"]])
    for name in _COLUMNS:
        schema = schema.add(name, "boolean" if name in ("base_failed", "kept") else "long")

    def run(batches):
        for batch in sliced(batches):
            verdicts = [v for _, _, v in judged(batch)]
            columns = [pa.array([v[i] for v in verdicts], pa.bool_() if n in ("base_failed", "kept") else pa.int64()) for i, n in enumerate(_COLUMNS)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


def without_lines(text: bytes, drop: set[int]) -> bytes:
    return b"\n".join(line for line in text.split(b"\n") if not (own := line.split()) or line_hash(own) not in drop)


def apply_rules(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, depleted: float = DEPLETED, max_lines: int = MAX_LINES) -> DataFrame:
    """The kept rows with all their columns, without the lines over the limit."""
    names = docs.columns
    carried = [f"_c{i}" for i in range(len(names))]
    text = f"_c{names.index('text')}"
    plain = docs.toDF(*carried)
    rows, judged = _judging(plain.withColumn("source", F.col(f"_c{names.index('source')}")), text, min_docs, share, depleted, max_lines)

    def run(batches):
        for batch in sliced(batches):
            texts, mask = [], []
            for data, drop, verdict in judged(batch):
                mask.append(verdict[-1])
                texts.append(without_lines(data, drop) if verdict[-1] and drop else data if verdict[-1] else None)
            new = pa.array(texts, pa.binary()).cast(pa.string())
            out = pa.RecordBatch.from_arrays([new if c == text else batch.column(c) for c in carried], names=carried)
            yield out.filter(pa.array(mask, pa.bool_()))

    return rows.mapInArrow(run, plain.schema).toDF(*names)
