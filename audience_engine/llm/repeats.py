"""Substring dedup: passages of ``WINDOW`` words or more that stand anywhere else too, found by seed and extend.

Seeds: among the ``WINDOW - SEED + 1`` seeds (hashes of ``SEED`` words) in a window, the last smallest one is the window's
anchor, so equal windows have equal anchors at the same place. Windows next to each other mostly share an anchor; such a run
is one row: the anchor, the hash of all words of the run (the anchor with its context on both sides), and where it is.

Extension: rows meet by anchor. Runs that are equal as a whole repeat as a whole. Where an anchor stands in different
contexts, one row of each context is extended to both sides word by word: the windows of its run are hashed from the text,
and those that another context holds too repeat. Repeated windows that overlap grow together into the maximal repeat, which
is cut out of each document that holds it.

Rows are narrowed before every shuffle: what repeats inside a batch is settled there, its neighbouring windows become
one interval, and a single row stands for it in the shuffle, so thousands of copies of one text send little more
than one does. Anchors that a sample of the documents shows to be very frequent are dealt over ``SALTS`` tasks by their
context and extended in any case; the sample steers only where rows go, never what is found. The texts are shuffled
once by document: extension and cutting read the same exchange.

Hashes have 128 bits (anchor and context, or anchor and window); rows of one id are told apart by 64 bits of their texts. Defined cases: a null text has no words; texts shorter than
a window stay whole; rows that repeat an id are documents of their own and repeat each other if their texts do; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audience_engine.llm.common import batches_of, covered, id_back, id_key, mixed, row_key, utf8, window_hashes, word_hashes
from audience_engine.llm.groups import whole_groups
from audience_engine.session import cut_lineage

WINDOW = 35
SEED = 16
SALTS = 256
SAMPLE = 5_000
HOT_SHARE = 0.01

_ROW = "a long, b long, d long, t long, s int, e int, n int"
_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("d", pa.int64()), ("t", pa.int64()), ("s", pa.int32()), ("e", pa.int32()), ("n", pa.int32())])


def last_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the last smallest value in every ``width`` consecutive ones."""
    at, done = np.arange(len(values)), 1

    def smaller(x, y):
        return np.where(values[y] <= values[x], y, x)

    while done * 2 <= width:
        at = smaller(at[: len(at) - done], at[done:])
        done *= 2
    rest = width - done
    return smaller(at[: len(at) - rest], at[rest:]) if rest else at


def runs(h: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, ...]:
    """(anchor, hash of the run, first window, window after the last) of a document's word hashes."""
    seeds, windows = window_hashes(h, seed), window_hashes(h, window)
    at = last_minimum(seeds, window - seed + 1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    stop = np.concatenate([first[1:], [len(at)]])
    whole = mixed(mixed(windows[first], windows[stop - 1]), (stop - first).astype(np.uint64))
    return seeds[at[first]], whole, first, stop


def _groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts by a, b; group number of each place in that order)."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    return order, np.cumsum(np.concatenate([[0], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else order


def _intervals(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals of the same document that overlap or touch, merged; sorted by (document, start)."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    span = np.int64(max(int(stop.max()), 1) + 1)
    reach = np.maximum.accumulate(doc * span + stop)
    new = np.concatenate([[True], doc[1:] * span + start[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return doc[at], start[at], np.maximum.reduceat(stop, at)


def _settled(part: dict[str, np.ndarray], ids: np.ndarray, prints: np.ndarray, length: Callable, once_only: bool):
    """What a batch sends: intervals (n = 0) of what repeats in it, and one row for each distinct (a, b).

    ``part`` has the arrays a, b, doc (place in the batch), s, e, n. ``once_only``: rows with n = 2 are settled elsewhere.
    """
    order, group = _groups(part["a"], part["b"])
    part = {k: v[order] for k, v in part.items()}
    total = np.bincount(group, part["n"]) if len(group) else np.empty(0)
    twice = total[group] >= 2 if len(group) else np.empty(0, bool)
    mine = twice & (part["n"] == 1) if once_only else twice
    doc, start, stop = _intervals(part["doc"][mine], part["s"][mine], length(part["s"], part["e"])[mine])
    head = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.empty(0, bool)
    spread = mixed(doc.astype(np.uint64) + np.uint64(1), start.astype(np.uint64)).view(np.int64)
    lone = part["doc"][head]
    number = np.where(twice[head], 2, 1)
    return {
        "a": np.concatenate([spread, part["a"][head].view(np.int64)]),
        "b": np.concatenate([np.zeros(len(doc), np.int64), part["b"][head].view(np.int64)]),
        "d": np.concatenate([ids[doc], ids[lone]]),
        "t": np.concatenate([prints[doc], prints[lone]]),
        "s": np.concatenate([start, part["s"][head]]),
        "e": np.concatenate([stop, part["e"][head]]),
        "n": np.concatenate([np.zeros(len(doc), np.int64), number]),
    }


def _stacked(parts: list[tuple], names: list[str]) -> dict[str, np.ndarray]:
    kinds = {"a": np.uint64, "b": np.uint64}
    return {k: np.concatenate([p[i] for p in parts]) if parts else np.empty(0, kinds.get(k, np.int64)) for i, k in enumerate(names)}


def _anchor_rows(frame: DataFrame, window: int, seed: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            parts = []
            for i, text in enumerate(utf8(batch.column("text"))):
                words = (text or b"").split()
                if len(words) >= window:
                    a, b, s, e = runs(word_hashes(words), window, seed)
                    parts.append((a, b, np.full(len(a), i), s, e, np.ones(len(a), np.int64)))
            part = _stacked(parts, ["a", "b", "doc", "s", "e", "n"])
            ids, prints = np.asarray(batch.column("d")), np.asarray(batch.column("t"))
            yield from batches_of(_settled(part, ids, prints, lambda s, e: e - 1 + window, False), _SCHEMA)

    return frame.mapInArrow(run, _ROW)


def hot_anchors(frame: DataFrame, window: int, seed: int) -> list[int]:
    """Anchors in a hundredth of a sample of the documents at least: at most a hundred times the anchors of a document."""
    every = max(1, frame.count() // SAMPLE)
    sample = frame.filter(F.pmod(F.xxhash64("d", F.lit(3)), F.lit(every)) == 0)

    def run(batches):
        for batch in batches:
            for text in utf8(batch.column("text")):
                words = (text or b"").split()
                if len(words) >= window:
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(runs(word_hashes(words), window, seed)[0]).view(np.int64))], names=["a"])

    counts = sample.mapInArrow(run, "a long").groupBy("a").agg(F.count("*").alias("n"))
    return [r["a"] for r in counts.filter(F.col("n") >= max(20, HOT_SHARE * SAMPLE)).collect()]


def _met(rows: DataFrame, hot: list[int], window: int) -> DataFrame:
    """Rows meet by anchor: intervals (n = 0) of what repeats, and one row (n > 0) of each context that is to be extended."""
    often = np.array(sorted(hot), np.int64)

    def run(batches):
        for table in whole_groups(batches, ["a"]):
            c = {k: np.asarray(table.column(k)) for k in _SCHEMA.names}
            seed = c["n"] > 0
            done = {k: v[~seed] for k, v in c.items()}
            c = {k: v[seed] for k, v in c.items()}
            if not len(c["a"]):
                yield from batches_of(done, _SCHEMA)
                continue
            new_a = np.concatenate([[True], c["a"][1:] != c["a"][:-1]])
            new_b = new_a | np.concatenate([[True], c["b"][1:] != c["b"][:-1]])
            by_a, by_b = np.cumsum(new_a) - 1, np.cumsum(new_b) - 1
            frequent = np.isin(c["a"], often)
            repeated = (np.bincount(by_a, c["n"])[by_a] >= 2) | frequent
            one_context = (np.bincount(by_a[new_b])[by_a] == 1) & ~frequent
            whole = repeated & (np.bincount(by_b, c["n"])[by_b] >= 2)
            extend = repeated & ~one_context & new_b
            out = {k: np.concatenate([done[k], c[k][whole], c[k][extend]]) for k in _SCHEMA.names}
            first, second = len(done["a"]), len(done["a"]) + int(whole.sum())
            out["e"][first:second] += window - 1
            out["n"][first:second] = 0
            out["n"][second:] = np.where(whole[extend], 2, 1)
            yield from batches_of(out, _SCHEMA)

    salted = rows
    if hot:
        salt = F.when((F.col("n") > 0) & F.col("a").isin(hot), F.pmod(F.xxhash64("b"), F.lit(SALTS))).otherwise(F.lit(0))
        salted = rows.withColumn("salt", salt.cast("int"))
    keys = ["a", "salt"] if hot else ["a"]
    return salted.repartition(*keys).sortWithinPartitions("a", "b").drop("salt").mapInArrow(run, _ROW)


def _windows(frame: DataFrame, open_rows: DataFrame, window: int) -> DataFrame:
    """Every window of the rows to be extended, by (anchor, window); settled inside the batch where it can be."""
    per_doc = open_rows.groupBy("d", "t").agg(F.collect_list(F.struct("a", "s", "e", "n")).alias("open"))  # rows of one document

    def run(batches):
        for batch in batches:
            parts = []
            for i, (text, rows) in enumerate(zip(utf8(batch.column("text")), batch.column("open"), strict=True)):
                hashes = window_hashes(word_hashes((text or b"").split()), window)
                row = rows.values
                a, s, e, n = (np.asarray(row.field(k)) for k in ("a", "s", "e", "n"))
                size = (e - s).astype(np.int64)
                start = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(s, size)
                parts.append((np.repeat(a.view(np.uint64), size), hashes[start], np.full(len(start), i), start, start + window, np.repeat(n, size).astype(np.int64)))
            part = _stacked(parts, ["a", "b", "doc", "s", "e", "n"])
            ids, prints = np.asarray(batch.column("d")), np.asarray(batch.column("t"))
            yield from batches_of(_settled(part, ids, prints, lambda s, e: e, True), _SCHEMA)

    return frame.join(per_doc, ["d", "t"]).select("d", "t", "text", "open").mapInArrow(run, _ROW)


def _met_windows(rows: DataFrame) -> DataFrame:
    """Windows meet by (anchor, window): intervals of those in two contexts."""

    def run(batches):
        for table in whole_groups(batches, ["a", "b"]):
            c = {k: np.asarray(table.column(k)) for k in _SCHEMA.names}
            new = np.concatenate([[True], (c["a"][1:] != c["a"][:-1]) | (c["b"][1:] != c["b"][:-1])])
            group = np.cumsum(new) - 1
            keep = (c["n"] == 0) | ((np.bincount(group, c["n"])[group] >= 2) & (c["n"] == 1))
            yield pa.RecordBatch.from_arrays([pa.array(c[k][keep]) for k in ("d", "t", "s", "e")], names=["d", "t", "s", "e"])

    return rows.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(run, "d long, t long, s int, e int")


def without_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``spans`` (repeats, as word places) and the kept ``text``, words joined by one space."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    frame = docs.select(id_key("doc_id").alias("d"), row_key("text").alias("t"), "text")
    met = cut_lineage(_met(_anchor_rows(frame, window, seed), hot_anchors(frame, window, seed), window))
    settled = met.filter("n = 0").select("d", "t", "s", "e")
    extended = _met_windows(_windows(frame, met.filter("n > 0"), window))
    spans = settled.unionByName(extended).groupBy("d", "t").agg(F.collect_list(F.struct("s", "e")).alias("spans"))  # of one document

    def run(batches):
        for batch in batches:
            out = {"d": batch.column("d"), "n_words": [], "n_removed": [], "spans": [], "text": []}
            for text, rows in zip(utf8(batch.column("text")), batch.column("spans"), strict=True):
                words = (text or b"").split()
                cut = []
                if rows.is_valid and len(rows.values):
                    s, e = (np.asarray(rows.values.field(k)).astype(np.int64) for k in ("s", "e"))
                    gone = covered(s, e, len(words))
                    out["n_removed"].append(int(gone.sum()))
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                    cut = [{"start": int(x), "stop": int(y)} for x, y in edges.reshape(-1, 2)]
                    kept = compress(words, (~gone).tolist())
                else:
                    out["n_removed"].append(0)
                    kept = words
                out["n_words"].append(len(words))
                out["spans"].append(cut)
                out["text"].append(b" ".join(kept))
            arrays = [
                out["d"],
                pa.array(out["n_words"], pa.int64()),
                pa.array(out["n_removed"], pa.int64()),
                pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                pa.array(out["text"], pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["d", "n_words", "n_removed", "spans", "text"])

    cut = frame.join(spans, ["d", "t"], "left").select("d", "t", "text", "spans").mapInArrow(
        run, "d long, n_words long, n_removed long, spans array<struct<start: int, stop: int>>, text string"
    )
    return cut.select(id_back("d").cast(kind).alias("doc_id"), "n_words", "n_removed", "spans", "text")
