"""Language ID: the mixture of languages in each document, by expectation-maximisation over letter trigrams.

Each learned language is a smoothed distribution over hashed trigrams of lower-cased letters and word ends. A document's
trigrams are modelled as draws from a mixture; expectation-maximisation finds the proportions. Languages are then taken in
order of their proportion, the mixture is fitted anew to the first 1, 2, ... of them, and the set with the best
likelihood, less ``PENALTY * log(trigrams)`` for each language, is kept. The prediction is the set's largest member, the
score its proportion.

Training counts the trigrams of about ``rows_per_language`` rows of each language (the documented bound; the rows with the
smallest hashes). The model is languages x ``2**BITS`` numbers, whatever the size of the corpus; prediction is one pass over
the texts without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is every text if nothing was learned;
equal proportions go to the language first in code point order; rows that repeat an id are judged each for itself; other
columns are ignored.
"""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audience_engine.llm.common import utf8

BITS = 15
ROWS_PER_LANGUAGE = 3_000
MAX_LANGUAGES = 200
PENALTY = 2.0
SMOOTHING = 0.1
STEPS, TOLERANCE = 60, 1e-4
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def trigrams(text: bytes | None) -> np.ndarray | None:
    """How often each hashed trigram occurs; None without a letter."""
    codes = np.frombuffer((text or b"").decode("utf-8", "replace").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letter_table()[codes]
    if not letter.any():
        return None
    line = np.zeros(len(codes) + 2, np.uint64)
    line[1:-1] = np.where(letter, codes, 0)
    a, b, c = line[:-2], line[1:-1], line[2:]
    h = (a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + c * np.uint64(0x165667B19E3779F9)) >> np.uint64(64 - BITS)
    return np.bincount(h[b != 0].astype(np.int64), minlength=1 << BITS)


def proportions(counts: np.ndarray, likelihood: np.ndarray) -> tuple[np.ndarray, float]:
    """(mixture proportions, log-likelihood) of ``counts`` under the columns of ``likelihood``."""
    total = counts.sum()
    share = np.full(likelihood.shape[1], 1 / likelihood.shape[1])
    for _ in range(STEPS if len(share) > 1 else 0):
        mixture = likelihood @ share
        new = share * ((counts / mixture) @ likelihood) / total
        moved = np.abs(new - share).max()
        share = new
        if moved < TOLERANCE:
            break
    return share, float(counts @ np.log(likelihood @ share))


def language_set(counts: np.ndarray, model: np.ndarray) -> list[tuple[int, float]]:
    """The chosen languages (columns of ``model``) and their proportions, largest first."""
    here = np.flatnonzero(counts)
    counts, likelihood = counts[here].astype(float), model[here]
    share, _ = proportions(counts, likelihood)
    order = np.argsort(-share, kind="stable")
    price, best, found = PENALTY * np.log(counts.sum() + 1), -np.inf, []
    for k in range(1, len(order) + 1):
        part, fit = proportions(counts, likelihood[:, order[:k]])
        if fit - k * price <= best:
            break
        best, found = fit - k * price, [(int(order[i]), float(part[i])) for i in np.lexsort((order[:k], -part))]
    return found


def train(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """(languages, likelihood of each trigram in each) from rows of ``docs`` (``doc_id``, ``text``, ``lang``)."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return [], np.empty((1 << BITS, 0))
    languages = sorted(sizes)
    part = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, rows_per_language / sizes[lang]))])[F.col("lang")]
    place = (F.xxhash64("doc_id", F.crc32(F.col("text").cast("binary"))) / F.lit(2.0**64)) + 0.5
    index = {lang: i for i, lang in enumerate(languages)}

    def run(batches):
        tally: dict[int, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(utf8(batch.column("text")), batch.column("lang").to_pylist(), strict=True):
                counts = trigrams(text)
                if counts is not None:
                    tally[index[lang]] = tally.get(index[lang], 0) + counts
        for lang, counts in tally.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), lang), pa.int32()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["lang", "gram", "n"])

    counted = rows.filter(place < part).select("text", "lang").mapInArrow(run, "lang int, gram int, n long")
    table = np.full((1 << BITS, len(languages)), SMOOTHING)
    rows = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()  # at most languages x 2**BITS rows
    table[np.asarray(rows.column("gram")), np.asarray(rows.column("lang"))] += np.asarray(rows.column("n"))
    return languages, table / table.sum(axis=0)


def identify(docs: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``languages`` (set with proportions) of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    item = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches):
        for batch in batches:
            found = []
            for text in utf8(batch.column("text")):
                counts = trigrams(text) if languages else None
                found.append([(languages[i], s) for i, s in language_set(counts, shared.value)] if counts is not None else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f[0][0] if f else UNDETERMINED for f in found], pa.string()),
                    pa.array([min(1.0, f[0][1]) if f else 0.0 for f in found], pa.float64()),
                    pa.array([[{"lang": a, "share": b} for a, b in f] for f in found], item),
                ],
                names=["doc_id", "lang_pred", "score", "languages"],
            )

    plain = docs.select("doc_id", "text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, languages array<struct<lang: string, share: double>>")
