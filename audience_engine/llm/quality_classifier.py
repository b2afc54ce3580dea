"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text has two rows of words: the words themselves (lower-cased, outer punctuation cut) and their shapes (case, digits and
the punctuation at the end, or ``=`` for a word equal to the one before). Word and shape 1- and 2-grams hash to
``2**BITS`` features; each of the four kinds sums to 1 in a text, so long and short texts compare. A score is the logistic
of a sparse dot product.

Training takes at most ``max_rows`` different labelled rows (the documented bound; those with the smallest hashes). They are dealt
evenly into ``SHARDS`` tasks; in each of ``ROUNDS`` rounds every task goes through its rows once from the common state, and the
states are averaged by their numbers of rows: ``SHARDS`` x 2 x ``2**BITS`` floats at a time on the driver, whatever the size of the corpus.
Scoring is one pass over the texts without a shuffle.

Defined cases: a null or empty text has no features and gets the logistic of the intercept; null labels and ids without a
document teach nothing; equal rows teach once; rows of one hash are taught in the order of their ids and labels; without labelled rows every score is 0.5; rows that repeat an id are scored each for itself; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audience_engine.llm.common import mixed, sliced, utf8
from audience_engine.session import cut_lineage

BITS = 18
MAX_ROWS = 20_000
SHARDS = 8
ROUNDS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-3
THRESHOLD = 0.3
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_KNOWN = 1 << 18


def shape(word: str) -> str:
    core = word.rstrip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    kind = "0" if any(c.isdigit() for c in core) else "X" if len(core) > 1 and core.isupper() else "Xx" if core[:1].isupper() else "x" if core else ""
    return kind + word[len(core) :][:3]


class _Views(dict):
    """Word to the hashes of its literal and its shape."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= _KNOWN:
            self.clear()
        literal = word.strip(_PUNCTUATION).lower()
        value = self[word] = (xxhash.xxh3_64_intdigest(literal, 1), xxhash.xxh3_64_intdigest(shape(word.decode("utf-8", "replace")), 2))
        return value


_VIEWS = _Views()
_SAME = np.uint64(xxhash.xxh3_64_intdigest(b"=", 3))


def features(text: bytes | None) -> list[np.ndarray]:
    """The feature places of each kind of n-gram, repeats included."""
    words = (text or b"").split()
    if not words:
        return []
    both = np.array([_VIEWS[w] for w in words], np.uint64)
    literal, shapes = both[:, 0].copy(), both[:, 1].copy()
    same = np.flatnonzero(literal[1:] == literal[:-1]) + 1
    shapes[same] = mixed(shapes[same], np.full(len(same), _SAME))
    kinds = [literal, mixed(literal[:-1], literal[1:]), shapes, mixed(shapes[:-1], shapes[1:])]
    return [(k >> np.uint64(64 - BITS)).astype(np.int64) for k in kinds if len(k)]


def dot(weights: np.ndarray, text: bytes | None) -> float:
    return float(weights[-1] + sum(weights[places].mean() for places in features(text)))


def _sparse(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    parts = features(text)
    places = np.concatenate([*parts, np.array([1 << BITS])])
    values = np.concatenate([*(np.full(len(p), 1 / len(p)) for p in parts), np.ones(1)])
    unique, back = np.unique(places, return_inverse=True)
    return unique, np.bincount(back, values)


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def ftrl_pass(rows: list, z: np.ndarray, n: np.ndarray) -> None:
    """One pass over (places, values, label) rows; ``z`` and ``n`` change in place."""
    for places, values, label in rows:
        w = weights_of(z[places], n[places])
        p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
        gradient = (p - label) * values
        more = gradient * gradient
        sigma = (np.sqrt(n[places] + more) - np.sqrt(n[places])) / ALPHA
        z[places] += gradient - sigma * w
        n[places] += more


def held_out(doc_id: str, parts: int = 5, part: int = 0) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts == part


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> np.ndarray:
    """Weights (the intercept last) from rows of ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``label``).

    Of the labelled ids that ``docs`` holds, ``max_rows`` may teach, and of their different rows as many, those with the
    least hashes; equal rows teach once. Each goes to one of ``SHARDS`` even shards by its hash.
    """
    spark = docs.sparkSession
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("double").alias("_label"))
    there = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = cut_lineage(there.orderBy(F.xxhash64("doc_id"), "doc_id", "_label").limit(max_rows))
    taught = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("_hash", F.xxhash64("doc_id", "text"))  # max_rows ids
    taught = cut_lineage(taught.dropDuplicates(["_hash", "doc_id", "_label"]))
    first = taught.select("_hash").distinct().orderBy("_hash").limit(max_rows)
    shard = F.pmod(F.xxhash64("_hash"), F.lit(SHARDS)).cast("int")
    rows = cut_lineage(taught.join(F.broadcast(first), "_hash", "left_semi").withColumn("_shard", shard))  # max_rows hashes
    rows = rows.repartitionById(SHARDS, "_shard").sortWithinPartitions("_hash", "doc_id", "_label")
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    for _ in range(ROUNDS):
        state = spark.sparkContext.broadcast((z.astype(np.float32), n.astype(np.float32)))

        def run(batches, state=state):
            own_z, own_n = (x.astype(np.float64) for x in state.value)
            seen = 0
            for batch in sliced(batches, 256):
                texts, marks = utf8(batch.column("text")), batch.column("_label").to_pylist()
                ftrl_pass([(*_sparse(t), y) for t, y in zip(texts, marks, strict=True)], own_z, own_n)
                seen += len(texts)
            if seen:
                yield pa.RecordBatch.from_pydict({"z": [own_z.astype(np.float32).tobytes()], "n": [own_n.astype(np.float32).tobytes()], "rows": [seen]})

        states = rows.mapInArrow(run, "z binary, n binary, rows long").collect()
        if not states:
            break
        share = np.array([s["rows"] for s in states]) / sum(s["rows"] for s in states)
        z, n = (sum(w * np.frombuffer(s[k], np.float32).astype(np.float64) for w, s in zip(share, states, strict=True)) for k in ("z", "n"))
        state.unpersist()
    return weights_of(z, n)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id`` and ``score`` of each row of ``docs`` (``doc_id``, ``text``)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches):
        w = shared.value
        for batch in batches:
            raw = np.array([dot(w, t) for t in utf8(batch.column("text"))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(raw, -35, 35))), pa.float64())], names=["doc_id", "score"])

    plain = docs.select("doc_id", "text")
    return plain.mapInArrow(run, f"doc_id {plain.schema['doc_id'].dataType.simpleString()}, score double")
