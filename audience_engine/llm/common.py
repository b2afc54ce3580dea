"""Words, window hashes, row keys and connected components that the corpus operators share.

A word is a maximal run of characters other than U+0020 and U+0009 to U+000D. ``bytes.split()`` without an argument
cuts at exactly these characters, so texts are handled as UTF-8 bytes inside tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audience_engine.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
NO_ID = -(2**63)
_KNOWN_WORDS = 1 << 18


class WordHashes(dict):
    """Word to 64-bit hash; emptied when it holds too many words, so its memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two ordered hashes."""
    out = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return out ^ (out >> np.uint64(32))


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """The hash of every ``n`` consecutive values: windows of 2, 4, 8, ... and, for the rest, two that overlap."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    width = 1
    while width * 2 <= n:
        h = mixed(h[: len(h) - width], h[width:])
        width *= 2
    rest = n - width
    return mixed(h[: len(h) - rest], h[rest:]) if rest else h


def covered(starts: np.ndarray, stops: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a half-open interval."""
    steps = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(stops, minlength=n + 1)[: n + 1]
    return np.cumsum(steps[:n]) > 0


def utf8(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts, so that a task holds few texts as Python values at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def batch_of(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def batches_of(columns: dict[str, np.ndarray], schema: pa.Schema, rows: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """Equal-length arrays as batches of bounded size."""
    n = len(next(iter(columns.values())))
    for at in range(0, n, rows):
        yield batch_of({k: v[at : at + rows] for k, v in columns.items()}, schema)


def id_key(column: str | Column) -> Column:
    """A document id that joins, null included."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(NO_ID)).cast("long")


def id_back(key: str) -> Column:
    return F.when(F.col(key) != NO_ID, F.col(key))


def text_key(column: str = "text") -> Column:
    """Tells rows apart that share an id; rows that share id and text have equal results anyway."""
    return (F.crc32(F.coalesce(F.col(column), F.lit("")).cast("binary")) - F.lit(2**31)).cast("int")


def row_key(column: str = "text") -> Column:
    """Like ``text_key`` with 64 bits, for joins where millions of texts may share an id."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")).cast("binary"))


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node that each node of the edges (``a``, ``b``) reaches. Isolated nodes are not listed.

    Alternating large and small stars: every node first hands its larger neighbours to the smallest neighbour, then its
    smaller ones, until nothing changes. Minima are aggregated before the shuffle and written before they are joined,
    so that a node with very many neighbours is split over tasks by the adaptive join (or the minima are broadcast, if
    their known size allows it). Each round is written to the shared folder.
    """
    edges = edges.filter("a <> b")
    stars = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = cut_lineage(
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        )
        least = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut_lineage(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            roots = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state
