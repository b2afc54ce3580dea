"""Line dedup: lines that many documents share lose all their places.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased; keys hash to 128 bits. Spark counts
the documents of each key (map tasks count their own batch first). All distinct keys are dealt into shards by hash, and
each shard is turned into a minimal perfect hash: levels of bit sets in which a key takes a place that no other key of its
level takes, so a key's rank among all set bits is its index. The index leads into an array of 64-bit fingerprints, which
turns away keys that are not in the shard, and an array of counts. The shards are a staged table.

Documents probe these arrays; lines are not joined. The hashes of a text's distinct keys go to the tasks that hold their
shards, a shard ahead of its probes, so a task holds one shard at a time and streams the probes. The counts say how many
probes a shard gets: one with more than ``SHARD_PROBES`` (a line that a third of all documents hold) goes to several tasks.
What comes back are the keys that go, by text; the texts themselves are shuffled once, to meet them. Nothing is collected,
and the way is the same at every size; broadcast is one small row per hot shard, at most one for ``SHARD_PROBES`` lines.

Defined cases: a null or empty text is one empty line; the empty key is never dropped; rows that repeat an id are
documents of their own; a very long text is
one row whose distinct keys are dealt like those of many texts; an empty table gives an empty result; other columns are ignored (``dedup_lines``) or carried
along (``apply_dedup``). In ``apply_dedup`` a null text stays null.
"""

from __future__ import annotations

import pickle
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audience_engine.llm.common import sliced, utf8
from audience_engine.session import cut_lineage

MIN_DOCS = 10
MIN_CHARS = 1
SHARD_KEYS = 50_000
SHARD_PROBES = 2_000_000
TASK_PROBES = 500_000
_U = np.uint64


def line_key(line: bytes) -> bytes:
    return line.strip().lower()


def key_hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def long_keys(keys: list[bytes], min_chars: int) -> list[bytes]:
    """The keys of at least ``min_chars`` code points."""
    return [k for k in keys if len(k) >= min_chars and (min_chars <= 1 or len(k.decode("utf-8", "replace")) >= min_chars)]


def as_pairs(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), _U).reshape(-1, 2)
    return both[:, 0], both[:, 1]


class PerfectHash:
    """A minimal perfect hash over distinct pairs of 64-bit hashes."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, slack: float = 1.6):
        self.levels: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        before = 0
        while len(h1):
            size = int(len(h1) * slack) + 64
            at = self._place(h1, h2, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append(alone)
            self.ranks.append(before + np.cumsum(alone, dtype=np.int64) - 1)
            before += int(alone.sum())
            h1, h2 = h1[~alone[at]], h2[~alone[at]]
        self.size = before

    @staticmethod
    def _place(h1, h2, level: int, size: int) -> np.ndarray:
        h = (h1 + _U(level) * h2 * _U(2) + _U(level)) * _U(0x9E3779B97F4A7C15)
        return ((h ^ (h >> _U(32))) % _U(size)).astype(np.int64)

    def index(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The index of each key; -1, or any index, for keys that are not in the set."""
        out = np.full(len(h1), -1, np.int64)
        todo = np.arange(len(h1))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = self._place(h1[todo], h2[todo], level, len(bits))
            hit = bits[at]
            out[todo[hit]] = rank[at[hit]]
            todo = todo[~hit]
            if not len(todo):
                break
        return out

    def packed(self) -> bytes:
        return pickle.dumps([(len(b), np.packbits(b).tobytes()) for b in self.levels])

    @classmethod
    def unpacked(cls, data: bytes) -> PerfectHash:
        self, before = cls.__new__(cls), 0
        self.levels, self.ranks = [], []
        for size, bits in pickle.loads(data):
            alone = np.unpackbits(np.frombuffer(bits, np.uint8), count=size).astype(bool)
            self.levels.append(alone)
            self.ranks.append((before + np.cumsum(alone, dtype=np.int64) - 1).astype(np.int32))
            before += int(alone.sum())
        self.size = before
        return self


class Shard:
    """A perfect hash with its fingerprint and count arrays; ``counts`` is 0 for unknown keys."""

    def __init__(self, perfect: bytes, prints: bytes, counts: bytes):
        self.perfect, self.prints, self.numbers = PerfectHash.unpacked(perfect), np.frombuffer(prints, _U), np.frombuffer(counts, np.uint32)

    def counts(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = self.perfect.index(h1, h2)
        known = (at >= 0) & (self.prints[at] == h2)
        return np.where(known, self.numbers[at], 0)


def key_counts(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``h1``, ``h2``, ``docs``: in how many rows each key occurs."""

    def run(batches):
        for batch in batches:
            seen: Counter[bytes] = Counter()
            for part in sliced([batch]):
                for text in utf8(part.column(0)):
                    seen.update(set(long_keys([line_key(x) for x in (text or b"").split(b"\n")], min_chars)))
            if seen:
                h1, h2 = as_pairs([key_hash(k) for k in seen])
                n = np.fromiter(seen.values(), np.int64, len(seen))
                yield pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(n)], names=["h1", "h2", "n"])

    pairs = docs.select("text").mapInArrow(run, "h1 long, h2 long, n long")
    return pairs.groupBy("h1", "h2").agg(F.sum("n").alias("docs"))


def shard_of(n: int) -> F.Column:
    return F.pmod(F.shiftrightunsigned("h1", 24), F.lit(n)).cast("long")


_INDEX = "shard long, probes long, perfect binary, prints binary, counts binary"


def build_shards(counts: DataFrame, n: int) -> DataFrame:
    """``shard``, ``probes`` (the sum of its counts), ``perfect``, ``prints``, ``counts``: one row per shard of a table of key counts."""

    def build(table: pa.Table) -> pa.Table:
        h1, h2 = (np.asarray(table.column(c)).view(_U) for c in ("h1", "h2"))
        docs = np.asarray(table.column("docs"))
        perfect = PerfectHash(h1, h2)
        at = perfect.index(h1, h2)
        prints, numbers = np.empty(len(h1), _U), np.empty(len(h1), np.uint32)
        prints[at] = h2
        numbers[at] = np.minimum(docs, 2**32 - 1)
        arrays = [pa.array([x], pa.binary()) for x in (perfect.packed(), prints.tobytes(), numbers.tobytes())]
        return pa.table([table.column("shard")[:1], pa.array([int(docs.sum())]), *arrays], names=["shard", "probes", "perfect", "prints", "counts"])

    return counts.withColumn("shard", shard_of(n)).groupBy("shard").applyInArrow(build, _INDEX)


def _probes(texts: DataFrame, min_chars: int) -> DataFrame:
    """``_a``, ``_b``, ``h1``, ``h2``: the distinct keys of each text; copies in one batch ask once."""
    schema = pa.schema([(c, pa.int64()) for c in ("_a", "_b", "h1", "h2")])

    def run(batches):
        for batch in batches:
            asked: set[tuple[int, int]] = set()
            for part in sliced([batch]):
                owners, digests = [], []
                own = zip(part.column("_a").to_pylist(), part.column("_b").to_pylist(), strict=True)
                for name, text in zip(own, utf8(part.column("text")), strict=True):
                    if text and name not in asked:
                        asked.add(name)
                        keys = long_keys(list({line_key(x) for x in text.split(b"\n")}), min_chars)
                        owners += [name] * len(keys)
                        digests += map(key_hash, keys)
                if owners:
                    names, (h1, h2) = np.array(owners, np.int64), as_pairs(digests)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (names[:, 0], names[:, 1], h1.view(np.int64), h2.view(np.int64))], schema=schema)

    return texts.mapInArrow(run, "_a long, _b long, h1 long, h2 long")


def probed(probes: DataFrame, index: DataFrame, n: int, min_docs: int) -> DataFrame:
    """``_a``, ``_b``, ``key`` (16 bytes) of the ``probes`` whose count in the ``n`` shards of ``index`` is at least ``min_docs``."""
    names = ["shard", "salt", "probe", "_a", "_b", "h1", "h2", "perfect", "prints", "counts"]
    copies = F.greatest(F.ceil(F.col("probes") / SHARD_PROBES), F.lit(1)).cast("int")
    tables = index.withColumn("salt", F.explode(F.sequence(F.lit(0), copies - 1))).withColumn("probe", F.lit(False))
    hot = index.filter(F.col("probes") > SHARD_PROBES).select("shard", copies.alias("copies"))
    placed = probes.withColumn("shard", shard_of(n)).withColumn("_part", F.spark_partition_id()).join(F.broadcast(hot), "shard", "left")
    salt = F.pmod(F.xxhash64("_a", "_part"), F.coalesce("copies", F.lit(1))).cast("int")
    asking = placed.withColumn("salt", salt).withColumn("probe", F.lit(True))
    both = tables.select(*[c if c in tables.columns else F.lit(None).cast("long").alias(c) for c in names]).unionByName(
        asking.select(*[c if c in asking.columns else F.lit(None).cast("binary").alias(c) for c in names])
    )
    total = index.agg(F.sum("probes")).first()[0] or 0
    order = ["shard", "salt"]
    laid = both.repartition(8 + total // TASK_PROBES, *order).sortWithinPartitions(*order, "probe")

    def run(batches):
        held = None
        for batch in batches:
            probe = batch.column("probe").to_numpy(zero_copy_only=False)
            stops = [*np.flatnonzero(~probe).tolist(), batch.num_rows]
            at = 0
            for stop in stops:
                if stop > at:
                    part = batch.slice(at, stop - at)
                    h1, h2 = (np.asarray(part.column(c)).view(_U) for c in ("h1", "h2"))
                    goes = np.flatnonzero(held.counts(h1, h2) >= min_docs)
                    data = np.stack([h1[goes], h2[goes]], axis=1).tobytes()
                    keys = pa.array([data[i : i + 16] for i in range(0, len(data), 16)], pa.binary())
                    yield pa.RecordBatch.from_arrays([part.column("_a").take(pa.array(goes)), part.column("_b").take(pa.array(goes)), keys], names=["_a", "_b", "key"])
                if stop < batch.num_rows:
                    held = Shard(*(batch.column(c)[stop].as_py() for c in ("perfect", "prints", "counts")))
                at = stop + 1

    return laid.mapInArrow(run, "_a long, _b long, key binary")


def _cut(text: bytes | None, drop: list[bytes] | None) -> tuple[bytes | None, int, int]:
    """(what is left, lines, dropped lines); ``drop`` are the hashes of the keys that go."""
    if not drop:
        return text, (text or b"").count(b"\n") + 1, 0
    lines, gone = text.split(b"\n"), set(drop)
    kept = [x for x in lines if key_hash(line_key(x)) not in gone]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def _dropped(docs: DataFrame, text: str, min_docs: int, min_chars: int) -> DataFrame:
    """``docs`` with its column ``text`` cut, plus ``_lines`` and ``_gone``."""
    schema = T.StructType([*docs.schema.fields, T.StructField("_lines", T.LongType()), T.StructField("_gone", T.LongType())])
    names = [f.name for f in schema]
    counts = cut_lineage(key_counts(docs.select(F.col(text).alias("text")), min_chars))
    n = max(1, -(-counts.count() // SHARD_KEYS))
    index = cut_lineage(build_shards(counts, n))
    # what goes follows from the text alone, so 128 bits of it stand for all its rows
    keyed = docs.withColumn("_a", F.xxhash64(text)).withColumn("_b", F.xxhash64(F.lit(1), text))
    goes = probed(_probes(keyed.select("_a", "_b", F.col(text).alias("text")), min_chars), index, n, min_docs)
    drops = cut_lineage(goes.groupBy("_a", "_b").agg(F.collect_set("key").alias("_drop")))  # a text's own keys

    def run(batches):
        for batch in sliced(batches):
            done = [_cut(t, d) for t, d in zip(utf8(batch.column(text)), batch.column("_drop").to_pylist(), strict=True)]
            new = pa.array([d[0] for d in done], pa.binary()).cast(pa.string())
            columns = [new if c == text else batch.column(c) for c in names[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], names=names)

    return keyed.join(drops, ["_a", "_b"], "left").drop("_a", "_b").mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped`` and the kept ``text`` of each row."""
    out = _dropped(docs.select("doc_id", "text"), "text", min_docs, min_chars)
    return out.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_gone").alias("n_dropped"), "text")


def apply_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows and columns of ``docs`` with the frequent lines cut out of ``text``."""
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    out = _dropped(plain, f"_c{names.index('text')}", min_docs, min_chars)
    return out.select(*plain.columns).toDF(*names)
