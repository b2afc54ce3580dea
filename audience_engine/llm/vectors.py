"""Embedding near-dedup: p-stable hashing into buckets of several tables, then exact cosines.

Equal vectors become one class that counts its members; vectors travel as they are stored and are scaled to length 1 in
double precision where they are compared. On unit
vectors a cosine of ``threshold`` is a distance of ``sqrt(2 - 2 * threshold)``, and a table's key is ``k`` values
``floor((a . v + b) / WIDTH)`` with Gaussian ``a`` and uniform ``b`` from a fixed seed. ``k`` grows with the logarithm of
the number of classes, so buckets stay small, and the number of tables follows from the wish to meet a pair at the very
threshold in one of them at least with probability ``recall``. Inside a bucket all cosines are computed as blocks of a matrix product; a pair
counts only in the first table whose bucket holds both, so links are counted once and no pair leaves its task: a task
returns the links of each class and a spanning forest. A bucket with many classes is dealt as pairs of equal chunks.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, link with nothing and stand
alone; vectors of different lengths are never linked; rows that repeat an id are vectors of their own; a component's id is
its smallest id that is not null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audience_engine.llm.common import components
from audience_engine.llm.groups import Labels, dealt, group_starts, parts_for, whole_groups
from audience_engine.session import cut_lineage

THRESHOLD = 0.9
RECALL = 0.99
WIDTH = 2.0
SEED = 20_240
CHUNK = 2048
_BLOCK = 512


def meets(distance: float, width: float = WIDTH) -> float:
    """How often one hash value of two points at ``distance`` is the same."""
    t = width / distance
    below = 0.5 * (1 + math.erf(-t / math.sqrt(2)))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def sizes(classes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(values in a key, tables): about a hundred far vectors share a bucket."""
    k = max(4, min(24, round(math.log(max(classes, 100) / 100) / -math.log(meets(math.sqrt(2))))))
    near = meets(math.sqrt(2 - 2 * threshold)) ** k
    return k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near)))


@lru_cache(maxsize=8)
def projections(dim: int, k: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.PCG64([SEED, dim]))
    return draw.standard_normal((tables * k, dim)).T.copy(), draw.uniform(0, WIDTH, tables * k)


def bucket_keys(unit: np.ndarray, k: int, tables: int) -> np.ndarray:
    """One 64-bit bucket key per vector (row) and table (column)."""
    a, b = projections(unit.shape[1], k, tables)
    cells = np.floor((unit @ a + b) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(unit), tables, k)
    key = np.full((len(unit), tables), unit.shape[1], np.uint64)
    for i in range(k):
        key = (key ^ cells[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def usable(values, kind: str = "f8") -> np.ndarray | None:
    """A vector that can be compared, as it is stored: ``kind`` is ``f4`` where the table holds single precision."""
    if not values or any(v is None for v in values):
        return None
    v = np.asarray(values, kind)
    return v if np.isfinite(v).all() and v.any() else None


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def units(data: list[bytes], kind: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length to (places, vectors of length 1)."""
    lengths = np.fromiter(map(len, data), np.int64, len(data)) // np.dtype(kind).itemsize
    out = {}
    for d in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == d)
        out[d] = (at, scaled(np.frombuffer(b"".join([data[i] for i in at]), kind).reshape(-1, d)))
    return out


def _stored(vectors: DataFrame, vec_id: str, embedding: str, kind: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [usable(v, kind) for v in batch.column("v").to_pylist()]
            data = [None if v is None else v.tobytes() for v in found]
            keys = [None if d is None else xxhash.xxh3_64_intdigest(d) - (1 << 63) for d in data]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.int64()), pa.array(data, pa.binary())], names=["vec_id", "node", "unit"])

    plain = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<float>" if kind == "f4" else "array<double>").alias("v"))
    return plain.mapInArrow(run, f"vec_id {plain.schema['vec_id'].dataType.simpleString()}, node long, unit binary")


def bucket_links(unit: np.ndarray, keys: np.ndarray, table: int, weight: np.ndarray, split: int | None, threshold: float, labels: Labels, base: int, count: np.ndarray) -> None:
    """Adds the links of one bucket: ``split`` divides two chunks of which only pairs across count."""
    n = len(unit)
    rows = range(0, n if split is None else split, _BLOCK)
    for r0 in rows:
        r1 = min(r0 + _BLOCK, n if split is None else split)
        c0 = r0 if split is None else split
        near = unit[r0:r1] @ unit[c0:].T >= threshold
        x, y = np.nonzero(near)
        x, y = x + r0, y + c0
        if split is None:
            x, y = x[x < y], y[x < y]
        if table and len(x):
            first = ~(keys[x, :table] == keys[y, :table]).any(axis=1)
            x, y = x[first], y[first]
        if len(x):
            np.add.at(count, base + x, weight[y])
            np.add.at(count, base + y, weight[x])
            labels.link(base + x, base + y)


def links(classes: DataFrame, kind: str, threshold: float = THRESHOLD, recall: float = RECALL, chunk: int = CHUNK) -> DataFrame:
    """``node``, ``other``, ``n``: per task, the links of a class to members of other classes and its tree's root."""
    number = classes.count()
    k, tables = sizes(number, threshold, recall)

    def keyed(batches, with_vector: bool):
        for batch in batches:
            nodes, data = np.asarray(batch.column("node")), batch.column("unit").to_pylist()
            for places, unit in units(data, kind).values():
                keys = bucket_keys(unit, k, tables)
                for t in range(tables):
                    columns = [pa.array(np.full(len(places), t), pa.int32()), pa.array(keys[:, t].copy())]
                    if with_vector:
                        columns += [pa.array(nodes[places]), pa.array(np.asarray(batch.column("members"))[places]), pa.array([data[i] for i in places], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["t", "key", "node", "members", "unit"][: len(columns)])

    sized = classes.select("node", "unit").mapInArrow(lambda b: keyed(b, False), "t int, key long").groupBy("t", "key").agg(F.count("*").alias("n"))
    hot = cut_lineage(sized.filter(F.col("n") > chunk).withColumn("_chunks", F.ceil(F.col("n") / chunk)).drop("n"))
    rows = classes.select("node", "members", "unit").mapInArrow(lambda b: keyed(b, True), "t int, key long, node long, members long, unit binary")
    rows = rows.join(hot, ["t", "key"], "left")
    tasks = dealt(rows, ["t", "key"], F.coalesce("_chunks", F.lit(1)), F.xxhash64("node"), parts_for(number * tables)).drop("_chunks")

    def run(batches):
        for table in whole_groups(batches, ["t", "key", "_i", "_j"], 1 << 15):
            starts = [*group_starts(table, ["t", "key", "_i", "_j"]).tolist(), table.num_rows]
            t, own, i, j, members, node = (np.asarray(table.column(c)) for c in ("t", "_own", "_i", "_j", "members", "node"))
            data = table.column("unit").to_pylist()
            labels, count = Labels(table.num_rows), np.zeros(table.num_rows, np.int64)
            for low, high in zip(starts, starts[1:], strict=False):
                if high - low < 2:
                    continue
                split = None if i[low] == j[low] else int((own[low:high] == i[low]).sum())
                ((_, unit),) = units(data[low:high], kind).values()
                bucket_links(unit, bucket_keys(unit, k, tables), int(t[low]), members[low:high], split, threshold, labels, low, count)
            hit = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(node[hit]), pa.array(node[labels.label[hit]]), pa.array(count[hit])], names=["node", "other", "n"])

    return tasks.mapInArrow(run, "node long, other long, n long")


def near_groups(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL, chunk: int = CHUNK) -> DataFrame:
    """``vec_id``, ``n_links``, ``component`` of each row."""
    single = vectors.schema[embedding].dataType.simpleString() == "array<float>"
    kind = "f4" if single else "f8"
    rows = cut_lineage(_stored(vectors, vec_id, embedding, kind))
    known = rows.filter(F.col("node").isNotNull())
    classes = cut_lineage(known.groupBy("node", "unit").agg(F.count("*").alias("members"), F.min("vec_id").alias("least")))
    found = cut_lineage(links(classes, kind, threshold, recall, chunk))
    roots = cut_lineage(components(found.select(F.col("node").alias("a"), F.col("other").alias("b"))))
    direct = found.groupBy("node").agg(F.sum("n").alias("n"))
    joined = classes.drop("unit").join(direct, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    joined = cut_lineage(joined.withColumn("n_links", F.coalesce("n", F.lit(0)) + F.col("members") - 1).select("node", "n_links", "least", "root"))
    least = cut_lineage(joined.groupBy("root").agg(F.min("least").alias("component")))
    named = cut_lineage(joined.join(least, "root").select("node", "n_links", "component"))
    out = rows.drop("unit").join(named, "node", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", F.when(F.col("node").isNull(), F.col("vec_id"))).alias("component"))
