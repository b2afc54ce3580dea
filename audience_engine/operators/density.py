"""Clusters of vectors by density, with the rows that lie in no dense place as outliers."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from audience_engine.operators.joining import dense_index, lookup_join
from audience_engine.session import cut_lineage

BINS = 256
#: Bits of a second code, by which a crowded cell is cut once more.
FINE = 24
#: Two groups of core distances explain at least this share of their spread in logarithms, else there is one group only. (Two
#: halves of one bell curve explain 0.64 of it, two halves of an even spread 0.75.)
APART = 0.8


def _stacked(table: pa.Table | pa.RecordBatch, name: str = "x") -> np.ndarray:
    column = table.column(name)
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _blocks(x: np.ndarray, rows: int = 256) -> Iterator[tuple[int, np.ndarray]]:
    """Squared distances of ``rows`` rows at a time to all."""
    norms = (x**2).sum(axis=1)
    for at in range(0, len(x), rows):
        yield at, np.maximum(norms[at : at + rows, None] - 2.0 * x[at : at + rows] @ x.T + norms, 0.0)


def distinct_vectors(df: DataFrame, vec: str) -> tuple[DataFrame, DataFrame]:
    """The rows with ``_v``, a 128-bit hash of their vector, and each vector once: (id, x, weight).

    ``_v`` is null for vectors that are null, empty, of another length than most, or hold a null or non-finite number.
    """
    x = F.transform(F.col(vec).cast("array<double>"), lambda v: v + F.lit(0.0))  # -0.0 is 0.0
    broken = F.exists("_x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(math.inf)))
    fine = F.coalesce((F.size("_x") > 0) & ~broken, F.lit(False))
    rows = df.withColumn("_x", x).withColumn("_fine", fine)
    # at most one row per length, the one row taken
    most = rows.filter("_fine").groupBy(F.size("_x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    length = most["n"] if most else 0
    hashed = F.concat(F.hex(F.xxhash64("_x")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), "_x")))
    rows = rows.withColumn("_v", F.when(F.col("_fine") & (F.size("_x") == length), hashed)).drop("_fine")
    found = rows.filter(F.col("_v").isNotNull()).groupBy(F.col("_v").alias("id")).agg(F.first("_x").alias("x"), F.count("*").alias("weight"))
    return rows.drop("_x"), found


def parts_of(vectors: DataFrame, count: int, limit: int, orders: int, seed: int) -> DataFrame:
    """(part, id): each vector in one part of each order, parts of about ``limit`` vectors at most, near vectors mostly together.

    An order reads, as a code, on which side of random planes a vector lies; each plane goes through a vector of its own, so
    that no place is cut off by all of them. A cell is the shortest prefix of the code with at most ``limit`` vectors; a
    cell that needs more bits gets them by its size, and one that stays crowded is dealt by the hash of its vectors.
    Up to ``limit`` vectors are one part of one order, and all is exact.
    """
    if count <= limit:
        return vectors.select(F.lit(0).cast("long").alias("part"), "id")
    bits = min(24, math.ceil(math.log2(2 * count / limit)))
    planes = orders * (bits + FINE)
    # ids are hashes, so the first are drawn fairly; with less of them than planes they serve again
    through = np.array([r["x"] for r in vectors.orderBy("id").limit(planes).select("x").collect()])
    directions = np.random.default_rng(seed).normal(size=(through.shape[1], planes))
    borders = (through[np.arange(planes) % len(through)] * directions.T).sum(axis=1)
    powers = [1 << i for i in reversed(range(bits))], [1 << i for i in reversed(range(FINE))]

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signs = (_stacked(batch) @ directions >= borders).reshape(batch.num_rows, orders, bits + FINE).astype(np.int64)
            for order in range(orders):
                head, tail = signs[:, order, :bits] @ powers[0], signs[:, order, bits:] @ powers[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, order, np.int64)), batch.column("id"), pa.array(head), pa.array(tail)],
                    ["order", "id", "head", "tail"],
                )

    coded = cut_lineage(vectors.select("id", "x").mapInArrow(codes, "order long, id string, head long, tail long"))
    cells = cut_lineage(coded.groupBy("order", "head").agg(F.count("*").alias("n")))
    # every cell once per prefix length; ``off`` bits are cut from its end
    prefixes = cells.select("order", "head", "n", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("off"))
    prefixes = prefixes.withColumn("cell", F.expr("shiftright(head, off)"))
    sizes = prefixes.groupBy("order", "cell", "off").agg(F.sum("n").alias("n"))
    fitting = prefixes.drop("n").join(sizes, ["order", "cell", "off"])
    shortest = fitting.groupBy("order", "head").agg(F.max(F.when((F.col("n") <= limit) | (F.col("off") == 0), F.struct("off", "cell", "n"))).alias("c"))
    more = F.when(F.col("c.n") > limit, F.least(F.ceil(F.log2(2 * F.col("c.n") / limit)), F.lit(FINE))).otherwise(0).cast("int")
    leaves = shortest.select("order", "head", "c.off", "c.cell", more.alias("more"))
    cut = lookup_join(coded, cut_lineage(leaves), ["order", "head"], "inner").withColumn("fine", F.expr(f"shiftright(tail, {FINE} - more)"))
    leaf = ["order", "off", "cell", "fine"]
    crowded = cut.groupBy(*leaf).agg(F.count("*").alias("n"))
    dealt = crowded.select(*leaf, F.when(F.col("n") > limit, F.ceil(2 * F.col("n") / limit)).otherwise(1).alias("deals"))
    deal = F.pmod(F.xxhash64("order", "id"), F.col("deals"))
    return lookup_join(cut, dealt, leaf, "inner").select(F.xxhash64(*leaf, deal).alias("part"), "id")


def _nearest(k: int) -> Callable[[pa.Table], pa.Table]:
    def near(table: pa.Table) -> pa.Table:
        x, weights, ids = _stacked(table), table.column("weight").to_numpy(), table.column("id").combine_chunks()
        own = min(k, len(x) - 1)
        others, far = np.empty((len(x), own), np.int64), np.empty((len(x), own))
        for at, squared in _blocks(x):
            squared[np.arange(len(squared)), np.arange(at, at + len(squared))] = np.inf
            best = np.argpartition(squared, own - 1, axis=1)[:, :own] if own else np.empty((len(squared), 0), np.int64)
            others[at : at + len(squared)] = best
            # measured anew, so that a pair has the same distance in every part
            far[at : at + len(squared)] = np.sqrt(((x[at : at + len(squared), None, :] - x[best]) ** 2).sum(axis=2))
        flat = others.ravel()
        listed = pa.StructArray.from_arrays([ids.take(pa.array(flat)), pa.array(far.ravel()), pa.array(weights[flat])], ["other", "far", "weight"])
        offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * own)
        return pa.table({"id": ids, "own": pa.array(weights), "near": pa.ListArray.from_arrays(offsets, listed)})

    return near


def core_distances(vectors: DataFrame, parts: DataFrame, k: int) -> DataFrame:
    """(id, weight, core): how far the ``k``-th nearest other row is; copies count as rows. Null if fewer were met."""
    near = "id string, own long, near array<struct<other: string, far: double, weight: long>>"
    lists = parts.join(vectors, "id").groupBy("part").applyInArrow(_nearest(k), near)
    # k neighbours an order
    met = lists.groupBy("id").agg(F.first("own").alias("weight"), F.sort_array(F.flatten(F.collect_list("near"))).alias("m"))
    once = F.filter("m", lambda e, i: (i == 0) | (e["other"] != F.get(F.col("m"), i - 1)["other"]))
    ordered = F.sort_array(F.transform(once, lambda e: F.struct(e["far"].alias("far"), e["weight"].alias("n"))))
    start = F.struct(
        (F.col("weight") - 1).alias("n"), F.when(F.col("weight") > k, F.lit(0.0)).cast("double").alias("core")
    )
    reached = F.aggregate(
        ordered,
        start,
        lambda s, e: F.struct((s["n"] + e["n"]).alias("n"), F.coalesce(s["core"], F.when(s["n"] + e["n"] >= k, e["far"])).alias("core")),
    )
    return met.select("id", "weight", reached["core"].alias("core"))


def dense_radius(cores: DataFrame, spread: float = 3.0) -> float:
    """The core distance up to which a place is dense.

    Core distances above zero are counted by row in bins of their logarithm. If two groups explain their spread, the
    limit is in the middle of the gap between the two, otherwise it is ``spread`` times the median bin. Zero if all are zero.
    """
    logs = cores.filter("core > 0").select("weight", F.log("core").alias("l"))
    low, high = logs.agg(F.min("l"), F.max("l")).first()
    if low is None:
        return 0.0
    if high - low < 1e-9:
        return math.exp(high) * spread
    place = F.least(F.floor((F.col("l") - low) * BINS / (high - low)), F.lit(BINS - 1)).cast("int")
    counted = np.zeros(BINS)
    for bin_, n in logs.groupBy(place.alias("bin")).agg(F.sum("weight").alias("n")).collect():  # at most 256 rows
        counted[bin_] = n
    edges = low + np.arange(1, BINS + 1) * (high - low) / BINS
    middle = edges - (high - low) / BINS / 2
    share = counted / counted.sum()
    below, sums = np.cumsum(share)[:-1], np.cumsum(share * middle)[:-1]
    mean = (share * middle).sum()
    between = (mean * below - sums) ** 2 / np.maximum(below * (1 - below), 1e-300)
    if between.max() >= APART * (share * (middle - mean) ** 2).sum():
        best = np.flatnonzero(between >= between.max() * (1 - 1e-9))  # equal all along an empty gap
        return float(np.exp((edges[best[0]] + edges[best[-1]]) / 2))
    return float(np.exp(middle[np.searchsorted(np.cumsum(share), 0.5)])) * spread


def _local_clusters(radius: float) -> Callable[[pa.Table], pa.Table]:
    def local(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        x, ids = _stacked(table), table.column("id").combine_chunks()
        cores = table.column("core").to_numpy()
        dense = np.flatnonzero(cores <= radius)  # not so if null
        root, to, far = np.full(len(x), -1, np.int64), np.full(len(x), -1, np.int64), np.full(len(x), np.inf)
        linked = np.zeros((len(dense), len(dense)), bool)
        rank = np.full(len(x), -1, np.int64)
        rank[dense] = np.arange(len(dense))
        for at, squared in _blocks(x):
            if not len(dense):
                break
            reach = np.sqrt(squared[:, dense])
            rows = np.arange(at, at + len(squared))
            inner = rank[rows] >= 0
            linked[rank[rows[inner]]] = reach[inner] <= radius
            best = reach[~inner].argmin(axis=1)  # the first of equals, by id
            to[rows[~inner]], far[rows[~inner]] = dense[best], reach[~inner, best] if len(best) else []
        left = np.ones(len(dense), bool)
        for first in range(len(dense)):
            if left[first]:
                front = np.array([first])
                while len(front):
                    left[front] = False
                    root[dense[front]] = dense[first]
                    front = np.flatnonzero(linked[front].any(axis=0) & left)
        to[far > radius] = -1
        name = lambda at: ids.take(pa.array(at, mask=at < 0))
        return pa.table({"part": table.column("part"), "id": ids, "root": name(root), "to": name(to), "far": pa.array(far)})

    return local


def joined_clusters(local: DataFrame) -> DataFrame:
    """(id, label): clusters of the parts (part, root, id) united where they share an id; the label is the least id.

    A round takes the least label inside each local cluster (no larger than a part), then over the few rows of each id,
    then the label's own label, so chains of parts halve with every round.
    """
    inside, same = Window.partitionBy("part", "root"), Window.partitionBy("id")
    rows = cut_lineage(local.select("part", "root", "id", F.col("root").alias("label")))
    while True:
        least = rows.withColumn("new", F.min("label").over(inside)).withColumn("new", F.min("new").over(same))
        known = least.groupBy(F.col("id").alias("new")).agg(F.min("new").alias("further"))
        moved = least.join(known, "new", "left").select("part", "root", "id", "label", F.coalesce(F.least("new", "further"), "new").alias("new"))
        moved = cut_lineage(moved)
        if moved.filter("new <> label").isEmpty():
            return moved.groupBy("id").agg(F.min("label").alias("label"))
        rows = moved.select("part", "root", "id", F.col("new").alias("label"))


def density_clusters(
    df: DataFrame,
    vec: str,
    neighbours: int = 10,
    min_size: int = 50,
    radius: float | None = None,
    limit: int = 2048,
    orders: int = 4,
    seed: int = 42,
    out: str = "topic",
    strength: str = "topic_prob",
) -> DataFrame:
    """Add the row's cluster by density, numbered from 0 in no order of size (-1: outlier), and its ``strength`` from 0 to 1.

    A row is dense if its ``neighbours``-th nearest other row is within ``radius``, which comes from the core distances
    (``dense_radius``) unless given. Dense rows within the radius of each other share a cluster: its spanning forest is
    grown inside parts of about ``limit`` vectors and joined over ``orders`` partitions of the rows. A row that isn't dense
    joins its nearest dense row within the radius, the first of equals by hash. Clusters of fewer than ``min_size`` rows are
    outliers. Strength is the cluster's least core distance over the row's own (1 for copies that many). Up to ``limit``
    distinct vectors the result is exact; beyond it core distances are from the vectors met in any order, so they may be
    too large, never too small, and two halves of a cluster that meet in no part stay apart.

    One radius holds for all rows: clusters of very different density are told apart only by calls of their own. Repeated
    vectors are one vector with a weight and share their cluster. Null, empty, odd-length and non-finite vectors are
    outliers; an empty table gives no rows; columns of ``df`` keep their values whatever they are called, but ``out``
    and ``strength`` are replaced.
    """
    if neighbours < 1 or limit < 2 or orders < 1:
        raise ValueError("neighbours and orders are at least 1, limit at least 2")
    given = [c for c in df.columns if c not in (out, strength)]
    held = cut_lineage(df.select(F.struct(*given).alias("_row"), F.col(vec).alias("_vec")))
    rows, found = distinct_vectors(held, "_vec")
    vectors = cut_lineage(found)
    parts = cut_lineage(parts_of(vectors, vectors.count(), limit, orders, seed))
    cores = cut_lineage(core_distances(vectors, parts, neighbours))
    within = dense_radius(cores) if radius is None else radius
    local = cut_lineage(
        parts.join(vectors.drop("weight"), "id").join(cores.drop("weight"), "id").groupBy("part")
        .applyInArrow(_local_clusters(within), "part long, id string, root string, to string, far double")
    )
    labels = cut_lineage(joined_clusters(local.filter("root IS NOT NULL")))
    near = local.filter("to IS NOT NULL").groupBy("id").agg(F.min(F.struct("far", "to"))["to"].alias("to"))
    edge = near.join(labels.withColumnRenamed("id", "to"), "to").select("id", "label")
    placed = cut_lineage(labels.unionByName(edge).join(cores, "id"))
    sizes = placed.groupBy("label").agg(F.sum("weight").alias("size"), F.min("core").alias("least"))
    numbered = dense_index(cut_lineage(sizes.filter(F.col("size") >= min_size)), "label", "number").select("label", "number", "least")
    own = F.coalesce(F.when(F.col("core") > 0, F.col("least") / F.col("core")), F.when(F.col("core") == 0, F.lit(1.0)), F.lit(0.0))
    known = lookup_join(placed, cut_lineage(numbered), "label", "inner").select(F.col("id").alias("_v"), "number", own.alias("own"))
    return lookup_join(rows, cut_lineage(known), "_v").select(
        *[F.col("_row")[c].alias(c) for c in given],
        F.coalesce(F.col("number").cast("int"), F.lit(-1)).alias(out),
        F.coalesce("own", F.lit(0.0)).alias(strength),
    )
