"""Near copies by word shingles: texts whose sets of ``SHINGLE`` words have a Jaccard similarity of ``THRESHOLD`` or more.

Candidates come in two ways. Each set has the SimHash fingerprint of ``simhash``, and the binary tries of that module link
fingerprints of at most ``BUDGET`` differing bits. That alone misses most pairs: at a similarity of 0.8 two fingerprints differ
in 10 bits on average and up to 17 bits are needed for a recall of 0.99, where a join by blocks of equal bits compares almost
all pairs. So sets that share a min-hash key are candidates too: a set's ``BANDS`` keys each hash ``ROWS`` minima. At a
similarity of exactly 0.8 two sets share a key with probability 0.9993, above it more often. Both kinds of links make up the
candidate groups (no pair is formed for that).

Inside a group every pair is decided by the exact similarity of the two sets; pairs that are linked already are left out.
A group of more than ``CHUNK`` sets is cut by hash, and each part is linked together with the group's smallest set. What is
not connected with that one afterwards (an open set) meets all of its group in a second round, so that a large group of
copies costs little more than one comparison each. Links are a forest; components are found by stars over staged tables.

Defined cases: words and shingles as in ``simhash`` (fewer words than ``SHINGLE`` are one shingle), but a set holds each
shingle once; texts without words are copies of one another, as are all texts with equal sets; null ids take part; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from audience_engine.llm.common import components, id_key, mixed, sliced, utf8
from audience_engine.llm.groups import Labels, group_starts, parts_for, whole_groups
from audience_engine.llm.simhash import BUDGET, fingerprint, forest, shingle_hashes
from audience_engine.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
ROWS, BANDS = 8, 40
SEED = 20_241
CHUNK = 512
_SLICE = 512
_U = np.uint64
_DRAW = np.random.Generator(np.random.PCG64(SEED)).integers(0, 2**64, (2, ROWS * BANDS), np.uint64)
_FLIP, _TIMES = _DRAW[0], _DRAW[1] | _U(1)


def shingle_set(text: bytes | None, n: int = SHINGLE) -> np.ndarray:
    return np.unique(shingle_hashes(text, n))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; none for an empty set."""
    if not len(hashes):
        return np.empty(0, _U)
    least = np.full(ROWS * BANDS, 2**64 - 1, _U)
    for at in range(0, len(hashes), _SLICE):
        least = np.minimum(least, ((hashes[at : at + _SLICE, None] ^ _FLIP) * _TIMES).min(axis=0))
    key = least.reshape(BANDS, ROWS)
    while key.shape[1] > 1:
        key = mixed(key[:, ::2], key[:, 1::2])
    return mixed(key[:, 0], np.arange(1, BANDS + 1, dtype=_U))


def linked(sets: list[np.ndarray], threshold: float = THRESHOLD) -> np.ndarray:
    """A label for each of ``sets``: equal for those that a chain of links connects."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    order = np.argsort(size, kind="stable")
    size, labels = size[order], Labels(len(sets))
    for i in range(len(sets)):
        own = sets[order[i]]
        # a pair's similarity is its sizes' ratio at most
        others = np.arange(i + 1, np.searchsorted(size, size[i] / threshold + 1e-6, "right"))
        others = others[labels.label[others] != labels.label[i]]
        for at in range(0, len(others), _SLICE):
            part = others[at : at + _SLICE]
            values = np.concatenate([sets[k] for k in order[part]])
            hit = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
            common = np.add.reduceat(hit, np.cumsum(size[part]) - size[part], dtype=np.int64)
            near = part[common / (size[i] + size[part] - common) >= threshold]
            labels.link(np.full(len(near), i), near)
    out = np.empty(len(sets), np.int64)
    out[order] = order[labels.label]
    return out


def _sketched(keyed: DataFrame, shingle: int) -> DataFrame:
    """``node`` (128-bit hash of a text's set), ``c`` (its first half), ``bands`` and ``fp`` of the set, with the row's keys."""
    carried = ["no_id", "_d", "_h"]

    def run(batches):
        for batch in sliced(batches):
            nodes, bands, prints = [], [], []
            for text in utf8(batch.column("text")):
                own = shingle_set(text, shingle)
                nodes.append(xxhash.xxh3_128_digest(own.tobytes()))
                bands.append(band_keys(own).view(np.int64))
                prints.append(fingerprint(own))
            halves = np.frombuffer(b"".join(n[:8] for n in nodes), np.int64)
            columns = [pa.array(nodes, pa.binary()), pa.array(halves), pa.array(bands, pa.list_(pa.int64())), pa.array(prints, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *columns], names=[*carried, "node", "c", "bands", "fp"])

    return keyed.select(*carried, "text").mapInArrow(run, "no_id boolean, _d long, _h long, node binary, c long, bands array<long>, fp long")


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    def run(batches):
        for batch in sliced(batches):
            sets = pa.array([shingle_set(t, shingle).tobytes() for t in utf8(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("g"), batch.column("node"), sets], names=["g", "node", "set"])

    return texts.select("g", "node", "text").mapInArrow(run, "g long, node binary, set binary")


def _linked_in(tasks: DataFrame, keys: list[str], parts: int, threshold: float) -> DataFrame:
    """``a``, ``b``: a forest of the links among the sets of each task."""

    def run(batches):
        for table in whole_groups(batches, keys, 1 << 12):
            starts = [*group_starts(table, keys).tolist(), table.num_rows]
            node, data = table.column("node").to_pylist(), table.column("set")
            a, b = [], []
            for low, high in zip(starts, starts[1:], strict=False):
                label = linked([np.frombuffer(s, _U) for s in data.slice(low, high - low).to_pylist()], threshold)
                for i in np.flatnonzero(label != np.arange(len(label))).tolist():
                    a.append(node[low + i])
                    b.append(node[low + int(label[i])])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    laid = tasks.select(*keys, "node", "set").repartition(parts, *keys).sortWithinPartitions(*keys)
    return laid.mapInArrow(run, "a binary, b binary")


def fingerprint_links(classes: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``a``, ``b``: links (as ``c``) that connect the sets whose fingerprints differ in at most ``budget`` bits."""
    prints = cut_lineage(classes.groupBy("fp").agg(F.min("c").alias("m")))
    equal = classes.join(prints, "fp").filter("c <> m").select(F.col("c").alias("a"), F.col("m").alias("b"))
    near = cut_lineage(forest(prints.select("fp"), budget))
    one, other = (prints.select(F.col("fp").alias(side), F.col("m").alias(f"_{side}")) for side in ("a", "b"))
    return equal.unionByName(near.join(one, "a").join(other, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))


def candidate_groups(classes: DataFrame) -> DataFrame:
    """``c``, ``g``: the group of each set that shares a key with another one, or whose fingerprint lies near another one's."""
    each = classes.select("c", F.explode("bands").alias("key"))
    least = each.groupBy("key").agg(F.min("c").alias("m"), F.count("*").alias("n")).filter("n > 1").drop("n")
    keyed = each.join(cut_lineage(least), "key").filter("c <> m").select(F.col("c").alias("a"), F.col("m").alias("b"))
    edges = cut_lineage(keyed.unionByName(fingerprint_links(classes)).distinct())
    return cut_lineage(components(edges)).select(F.col("node").alias("c"), F.col("root").alias("g"))


def links(sets: DataFrame, threshold: float = THRESHOLD, chunk: int = CHUNK) -> DataFrame:
    """``a``, ``b``: links that connect what the similar pairs inside each group ``g`` of ``sets`` connect."""
    sizes = sets.groupBy("g").agg(F.min("node").alias("least"), F.count("*").alias("n"))
    sizes = cut_lineage(sizes.withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int")))
    parts = parts_for(8 * (sizes.agg(F.sum("n")).first()[0] or 0))
    placed = sets.join(sizes.drop("n"), "g").withColumn("i", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    everywhere = F.sequence(F.lit(0), F.col("chunks") - 1)
    own = placed.withColumn("i", F.explode(F.when(F.col("node") == F.col("least"), everywhere).otherwise(F.array("i"))))
    first = cut_lineage(_linked_in(own, ["g", "i"], parts, threshold))
    large = sizes.filter("chunks > 1")
    if large.first() is None:
        return first
    roots = cut_lineage(components(first))
    tops = large.join(roots.withColumnRenamed("node", "least"), "least", "left").select("g", F.coalesce("root", "least").alias("top"))
    state = placed.filter("chunks > 1").join(roots, "node", "left").join(tops, "g")
    state = cut_lineage(state.withColumn("open", F.coalesce("root", "node") != F.col("top")).drop("root", "top", "least"))
    opened = cut_lineage(state.filter("open").groupBy("g").agg(F.ceil(F.count("*") / chunk).cast("int").alias("cuts")))
    rest = state.join(opened, "g").withColumn("k", F.pmod(F.xxhash64("node", F.lit(1)), F.col("cuts")).cast("int"))
    met = rest.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    meets = rest.filter("open").withColumn("i", F.explode(everywhere))
    return first.unionByName(_linked_in(met.unionByName(meets), ["g", "k", "i"], parts, threshold))


def apply_dedup(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, chunk: int = CHUNK) -> DataFrame:
    """One row of each component with all its columns: the smallest id (null last), then the smallest hash of the row."""
    names = docs.columns
    row = F.struct(*[f"`{c}`" for c in names])
    keyed = docs.select(id_key("doc_id").alias("_d"), F.xxhash64(*[F.col(f"`{c}`") for c in names]).alias("_h"), F.col("text"), row.alias("_row"))
    rows = _sketched(keyed.withColumn("no_id", F.col("_row.doc_id").isNull()), shingle)
    first = F.min(F.struct("no_id", "_d", "_h")).alias("first")
    classes = cut_lineage(rows.groupBy("node", "c").agg(first, F.first("bands").alias("bands"), F.first("fp").alias("fp")))
    members = cut_lineage(classes.join(candidate_groups(classes), "c").select("g", "node", "first._d", "first._h"))
    sets = cut_lineage(_sets(keyed.select("_d", "_h", "text").join(members, ["_d", "_h"]), shingle).dropDuplicates(["g", "node"]))
    roots = cut_lineage(components(cut_lineage(links(sets, threshold, chunk))))
    rooted = classes.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    stays = cut_lineage(rooted.groupBy("root").agg(F.min("first").alias("first")).select("first._d", "first._h"))
    equal = F.row_number().over(Window.partitionBy("_d", "_h").orderBy(F.lit(0)))
    kept = keyed.select("_d", "_h", "_row").join(stays, ["_d", "_h"])
    return kept.withColumn("_equal", equal).filter("_equal = 1").select("_row.*")
