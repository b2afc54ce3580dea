"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked by a self-join of binary tries.

A text's A-Z are lower-cased and its words cut into shingles of ``SHINGLE`` words (repeats included, joined by one space;
fewer words are one shingle). Each shingle hashes with XXH64 (seed 42); a fingerprint bit is 1 if it is set in more than
half of the hashes. No words: fingerprint 0, linked like any other.

Distinct fingerprints are the leaves of binary tries. The join goes down two nodes at a time: a pair of nodes becomes the
pairs of their children, children on different sides add one differing bit, and a pair over the budget is cut with all
below it. A pair whose remaining bits fit into the budget is linked whole, and a pair that is linked already is not gone
into, so dense groups of near copies cost no pair of leaves each. To spread the join, the bits are cut into ``budget + 1``
blocks: two fingerprints within the budget agree in one block at least, so one trie is built per block and value of the
block, with the block's bits first, and tries are dealt over tasks. A trie with many leaves is dealt as pairs of
equal chunks. Tasks return a spanning forest, never all pairs; components are found by stars over staged tables.

Defined cases: a null text has no words; null ids take part, and a component's id is its smallest id that is not null;
rows that repeat an id are documents of their own; an empty table gives an empty result; other columns are ignored
(``near_groups``) or carried along (``apply_dedup``, which keeps one row of each component: the one with the smallest id).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audience_engine.llm.common import components, id_key, utf8
from audience_engine.llm.groups import Labels, dealt, group_starts, parts_for, whole_groups
from audience_engine.session import cut_lineage

SHINGLE = 4
BUDGET = 4
BITS = 64
SEED = 42
CHUNK = 2048
_SLICE = 1 << 18
_U = np.uint64


def shingle_hashes(text: bytes | None, n: int = SHINGLE) -> np.ndarray:
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, _U)
    joined = b" ".join(words)
    if len(words) <= n:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], _U)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-n] + 1]).tolist()
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends[n - 1 :].tolist(), strict=True)]), ">u8").astype(_U)


def fingerprint(hashes: np.ndarray) -> int:
    """Each bit as in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without ``text``, plus ``fp``."""
    carried = [c for c in docs.columns if c != "text"]

    def run(batches):
        for batch in batches:
            prints = pa.array([fingerprint(shingle_hashes(t, shingle)) for t in utf8(batch.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), prints], names=[*carried, "fp"])

    return docs.mapInArrow(run, T.StructType(list(docs.select(*carried).schema)).add("fp", "long"))


def blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``budget + 1`` blocks."""
    edges = [-(-BITS * i // (budget + 1)) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


class TrieJoin:
    """Links within ``budget`` bits among values that are sorted inside each root's range."""

    def __init__(self, values: np.ndarray, budget: int):
        self.values, self.budget = values, budget
        self.labels = Labels(len(values))
        self._zeros: dict[int, np.ndarray] = {}
        self._changes: np.ndarray | None = None

    def _split(self, depth: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Where the ones begin in each node at ``depth``."""
        if depth not in self._zeros:
            bit = ((self.values >> _U(BITS - 1 - depth)) & _U(1)) == 0
            self._zeros[depth] = np.concatenate([[0], np.cumsum(bit)]).astype(np.int32)
        zeros = self._zeros[depth]
        return low + zeros[high] - zeros[low]

    def _linked(self, a0, a1, b0, b1) -> np.ndarray:
        """Which pairs of nodes are in one set already."""
        label = self.labels.label
        if self._changes is None:
            self._changes = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        same = self._changes[a1 - 1] == self._changes[a0]
        return same & (self._changes[b1 - 1] == self._changes[b0]) & (label[a0] == label[b0])

    def _link(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.labels.link(a, b)
            self._changes = None

    def run(self, depth: np.ndarray, a0, a1, b0, b1) -> np.ndarray:
        """Joins the pairs of roots [a0, a1) x [b0, b1), both at ``depth``; a root may be paired with itself."""
        stack = []
        for d in np.unique(depth).tolist():
            at = depth == d
            stack.append((d, a0[at], a1[at], b0[at], b1[at], np.zeros(int(at.sum()), np.int64)))
        while stack:
            d, a0, a1, b0, b1, off = stack.pop()
            if len(a0) > _SLICE:
                half = len(a0) // 2
                stack += [(d, *(x[half:] for x in (a0, a1, b0, b1, off))), (d, *(x[:half] for x in (a0, a1, b0, b1, off)))]
                continue
            single = (a1 - a0 == 1) & (b1 - b0 == 1)
            if single.any():
                x, y = a0[single], b0[single]
                near = np.bitwise_count(self.values[x] ^ self.values[y]) <= self.budget
                self._link(x[near], y[near])
            near = ~single & (off + BITS - d <= self.budget)
            if near.any():
                self._whole(a0[near], a1[near], b0[near], b1[near])
            go = ~single & ~near
            go[go] = ~self._linked(a0[go], a1[go], b0[go], b1[go])
            if not go.any():
                continue
            a0, a1, b0, b1, off = (x[go] for x in (a0, a1, b0, b1, off))
            am, bm = self._split(d, a0, a1), self._split(d, b0, b1)
            cross, own = off < self.budget, a0 == b0
            apart = cross & ~own
            below = []
            # one piece of work for all children, so that a level costs few steps; those that add no bit come first
            for x0, x1, y0, y1, o, which in (
                (a0, am, b0, bm, off, None),
                (am, a1, bm, b1, off, None),
                (a0, am, bm, b1, off + 1, cross),
                (am, a1, b0, bm, off + 1, apart),
            ):
                keep = (x1 > x0) & (y1 > y0) & ~((x0 == y0) & (x1 - x0 == 1))
                keep = keep if which is None else keep & which
                below.append([v[keep] for v in (x0, x1, y0, y1, o)])
            stack.append((d + 1, *(np.concatenate(parts) for parts in zip(*below, strict=True))))
        return self.labels.label

    def _whole(self, a0, a1, b0, b1) -> None:
        """Everything in a node, and the two nodes of a pair, are within the budget."""
        for low, high in ((a0, a1), (b0, b1)):
            sizes = high - low
            first = np.repeat(low, sizes)
            place = np.arange(len(first)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first
            self._link(first, place)
        self._link(a0, b0)


def forest(prints: DataFrame, budget: int = BUDGET, chunk: int = CHUNK) -> DataFrame:
    """``a``, ``b``: a spanning forest of the links among distinct fingerprints ``fp``, task by task."""
    cuts = blocks(budget)
    groups = F.array(
        *[
            F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(F.shiftleft("fp", first), BITS - n).alias("value"))
            for b, (first, n) in enumerate(cuts)
        ]
    )
    rows = prints.select("fp", F.explode(groups).alias("g")).select("fp", "g.block", "g.value")
    sizes = rows.groupBy("block", "value").agg(F.count("*").alias("n"))
    total = cut_lineage(sizes)
    mean, number = total.agg(F.coalesce(F.avg("n"), F.lit(0.0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    chunk = max(chunk, int(4 * mean))
    hot = cut_lineage(total.filter(F.col("n") > chunk).withColumn("_chunks", F.ceil(F.col("n") / chunk)).drop("n"))
    rows = rows.join(hot, ["block", "value"], "left")
    tasks = dealt(rows, ["block", "value"], F.coalesce("_chunks", F.lit(1)), F.xxhash64("fp"), parts_for(number)).drop("_chunks")
    firsts = np.array([c[0] for c in cuts])
    bits = np.array([c[1] for c in cuts])

    def run(batches):
        for table in whole_groups(batches, ["block", "value", "_i", "_j"]):
            block = np.asarray(table.column("block")).astype(np.int64)
            fp = np.asarray(table.column("fp")).view(_U)
            turn = firsts[block].astype(_U)
            turned = (fp << turn) | np.where(turn > 0, fp >> ((_U(64) - turn) % _U(64)), _U(0))
            sides = ["block", "value", "_i", "_j", "_own"]
            starts = group_starts(table, sides)
            order = np.lexsort((turned, np.repeat(np.arange(len(starts)), np.diff([*starts, len(fp)]))))
            fp, turned = fp[order], turned[order]
            stops = np.concatenate([starts[1:], [len(fp)]])
            task = np.column_stack([np.asarray(table.column(c))[starts] for c in ("block", "value", "_i", "_j")])
            own = task[:, 2] == task[:, 3]
            pair = np.flatnonzero((task[1:] == task[:-1]).all(axis=1))  # both sides of one task
            a = np.concatenate([np.flatnonzero(own), pair])
            b = np.concatenate([np.flatnonzero(own), pair + 1])
            join = TrieJoin(turned, budget)
            label = join.run(bits[block[starts[a]]], starts[a], stops[a], starts[b], stops[b])
            linked = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([pa.array(fp[linked].view(np.int64)), pa.array(fp[label[linked]].view(np.int64))], names=["a", "b"])

    return tasks.mapInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET, chunk: int = CHUNK) -> DataFrame:
    """``docs`` without ``text``, plus ``fp`` and ``component`` (the smallest ``doc_id`` of its component)."""
    rows = cut_lineage(fingerprints(docs, shingle))
    prints = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = cut_lineage(components(cut_lineage(forest(prints, budget, chunk))))
    rooted = cut_lineage(prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = cut_lineage(rooted.groupBy("root").agg(F.min("least").alias("component")))
    named = cut_lineage(rooted.select("fp", "root").join(least, "root").select("fp", "component"))
    return rows.join(named, "fp")


def apply_dedup(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET, chunk: int = CHUNK) -> DataFrame:
    """One row of each component with all its columns: the smallest id (null last), then the smallest hash of the row."""
    names = docs.columns
    row = F.struct(*[f"`{c}`" for c in names])
    keyed = docs.select(id_key("doc_id").alias("_d"), F.xxhash64(*[F.col(f"`{c}`") for c in names]).alias("_h"), F.col("text"), row.alias("_row"))
    rows = cut_lineage(fingerprints(keyed.select("_d", "_h", "text", F.col("_row.doc_id").alias("doc_id")), shingle))
    prints = cut_lineage(rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "_d", "_h")).alias("first")))
    roots = cut_lineage(components(cut_lineage(forest(prints, budget, chunk))))
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    stays = cut_lineage(rooted.groupBy("root").agg(F.min("first").alias("first")).select("first._d", "first._h"))
    equal = F.row_number().over(Window.partitionBy("_d", "_h").orderBy(F.lit(0)))
    kept = keyed.select("_d", "_h", "_row").join(stays, ["_d", "_h"])
    return kept.withColumn("_equal", equal).filter("_equal = 1").select("_row.*")
