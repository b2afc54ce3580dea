"""Mixing sources to target weights by entropy balancing.

Sources, in code point order with null last, weigh 3, 1, 2, 3, 1, 2, ... and share ``share`` of all words. A target
stops at ``cap`` times its source's words; what is above is shared again by weight until none is above. Among all
document rates between 0 and ``cap`` that meet a source's target, those with the least entropy relative to 1 are
``min(cap, exp(lambda * words / mean words))``; the lambdas solve a convex dual by Newton steps, each step one
aggregation over counts of (source, words), and all sources at once. A step that leaves the bracket of the root is
replaced by its middle.

Rates become copies without chance: a source's documents are lined up by size, and the running sum of their fractional
copies, rounded, says how many of each size get one copy more; a hash of id and text says which. So a source's words miss
its target by at most one document's words, and reruns agree.

Hot groups: sums come from (source, words) counts, which are aggregated before the shuffle. Rows of one id and text are
one class with a count, however many they are: the class takes its share of the extra copies at once. Classes of one size
are numbered in hashed parts of at most about a million rows, so no task sorts all documents of a source or a size; rows
without words are not numbered. A class becomes rows again in blocks of ``BLOCK``, each of which may go to its own task.

Defined cases: a null text has 0 words and no copies; a null source is a source of its own; a source without words has
target 0; rows that repeat an id are documents of their own; of equal rows,
which are alike, any take the extra copies; a very long text is a document with a large size; an empty table gives an empty result; other columns are
ignored (``mix``) or carried along (``apply_mix``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from audience_engine.llm.common import WORD, id_key, text_key
from audience_engine.session import cut_lineage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
PARTS, PART_ROWS = 256, 1_000_000
BLOCK = 100_000
TOLERANCE = 1e-9
_STEPS = 60


def word_count(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> dict:
    """Source to target words; ``sizes`` maps each source (None allowed) to its words."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= cap * sizes[s]}
        if not full:
            out.update({s: left * weight[s] / total for s in open_})
            break
        out.update({s: cap * sizes[s] for s in full})
        left -= sum(cap * sizes[s] for s in full)
        open_ -= full
    return {s: float(out[s]) for s in order}


def _sources(sizes: DataFrame, weights, share: float, cap: float) -> DataFrame:
    """``_s``, ``source_size``, ``mean``, ``target``: one row per source; the list of sources is small (checked)."""
    rows = sizes.groupBy("_s").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("n")).collect()
    if len(rows) > 1_000_000:
        raise ValueError("more than a million sources: group them first")
    by = {r["_s"][1:] if r["_s"] else None: r for r in rows}
    goal = targets({s: int(r["words"]) for s, r in by.items()}, weights, share, cap)
    out = [(r["_s"], int(r["words"]), r["words"] / r["n"], goal[s]) for s, r in by.items()]
    return sizes.sparkSession.createDataFrame(out, "_s string, source_size long, mean double, target double")


def balance(sizes: DataFrame, sources: DataFrame, cap: float = CAP) -> DataFrame:
    """Adds ``rate`` to the (source, words) classes ``sizes`` (``_s``, ``size``, ``n``)."""
    spark = sizes.sparkSession
    classes = cut_lineage(sizes.filter("size > 0").join(sources, "_s"))
    state = {r["_s"]: [0.0, None, None] for r in sources.collect() if 0 < r["target"] < cap * r["source_size"]}
    done: dict[str, float] = {}
    for _ in range(_STEPS):
        if not state:
            break
        tilts = spark.createDataFrame([(s, v[0]) for s, v in state.items()], "_s string, tilt double")
        z = F.col("size") / F.col("mean")
        rate = F.least(F.lit(cap), F.exp(F.least(F.col("tilt") * z, F.lit(50.0))))
        slope = F.when(rate < cap, rate * z).otherwise(0.0)
        sums = (
            classes.join(F.broadcast(tilts), "_s")  # one row per source, checked above
            .groupBy("_s")
            .agg(F.sum(F.col("n") * F.col("size") * rate).alias("got"), F.sum(F.col("n") * F.col("size") * slope).alias("slope"), F.first("target").alias("target"))
            .collect()
        )
        for r in sums:
            tilt, low, high = state[r["_s"]]
            miss = r["got"] - r["target"]
            if abs(miss) <= TOLERANCE * r["target"]:
                done[r["_s"]] = state.pop(r["_s"])[0]
                continue
            low, high = (tilt, high) if miss < 0 else (low, tilt)
            step = tilt - miss / r["slope"] if r["slope"] > 0 else None
            if step is None or (low is not None and step <= low) or (high is not None and step >= high):
                step = (low + high) / 2 if low is not None and high is not None else (tilt * 2 + 1 if miss < 0 else tilt * 2 - 1)
            if step == tilt:
                done[r["_s"]] = state.pop(r["_s"])[0]
            else:
                state[r["_s"]] = [step, low, high]
    done.update({s: v[0] for s, v in state.items()})
    solved = spark.createDataFrame([(s, float(f"{v:.10g}")) for s, v in done.items()], "_s string, tilt double")
    at_cap = F.when(F.col("target") > 0, F.lit(cap)).otherwise(0.0)
    solution = F.least(F.lit(cap), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(50.0))))
    return classes.join(F.broadcast(solved), "_s", "left").withColumn("rate", F.coalesce(solution, at_cap))


def _copies(rows: DataFrame, carry: tuple[str, ...], weights, share: float, cap: float) -> tuple[DataFrame, DataFrame]:
    """(classes, sources): each class of equal ``rows`` has ``n`` rows with ``whole`` copies, ``extra`` of which have one more."""
    counted = cut_lineage(rows.groupBy(*carry, "_d", "_t", "_s", "size").agg(F.count("*").alias("n")))
    parts = max(PARTS, -(-(counted.agg(F.sum("n")).first()[0] or 0) // PART_ROWS))
    counted = counted.withColumn("_part", F.pmod(F.xxhash64("_d", "_t"), F.lit(parts)).cast("int"))
    cells = cut_lineage(counted.groupBy("_s", "size", "_part").agg(F.sum("n").alias("n")))
    sizes = cells.groupBy("_s", "size").agg(F.sum("n").alias("n"))
    sources = _sources(sizes, weights, share, cap)
    classes = balance(sizes, sources, cap)
    rate = F.round("rate", 10)
    fraction = F.col("n") * (rate - F.floor(rate))
    run = Window.partitionBy("_s").orderBy("size")
    upto = F.floor(F.sum(fraction).over(run) + 0.5)
    before = F.floor(F.coalesce(F.sum(fraction).over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) + 0.5)
    quota = classes.select("_s", "size", F.floor(rate).alias("whole"), (upto - before).cast("long").alias("more"))
    within = Window.partitionBy("_s", "size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.filter("size > 0").withColumn("start", F.coalesce(F.sum("n").over(within), F.lit(0)))
    plan = cut_lineage(starts.join(quota, ["_s", "size"]).drop("n"))
    ahead = Window.partitionBy("_s", "size", "_part").orderBy(F.xxhash64("_t", "_d"), "_d", "_t").rowsBetween(Window.unboundedPreceding, -1)
    numbered = counted.filter("size > 0").withColumn("_ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).join(plan, ["_s", "size", "_part"])
    extra = F.greatest(F.least(F.col("more") - F.col("start") - F.col("_ahead"), F.col("n")), F.lit(0))
    names = [*carry, "_d", "_t", "_s", "size", "n"]
    empty = counted.filter("size = 0").select(*names, F.lit(0).cast("long").alias("whole"), F.lit(0).cast("long").alias("extra"))
    return cut_lineage(numbered.select(*names, F.col("whole").cast("long"), extra.cast("long").alias("extra")).unionByName(empty)), sources


def _unfolded(classes: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` (at least 1) times, numbered from 1 by ``_i``; long series are dealt over tasks by blocks."""
    n = F.col(times)
    few = classes.filter(n <= BLOCK).withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), n)))
    blocks = classes.filter(n > BLOCK).withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / BLOCK))))
    first, last = F.col("_b") * BLOCK + 1, F.least((F.col("_b") + 1) * BLOCK, n)
    many = blocks.repartition("_d", "_t", "_b").withColumn("_i", F.explode(F.sequence(first, last))).drop("_b")
    return few.unionByName(many)


def _source_key() -> F.Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` (of its source), ``copies``, ``taken`` of each row."""
    sized = docs.select(
        "doc_id", id_key("doc_id").alias("_d"), text_key("text").cast("long").alias("_t"), _source_key().alias("_s"), word_count("text").alias("size")
    )
    out, sources = _copies(sized, ("doc_id",), weights, share, cap)
    copies = (F.col("whole") + F.when(F.col("_i") <= F.col("extra"), 1).otherwise(0)).cast("int")
    out = _unfolded(out.join(F.broadcast(sources), "_s"), "n").withColumn("copies", copies)  # one row per source, checked
    return out.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def apply_mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; rows equal in all columns share their copies."""
    names = docs.columns
    held = docs.select(
        id_key("doc_id").alias("_d"), F.xxhash64(*[F.col(f"`{c}`") for c in names]).alias("_t"), F.struct(*[f"`{c}`" for c in names]).alias("_row")
    )
    sized = docs.select(
        id_key("doc_id").alias("_d"), F.xxhash64(*[F.col(f"`{c}`") for c in names]).alias("_t"), _source_key().alias("_s"), word_count("text").alias("size")
    )
    out, _ = _copies(sized, (), weights, share, cap)
    taken = cut_lineage(out.select("_d", "_t", (F.col("n") * F.col("whole") + F.col("extra")).alias("_n")).filter("_n > 0"))
    # equal in all columns: one stands for all; they meet in the map tasks, and the texts are shuffled once, for this and the join
    one = held.groupBy("_d", "_t").agg(F.first("_row").alias("_row"))
    return _unfolded(one.join(taken, ["_d", "_t"]), "_n").select("_row.*")
