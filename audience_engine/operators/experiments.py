"""A/B log, winners and epsilon-greedy assignment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audience_engine.functions import scoring
from audience_engine.functions.clock import instant
from audience_engine.functions.drafts import short_id
from audience_engine.operators.joining import dense_index, lookup_join, top_per_group

METRICS = ("replies", "likes", "ctr")


def enrol_variants(cands: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Log rows for candidates: a post id each, the time, and blank metrics."""
    return cands.select(
        F.concat(F.lit("local_"), short_id("variant_id", "topic", "variant_text", F.lit(as_of.isoformat()))).alias("post_id"),
        "topic",
        "variant_id",
        "variant_text",
        instant(as_of).alias("ts"),
        F.lit(None).cast("long").alias("replies"),
        F.lit(None).cast("long").alias("likes"),
        F.lit(None).cast("double").alias("ctr"),
    )


def record_metrics(log: DataFrame, updates: DataFrame, order: str = "ts") -> DataFrame:
    """The log with the updates of each post, applied in time order, written to all its rows.

    Each update replaces replies and likes (0 when not given), and the click rate only when it gives one, so the last
    given rate stays.
    """
    place = F.struct(order, *METRICS)
    last = updates.groupBy("post_id").agg(
        F.lit(True).alias("_new"),
        F.max_by(F.struct("replies", "likes"), place).alias("_last"),
        F.max_by("ctr", F.when(F.col("ctr").isNotNull(), place)).alias("_ctr"),
    )
    last = last.select("post_id", "_new", F.col("_last.replies").alias("_replies"), F.col("_last.likes").alias("_likes"), "_ctr")
    joined = lookup_join(log, last, "post_id")
    new = F.col("_new").isNotNull()
    return joined.withColumns(
        {
            "replies": F.when(new, F.coalesce("_replies", F.lit(0).cast("long"))).otherwise(F.col("replies")),
            "likes": F.when(new, F.coalesce("_likes", F.lit(0).cast("long"))).otherwise(F.col("likes")),
            "ctr": F.coalesce("_ctr", "ctr"),
        }
    ).select(*log.columns)


def unscored(log: DataFrame) -> DataFrame:
    """Log rows without a click rate."""
    return log.filter(F.col("ctr").isNull() | (F.col("ctr").cast("string") == ""))


def pick_winner(log: DataFrame, by: str | None = None) -> DataFrame:
    """The row with the highest click rate, overall or per ``by``; the earliest row wins a tie."""
    ranked = log.withColumn("score", scoring.ctr_value("ctr"))
    order = [F.col("score").desc(), F.col("ts"), F.col("post_id"), F.col("variant_id")]
    if by is None:
        return ranked.orderBy(*order).limit(1)
    return top_per_group(ranked, [by], order, 1)


def variant_averages(log: DataFrame) -> DataFrame:
    """Mean click rate, and mean likes cut to a whole number."""
    return log.agg(
        F.round(F.avg("ctr"), 4).alias("avg_ctr"), F.avg("likes").cast("long").alias("avg_likes")
    )


def rank_candidates(cands: DataFrame, n: int | None = 5, text: str = "variant_text") -> DataFrame:
    """Candidates by offline score, best first."""
    scored = cands.withColumn("score", scoring.rank_score(text)).withColumn("reason", F.lit("heuristic"))
    ranked = scored.orderBy(F.col("score").desc(), "variant_id")
    return ranked if n is None else ranked.limit(n)


def lookup_variant(variants: DataFrame, ids: DataFrame) -> DataFrame:
    """The variants with the given ids."""
    return lookup_join(variants, ids.select("variant_id"), "variant_id", "left_semi")


def log_prediction(cands: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The best-ranked candidate as a log row without metrics."""
    return rank_candidates(cands, 1).select(
        F.concat(F.lit("pred_"), short_id("variant_id", F.lit(as_of.isoformat()))).alias("post_id"),
        "topic",
        "variant_id",
        "variant_text",
        F.lit(None).cast("timestamp_ntz").alias("ts"),
        F.lit(None).cast("long").alias("replies"),
        F.lit(None).cast("long").alias("likes"),
        F.lit(None).cast("double").alias("ctr"),
    )


def assign_variants(
    events: DataFrame,
    variants: DataFrame,
    scores: DataFrame,
    eps: float = 0.1,
    seed: int = 42,
    key: str = "event_id",
    kept: Sequence[str] = ("variant_id", "variant_text"),
) -> DataFrame:
    """Epsilon-greedy choice of a variant for each event, repeatable for a seed.

    A share ``eps`` of the events explores: a hash of its key picks any variant. The others get the best-scored
    variant; a missing or bad score counts as 0, the first id wins a tie. Without scores, or when the best id is not
    among the variants, every event explores. Without variants the query fails.
    """
    ranked = scores.orderBy(scoring.ctr_value("score").desc(), "variant_id").limit(1)
    best = lookup_variant(variants, ranked).groupBy().agg(F.min(F.struct(*kept)).alias("best")).select("best").scalar()
    size = variants.agg(F.count("*")).scalar()
    some = F.when(size > 0, F.lit(True)).otherwise(F.raise_error(F.lit("there are no variants to assign")).cast("boolean"))

    def draw(tag: str) -> Column:
        return scoring.unit_hash(F.col(key).cast("string"), F.lit(str(seed)), F.lit(tag))

    drawn = events.filter(some).withColumn("_best", best).withColumn("explored", F.col("_best").isNull() | (draw("explore") < F.lit(eps)))
    # exploiters need no variant row: their negative places join nothing and are spread over all tasks
    nowhere = F.lit(-1) - F.pmod(F.xxhash64(key), F.lit(1 << 20))
    placed = drawn.withColumn("_index", F.when(F.col("explored"), F.floor(draw("pick") * size)).otherwise(nowhere))
    numbered = dense_index(variants.select(*kept), "variant_id", "_index").withColumnsRenamed({c: f"_{c}" for c in kept})
    joined = lookup_join(placed, numbered, "_index")
    chosen = {c: F.when(F.col("explored"), F.col(f"_{c}")).otherwise(F.col("_best")[c]) for c in kept}
    return joined.withColumns(chosen).select(*events.columns, "explored", *kept)
