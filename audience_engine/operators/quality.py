"""Comment cleaning and its data-quality log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from audience_engine import vocabulary as voc
from audience_engine.functions import scoring, text
from audience_engine.settings import Settings


def _density(settings: Settings) -> Column:
    return scoring.engagement_density(
        "likes_or_score", "reply_count", "creator_heart_or_awards", "created_utc", settings.as_of
    )


#: Reasons that drop a row but are not logged.
UNLOGGED = ("short_text", "ed_unknown")


def _checks(settings: Settings, t: Column) -> dict[str, Column]:
    """The failing condition of each reason on the text ``t``, never null, in the order in which they are applied."""
    lang, toxic, density, signal = voc.DQ_REASONS
    value = _density(settings)
    return {
        "short_text": ~text.longer_than(t, settings.min_chars),
        lang: ~text.is_english(t, settings.ascii_ratio),
        toxic: text.toxicity(t, settings.toxic_words) > settings.max_toxicity,
        density: F.coalesce(value < settings.min_density, F.lit(False)),
        "ed_unknown": F.isnull(value),
        signal: ~(text.has_signal(t, settings.signal_phrases) | text.has_hashtag(t)),
    }


def first_fail(settings: Settings) -> Column:
    """Why a row is dropped: the reason of its first failing check, or null for a row that stays."""
    return reduce(lambda out, check: out.when(check[1], F.lit(check[0])), _checks(settings, F.col("text")).items(), F.when(F.lit(False), F.lit("")))


def score(df: DataFrame, settings: Settings) -> DataFrame:
    """Add language, toxicity, sentiment, hashtags, signals and engagement density."""
    return df.withColumns(
        {
            "lang": F.when(text.is_english("text", settings.ascii_ratio), F.lit("en")).otherwise(F.lit("other")),
            "toxicity_score": text.toxicity("text", settings.toxic_words),
            "sentiment_score": text.rule_sentiment("text", settings.positive_words, settings.negative_words),
            "hashtags": text.hashtags("text"),
            "marketing_signals": text.marketing_signals("text", settings.signal_phrases),
            "engagement_density": _density(settings),
        }
    )


def clean(df: DataFrame, settings: Settings) -> DataFrame:
    """The rows that pass every check, scored.

    The checks do not depend on each other, so the ones on numbers run before those that search the text.
    """

    def fails(t: Column, numbers: bool) -> Column:
        on_numbers = (voc.DQ_REASONS[2], "ed_unknown")
        return reduce(or_, [check for reason, check in _checks(settings, t).items() if (reason in on_numbers) == numbers])

    kept = ~fails(F.col("text"), True) & text.evaluate_once(F.col("text"), lambda t: ~fails(t, False))
    return score(df.filter(kept), settings)


def platform_spine(df: DataFrame, platforms: Sequence[str], name: str = "platform") -> DataFrame:
    """One row per reported platform."""
    return df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(p) for p in platforms])).alias(name))


def dq_log(df: DataFrame, settings: Settings, platforms: Sequence[str], platform: str = "platform") -> DataFrame:
    """Dropped rows per platform and reason, each counted among the rows that the earlier checks left."""
    reasons = voc.DQ_REASONS
    counted = (
        # never null: a null-check on the join key would repeat every text check ahead of the count
        df.select(F.col(platform).alias("platform"), F.coalesce(first_fail(settings), F.lit("kept")).alias("reason"))
        .groupBy("platform", "reason")
        .agg(F.count("*").alias("count"))
    )
    spine = platform_spine(df, platforms).withColumn("reason", F.explode(F.array(*[F.lit(r) for r in reasons])))
    # both sides hold at most one row per reported platform and reason
    return spine.join(counted.filter(F.col("platform").isin(*platforms)), ["platform", "reason"], "left").select(
        "platform", "reason", F.coalesce("count", F.lit(0)).alias("count")
    )


def observe_counts(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Row counts taken while the data passes, without a pass of their own."""
    observation = Observation(name)
    return df.observe(observation, F.count("*").alias("rows"), *[m.alias(k) for k, m in metrics.items()]), observation


def observe_dq(
    df: DataFrame, settings: Settings, platforms: Sequence[str], name: str = "dq", platform: str = "platform"
) -> tuple[DataFrame, Observation]:
    """The cleaned rows, with the quality log counted in the same pass as ``platform|reason`` metrics."""
    flagged = df.withColumn("_reason", first_fail(settings))
    metrics = {
        f"{p}|{reason}": F.count_if((F.col(platform) == p) & (F.col("_reason") == reason))
        for p in platforms
        for reason in voc.DQ_REASONS
    }
    watched, observation = observe_counts(flagged, name, **metrics)
    return score(watched.filter(F.col("_reason").isNull()).drop("_reason"), settings), observation
