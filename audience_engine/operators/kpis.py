"""Platform KPIs, comment metrics and report figures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audience_engine.functions.clock import event_time, instant
from audience_engine.operators.joining import top_per_group
from audience_engine.operators.quality import platform_spine

SENTIMENT_NAMES = ("sentiment_label", "sentiment", "label")


def signal_counts(clean_df: DataFrame, platform: str = "platform", positive_above: float = 0.2) -> DataFrame:
    """Totals per (platform, signal) in one pass; the row with a null signal counts each comment once."""
    marks = F.concat(F.array(F.lit(None).cast("string")), F.array_distinct("marketing_signals"))
    return (
        clean_df.select(
            F.col(platform).alias("platform"),
            F.explode(marks).alias("signal"),
            F.col("engagement_density").alias("density"),
            (F.col("sentiment_score") > positive_above).cast("long").alias("positive"),
        )
        .groupBy("platform", "signal")
        .agg(F.count("*").alias("n"), F.sum("positive").alias("positive"), F.sum("density").alias("density"))
    )


def top_signal(clean_df: DataFrame, platform: str = "platform") -> DataFrame:
    """The most frequent signal per platform with the mean density of its rows; ties go to the first by name."""
    counted = signal_counts(clean_df, platform).filter(F.col("signal").isNotNull())
    best = top_per_group(counted, ["platform"], [F.col("n").desc(), F.col("signal")], 1)
    return best.select("platform", "signal", "n", F.round(F.col("density") / F.col("n"), 3).alias("signal_density"))


def compute_kpis(
    clean_df: DataFrame,
    platforms: Sequence[str],
    date: str,
    platform: str = "platform",
    notes: str = "",
    positive_above: float = 0.2,
) -> DataFrame:
    """One KPI row per platform: total, share of positive comments, top signal and mean density.

    All figures come from one pass and one shuffle of (platforms x phrases) rows.
    """
    best = F.max_by(
        F.when(F.col("signal").isNotNull(), F.struct("signal", "n", "density")),
        F.when(F.col("signal").isNotNull(), F.struct(F.col("n"), F.col("rank"))),
    )
    # a later name must rank lower at equal counts
    by_name = Window.partitionBy("platform").orderBy(F.col("signal").desc())
    whole = F.col("signal").isNull()
    figures = (
        signal_counts(clean_df, platform, positive_above)
        .withColumn("rank", F.row_number().over(by_name))
        .groupBy("platform")
        .agg(
            F.sum(F.when(whole, F.col("n"))).alias("total"),
            F.sum(F.when(whole, F.col("positive"))).alias("positive"),
            F.sum(F.when(whole, F.col("density"))).alias("density"),
            best.alias("best"),
        )
    )
    # both sides hold one row per platform
    return (
        platform_spine(clean_df, platforms)
        .join(figures, "platform", "left")
        .select(
            F.lit(date).alias("Date"),
            F.col("platform").alias("Platform"),
            F.coalesce("total", F.lit(0)).alias("TotalComments"),
            F.coalesce(F.round(F.try_divide("positive", "total"), 3), F.lit(0.0)).alias("PositivityRate"),
            F.coalesce("best.signal", F.lit("n/a")).alias("TopTrend"),
            F.coalesce(F.round(F.try_divide("best.density", "best.n"), 3), F.lit(0.0)).alias("TopTrendScore"),
            F.coalesce(F.round(F.try_divide("density", "total"), 3), F.lit(0.0)).alias("AvgEngagementDensity"),
            F.lit(notes).alias("Notes"),
        )
    )


def comment_metrics(
    df: DataFrame, text: str = "comment", length: str | None = None, as_of: dt.datetime | Column | None = None
) -> DataFrame:
    """Total, mean text length, and positive, negative and other comments; ``length`` names a ready length column."""
    label = next((c for c in SENTIMENT_NAMES if c in df.columns), None)
    if length:
        chars = F.coalesce(F.col(length), F.lit(0))
    else:
        chars = F.length(F.coalesce(F.col(text), F.lit(""))) if text in df.columns else F.lit(0)
    pos = F.count_if(F.col(label) == "positive") if label else F.lit(0).cast("long")
    neg = F.count_if(F.col(label) == "negative") if label else F.lit(0).cast("long")
    out = df.agg(
        F.count("*").alias("total"),
        F.coalesce(F.round(F.avg(chars), 1), F.lit(0.0)).alias("avg_len"),
        pos.alias("pos"),
        neg.alias("neg"),
    ).withColumn("neu", F.col("total") - F.col("pos") - F.col("neg"))
    return out if as_of is None else out.select(instant(as_of).alias("ts"), *out.columns)


def sentiment_split(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """Comments and percent per label."""
    counted = df.groupBy(label).agg(F.count("*").alias("n"))
    # one row per label
    share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counted.withColumn("percent", F.round(share, 1))


def report_window(
    df: DataFrame, start: dt.datetime | Column, end: dt.datetime | Column, ts: str = "created_utc"
) -> DataFrame:
    """Rows in ``[start, end)``; a table without the time column passes whole."""
    if ts not in df.columns:
        return df
    time = F.col(ts) if dict(df.dtypes)[ts].startswith("timestamp") else event_time(ts)
    return df.filter((time >= instant(start)) & (time < instant(end)))


def date_window(days: int, end: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """The ``days`` before ``end``."""
    return end - dt.timedelta(days=days), end


def top_topics(
    summary: DataFrame, n: int = 20, mode: str = "weighted", name: str = "Name", count: str = "Count"
) -> DataFrame:
    """The most frequent topic names, by member count (``weighted``) or by summary rows (``rows``)."""
    size = F.sum(count) if mode == "weighted" else F.count("*")
    return summary.groupBy(name).agg(size.cast("long").alias("n")).orderBy(F.col("n").desc(), name).limit(n)


def weekly_rollup(
    sentiment: DataFrame,
    summary: DataFrame,
    start: dt.datetime,
    end: dt.datetime,
    mode: str = "weighted",
    label: str = "sentiment_label",
) -> DataFrame:
    """One row for the week: totals per label and the five top topics, as text and as an array."""
    totals = report_window(sentiment, start, end).agg(
        F.count("*").alias("total"),
        F.count_if(F.col(label) == "positive").alias("pos"),
        F.count_if(F.col(label) == "negative").alias("neg"),
    )
    ranked = top_topics(report_window(summary, start, end), 5, mode)
    # five rows at most
    listed = ranked.agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("down"), "Name"))).alias("top")).select(
        F.transform("top", lambda t: t["Name"]).alias("names"),
        F.array_join(
            F.transform("top", lambda t: F.concat(t["Name"], F.lit(" ("), (-t["down"]).cast("string"), F.lit(")"))), "; "
        ).alias("top5"),
    )
    top = listed.select(F.struct("top5", "names")).scalar()
    return totals.withColumn("_top", top).select(
        F.lit(start.date().isoformat()).alias("week_start"),
        "total",
        "pos",
        (F.col("total") - F.col("pos") - F.col("neg")).alias("neu"),
        "neg",
        F.col("_top.top5").alias("top5"),
        F.col("_top.names").alias("names"),
    )
