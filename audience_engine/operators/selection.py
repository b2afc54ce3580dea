"""Choosing videos, posts and comments."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audience_engine.functions.clock import event_time, instant
from audience_engine.functions.scoring import magnitude_bin
from audience_engine.functions.text import coalesce_text
from audience_engine.operators.joining import lookup_join, top_per_group

VIDEO_ORDER = ("comment_count", "view_count")
SALT_ABOVE = 10


def cap_per_group(
    df: DataFrame,
    group: str | Sequence[str],
    n: int | Column,
    order: Sequence[Column],
    max_n: int | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """At most ``n`` rows per group; ``n`` may be a column, with ``max_n`` its largest value.

    For a larger ``n`` pass ``spread_by`` (columns that identify a row) to cut a hot group in parallel first.
    """
    groups = [group] if isinstance(group, str) else list(group)
    if isinstance(n, int):
        return top_per_group(df, groups, order, n, spread_by=spread_by if n > SALT_ABOVE else None)
    if max_n is None:
        raise ValueError("a cap column needs max_n, its largest value")
    capped = top_per_group(df, groups, order, max_n, rank="_position", spread_by=spread_by if max_n > SALT_ABOVE else None)
    return capped.filter(F.col("_position") <= n).drop("_position")


def cap_per_channel(df: DataFrame, n: int = 2, tie: str = "position") -> DataFrame:
    """At most ``n`` videos per channel, most commented first; videos without a channel are not capped."""
    channel = coalesce_text("channel_id")
    own_group = F.when(channel == "", F.col("video_id"))
    order = [*(F.col(c).desc() for c in VIDEO_ORDER), F.col(tie), F.col("video_id")]
    return top_per_group(df, [channel, own_group], order, n)


def select_videos(df: DataFrame, per_channel: int = 2, n: int = 120, tie: str = "position") -> DataFrame:
    """The ``n`` most commented videos after the channel cap."""
    order = [*(F.col(c).desc() for c in VIDEO_ORDER), F.col(tie), F.col("video_id")]
    return cap_per_channel(df, per_channel, tie).orderBy(*order).limit(n)


def only_selected(comments: DataFrame, selected: DataFrame, key: str = "video_id") -> DataFrame:
    """Comments of the selected videos."""
    return lookup_join(comments, selected.select(key), key, "left_semi")


def attach_video_meta(
    comments: DataFrame, videos: DataFrame, key: str = "video_id", how: str = "left", keep: Sequence[str] = ()
) -> DataFrame:
    """Add category, region, title and counts of the video, and its columns ``keep``; unknown videos get empty text and zeros.

    A video that is listed twice counts once (its largest row), so comments stay one row each.
    """
    rest = [c for c in ("category", "region", "title", "view_count", "like_count", *keep)]
    single = videos.groupBy(key).agg(F.max(F.struct(*rest)).alias("_v")).select(key, "_v.*")
    meta = single.select(
        key,
        *keep,
        F.col("category").alias("_category"),
        F.col("region").alias("_region"),
        F.col("title").alias("_title"),
        F.col("view_count").alias("_views"),
        F.col("like_count").alias("_likes"),
    )
    out = lookup_join(comments, meta, key, how)
    text = {"category": "_category", "region": "_region", "post_title": "_title"}
    numbers = {"view_count": "_views", "like_count": "_likes"}
    return out.withColumns(
        {
            **{name: F.coalesce(F.col(c), F.lit("")) for name, c in text.items()},
            **{name: F.coalesce(F.col(c).cast("long"), F.lit(0)) for name, c in numbers.items()},
            "channel_subscribers": F.lit(0).cast("long"),
        }
    ).drop("_category", "_region", "_title", "_views", "_likes")


def score_threshold(df: DataFrame, group: str, p: float = 0.75, score: str = "score", exact: bool = True) -> DataFrame:
    """Per group, the score at place ``floor(p * n)`` (at least the first) of its ascending scores; no score counts as 0.

    Scores are counted before the shuffle. The place is then found among the group's bins and, with a second small
    ranking, among the distinct scores of the one bin that holds it; no task ever sorts a whole group.
    ``exact=False`` takes Spark's bounded quantile sketch instead.
    """
    if not exact:
        return df.groupBy(group).agg(F.percentile_approx(score, p, 10_000).alias("threshold"))
    counts = (
        df.select(F.col(group), F.coalesce(F.col(score).cast("long"), F.lit(0)).alias("_score"))
        .filter(F.col(group).isNotNull())
        .groupBy(group, "_score")
        .agg(F.count("*").alias("_n"))
        .withColumn("_bin", magnitude_bin(F.col("_score")))
    )
    by_bin = Window.partitionBy(group).orderBy("_bin")
    target = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(p) * F.sum("_n").over(Window.partitionBy(group))))
    bins = (
        counts.groupBy(group, "_bin")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(by_bin))
        .withColumn("_target", target)
        .filter((F.col("_upto") >= F.col("_target")) & (F.col("_upto") - F.col("_n") < F.col("_target")))
        .select(group, "_bin", (F.col("_target") - F.col("_upto") + F.col("_n")).alias("_rest"))
    )
    by_score = Window.partitionBy(group).orderBy("_score")
    return (
        counts.join(bins, [group, "_bin"])
        .withColumn("_upto", F.sum("_n").over(by_score))
        .filter(F.col("_upto") >= F.col("_rest"))
        .groupBy(group)
        .agg(F.min("_score").alias("threshold"))
    )


def above_threshold(
    df: DataFrame, group: str, p: float = 0.75, score: str = "score", exact: bool = True
) -> DataFrame:
    """Rows that reach their group's score threshold, with the threshold."""
    thresholds = score_threshold(df, group, p, score, exact)
    return lookup_join(df, thresholds, group, "inner").filter(F.coalesce(F.col(score), F.lit(0)) >= F.col("threshold"))


def pick_posts(
    df: DataFrame,
    group: str = "subreddit",
    key: str = "post_id",
    n: int = 2,
    p: float = 0.75,
    order: str = "listing",
    position: str = "position",
) -> DataFrame:
    """Per group the first ``n`` posts at or above the score threshold, by listing place or by score."""
    if order not in ("listing", "score"):
        raise ValueError("order is 'listing' or 'score'")
    posts = top_per_group(df, [key], [F.col(position)], 1)
    ranked = [F.col(position), F.col(key)] if order == "listing" else [F.coalesce("score", F.lit(0)).desc(), F.col(position), F.col(key)]
    return cap_per_group(above_threshold(posts, group, p), group, n, ranked)


def keep_last_n_days(df: DataFrame, as_of: dt.datetime, n: int = 60, ts: str = "created_utc") -> DataFrame:
    """Rows not older than ``n`` days to the second; bad times drop, a table without times passes whole."""
    if ts not in df.columns:
        return df
    time = F.col(ts) if dict(df.dtypes)[ts].startswith("timestamp") else event_time(ts)
    return df.filter(time >= instant(as_of - dt.timedelta(days=n)))
