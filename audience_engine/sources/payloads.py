"""Flattening landed API payloads into rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audience_engine.functions.clock import event_time, instant
from audience_engine.functions.text import is_english, to_text
from audience_engine.schemas import COMMENT_PAGE, POPULAR_VIDEO_PAGE, SEARCH_VIDEO_PAGE


def _count(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(value.try_cast("long"), F.lit(0).cast("long"))


#: No page of a listing has this many items.
PAGE_ITEMS = 10_000


def _place(pages: DataFrame) -> Column:
    """A unique place in the listing: the page's number (its column ``page``, if it has one), then the item's."""
    page = F.coalesce(F.col("page").cast("long"), F.lit(0)) if "page" in pages.columns else F.lit(0)
    return (page * PAGE_ITEMS + F.col("_item")).cast("long")


def unreadable_pages(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """The pages whose payload is no JSON: the flatteners have no rows for them, so keep them for another look."""
    return pages.filter(F.isnull(F.try_parse_json(payload)))


def flatten_comment_threads(
    pages: DataFrame, collected: dt.datetime | None = None, payload: str = "payload", keep_english: bool = False
) -> DataFrame:
    """One raw comment row per item of the pages (video_id, payload); absent fields get empty text and zeros.

    ``position`` is the comment's place in the video's listing; ``page`` is the page's number in it. ``keep_english``
    drops comments that are not English. See ``unreadable_pages``.
    """
    items = pages.select(
        "video_id", *(["page"] if "page" in pages.columns else []), F.posexplode(F.from_json(payload, COMMENT_PAGE)["items"]).alias("_item", "it")
    )
    place = _place(items).alias("position")
    top = F.col("it.snippet.topLevelComment.snippet")
    if keep_english:
        items = items.filter(is_english(top["textDisplay"]))
    return items.select(
        F.lit("YouTube").alias("platform"),
        "video_id",
        F.lit("").alias("post_title"),
        F.concat(F.lit("https://www.youtube.com/watch?v="), F.col("video_id").cast("string")).alias("source_url"),
        to_text("it.id").alias("comment_id"),
        to_text(top["authorDisplayName"]).alias("author"),
        to_text(top["textDisplay"]).alias("text"),
        _count(top["likeCount"]).alias("likes_or_score"),
        _count("it.snippet.totalReplyCount").alias("reply_count"),
        F.lit(0).cast("long").alias("creator_heart_or_awards"),
        event_time(top["publishedAt"]).alias("created_utc"),
        (instant(collected).cast("timestamp") if collected else F.lit(None).cast("timestamp")).alias("collected_utc"),
        place,
    )


def flatten_videos(pages: DataFrame, stream: str, payload: str = "payload") -> DataFrame:
    """One video row per item of the pages; ``position`` is its place in the whole listing.

    The pages' column ``page`` numbers them in the order in which they were fetched, over regions and categories too.

    Popular pages carry their region, category and statistics. Search results have none: they get fixed priors that
    rank them among the popular ones. Items without an id are dropped.
    """
    popular = stream == "popular"
    schema = POPULAR_VIDEO_PAGE if popular else SEARCH_VIDEO_PAGE
    kept = [c for c in pages.columns if c != payload]
    items = pages.select(*kept, F.posexplode(F.from_json(payload, schema)["items"]).alias("_item", "it"))
    items = items.withColumn("position", _place(items)).drop("_item")
    shared = {
        "stream": F.lit(stream),
        "title": to_text("it.snippet.title"),
        "channel_id": to_text("it.snippet.channelId"),
    }
    if popular:
        own = {
            "video_id": F.col("it.id"),
            "comment_count": _count("it.statistics.commentCount"),
            "view_count": _count("it.statistics.viewCount"),
            "like_count": _count("it.statistics.likeCount"),
        }
    else:
        own = {
            "video_id": F.col("it.id.videoId"),
            "region": F.lit("marketing"),
            "category": F.lit("marketing"),
            "comment_count": F.lit(100).cast("long"),
            "view_count": F.lit(0).cast("long"),
            "like_count": F.lit(0).cast("long"),
        }
    return items.withColumns({**shared, **own}).drop("it").filter(F.coalesce("video_id", F.lit("")) != "")


def map_post_comments(df: DataFrame) -> DataFrame:
    """Landed post comments (id, post_id, permalink, body, score, replies, awards, author, epoch seconds) as raw rows.

    A landed ``position`` (the place in the post's listing) stays.
    """
    return df.select(
        F.lit("reddit").alias("platform"),
        "post_id",
        F.col("id").alias("comment_id"),
        F.timestamp_seconds("created_epoch").alias("created_utc"),
        to_text("body").alias("text"),
        _count("score").alias("likes_or_score"),
        _count("num_replies").alias("reply_count"),
        _count("num_awards").alias("creator_heart_or_awards"),
        F.lit(0).cast("long").alias("author_cred_proxy"),
        "author",
        F.concat(F.lit("https://reddit.com"), to_text("permalink")).alias("source_url"),
        *(["position"] if "position" in df.columns else []),
    )
