"""Payload, video and post selection queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from audience_engine.functions import clock
from audience_engine.operators import conform, selection
from audience_engine.plans import pipelines
from audience_engine.plans.comment_queries import ENGLISH
from audience_engine.plans.registry import Inputs, query
from audience_engine.settings import Settings
from audience_engine.sources import payloads

CFG = Settings()

# --- payloads --------------------------------------------------------------------------------------------------------


@query(
    "comment_payloads",
    """SELECT 'YouTube' AS platform, post_id AS video_id, CAST(comment_id AS VARCHAR) AS comment_id, author, md5(text) AS text,
    likes_or_score, reply_count, CAST(0 AS BIGINT) AS creator_heart_or_awards,
    concat('https://www.youtube.com/watch?v=', CAST(post_id AS VARCHAR)) AS source_url,
    strftime(created_utc, '%Y-%m-%dT%H:%M:%SZ') AS created FROM comments""",
    ["comments"],
)
def comment_payloads(t: Inputs):
    item = F.struct(
        F.col("comment_id").cast("string").alias("id"),
        F.struct(
            F.col("reply_count").alias("totalReplyCount"),
            F.struct(
                F.struct(
                    F.col("text").alias("textDisplay"),
                    F.col("author").alias("authorDisplayName"),
                    F.col("likes_or_score").alias("likeCount"),
                    clock.iso_z("created_utc").alias("publishedAt"),
                ).alias("snippet")
            ).alias("topLevelComment"),
        ).alias("snippet"),
    )
    # a page holds at most 50 comments of one video
    pages = (
        t.comments.groupBy(F.col("post_id").alias("video_id"), F.floor(F.col("comment_id") / 2500).alias("page"))
        .agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("payload"))
    )
    return payloads.flatten_comment_threads(pages).select(
        "platform", "video_id", "comment_id", "author", F.md5("text").alias("text"), "likes_or_score", "reply_count",
        "creator_heart_or_awards", "source_url", clock.iso_z("created_utc").alias("created"),
    )


@query(
    "video_payloads",
    """SELECT CAST(video_id AS VARCHAR) AS video_id, stream, region, category, title, channel_id,
      CAST(comment_count AS BIGINT) AS comment_count, view_count, like_count FROM videos WHERE stream = 'popular'
    UNION ALL
    SELECT CAST(video_id AS VARCHAR), 'marketing', 'marketing', 'marketing', title, channel_id, 100, 0, 0
    FROM videos WHERE stream = 'marketing'""",
    ["videos"],
)
def video_payloads(t: Inputs):
    snippet = F.struct("title", F.col("channel_id").alias("channelId"))
    popular = F.struct(
        F.col("video_id").cast("string").alias("id"),
        snippet.alias("snippet"),
        F.struct(
            F.col("comment_count").cast("string").alias("commentCount"),
            F.col("view_count").cast("string").alias("viewCount"),
            F.col("like_count").cast("string").alias("likeCount"),
        ).alias("statistics"),
    )
    found = F.struct(F.struct(F.col("video_id").cast("string").alias("videoId")).alias("id"), snippet.alias("snippet"))
    # a page holds at most 50 videos
    page = F.floor(F.col("video_id") / 50).alias("page")

    def paged(df, item, *keys):
        return df.groupBy(*keys, page).agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("payload"))

    a = paged(t.videos.filter("stream = 'popular'"), popular, "region", "category")
    b = paged(t.videos.filter("stream = 'marketing'"), found)
    columns = ["video_id", "stream", "region", "category", "title", "channel_id", "comment_count", "view_count", "like_count"]
    return payloads.flatten_videos(a, "popular").select(columns).unionByName(
        payloads.flatten_videos(b, "marketing").select(columns)
    )


@query(
    "post_comment_payloads",
    """SELECT 'reddit' AS platform, post_id, comment_id, CASE WHEN comment_id % 9 = 0 THEN '' ELSE md5(text) END AS text,
    CASE WHEN comment_id % 7 = 0 THEN 0 ELSE likes_or_score END AS likes_or_score, reply_count, creator_heart_or_awards,
    CAST(0 AS BIGINT) AS author_cred_proxy, concat('https://reddit.com/r/', channel_id) AS source_url,
    strftime(created_utc, '%Y-%m-%dT%H:%M:%SZ') AS created FROM comments WHERE source = 'reddit'""",
    ["comments"],
)
def post_comment_payloads(t: Inputs):
    landed = t.comments.filter("source = 'reddit'").select(
        F.col("comment_id").alias("id"),
        "post_id",
        F.concat(F.lit("/r/"), F.col("channel_id")).alias("permalink"),
        F.when(F.col("comment_id") % 9 != 0, F.md5("text")).alias("body"),
        F.when(F.col("comment_id") % 7 != 0, F.col("likes_or_score")).alias("score"),
        F.col("reply_count").alias("num_replies"),
        F.col("creator_heart_or_awards").alias("num_awards"),
        "author",
        F.unix_timestamp("created_utc").alias("created_epoch"),
    )
    return payloads.map_post_comments(landed).select(
        "platform", "post_id", "comment_id", "text", "likes_or_score", "reply_count", "creator_heart_or_awards",
        "author_cred_proxy", "source_url", clock.iso_z("created_utc").alias("created"),
    )


# --- videos ----------------------------------------------------------------------------------------------------------

CAPPED = """
capped AS (SELECT * FROM videos QUALIFY row_number() OVER (
  PARTITION BY CASE WHEN channel_id = '' THEN concat('v:', CAST(video_id AS VARCHAR)) ELSE channel_id END
  ORDER BY comment_count DESC, view_count DESC, position) <= 2),
selected AS (SELECT * FROM capped ORDER BY comment_count DESC, view_count DESC, position LIMIT 120)"""


@query("videos_capped", "SELECT video_id, channel_id FROM capped", ["videos"], CAPPED)
def videos_capped(t: Inputs):
    return selection.cap_per_channel(t.videos).select("video_id", "channel_id")


@query("selected_videos", "SELECT video_id, CAST(comment_count AS BIGINT) AS comment_count FROM selected", ["videos"], CAPPED)
def selected_videos(t: Inputs):
    return selection.select_videos(t.videos).select("video_id", F.col("comment_count").cast("long").alias("comment_count"))


LISTED = """
listed AS (SELECT video_id, region, category, position FROM videos UNION ALL
  SELECT video_id, 'GB' AS region, category, position + 1000000 AS position FROM videos WHERE video_id % 3 = 0),
firsts AS (SELECT * FROM listed QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY position) = 1)"""


def listed(t: Inputs):
    v = t.videos.select("video_id", "region", "category", "position")
    again = v.filter("video_id % 3 = 0").withColumns({"region": F.lit("GB"), "position": F.col("position") + 1000000})
    return v.unionByName(again)


@query("first_seen", "SELECT video_id, region, position FROM firsts", ["videos"], LISTED)
def first_seen(t: Inputs):
    return conform.first_seen(listed(t), "video_id", [F.col("position")]).select("video_id", "region", "position")


COARSE = """
listed AS (SELECT video_id, region, split_part(category, ' ', 1) AS category, position FROM videos UNION ALL
  SELECT video_id, 'GB' AS region, split_part(category, ' ', 1) AS category, position + 1000000 AS position FROM videos WHERE video_id % 3 = 0),
firsts AS (SELECT * FROM listed QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY position) = 1)"""


@query(
    "category_cap",
    """SELECT region, category, video_id FROM firsts
    QUALIFY row_number() OVER (PARTITION BY region, category ORDER BY position, video_id) <= 80""",
    ["videos"],
    COARSE.replace("video_id % 3 = 0", "video_id % 3 < 2"),
)
def category_cap(t: Inputs):
    v = t.videos.select("video_id", "region", F.split_part("category", F.lit(" "), F.lit(1)).alias("category"), "position")
    again = v.filter("video_id % 3 < 2").withColumns({"region": F.lit("GB"), "position": F.col("position") + 1000000})
    firsts = conform.first_seen(v.unionByName(again), "video_id", [F.col("position")])
    order = [F.col("position"), F.col("video_id")]
    capped = selection.cap_per_group(firsts, ["region", "category"], CFG.videos_per_category, order, spread_by=["video_id"])
    return capped.select("region", "category", "video_id")


@query(
    "keyword_cap",
    """SELECT (video_id // 4) % 5 AS keyword, video_id FROM videos WHERE stream = 'marketing'
    QUALIFY row_number() OVER (PARTITION BY (video_id // 4) % 5 ORDER BY (video_id * 7919) % 10007, video_id) <= 20""",
    ["videos"],
)
def keyword_cap(t: Inputs):
    found = t.videos.filter("stream = 'marketing'").select(
        (F.floor(F.col("video_id") / 4) % 5).alias("keyword"), "video_id", ((F.col("video_id") * 7919) % 10007).alias("position")
    )
    order = [F.col("position"), F.col("video_id")]
    capped = selection.cap_per_group(found, "keyword", CFG.videos_per_keyword, order, spread_by=["video_id"])
    return capped.select("keyword", "video_id")


# --- posts -----------------------------------------------------------------------------------------------------------

THRESHOLDS = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY score) AS place,
  count(*) OVER (PARTITION BY subreddit) AS n FROM reddit_posts),
thresholds AS (SELECT subreddit, score AS threshold FROM ranked WHERE place = greatest(1, CAST(floor(n * 0.75) AS BIGINT)))"""


@query("adaptive_threshold", "SELECT subreddit, threshold FROM thresholds", ["reddit_posts"], THRESHOLDS)
def adaptive_threshold(t: Inputs):
    return selection.score_threshold(t.reddit_posts, "subreddit", CFG.score_percentile)


@query(
    "posts_capped",
    """SELECT p.subreddit, p.post_id, p.score FROM reddit_posts p JOIN thresholds h ON h.subreddit = p.subreddit
    WHERE p.score >= h.threshold
    QUALIFY row_number() OVER (PARTITION BY p.subreddit ORDER BY p.position) <= 2""",
    ["reddit_posts"],
    THRESHOLDS,
)
def posts_capped(t: Inputs):
    return selection.pick_posts(t.reddit_posts, n=CFG.posts_per_community).select("subreddit", "post_id", "score")


@query(
    "best_posts",
    """SELECT subreddit, post_id, score FROM reddit_posts
    QUALIFY row_number() OVER (PARTITION BY subreddit ORDER BY score DESC, position) <= 2""",
    ["reddit_posts"],
)
def best_posts(t: Inputs):
    return selection.pick_posts(t.reddit_posts, n=CFG.posts_per_community, order="score").select("subreddit", "post_id", "score")


# --- comments of the selection ---------------------------------------------------------------------------------------


def video_comments(t: Inputs):
    return t.comments.filter("source = 'youtube'").withColumnRenamed("post_id", "video_id")


@query(
    "video_join",
    """SELECT c.comment_id, c.post_id AS video_id, coalesce(v.category, '') AS category, coalesce(v.region, '') AS region,
    coalesce(v.title, '') AS post_title, coalesce(v.view_count, 0) AS view_count, coalesce(v.like_count, 0) AS like_count,
    CAST(0 AS BIGINT) AS channel_subscribers
    FROM comments c LEFT JOIN videos v ON v.video_id = c.post_id WHERE c.source = 'youtube'""",
    ["comments", "videos"],
)
def video_join(t: Inputs):
    return selection.attach_video_meta(video_comments(t), t.videos).select(
        "comment_id", "video_id", "category", "region", "post_title", "view_count", "like_count", "channel_subscribers"
    )


@query(
    "selected_comments",
    """SELECT comment_id, post_id AS video_id FROM comments WHERE source = 'youtube' AND post_id IN (SELECT video_id FROM capped)""",
    ["comments", "videos"],
    CAPPED,
)
def selected_comments(t: Inputs):
    return selection.only_selected(video_comments(t), selection.cap_per_channel(t.videos)).select("comment_id", "video_id")


SHUFFLED = """
placed AS (SELECT comment_id, CAST(comment_id % 7 + 1 AS BIGINT) AS group_id, created_utc,
  row_number() OVER (PARTITION BY comment_id % 7 ORDER BY (comment_id * 7919) % 10007, comment_id) AS place FROM comments)"""


def comment_pages(t: Inputs, shown: Column):
    """A payload page for each comment of a video's listing; the page's number follows the listing's order, not the ids'."""
    item = F.struct(
        F.col("comment_id").cast("string").alias("id"),
        F.struct(F.struct(F.struct(shown.alias("textDisplay")).alias("snippet")).alias("topLevelComment")).alias("snippet"),
    )
    number = (F.col("comment_id") * 7919) % 10007 * 10_000_000_000 + F.col("comment_id")
    return t.comments.select(
        (F.col("comment_id") % 7 + 1).cast("long").alias("video_id"), number.alias("page"),
        F.to_json(F.struct(F.array(item).alias("items"))).alias("payload"),
    )


@query(
    "comments_capped",
    """SELECT c.comment_id, c.group_id AS video_id, v.category FROM placed c JOIN videos v ON v.video_id = c.group_id
    WHERE c.place <= CASE WHEN v.stream = 'marketing' THEN 50 ELSE 20 END""",
    ["comments", "videos"],
    SHUFFLED,
)
def comments_capped(t: Inputs):
    flat = payloads.flatten_comment_threads(comment_pages(t, F.md5("text")))
    return pipelines.collect_video_comments(flat, t.videos, CFG).select(
        F.col("comment_id").cast("long").alias("comment_id"), "video_id", "category"
    )


@query(
    "english_comments_capped",
    """SELECT comment_id, group_id AS video_id FROM (SELECT c.comment_id, c.group_id,
      row_number() OVER (PARTITION BY c.group_id ORDER BY c.place) AS place
      FROM placed c JOIN comments t ON t.comment_id = c.comment_id AND """ + ENGLISH + """) c
    JOIN videos v ON v.video_id = c.group_id WHERE c.place <= CASE WHEN v.stream = 'marketing' THEN 50 ELSE 20 END""",
    ["comments", "videos"],
    SHUFFLED,
)
def english_comments_capped(t: Inputs):
    """A run that collects English comments only: the others don't use up a video's cap."""
    flat = payloads.flatten_comment_threads(comment_pages(t, F.col("text")))
    return pipelines.collect_video_comments(flat, t.videos, replace(CFG, english_only=True)).select(
        F.col("comment_id").cast("long").alias("comment_id"), "video_id"
    )


@query(
    "post_comments_capped",
    """SELECT post_id, comment_id FROM (SELECT comment_id % 3 AS post_id, comment_id,
      row_number() OVER (PARTITION BY comment_id % 3 ORDER BY (comment_id * 7919) % 10007, comment_id) AS place FROM comments
      WHERE floor(date_diff('second', created_utc, TIMESTAMP '2024-03-31 00:00:00') / 86400.0) <= 60)
    WHERE place <= 150""",
    ["comments"],
)
def post_comments_capped(t: Inputs):
    recent = t.comments.filter(clock.recent_days("created_utc", CFG.as_of, CFG.window_days)).select(
        (F.col("comment_id") % 3).alias("post_id"), "comment_id", ((F.col("comment_id") * 7919) % 10007).alias("position")
    )
    order = [F.col("position"), F.col("comment_id")]
    return selection.cap_per_group(recent, "post_id", CFG.comments_per_post, order, spread_by=["comment_id"]).select("post_id", "comment_id")
