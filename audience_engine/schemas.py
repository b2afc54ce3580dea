"""Schemas of the stored tables."""

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _table(columns: str) -> T.StructType:
    """A flat schema from ``name type`` pairs."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_VIDEO_COMMENT = _table(
    "platform string, video_id string, post_title string, source_url string, comment_id string, author string, "
    "text string, likes_or_score long, reply_count long, creator_heart_or_awards long, created_utc timestamp, "
    "collected_utc timestamp, category string, region string, view_count long, like_count long, "
    "channel_subscribers long"
)

RAW_POST_COMMENT = _table(
    "platform string, post_id string, comment_id string, created_utc timestamp, text string, likes_or_score long, "
    "reply_count long, creator_heart_or_awards long, author_cred_proxy long, author string, source_url string"
)

RAW_SCHEMAS = {"youtube": RAW_VIDEO_COMMENT, "reddit": RAW_POST_COMMENT}

ALL_COMMENTS = _table(
    "platform string, video_id string, post_title string, source_url string, comment_id string, author string, "
    "comment string, likes_or_score long, reply_count long, created_utc timestamp, source string"
)

TOPIC_MEMBERS = _table(
    "topic string, topic_prob double, topic_name string, document string, original_index string, "
    "post_title string, comment string"
)

DRAFTS = _table(
    "topic string, topic_name string, topic_group string, variant_id string, variant_index int, "
    "representative_doc string, sentiment_hint string, platform string, caption string, cta string, "
    "raw_text string, raw_length int, created_utc string"
)

AB_LOG = _table(
    "post_id string, topic string, variant_id string, variant_text string, ts timestamp, replies long, likes long, "
    "ctr double"
)

DQ_LOG = _table("platform string, reason string, count long")

KPI = _table(
    "Date string, Platform string, TotalComments long, PositivityRate double, TopTrend string, TopTrendScore double, "
    "AvgEngagementDensity double, Notes string"
)

COMMENT_PAGE = (
    "items array<struct<id: string, snippet: struct<totalReplyCount: long, topLevelComment: struct<snippet: "
    "struct<textDisplay: string, authorDisplayName: string, likeCount: long, publishedAt: string>>>>>, "
    "nextPageToken string"
)

POPULAR_VIDEO_PAGE = (
    "items array<struct<id: string, snippet: struct<title: string, channelId: string>, statistics: "
    "struct<commentCount: string, viewCount: string, likeCount: string>>>, nextPageToken string"
)

SEARCH_VIDEO_PAGE = (
    "items array<struct<id: struct<videoId: string>, snippet: struct<title: string, channelId: string>>>, "
    "nextPageToken string"
)

APPROVAL = (
    "user struct<username: string, id: string>, actions array<struct<value: string>>"
)

RANKING = "array<struct<variant_id: string, score: double, reason: string>>"
