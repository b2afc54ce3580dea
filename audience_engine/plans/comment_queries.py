"""Cleaning, scoring, merging and KPI queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from audience_engine.functions import clock, scoring, text
from audience_engine.operators import conform, kpis, quality, selection
from audience_engine.plans import expected
from audience_engine.plans.registry import Inputs, any_in, query, sql_list, stripped
from audience_engine.session import cut_lineage
from audience_engine.settings import Settings
from audience_engine.sources import sinks

CFG = Settings()
AS_OF = "TIMESTAMP '2024-03-31 00:00:00'"
PLATFORMS = ("youtube", "reddit")

ENGLISH = r"coalesce(CAST(length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) AS DOUBLE) / nullif(length(text), 0) > CAST(0.95 AS DOUBLE), false)"
TOXIC = any_in("lower(text)", expected.TOXIC_WORDS)
TOXICITY = f"CAST(CASE WHEN {TOXIC} THEN 0.6 ELSE 0.05 END AS DOUBLE)"
SENTIMENT = (
    f"CAST(CASE WHEN {any_in('lower(text)', expected.POSITIVE_WORDS)} THEN 0.7 "
    f"WHEN {any_in('lower(text)', expected.NEGATIVE_WORDS)} THEN -0.6 ELSE 0.1 END AS DOUBLE)"
)
TAGS = r"list_sort(list_distinct(list_transform(regexp_extract_all(text, '#[\p{L}\p{N}_]+'), lambda x: lower(x))))"
SIGNALS = f"list_filter([{sql_list(expected.SIGNAL_PHRASES)}], lambda s: contains(lower(text), s))"
HOURS = f"greatest(CAST(1 AS DOUBLE), date_diff('microsecond', created_utc, {AS_OF}) / CAST(3600000000 AS DOUBLE))"
DENSITY = f"(likes_or_score + reply_count + 5 * creator_heart_or_awards) / {HOURS}"

SCORED = f"""
scored AS (SELECT *, {ENGLISH} AS english, {TOXICITY} AS toxicity_score, {SENTIMENT} AS sentiment_score, {TAGS} AS tags,
  {SIGNALS} AS signals, {DENSITY} AS density FROM comments),
cleaned AS (SELECT * FROM scored WHERE length(text) > 6 AND english AND toxicity_score <= 0.30 AND density >= 0.20
  AND (len(tags) > 0 OR len(signals) > 0))"""

FAILED = """,
failed AS (SELECT source AS platform, CASE WHEN length(text) <= 6 THEN 'short_text' WHEN NOT english THEN 'lang_other'
  WHEN toxicity_score > 0.30 THEN 'toxicity_gt_0.30' WHEN density < 0.20 THEN 'ed_lt_0.20'
  WHEN len(tags) = 0 AND len(signals) = 0 THEN 'no_signal_or_hashtag' END AS reason FROM scored)"""


def cleaned(t: Inputs):
    return quality.clean(t.comments, CFG)


@query(
    "clean_comments",
    """SELECT comment_id, source, 'en' AS lang, toxicity_score, sentiment_score, array_to_string(tags, ',') AS hashtags,
      array_to_string(signals, ',') AS marketing_signals, round(density, 6) AS engagement_density FROM cleaned""",
    ["comments"],
    SCORED,
)
def clean_comments(t: Inputs):
    return cleaned(t).select(
        "comment_id", "source", "lang", "toxicity_score", "sentiment_score",
        F.array_join("hashtags", ",").alias("hashtags"),
        F.array_join("marketing_signals", ",").alias("marketing_signals"),
        F.round("engagement_density", 6).alias("engagement_density"),
    )


@query(
    "dq_log",
    f"""SELECT p.platform, r.reason, CAST(count(f.reason) AS BIGINT) AS count
    FROM (VALUES ('youtube'), ('reddit')) p(platform)
    CROSS JOIN (SELECT unnest([{sql_list(expected.DQ_REASONS)}]) AS reason) r
    LEFT JOIN failed f ON f.platform = p.platform AND f.reason = r.reason GROUP BY 1, 2""",
    ["comments"],
    SCORED + FAILED,
)
def dq_log(t: Inputs):
    return quality.dq_log(t.comments, CFG, PLATFORMS, platform="source")


GAPPY = SCORED.replace("FROM comments", "FROM gappy_comments")
GAPPY_FAILED = FAILED.replace("WHEN density < 0.20 THEN 'ed_lt_0.20'", "WHEN density < 0.20 THEN 'ed_lt_0.20' WHEN density IS NULL THEN 'ed_unknown'")


@query(
    "gappy_clean_comments",
    "SELECT comment_id, round(density, 6) AS engagement_density FROM cleaned",
    ["comments", "gappy_comments"],
    GAPPY,
)
def gappy_clean_comments(t: Inputs):
    """Comments without likes have no density: they go, and no reason of the log counts them."""
    return quality.clean(t.gappy_comments, CFG).select("comment_id", F.round("engagement_density", 6).alias("engagement_density"))


@query(
    "gappy_dq_log",
    f"""SELECT p.platform, r.reason, CAST(count(f.reason) AS BIGINT) AS count
    FROM (VALUES ('youtube'), ('reddit')) p(platform)
    CROSS JOIN (SELECT unnest([{sql_list(expected.DQ_REASONS)}]) AS reason) r
    LEFT JOIN failed f ON f.platform = p.platform AND f.reason = r.reason GROUP BY 1, 2""",
    ["comments", "gappy_comments"],
    GAPPY + GAPPY_FAILED,
)
def gappy_dq_log(t: Inputs):
    return quality.dq_log(t.gappy_comments, CFG, PLATFORMS, platform="source")


@query(
    "gappy_outcomes",
    "SELECT platform, coalesce(reason, 'kept') AS outcome, count(*) AS n FROM failed GROUP BY 1, 2",
    ["comments", "gappy_comments"],
    GAPPY + GAPPY_FAILED,
)
def gappy_outcomes(t: Inputs):
    """Every row has one outcome: kept, or its first failing check."""
    outcome = F.coalesce(quality.first_fail(CFG), F.lit("kept")).alias("outcome")
    return t.gappy_comments.select(F.col("source").alias("platform"), outcome).groupBy("platform", "outcome").agg(F.count("*").alias("n"))


SIGNAL_ROWS = """,
signal_rows AS (SELECT source AS platform, unnest(signals) AS signal, density FROM cleaned),
signal_totals AS (SELECT platform, signal, count(*) AS n, round(avg(density), 3) AS signal_density FROM signal_rows GROUP BY 1, 2),
best AS (SELECT * FROM signal_totals QUALIFY row_number() OVER (PARTITION BY platform ORDER BY n DESC, signal) = 1)"""


@query(
    "kpis",
    """SELECT '2024-03-31' AS "Date", p.platform AS "Platform", CAST(count(c.comment_id) AS BIGINT) AS "TotalComments",
      coalesce(round(avg(CASE WHEN c.sentiment_score > 0.2 THEN 1.0 WHEN c.comment_id IS NOT NULL THEN 0.0 END), 3), 0.0) AS "PositivityRate",
      coalesce(any_value(b.signal), 'n/a') AS "TopTrend", coalesce(any_value(b.signal_density), 0.0) AS "TopTrendScore",
      coalesce(round(avg(c.density), 3), 0.0) AS "AvgEngagementDensity", 'weekly' AS "Notes"
    FROM (VALUES ('youtube'), ('reddit'), ('tiktok')) p(platform) LEFT JOIN cleaned c ON c.source = p.platform
    LEFT JOIN best b ON b.platform = p.platform GROUP BY p.platform""",
    ["comments"],
    SCORED + SIGNAL_ROWS,
)
def platform_kpis(t: Inputs):
    return kpis.compute_kpis(cleaned(t), (*PLATFORMS, "tiktok"), "2024-03-31", platform="source", notes="weekly")


@query("top_signal", "SELECT * FROM best", ["comments"], SCORED + SIGNAL_ROWS)
def top_signal(t: Inputs):
    return kpis.top_signal(cleaned(t), platform="source")


@query(
    "hashtags",
    f"SELECT comment_id, CAST(to_json({TAGS}) AS VARCHAR) AS hashtags, CAST(len({TAGS}) AS BIGINT) AS n FROM comments",
    ["comments"],
)
def hashtags(t: Inputs):
    found = t.comments.select("comment_id", text.hashtags("text").alias("tags"))
    return found.select("comment_id", text.json_arr("tags").alias("hashtags"), F.size("tags").cast("long").alias("n"))


@query(
    "marketing_signals",
    f"SELECT comment_id, CAST(to_json({SIGNALS}) AS VARCHAR) AS signals FROM comments",
    ["comments"],
)
def marketing_signals(t: Inputs):
    return t.comments.select("comment_id", text.json_arr(text.marketing_signals("text")).alias("signals"))


@query(
    "json_lists",
    f"""SELECT comment_id, CASE WHEN comment_id % 4 = 0 THEN '' ELSE array_to_string({SIGNALS}, ',') END AS signals
    FROM comments""",
    ["comments"],
)
def json_lists(t: Inputs):
    as_text = F.when(F.col("comment_id") % 4 == 0, F.lit("not a list")).otherwise(
        text.json_arr(text.marketing_signals("text"))
    )
    return t.comments.select("comment_id", as_text.alias("j")).select(
        "comment_id", F.array_join(text.parse_json_list("j"), ",").alias("signals")
    )


@query(
    "rule_scores",
    f"""SELECT comment_id, CASE WHEN {ENGLISH} THEN 'en' ELSE 'other' END AS lang, {TOXICITY} AS toxicity_score,
    {SENTIMENT} AS sentiment_score FROM comments""",
    ["comments"],
)
def rule_scores(t: Inputs):
    return quality.score(t.comments, CFG).select("comment_id", "lang", "toxicity_score", "sentiment_score")


@query("english_documents", f"SELECT doc_id, {ENGLISH} AS english FROM documents")
def english_documents(t: Inputs):
    return t.documents.select("doc_id", text.is_english("text").alias("english"))


@query(
    "engagement_density",
    f"""SELECT comment_id, round({HOURS}, 6) AS hours, round({DENSITY}, 6) AS density,
    strftime(created_utc, '%Y-%m-%dT%H:%M:%SZ') AS created FROM comments""",
    ["comments"],
)
def engagement_density(t: Inputs):
    density = scoring.engagement_density("likes_or_score", "reply_count", "creator_heart_or_awards", "created_utc", CFG.as_of)
    return t.comments.select(
        "comment_id",
        F.round(clock.hours_since("created_utc", CFG.as_of), 6).alias("hours"),
        F.round(density, 6).alias("density"),
        clock.iso_z("created_utc").alias("created"),
    )


@query(
    "kept_texts",
    f"SELECT doc_id FROM documents WHERE length(text) > 6 AND lower({stripped('text')}) NOT IN ('', '[removed]')",
)
def kept_texts(t: Inputs):
    return t.documents.filter(text.longer_than("text", CFG.min_chars) & text.not_removed("text")).select("doc_id")


# --- merging ---------------------------------------------------------------------------------------------------------


def united(t: Inputs):
    parts = [
        conform.conform_comments(t.raw_comments.filter(F.col("source") == p).drop("source"), p) for p in PLATFORMS
    ]
    return conform.union_sources(*parts)


def merged(t: Inputs):
    first = conform.dedupe_comments(united(t), [F.col("pull_no")])
    return selection.keep_last_n_days(first, CFG.as_of, CFG.window_days)


DEDUPED = """
deduped AS (SELECT * FROM raw_comments QUALIFY row_number() OVER (PARTITION BY text, source, comment_id ORDER BY pull_no) = 1),
merged AS (SELECT * FROM deduped WHERE created_utc >= TIMESTAMP '2024-03-31 00:00:00' - INTERVAL 60 DAY)"""


@query(
    "merged_comments",
    """SELECT comment_id, source, md5(text) AS comment, likes_or_score, CAST(pull_no AS BIGINT) AS pull_no,
    strftime(created_utc, '%Y-%m-%dT%H:%M:%SZ') AS created FROM merged""",
    ["raw_comments"],
    DEDUPED,
)
def merged_comments(t: Inputs):
    return merged(t).select(
        "comment_id", "source", F.md5("comment").alias("comment"), "likes_or_score",
        F.col("pull_no").cast("long").alias("pull_no"), clock.iso_z("created_utc").alias("created"),
    )


@query("deduped_comments", "SELECT source, comment_id, likes_or_score FROM deduped", ["raw_comments"], DEDUPED)
def deduped_comments(t: Inputs):
    return conform.dedupe_comments(united(t), [F.col("pull_no")]).select("source", "comment_id", "likes_or_score")


@query(
    "union_sources",
    """SELECT source, CAST(count(*) AS BIGINT) AS n, CAST(count(video_id) AS BIGINT) AS with_video,
    CAST(count(subreddit) AS BIGINT) AS with_subreddit FROM (
      SELECT 'youtube' AS source, video_id, NULL AS subreddit FROM videos UNION ALL
      SELECT 'reddit' AS source, NULL AS video_id, subreddit FROM reddit_posts) GROUP BY source""",
    ["videos", "reddit_posts"],
)
def union_sources(t: Inputs):
    both = conform.union_sources(
        t.videos.withColumn("source", F.lit("youtube")), t.reddit_posts.withColumn("source", F.lit("reddit"))
    )
    return both.groupBy("source").agg(
        F.count("*").alias("n"), F.count("video_id").alias("with_video"), F.count("subreddit").alias("with_subreddit")
    )


@query(
    "conformed_comments",
    """SELECT 'youtube' AS source, comment_id, md5(text) AS comment, CAST(NULL AS VARCHAR) AS post_title, likes_or_score
    FROM comments WHERE source = 'youtube'""",
    ["comments"],
)
def conformed_comments(t: Inputs):
    raw = t.comments.filter("source = 'youtube'").drop("source")
    return conform.conform_comments(raw, "youtube").select(
        "source", "comment_id", F.md5("comment").alias("comment"), "post_title", "likes_or_score"
    )


@query(
    "conform_header",
    """SELECT CAST(label AS VARCHAR) AS topic, CAST(NULL AS DOUBLE) AS topic_prob, CAST(NULL AS VARCHAR) AS topic_name,
    md5(text) AS document, CAST(NULL AS VARCHAR) AS original_index FROM embedded_docs""",
    ["embedded_docs"],
)
def conform_header(t: Inputs):
    from audience_engine.schemas import TOPIC_MEMBERS

    members = t.embedded_docs.withColumnsRenamed({"label": "topic", "text": "document"})
    return conform.conform_to(members, TOPIC_MEMBERS).select(
        "topic", "topic_prob", "topic_name", F.md5("document").alias("document"), "original_index"
    )


@query(
    "coalesce_text",
    """SELECT topic, variant_id, coalesce(nullif(raw_text, ''), nullif(topic_name, ''), '') AS picked,
    coalesce(nullif(substr(raw_text, 1, 80), ''), '') AS cut FROM llm_drafts""",
    ["llm_drafts"],
)
def coalesce_text(t: Inputs):
    return t.llm_drafts.select(
        "topic", "variant_id", text.coalesce_text("raw_text", "topic_name").alias("picked"),
        text.truncate(text.to_text("raw_text"), 80).alias("cut"),
    )


@query(
    "text_or_joined_fields",
    """SELECT variant_id, coalesce(nullif(raw_text, ''), concat_ws(' ', topic, topic_name, variant_id, raw_text)) AS document
    FROM llm_drafts""",
    ["llm_drafts"],
)
def text_or_joined_fields(t: Inputs):
    return t.llm_drafts.select(
        "variant_id", conform.coalesce_text_or_join(t.llm_drafts, ("raw_text",)).alias("document")
    )


@query(
    "cell_safe",
    """SELECT CAST(vec_id AS VARCHAR) AS vec_id, CASE WHEN vec_id % 5 = 0 THEN '' ELSE CAST(label AS VARCHAR) END AS label,
    concat('[', CAST(vec_id AS VARCHAR), ',', CAST(label AS VARCHAR), ']') AS pair,
    CASE WHEN vec_id % 3 = 0 THEN '' ELSE '1.5' END AS weight FROM embeddings""",
)
def cell_safe(t: Inputs):
    return sinks.cell_safe(
        t.embeddings.select(
            "vec_id",
            F.when(F.col("vec_id") % 5 != 0, F.col("label")).alias("label"),
            F.array(F.col("vec_id"), F.col("label").cast("long")).alias("pair"),
            F.when(F.col("vec_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.lit(1.5)).alias("weight"),
        )
    )


@query(
    "numeric_features",
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_linenumber = 3 THEN 0.0 ELSE l_discount END AS l_discount,
    l_extendedprice AS target FROM lineitem""",
)
def numeric_features(t: Inputs):
    discount = F.when(F.col("l_linenumber") != 3, F.col("l_discount"))
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", discount.alias("l_discount"), "l_returnflag",
        F.col("l_extendedprice").alias("target"),
    )
    return conform.numeric_features(rows)


@query(
    "keyed_union",
    """SELECT video_id, stream, title FROM (
      SELECT video_id, stream, title, 1 AS p FROM videos WHERE stream = 'marketing' UNION ALL
      SELECT video_id, 'popular' AS stream, title, 0 AS p FROM videos WHERE stream = 'popular' OR video_id % 8 = 0)
    QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY p DESC) = 1""",
    ["videos"],
)
def keyed_union(t: Inputs):
    v = t.videos.select("video_id", "stream", "title")
    popular = v.filter("stream = 'popular' OR video_id % 8 = 0").withColumn("stream", F.lit("popular"))
    return conform.keyed_union([popular, v.filter("stream = 'marketing'")], "video_id")


@query(
    "rolling_window",
    f"SELECT comment_id FROM comments WHERE created_utc >= {AS_OF} - INTERVAL 60 DAY",
    ["comments"],
)
def rolling_window(t: Inputs):
    return selection.keep_last_n_days(t.comments, CFG.as_of).select("comment_id")


@query(
    "recent_comments",
    f"""SELECT comment_id, source FROM comments
    WHERE floor(date_diff('second', created_utc, {AS_OF}) / 86400.0) <= 60""",
    ["comments"],
)
def recent_comments(t: Inputs):
    return t.comments.filter(clock.recent_days("created_utc", CFG.as_of, CFG.window_days)).select("comment_id", "source")


@query(
    "stage_counts",
    """SELECT 'merged' AS stage, CAST((SELECT count(*) FROM raw_comments) AS BIGINT) AS before,
    CAST((SELECT count(*) FROM merged) AS BIGINT) AS after""",
    ["raw_comments"],
    DEDUPED,
)
def stage_counts(t: Inputs):
    """Both counts are taken while the merged rows are written."""
    raw, before = quality.observe_counts(united(t), "before")
    first = conform.dedupe_comments(raw, [F.col("pull_no")])
    kept, after = quality.observe_counts(selection.keep_last_n_days(first, CFG.as_of, CFG.window_days), "after")
    cut_lineage(kept)
    row = ("merged", before.get["rows"], after.get["rows"])
    return t.spark.createDataFrame([row], "stage string, before long, after long")


@query(
    "observed_dq_log",
    f"""SELECT p.platform, r.reason, CAST(count(f.reason) AS BIGINT) AS count, any_value((SELECT count(*) FROM cleaned)) AS kept
    FROM (VALUES ('youtube'), ('reddit')) p(platform)
    CROSS JOIN (SELECT unnest([{sql_list(expected.DQ_REASONS)}]) AS reason) r
    LEFT JOIN failed f ON f.platform = p.platform AND f.reason = r.reason GROUP BY 1, 2""",
    ["comments"],
    SCORED + FAILED,
)
def observed_dq_log(t: Inputs):
    """The quality log that a run counts while it writes its cleaned rows, and the number of those."""
    rows, log = quality.observe_dq(t.comments, CFG, PLATFORMS, platform="source")
    kept = cut_lineage(rows.select("comment_id")).agg(F.count("*").alias("kept"))
    counts = [(*name.split("|"), n) for name, n in log.get.items() if "|" in name]
    return t.spark.createDataFrame(counts, "platform string, reason string, count long").withColumn("kept", kept.scalar())
