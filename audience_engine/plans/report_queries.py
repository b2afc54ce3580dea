"""Sentiment, metrics and weekly report queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from audience_engine.functions import clock, drafts
from audience_engine.operators import kpis, sentiment
from audience_engine.plans.expected import NEGATORS
from audience_engine.plans.registry import Inputs, query, sql_list

WEEK = kpis.date_window(7, dt.datetime(2024, 3, 10))

WORDS = rf"""
words AS (SELECT source, comment_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM (
  SELECT source, comment_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}_'']+'), lambda w: w <> '') AS ws
  FROM comments)),
looked AS (SELECT w.*, coalesce(lag(word, 1) OVER o IN ({sql_list(NEGATORS)}), false)
    OR coalesce(lag(word, 2) OVER o IN ({sql_list(NEGATORS)}), false)
    OR coalesce(lag(word, 3) OVER o IN ({sql_list(NEGATORS)}), false) AS negated
  FROM words w WINDOW o AS (PARTITION BY source, comment_id ORDER BY place))"""

SENTIMENT = (
    WORDS
    + """,
valued AS (SELECT l.source, l.comment_id, x.valence * CASE WHEN l.negated THEN -0.74 ELSE 1.0 END AS v
  FROM looked l LEFT JOIN lexicon x ON x.word = l.word),
sums AS (SELECT c.source, c.comment_id, coalesce(sum(v), CAST(0 AS DOUBLE)) AS s,
    coalesce(sum(CASE WHEN v > 0 THEN v + 1 END), CAST(0 AS DOUBLE)) AS p,
    coalesce(sum(CASE WHEN v < 0 THEN 1 - v END), CAST(0 AS DOUBLE)) AS n,
    any_value(k.size) - count(CASE WHEN v <> 0 THEN 1 END) AS z
  FROM comments c LEFT JOIN valued USING (source, comment_id)
  LEFT JOIN (SELECT source, comment_id, count(*) AS size FROM words GROUP BY 1, 2) k USING (source, comment_id)
  GROUP BY 1, 2),
sentiment AS (SELECT source, comment_id, coalesce(round(n / nullif(p + n + z, 0), 3), 0) AS neg,
    coalesce(round(z / nullif(p + n + z, 0), 3), 0) AS neu, coalesce(round(p / nullif(p + n + z, 0), 3), 0) AS pos,
    round(s / sqrt(s * s + 15), 4) AS compound,
    CASE WHEN round(s / sqrt(s * s + 15), 4) >= 0.05 THEN 'positive'
      WHEN round(s / sqrt(s * s + 15), 4) <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment_label FROM sums),
labelled AS (SELECT c.comment_id, c.source, c.text, c.created_utc, s.sentiment_label FROM comments c JOIN sentiment s USING (source, comment_id))"""
)


def comments(t: Inputs):
    return t.comments.withColumnRenamed("text", "comment")


def scored(t: Inputs):
    return sentiment.lexicon_sentiment(comments(t), t.lexicon)


@query(
    "lexicon_sentiment",
    "SELECT source, comment_id, neg, neu, pos, compound, sentiment_label FROM sentiment",
    ["comments", "lexicon"],
    SENTIMENT,
)
def lexicon_sentiment(t: Inputs):
    return scored(t).drop("text_hash")


@query(
    "negated_words",
    """SELECT comment_id, CAST(count(*) AS BIGINT) AS words, CAST(count(CASE WHEN negated THEN 1 END) AS BIGINT) AS negated
    FROM looked GROUP BY comment_id""",
    ["comments"],
    WORDS,
)
def negated_words(t: Inputs):
    marked = t.comments.select("comment_id", sentiment.negated(sentiment.words("text")).alias("w"))
    return marked.filter(F.size("w") > 0).select(
        "comment_id",
        F.size("w").cast("long").alias("words"),
        F.size(F.filter("w", lambda w: w["negated"])).cast("long").alias("negated"),
    )


def labelled(t: Inputs):
    return sentiment.join_labels(comments(t), scored(t))


@query("labelled_comments", "SELECT comment_id, source, sentiment_label FROM labelled", ["comments", "lexicon"], SENTIMENT)
def labelled_comments(t: Inputs):
    return labelled(t).select("comment_id", "source", "sentiment_label")


@query(
    "comments_with_sentiment",
    "SELECT comment_id, md5(text) AS comment, compound, s.sentiment_label FROM comments JOIN sentiment s USING (source, comment_id)",
    ["comments", "lexicon"],
    SENTIMENT,
)
def comments_with_sentiment(t: Inputs):
    return sentiment.with_sentiment(comments(t), t.lexicon).select(
        "comment_id", F.md5("comment").alias("comment"), "compound", "sentiment_label"
    )


COUNTS = """CAST(count(*) AS BIGINT) AS total, CAST(count(CASE WHEN sentiment_label = 'positive' THEN 1 END) AS BIGINT) AS pos,
  CAST(count(CASE WHEN sentiment_label = 'negative' THEN 1 END) AS BIGINT) AS neg,
  CAST(count(CASE WHEN sentiment_label = 'neutral' THEN 1 END) AS BIGINT) AS neu"""


@query(
    "comment_metrics",
    f"SELECT round(avg(length(text)), 1) AS avg_len, {COUNTS} FROM labelled",
    ["comments", "lexicon"],
    SENTIMENT,
)
def comment_metrics(t: Inputs):
    return kpis.comment_metrics(sentiment.with_sentiment(comments(t), t.lexicon))


EDITED = """
rows_of AS (SELECT row_number() OVER () AS comment_id, 'any' AS source, text, created_utc FROM edited_comments),""" + SENTIMENT.replace(
    "FROM comments", "FROM rows_of"
)


@query(
    "edited_comment_metrics",
    f"SELECT round(avg(length(text)), 1) AS avg_len, {COUNTS} FROM labelled",
    ["edited_comments", "lexicon"],
    EDITED,
)
def edited_comment_metrics(t: Inputs):
    """Texts that change under one id, and comments without an id, each count once."""
    edited = t.edited_comments.withColumnRenamed("text", "comment")
    labelled = sentiment.join_labels(edited, sentiment.lexicon_sentiment(edited, t.lexicon))
    return kpis.comment_metrics(labelled)


@query(
    "edited_weekly_rollup",
    f"""SELECT '2024-03-03' AS week_start, {COUNTS} FROM labelled
    WHERE created_utc >= TIMESTAMP '2024-03-03' AND created_utc < TIMESTAMP '2024-03-10'""",
    ["edited_comments", "lexicon"],
    EDITED,
)
def edited_weekly_rollup(t: Inputs):
    rows = sentiment.with_sentiment(t.edited_comments.withColumnRenamed("text", "comment"), t.lexicon)
    return kpis.weekly_rollup(rows, t.topic_summary, *WEEK).drop("top5", "names")


@query(
    "sentiment_split",
    """SELECT sentiment_label, CAST(count(*) AS BIGINT) AS n,
    round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 1) AS percent FROM sentiment GROUP BY 1""",
    ["comments", "lexicon"],
    SENTIMENT,
)
def sentiment_split(t: Inputs):
    return kpis.sentiment_split(scored(t))


TOP = """,
top AS (SELECT Name, CAST(sum(Count) AS BIGINT) AS n FROM topic_summary GROUP BY Name ORDER BY n DESC, Name LIMIT 5),
week AS (SELECT * FROM labelled WHERE created_utc >= TIMESTAMP '2024-03-03' AND created_utc < TIMESTAMP '2024-03-10'),
rollup_row AS (SELECT '2024-03-03' AS week_start, """ + COUNTS + """,
  (SELECT string_agg(concat(Name, ' (', CAST(n AS VARCHAR), ')'), '; ' ORDER BY n DESC, Name) FROM top) AS top5,
  (SELECT string_agg(Name, ', ' ORDER BY n DESC, Name) FROM top) AS names FROM week)"""


def weekly(t: Inputs):
    return kpis.weekly_rollup(sentiment.with_sentiment(comments(t), t.lexicon), t.topic_summary, *WEEK)


@query(
    "weekly_rollup",
    "SELECT week_start, total, pos, neu, neg, top5 FROM rollup_row",
    ["comments", "lexicon", "topic_summary"],
    SENTIMENT + TOP,
)
def weekly_rollup(t: Inputs):
    return weekly(t).drop("names")


@query(
    "weekly_message",
    """SELECT concat('*Weekly snapshot* (2024-03-03 → 2024-03-10)', chr(10), 'Total comments: ', CAST(total AS VARCHAR), ' | Pos ',
    CAST(pos AS VARCHAR), ' | Neu ', CAST(neu AS VARCHAR), ' | Neg ', CAST(neg AS VARCHAR), chr(10), 'Top topics: ', names) AS message
    FROM rollup_row""",
    ["comments", "lexicon", "topic_summary"],
    SENTIMENT + TOP,
)
def weekly_message(t: Inputs):
    start, end = (clock.instant(at) for at in WEEK)
    return weekly(t).select(drafts.weekly_message(start, end, "total", "pos", "neu", "neg", "names").alias("message"))


@query(
    "report_window",
    "SELECT comment_id FROM comments WHERE created_utc >= TIMESTAMP '2024-03-03' AND created_utc < TIMESTAMP '2024-03-10'",
    ["comments"],
)
def report_window(t: Inputs):
    return kpis.report_window(t.comments, *WEEK).select("comment_id")


@query(
    "top_topics",
    "SELECT Name, CAST(sum(Count) AS BIGINT) AS n FROM topic_summary GROUP BY Name ORDER BY n DESC, Name LIMIT 20",
    ["topic_summary"],
)
def top_topics(t: Inputs):
    return kpis.top_topics(t.topic_summary, 20)


@query(
    "top_topics_by_rows",
    "SELECT Name, CAST(count(*) AS BIGINT) AS n FROM topic_summary GROUP BY Name ORDER BY n DESC, Name LIMIT 10",
    ["topic_summary"],
)
def top_topics_by_rows(t: Inputs):
    return kpis.top_topics(t.topic_summary, 10, mode="rows")


@query(
    "order_weeks",
    """SELECT strftime(o_orderdate, '%Y-Week-%W') AS week, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1""",
)
def order_weeks(t: Inputs):
    return t.orders.groupBy(clock.week_label("o_orderdate").alias("week")).agg(F.count("*").alias("n"))
