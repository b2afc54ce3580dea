"""The engine's input tables as views over the given base tables.

One text serves both engines; ``$S`` is the text type and ``$TS`` the planted time of a document.
"""

from __future__ import annotations

import zlib
from string import Template

from pyspark.sql import DataFrame, SparkSession

from audience_engine.session import use_all_cores
from audience_engine.vocabulary import SIGNAL_PHRASES

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

LONG_TEXTS = ("documents",)

_PLANTED = ",".join(SIGNAL_PHRASES)

VIEWS = {
    "comments": f"""
SELECT doc_id AS comment_id, CASE WHEN doc_id % 2 = 0 THEN 'youtube' ELSE 'reddit' END AS source,
  source AS channel_id, doc_id % 50 AS post_id, concat('user', CAST(doc_id % 97 AS $S)) AS author,
  concat(text,
    CASE WHEN doc_id % 3 = 0 THEN concat(' ', split_part('{_PLANTED}', ',', CAST(doc_id % 29 + 1 AS INT))) ELSE '' END,
    CASE WHEN doc_id % 7 = 1 THEN concat(' #Tag', CAST(doc_id % 11 AS $S)) ELSE '' END,
    CASE WHEN doc_id % 5 = 0 THEN ' works' WHEN doc_id % 5 = 1 THEN ' broken' ELSE '' END) AS text,
  (doc_id * 7919) % 500 AS likes_or_score, (doc_id * 31) % 40 AS reply_count, doc_id % 3 AS creator_heart_or_awards,
  $TS AS created_utc FROM $documents""",
    "raw_comments": """
SELECT *, 1 AS pull_no FROM $comments UNION ALL
SELECT comment_id, source, channel_id, post_id, author, text, likes_or_score + 1 AS likes_or_score, reply_count,
  creator_heart_or_awards, created_utc, 2 AS pull_no FROM $comments WHERE comment_id % 10 = 0""",
    "gappy_comments": """
SELECT comment_id, source, text, CASE WHEN comment_id % 13 = 0 THEN NULL ELSE likes_or_score END AS likes_or_score, reply_count,
  creator_heart_or_awards, CASE WHEN comment_id % 17 = 0 THEN NULL ELSE created_utc END AS created_utc FROM $comments""",
    "edited_comments": """
SELECT CASE WHEN doc_id % 11 = 0 THEN NULL ELSE doc_id END AS comment_id, 'youtube' AS source, text, $TS AS created_utc FROM $documents
UNION ALL SELECT CASE WHEN doc_id % 11 = 0 THEN NULL ELSE doc_id END AS comment_id, 'youtube' AS source,
  concat(text, CASE WHEN doc_id % 20 = 0 THEN ' not great' ELSE ' useless but useful' END) AS text, $TS AS created_utc
FROM $documents WHERE doc_id % 10 = 0 OR doc_id % 11 = 0""",
    "videos": """
SELECT p_partkey AS video_id, CASE WHEN p_partkey % 4 = 0 THEN 'marketing' ELSE 'popular' END AS stream,
  split_part('US,GB,CA,AU,IE', ',', CAST(p_partkey % 5 + 1 AS INT)) AS region, p_type AS category, p_name AS title,
  CASE WHEN p_partkey % 13 = 0 THEN '' ELSE p_brand END AS channel_id,
  CASE WHEN p_partkey % 4 = 0 THEN 100 ELSE p_size * 10 END AS comment_count,
  CAST(p_retailprice * 100 AS BIGINT) AS view_count, p_partkey % 97 AS like_count, p_partkey AS position FROM $part""",
    "reddit_posts": """
SELECT o_orderkey AS post_id, concat(o_orderpriority, '/', o_orderstatus) AS subreddit,
  CAST(floor(o_totalprice) AS BIGINT) % 10000 AS score, o_orderkey AS position, o_orderdate AS created_utc FROM $orders""",
    "ab_log": """
SELECT concat('p', CAST(k AS $S)) AS post_id, concat('t', CAST(k % 7 AS $S)) AS topic,
  concat('v', CAST(k % 20 AS $S)) AS variant_id, min(ts) AS ts,
  CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS replies,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS likes,
  CASE WHEN k % 9 = 0 THEN NULL ELSE round(CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS DOUBLE)
    / greatest(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END), 1), 4) END AS ctr
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM $events) e GROUP BY k""",
    "approvals_raw": """
SELECT event_id, ts, concat('{"user":{"username":"u', CAST(user_id AS $S), '"},"actions":[{"value":"t',
  CAST(user_id % 7 AS $S), '||v', CAST(user_id % 20 AS $S), '"}]}') AS payload
FROM $events WHERE event_type = 'click'""",
    "llm_drafts": """
SELECT conv_id AS topic, concat('topic ', CAST(conv_id AS $S)) AS topic_name,
  concat(CAST(conv_id AS $S), '_', CAST(turn AS $S)) AS variant_id,
  CASE WHEN conv_id % 3 = 0 THEN concat(left(text, 60), ' || "Read more"') WHEN conv_id % 3 = 1 THEN text ELSE '' END
    AS raw_text
FROM $conversations WHERE role = 'assistant'""",
    "embedded_docs": """
SELECT e.vec_id AS doc_id, e.label, e.embedding, d.text FROM $embeddings e JOIN $documents d ON d.doc_id = e.vec_id""",
    "lexicon": """
SELECT word, CAST(valence AS DOUBLE) AS valence FROM (VALUES ('great', 3.0), ('love', 3.0), ('awesome', 3.0),
  ('useful', 2.0), ('works', 1.0), ('broken', -2.0), ('useless', -2.0), ('hate', -3.0), ('worst', -3.0),
  ('idiot', -2.5), ('stupid', -2.5), ('trash', -1.5), ('worthless', -2.0)) AS t(word, valence)""",
    "topic_summary": """
SELECT concat(source, '/', lang) AS Topic, count(*) AS Count, source AS Name FROM $documents GROUP BY source, lang""",
}

_SPARK = {
    "S": "STRING",
    "TS": "timestampadd(HOUR, CAST((doc_id * 37) % 1800 AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00')",
}
_DUCK = {
    "S": "VARCHAR",
    "TS": "TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST((doc_id * 37) % 1800 AS INTEGER))",
}


def _needs(name: str) -> list[str]:
    text = VIEWS.get(name, "")
    return [n for n in (*BASE, *VIEWS) if f"${n}" in text and n != name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, read with only the columns that the query ends up using.

    The test data keeps all texts in one row group, which one task would have to work through alone.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return use_all_cores(df) if name in LONG_TEXTS else df


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a derived view."""
    if name in BASE:
        return table(spark, sf_dir, name)
    prefix = f"ae_{zlib.crc32(sf_dir.encode()):08x}_"
    for needed in _needs(name):
        view(spark, sf_dir, needed).createOrReplaceTempView(prefix + needed)
    names = {n: prefix + n for n in (*BASE, *VIEWS)}
    return spark.sql(Template(VIEWS[name]).substitute(_SPARK, **names))


def duck_views(*names: str) -> str:
    """The derived views as leading common table expressions, in dependency order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in BASE or name in ordered:
            return
        for needed in _needs(name):
            add(needed)
        ordered.append(name)

    for name in names:
        add(name)
    same = {n: n for n in (*BASE, *VIEWS)}
    return ",\n".join(f"{n} AS ({Template(VIEWS[n]).substitute(_DUCK, **same)})" for n in ordered)
