"""Sources and sinks: what is written is read back and compared with the table it came from."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audience_engine.functions import clock
from audience_engine.plans.registry import Inputs, query
from audience_engine.plans.stream_queries import drained
from audience_engine.schemas import AB_LOG, RAW_VIDEO_COMMENT
from audience_engine.session import staging_path
from audience_engine.settings import Settings
from audience_engine.sources import readers, sinks
from audience_engine.streaming import jobs

CFG = Settings()


def fresh(name: str) -> str:
    """A table name that no other run has."""
    return f"ae_{name}_{uuid.uuid4().hex[:12]}"


def snapshot(t: Inputs) -> DataFrame:
    """Video comments with the columns in another order than the raw schema's, one of them unknown to it."""
    return t.comments.filter("source = 'youtube'").select(
        "text",
        F.col("comment_id").cast("string").alias("comment_id"),
        clock.iso_z("created_utc").alias("created_utc"),
        F.lit("extra").alias("not_a_column"),
        F.col("likes_or_score").cast("string").alias("likes_or_score"),
        F.lit("youtube").alias("platform"),
    )


READ_BACK = """SELECT CAST(comment_id AS VARCHAR) AS comment_id, 'youtube' AS platform, md5(text) AS text, likes_or_score,
    CAST(NULL AS VARCHAR) AS author, strftime(created_utc, '%Y-%m-%dT%H:%M:%SZ') AS created FROM comments WHERE source = 'youtube'"""


def read_back(df: DataFrame) -> DataFrame:
    return df.select("comment_id", "platform", F.md5("text").alias("text"), "likes_or_score", "author", clock.iso_z("created_utc").alias("created"))


@query("csv_round_trip", READ_BACK, ["comments"])
def csv_round_trip(t: Inputs):
    path = staging_path(t.spark, "csv")
    sinks.write_csv(snapshot(t), path)
    return read_back(readers.read_comments_csv(t.spark, path, "youtube"))


@query("jsonl_round_trip", READ_BACK, ["comments"])
def jsonl_round_trip(t: Inputs):
    path = staging_path(t.spark, "jsonl")
    typed = snapshot(t).withColumn("likes_or_score", F.col("likes_or_score").cast("long"))
    sinks.write_jsonl(typed, path, "2024-03-31")
    return read_back(readers.read_comments_jsonl(t.spark, path, "youtube"))


@query("table_round_trip", READ_BACK, ["comments"])
def table_round_trip(t: Inputs):
    name = fresh("replaced")
    rows = readers.typed_as(snapshot(t), RAW_VIDEO_COMMENT)
    sinks.replace_table(rows.limit(1), name)
    sinks.replace_table(rows, name)
    return read_back(readers.read_table(t.spark, name))


@query(
    "appended_log",
    "SELECT post_id, CAST(2 * count(*) AS BIGINT) AS n, CAST(2 * count(ctr) AS BIGINT) AS rated FROM ab_log GROUP BY post_id",
    ["ab_log"],
)
def appended_log(t: Inputs):
    name = fresh("appended")
    rows = t.ab_log.select(*[(F.col(f.name) if f.name in t.ab_log.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in AB_LOG])
    for _ in range(2):
        sinks.append_table(rows, name, AB_LOG)
    return t.spark.table(name).groupBy("post_id").agg(F.count("*").alias("n"), F.count("ctr").alias("rated"))


@query(
    "csv_ab_log",
    "SELECT post_id, variant_id, replies, likes, ctr, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts FROM ab_log",
    ["ab_log"],
)
def csv_ab_log(t: Inputs):
    path = staging_path(t.spark, "ab-log")
    sinks.write_csv(t.ab_log.select("ctr", "likes", "replies", "ts", "variant_id", "topic", "post_id"), path)
    return readers.read_ab_log(t.spark, path).select("post_id", "variant_id", "replies", "likes", "ctr", clock.iso_z("ts").alias("ts"))


@query(
    "resolved_sources",
    """SELECT 'youtube' AS source, count(*) AS n, sum(length(text)) AS chars FROM comments WHERE source = 'youtube'
    UNION ALL SELECT 'reddit', count(*), sum(length(text)) FROM comments WHERE source = 'reddit'""",
    ["comments"],
)
def resolved_sources(t: Inputs):
    """The snapshot where there is one, the stored table where the path is empty."""
    path, name = staging_path(t.spark, "snapshot"), fresh("stored")
    sinks.write_csv(snapshot(t), path)
    sinks.replace_table(t.comments.filter("source = 'reddit'").select("comment_id", "text"), name)
    first = readers.resolve_source(t.spark, path, "no_such_table", "youtube")
    second = readers.resolve_source(t.spark, "", name, "reddit")
    both = first.select("source", "comment").unionByName(second.select("source", "comment"))
    return both.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.length("comment")).alias("chars"))


@query(
    "bulk_loaded",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size FROM part",
)
def bulk_loaded(t: Inputs):
    path, name = staging_path(t.spark, "bulk"), fresh("bulk")
    sinks.write_csv(t.part.select("p_size", "p_name", "p_partkey"), path)
    sinks.bulk_load(t.spark, {name: path, fresh("none"): f"{path}-missing"}, skip_missing=True)
    return t.spark.table(name).select("p_partkey", "p_name", "p_size")


@query(
    "manifested_run",
    """SELECT '2024-03-31T00:00:00Z' AS as_of, CAST(0.2 AS DOUBLE) AS min_density, concat('rows ', CAST(count(*) AS VARCHAR)) AS notes FROM comments""",
    ["comments"],
)
def manifested_run(t: Inputs):
    path = staging_path(t.spark, "manifest")
    sinks.write_manifest(t.spark, CFG, path, notes=f"rows {t.comments.count()}")
    return t.spark.read.schema("as_of string, min_density double, notes string").json(path)


@query("fallback_written", "SELECT s_name, s_nationkey FROM supplier")
def fallback_written(t: Inputs):
    """A table name that cannot be written: the rows go to the folder instead."""
    path = staging_path(t.spark, "fallback")
    written = sinks.write_with_fallback(t.supplier.select("s_nationkey", "s_name"), "no_such_database.suppliers", path)
    rows = t.spark.read.option("header", True).csv(written)
    return rows.select("s_name", F.col("s_nationkey").cast(t.supplier.schema["s_nationkey"].dataType).alias("s_nationkey"))


@query("training_rows", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice AS target FROM lineitem")
def training_rows(t: Inputs):
    path = staging_path(t.spark, "training")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_extendedprice").alias("target"))
    rows.write.option("header", True).csv(path)
    return readers.read_training(t.spark, path, schema=T.StructType(list(rows.schema)))


@query("streamed_snapshots", READ_BACK, ["comments"])
def streamed_snapshots(t: Inputs):
    path = staging_path(t.spark, "landed")
    typed = snapshot(t).withColumn("likes_or_score", F.col("likes_or_score").cast("long"))
    sinks.write_jsonl(typed, path, "2024-03-31")
    stream = jobs.stream_snapshots(t.spark, path, RAW_VIDEO_COMMENT)
    return read_back(drained(stream, "snapshots"))
