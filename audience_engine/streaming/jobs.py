"""Incremental ingest, deduplication, daily KPIs and approvals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from audience_engine.functions.drafts import parse_approval

DEFAULT_DELAY = "2 days"


def stream_snapshots(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Landed JSON-lines snapshots as a stream; each file is read once."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def _timed(df: DataFrame, ts: str, delay: str) -> DataFrame:
    # a time without zone cannot carry a watermark
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def stream_dedupe(
    df: DataFrame,
    delay: str = DEFAULT_DELAY,
    ts: str = "created_utc",
    keys: Sequence[str] = ("comment_id", "source", "comment"),
) -> DataFrame:
    """The first arrival of each key within the watermark.

    The state holds a 256-bit digest per key, whatever the length of its texts, and expires with the watermark.
    """
    digest = F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256)
    return _timed(df, ts, delay).withColumn("_key", digest).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def stream_first(
    df: DataFrame,
    delay: str = DEFAULT_DELAY,
    ts: str = "created_utc",
    keys: Sequence[str] = ("comment_id", "source", "comment"),
) -> DataFrame:
    """The row of each key that is first by event time, whatever the order of arrival.

    Rows of a key that are no more than ``delay`` apart are one session; its earliest row (of equal times the one with the
    smallest hash) is held in the state, which Spark merges when a row between two sessions arrives late, and comes out once
    the watermark has passed the session's end, ``delay`` after its last row.
    """
    digest = F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256)
    row = F.struct(*df.columns)
    timed = _timed(df, ts, delay).withColumn("_key", digest)
    sessions = timed.groupBy("_key", F.session_window(ts, delay))
    return sessions.agg(F.min_by(row, F.struct(ts, F.xxhash64(*df.columns))).alias("_row")).select("_row.*")


def stream_kpis(
    df: DataFrame, delay: str = DEFAULT_DELAY, ts: str = "created_utc", platform: str = "platform",
    positive_above: float = 0.2,
) -> DataFrame:
    """Totals per day and platform; a day is emitted once the watermark has passed it, and later rows are dropped."""
    return (
        _timed(df, ts, delay)
        .groupBy(F.window(ts, "1 day").alias("w"), F.col(platform).alias("platform"))
        .agg(
            F.count("*").alias("total"),
            F.count_if(F.col("sentiment_score") > positive_above).alias("positive"),
            F.sum("engagement_density").alias("density"),
        )
        .select(
            F.date_format("w.start", "yyyy-MM-dd").alias("day"),
            "platform",
            "total",
            F.round(F.col("positive") / F.col("total"), 3).alias("positivity"),
            F.round(F.col("density") / F.col("total"), 3).alias("avg_density"),
        )
    )


def stream_approvals(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Approval payloads, one JSON text per line, as (user, topic, variant)."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return approvals(reader.text(path), "value")


def approvals(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Approval rows of a batch or stream of payloads."""
    return df.select(parse_approval(payload).alias("a")).select("a.*")


def run_available(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything landed so far into parquet, then stop. A restart goes on where the checkpoint ends."""
    query = (
        df.writeStream.outputMode(mode)
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return query
