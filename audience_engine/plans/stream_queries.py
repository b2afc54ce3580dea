"""Streaming queries: everything landed is processed, then the written table is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audience_engine.plans.registry import Inputs, query
from audience_engine.session import cut_lineage, staging_path
from audience_engine.sources.versions import VersionedTable
from audience_engine.streaming import jobs


def landed(t: Inputs, name: str) -> DataFrame:
    """A base table as a stream of files."""
    schema = t.__getattr__(name).schema
    return t.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(t.sf_dir)


def drained(stream: DataFrame, name: str) -> DataFrame:
    spark = stream.sparkSession
    out = staging_path(spark, name)
    jobs.run_available(stream, out, staging_path(spark, f"{name}-progress"))
    return spark.read.schema(stream.schema).parquet(out)


@query(
    "stream_kpis",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS platform, CAST(count(*) AS BIGINT) AS total,
    round(CAST(count(CASE WHEN value > 10 THEN 1 END) AS DOUBLE) / count(*), 3) AS positivity, round(sum(value) / count(*), 3) AS avg_density
    FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 DAY FROM events) GROUP BY 1, 2""",
)
def stream_kpis(t: Inputs):
    events = landed(t, "events").select(
        "ts",
        F.col("event_type").alias("platform"),
        F.when(F.col("value") > 10, F.lit(0.7)).otherwise(F.lit(0.1)).alias("sentiment_score"),
        F.col("value").alias("engagement_density"),
    )
    return drained(jobs.stream_kpis(events, ts="ts"), "stream-kpis")


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type, props FROM events")
def stream_dedupe(t: Inputs):
    events = landed(t, "events").select("ts", "user_id", "event_type", "props")
    # all that has landed is one batch, which holds every repeat; its state expires after it
    unique = jobs.stream_dedupe(events, jobs.DEFAULT_DELAY, "ts", ("user_id", "event_type", "props"))
    return drained(unique.drop("ts"), "stream-dedupe")


@query(
    "stream_first",
    "SELECT event_id, epoch_us(ts) AS at FROM events WHERE ts < (SELECT max(ts) - INTERVAL 10 DAY FROM events)",
)
def stream_first(t: Inputs):
    """Copies land before the earlier rows that they repeat; several batches."""
    inbox = staging_path(t.spark, "copies-inbox")
    events = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    copies = events.select("event_id", (F.col("ts") + F.expr("INTERVAL 12 HOURS")).alias("ts"))
    day = F.floor(F.unix_timestamp("ts") / 86_400)
    first = events.agg(F.min(day).alias("d")).first()["d"]
    placed = copies.withColumn("_file", day - first).unionByName(events.withColumn("_file", day - first + 2))
    slots = cut_lineage(placed.withColumn("_file", F.floor(F.col("_file") / 6)))
    for slot in sorted(r[0] for r in slots.select("_file").distinct().collect()):  # one landing per six days
        slots.filter(F.col("_file") == slot).select("event_id", "ts").coalesce(1).write.mode("append").parquet(inbox)
    stream = t.spark.readStream.schema("event_id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(inbox)
    kept = drained(jobs.stream_first(stream, "4 days", "ts", ("event_id",)), "first")
    # the last days are still open when the stream ends
    end = t.events.agg(F.max("ts").cast("timestamp") - F.expr("INTERVAL 10 DAYS")).scalar()
    return kept.filter(F.col("ts") < end).select("event_id", F.unix_micros("ts").alias("at"))


@query(
    "stream_approvals",
    """SELECT concat('u', CAST(user_id AS VARCHAR)) AS "user", concat('t', CAST(user_id % 7 AS VARCHAR)) AS topic,
    concat('v', CAST(user_id % 20 AS VARCHAR)) AS variant, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type = 'click' GROUP BY 1, 2, 3""",
)
def stream_approvals(t: Inputs):
    inbox = staging_path(t.spark, "approval-inbox")
    t.approvals_raw.select("payload").write.text(inbox)
    rows = drained(jobs.stream_approvals(t.spark, inbox), "stream-approvals")
    return rows.groupBy("user", "topic", "variant").agg(F.count("*").alias("n"))


@query(
    "stream_appended",
    "SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT event_id) AS BIGINT) AS ids, round(sum(value), 4) AS total FROM events GROUP BY 1",
)
def stream_appended(t: Inputs):
    """Landed files appended one by one; what a restart repeats is not added again."""
    rows = t.events.select("event_id", "event_type", "value")
    inbox, progress = staging_path(t.spark, "event-inbox"), staging_path(t.spark, "event-progress")
    rows.repartition(4, "event_id").write.parquet(inbox)
    table = VersionedTable(t.spark, staging_path(t.spark, "event-log"))

    def stream() -> DataFrame:
        return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(inbox)

    table.append_stream(stream(), "events", progress)
    table.append(t.spark.read.schema(rows.schema).parquet(inbox), stream="events", batch=0)  # as a run that lost its last checkpoint
    table.append_stream(stream(), "events", progress)
    counts = table.read().groupBy("event_type")
    return counts.agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"), F.round(F.sum("value"), 4).alias("total"))
