import datetime as dt

from pyspark.sql import functions as F

from audience_engine.functions.drafts import parse_approval
from audience_engine.schemas import RAW_POST_COMMENT
from audience_engine.sources.sinks import write_jsonl
from audience_engine.streaming import jobs

DAY = dt.datetime(2024, 1, 1)


def comment(i, day, text="t", hour=0):
    return ("reddit", "p", str(i), DAY + dt.timedelta(days=day, hours=hour), text, i, 0, 0, 0, "a", "u")


def land(spark, path, rows, date):
    write_jsonl(spark.createDataFrame(rows, RAW_POST_COMMENT).coalesce(1), path, date)


def test_snapshots_are_read_once(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    land(spark, inbox, [comment(1, 0)], "2024-01-01")
    jobs.run_available(jobs.stream_snapshots(spark, inbox, RAW_POST_COMMENT), out, state)
    land(spark, inbox, [comment(2, 1)], "2024-01-02")
    jobs.run_available(jobs.stream_snapshots(spark, inbox, RAW_POST_COMMENT), out, state)
    assert sorted(r["comment_id"] for r in spark.read.parquet(out).collect()) == ["1", "2"]


def test_dedupe_equals_batch(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    days = [[comment(i, d) for i in range(d * 5, d * 5 + 10)] for d in range(4)]
    for d, rows in enumerate(days):
        land(spark, inbox, rows, f"2024-01-0{d + 1}")

    def stream():
        df = jobs.stream_snapshots(spark, inbox, RAW_POST_COMMENT, 1)
        return jobs.stream_dedupe(df, "30 days", keys=("comment_id", "text"))

    jobs.run_available(stream(), out, state)
    land(spark, inbox, days[0], "2024-01-09")
    jobs.run_available(stream(), out, state)
    got = [r["comment_id"] for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) and set(got) == {r[2] for rows in days for r in rows}


def test_daily_kpis_equal_batch_and_drop_late_rows(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = [[comment(i, d, hour=i % 24) for i in range(30)] for d in range(6)]
    for d, day in enumerate(rows):
        land(spark, inbox, day, f"2024-01-0{d + 1}")

    def stream():
        df = jobs.stream_snapshots(spark, inbox, RAW_POST_COMMENT).withColumns(
            {
                "sentiment_score": F.when(F.col("likes_or_score") % 3 == 0, 0.7).otherwise(0.1),
                "engagement_density": F.col("likes_or_score").cast("double"),
            }
        )
        return jobs.stream_kpis(df, "1 day")

    jobs.run_available(stream(), out, state)
    first = {r["day"]: r for r in spark.read.parquet(out).collect()}
    # days that ended a day before the newest row
    assert sorted(first) == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    for row in first.values():
        assert (row["total"], row["positivity"], row["avg_density"]) == (30, round(10 / 30, 3), 14.5)
    land(spark, inbox, [comment(99, 0)], "2024-01-07")  # later than the watermark
    land(spark, inbox, [comment(98, 20)], "2024-01-08")
    jobs.run_available(stream(), out, state)
    days = [r["day"] for r in spark.read.parquet(out).collect()]
    assert len(days) == len(set(days)) == 6


def test_approvals_stream(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    payloads = [f'{{"user":{{"id":"u{i}"}},"actions":[{{"value":"t{i}||v||{i}"}}]}}' for i in range(5)]
    df = spark.createDataFrame([(p,) for p in payloads], "value string")
    df.write.text(inbox)
    jobs.run_available(jobs.stream_approvals(spark, inbox), out, state)
    batch = df.select(parse_approval("value").alias("a")).select("a.*")
    assert sorted(spark.read.parquet(out).collect()) == sorted(batch.collect())


def test_dedupe_state_expires(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    landings = [[comment(1, 0), comment(1, 0)], [comment(2, 10), comment(2, 10, text=None)], [comment(1, 20)], [comment(1, 40), comment(2, 40)]]
    for n, rows in enumerate(landings):
        land(spark, inbox, rows, f"2024-01-0{n + 1}")
        stream = jobs.stream_dedupe(jobs.stream_snapshots(spark, inbox, RAW_POST_COMMENT), "2 days", keys=("comment_id", "text"))
        assert "_key" not in stream.columns
        jobs.run_available(stream, out, state)
    got = sorted((r["comment_id"], r["text"] or "", r["created_utc"].day) for r in spark.read.parquet(out).collect())
    # a run ends by dropping what the watermark has passed: the comment of day 0 is new again on day 20, not on day 40
    assert got == sorted([("1", "t", 1), ("1", "t", 21), ("2", "", 11), ("2", "t", 11), ("2", "t", 10)])


def test_first_by_event_time_in_any_order(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    landings = [
        [comment(1, 3), comment(2, 1), comment(2, 1, text="u")],
        [comment(1, 1), comment(3, 4), comment(2, 2)],  # an earlier row of 1 comes late
        [comment(1, 2, hour=5), comment(3, 4, text=None)],
        [comment(9, 30)],
        [comment(1, 40), comment(9, 60)],  # 1 comes again long after
    ]
    for n, rows in enumerate(landings):
        land(spark, inbox, rows, f"2024-01-0{n + 1}")
        stream = jobs.stream_first(jobs.stream_snapshots(spark, inbox, RAW_POST_COMMENT, 1), "4 days", keys=("comment_id", "text"))
        jobs.run_available(stream, out, state)
    got = sorted((r["comment_id"], r["text"] or "", (r["created_utc"].replace(tzinfo=None) - DAY).days) for r in spark.read.parquet(out).collect())
    assert got == sorted([("1", "t", 1), ("2", "t", 1), ("2", "u", 1), ("3", "t", 4), ("3", "", 4), ("9", "t", 30), ("1", "t", 40)])
