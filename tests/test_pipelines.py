import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from audience_engine.operators import quality
from audience_engine.plans import pipelines
from audience_engine.plans.views import view
from audience_engine.settings import Settings

SF = "/root/testdata/sf0.001"
CFG = Settings()


@pytest.fixture(scope="module")
def comments(spark):
    return view(spark, SF, "comments").withColumn("comment_id", F.col("comment_id").cast("string"))


def test_clean_and_report(spark, comments):
    raw = comments.withColumn("platform", F.col("source"))
    pipelines.clean_and_report(raw, ("youtube", "reddit"), CFG, "run_", "test")
    pipelines.clean_and_report(raw, ("youtube", "reddit"), CFG, "run_", "test")
    assert spark.table("run_kpis").count() == 4 and spark.table("run_dq_log").count() == 16
    reasons = {(r["platform"], r["reason"]): r["count"] for r in spark.table("run_dq_log").distinct().collect()}
    assert reasons == {(r["platform"], r["reason"]): r["count"] for r in quality.dq_log(raw, CFG, ("youtube", "reddit")).collect()}
    where = spark.conf.get("spark.sql.warehouse.dir") + "/run_manifest"
    assert {r["value"] for r in spark.read.text(where).collect()} == {json.dumps({**CFG.manifest(), "notes": "test"}, ensure_ascii=False)}
    total = spark.table("run_kpis").agg(F.sum("TotalComments")).first()[0]
    assert total == 2 * spark.table("run_clean").count() > 0


def test_merge_and_week(spark, comments):
    raw = {s: comments.filter(F.col("source") == s).drop("source") for s in ("youtube", "reddit")}
    merged = pipelines.merge_comments(raw, CFG)
    assert merged.count() == comments.filter("created_utc >= timestamp_ntz'2024-01-31'").count()
    cfg = Settings(as_of=dt.datetime(2024, 3, 10))
    row = pipelines.weekly_report(merged, view(spark, SF, "lexicon"), view(spark, SF, "topic_summary"), cfg).first()
    assert row["total"] == row["pos"] + row["neu"] + row["neg"] > 0
    assert row["folder"] == "2024-Week-10" and row["message"].startswith("*Weekly snapshot* (2024-03-03")


def test_collect(spark, comments):
    videos = view(spark, SF, "videos")
    marketing = videos.filter("stream = 'marketing'").withColumn("keyword", F.lit("k"))
    chosen = pipelines.collect_videos(videos.filter("stream = 'popular'"), marketing, CFG)
    assert 0 < chosen.count() <= 120
    mine = comments.withColumn("video_id", F.col("post_id") + 1)
    rows = pipelines.collect_video_comments(mine, chosen, Settings(comments_per_popular_video=1, comments_per_marketing_video=2))
    counted = rows.groupBy("video_id").count().join(chosen.select("video_id", "stream"), "video_id").collect()
    assert counted and all(r["count"] <= (2 if r["stream"] == "marketing" else 1) for r in counted)
    posts = view(spark, SF, "reddit_posts").limit(60).withColumn("created_utc", F.lit(CFG.as_of).cast("timestamp_ntz"))
    linked = comments.withColumn("post_id", F.col("post_id") + 1)
    kept = pipelines.collect_posts(posts, linked, Settings(comments_per_post=1))
    assert kept.count() == kept.select("post_id").distinct().count()


def test_topics_to_drafts_and_enrolment(spark, comments):
    cfg = Settings(topic_count=4, topic_dims=5, topic_vocabulary=500)
    built, drafted, messages = pipelines.topics_to_drafts({"youtube": comments.filter("source = 'youtube'")}, "comment_id", "text", cfg)
    assert drafted.count() == built.summary.count() > 0
    assert all(r["message"].startswith("*") for r in messages.collect())
    enrolled, predicted = pipelines.enrol_and_rank(drafted, cfg, 3)
    assert enrolled.count() == min(3, drafted.count()) and predicted.count() == 1


def test_outcomes_add_up(spark):
    rows = view(spark, SF, "gappy_comments").withColumn("platform", F.col("source"))
    kept, observed = quality.observe_dq(rows, CFG, ("youtube", "reddit"), "gaps")
    n = kept.count()
    logged = sum(observed.get.values()) - observed.get["rows"]
    outcomes = {r["r"]: r["count"] for r in rows.groupBy(quality.first_fail(CFG).alias("r")).count().collect()}
    assert n == quality.clean(rows, CFG).count() == outcomes[None]
    assert logged + n + sum(outcomes.get(r, 0) for r in quality.UNLOGGED) == rows.count()
    assert outcomes.get("ed_unknown", 0) > 0


def test_two_texts_and_null_ids_count_once(spark, comments):
    edited = view(spark, SF, "edited_comments").withColumnsRenamed({"text": "comment"})
    cfg = Settings(as_of=dt.datetime(2024, 3, 10))
    row = pipelines.weekly_report(edited, view(spark, SF, "lexicon"), view(spark, SF, "topic_summary"), cfg).first()
    week = edited.filter("created_utc >= timestamp_ntz'2024-03-03' and created_utc < timestamp_ntz'2024-03-10'")
    assert row["total"] == week.count() > week.select("comment_id").distinct().count()


def test_staged_tables_go(spark):
    from pathlib import Path

    from audience_engine.session import cut_lineage, staged_for_now

    kept = cut_lineage(spark.range(3))
    with staged_for_now(spark):
        path = cut_lineage(spark.range(5)).inputFiles()[0].removeprefix("file:")
        assert Path("/" + path.lstrip("/")).exists()
    assert not Path("/" + path.lstrip("/")).exists() and kept.count() == 3
