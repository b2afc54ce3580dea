import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from audience_engine.operators import conform, experiments, joining, kpis, quality, selection, sentiment, variants
from audience_engine.schemas import TOPIC_MEMBERS
from audience_engine.settings import Settings

CFG = Settings()
AS_OF = CFG.as_of
COMMENT = "platform string, text string, likes_or_score long, reply_count long, creator_heart_or_awards long, created_utc timestamp_ntz"


def comment_rows(spark, rows):
    hour_ago = AS_OF - dt.timedelta(hours=1)
    return spark.createDataFrame([(p, t, likes, 0, 0, hour_ago) for p, t, likes in rows], COMMENT)


ROWS = [
    ("yt", "short", 9), ("yt", "déjà vu été là", 9), ("yt", "the worst launch", 9), ("yt", "a launch today", 0),
    ("yt", "nothing to see", 9), ("yt", "great launch #Now", 9), ("yt", "launch of a reel", 2), ("rd", "only #tag here", 1),
]


def test_clean_and_log(spark):
    df = comment_rows(spark, ROWS)
    kept = quality.clean(df, CFG).orderBy("text").collect()
    assert [r["text"] for r in kept] == ["great launch #Now", "launch of a reel", "only #tag here"]
    assert kept[0]["sentiment_score"] == 0.7 and kept[0]["hashtags"] == ["#now"] and kept[0]["lang"] == "en"
    log = {(r["platform"], r["reason"]): r["count"] for r in quality.dq_log(df, CFG, ("yt", "rd", "none")).collect()}
    assert len(log) == 12
    assert {k: v for k, v in log.items() if v} == {
        ("yt", "lang_other"): 1, ("yt", "toxicity_gt_0.30"): 1, ("yt", "ed_lt_0.20"): 1, ("yt", "no_signal_or_hashtag"): 1
    }


def test_observed_log_equals_log(spark):
    df = comment_rows(spark, ROWS)
    cleaned, seen = quality.observe_dq(df, CFG, ("yt", "rd"))
    assert cleaned.count() == 3
    assert seen.get["rows"] == 8
    for row in quality.dq_log(df, CFG, ("yt", "rd")).collect():
        assert seen.get[f"{row['platform']}|{row['reason']}"] == row["count"]


def test_kpis(spark):
    out = {r["Platform"]: r for r in kpis.compute_kpis(quality.clean(comment_rows(spark, ROWS), CFG), ("yt", "rd", "none"), "d").collect()}
    assert (out["yt"]["TotalComments"], out["yt"]["PositivityRate"], out["yt"]["TopTrend"], out["yt"]["TopTrendScore"]) == (2, 0.5, "launch", 5.5)
    assert (out["rd"]["TopTrend"], out["rd"]["TopTrendScore"], out["rd"]["AvgEngagementDensity"]) == ("n/a", 0.0, 1.0)
    assert (out["none"]["TotalComments"], out["none"]["PositivityRate"], out["none"]["TopTrend"]) == (0, 0.0, "n/a")


def test_kpi_signal_tie_and_positive_bound(spark):
    rows = [("p", 0.2, ["short", "reel"], 1.0), ("p", 0.21, ["short", "reel"], 3.0)]
    df = spark.createDataFrame(rows, "platform string, sentiment_score double, marketing_signals array<string>, engagement_density double")
    row = kpis.compute_kpis(df, ("p",), "d").first()
    assert (row["TopTrend"], row["TopTrendScore"], row["PositivityRate"]) == ("reel", 2.0, 0.5)
    assert kpis.top_signal(df).first()["signal"] == "reel"


def test_conform_and_union(spark):
    a = spark.createDataFrame([("t", "1")], "Comment_Text string, comment_id string")
    out = conform.conform_comments(a, "youtube")
    row = out.first()
    assert (row["comment"], row["source"], row["post_title"]) == ("t", "youtube", None)
    assert dict(out.dtypes)["likes_or_score"] == "bigint"
    both = conform.union_sources(out, conform.conform_comments(spark.createDataFrame([("u", 5)], "text string, extra int"), "reddit"))
    assert {r["source"]: r["extra"] for r in both.collect()} == {"youtube": None, "reddit": 5}
    fixed = conform.conform_to(spark.createDataFrame([(1, "x", True)], "topic int, document string, dropped boolean"), TOPIC_MEMBERS)
    assert fixed.columns == [f.name for f in TOPIC_MEMBERS] and fixed.first()["topic"] == "1"


def test_dedupe_keeps_first_and_null_ids(spark):
    rows = [("c", "y", "1", 2), ("c", "y", "1", 1), ("c", "r", "1", 3), ("c", "y", None, 5), ("c", "y", None, 4)]
    df = spark.createDataFrame(rows, "comment string, source string, comment_id string, n int")
    assert sorted(r["n"] for r in conform.dedupe_comments(df, [F.col("n")]).collect()) == [1, 3, 4]
    assert conform.dedupe_comments(spark.createDataFrame([(1,), (1,)], "a int"), []).count() == 1


def test_keyed_union_later_wins(spark):
    a = spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string")
    b = spark.createDataFrame([(2, "b"), (3, "b")], "k int, v string")
    assert {r["k"]: r["v"] for r in conform.keyed_union([a, b], "k").collect()} == {1: "a", 2: "b", 3: "b"}


def test_numeric_features(spark):
    df = spark.createDataFrame([(1.0, None, "x", 2.0)], "a double, b int, c string, target double")
    assert conform.numeric_features(df).first().asDict() == {"a": 1.0, "b": 0, "target": 2.0}
    with pytest.raises(ValueError):
        conform.numeric_features(df.select("c", "target"))
    with pytest.raises(ValueError):
        conform.numeric_features(df.drop("target"))


def test_rolling_window(spark):
    df = spark.createDataFrame([("2024-01-31T00:00:00Z",), ("2024-01-30T23:59:59Z",), ("bad",), (None,)], "created_utc string")
    assert selection.keep_last_n_days(df, AS_OF, 60).count() == 1
    assert selection.keep_last_n_days(df.withColumnRenamed("created_utc", "x"), AS_OF).count() == 4


def test_channel_cap(spark):
    rows = [(1, "c", 5, 1), (2, "c", 5, 1), (3, "c", 5, 2), (4, "", 1, 1), (5, "", 1, 1), (6, None, 1, 1), (7, None, 0, 0)]
    df = spark.createDataFrame([(*r, r[0]) for r in rows], "video_id int, channel_id string, comment_count int, view_count int, position int")
    assert sorted(r[0] for r in selection.cap_per_channel(df).select("video_id").collect()) == [1, 3, 4, 5, 6, 7]
    assert [r[0] for r in selection.select_videos(df, n=3).select("video_id").collect()] == [3, 1, 4]


def place(scores, p):
    ordered = sorted(scores)
    return ordered[max(0, min(len(ordered) - 1, int(p * len(ordered)) - 1))]


def test_threshold_equals_sorted_place(spark):
    rng = random.Random(7)
    groups = {
        "one": [5], "two": [9, 1], "five": [1, 2, 3, 4, 5], "equal": [7] * 9, "hot": [rng.randint(-50, 50) for _ in range(4000)],
        "wide": [int(rng.lognormvariate(8, 4)) - 100 for _ in range(2000)], "huge": [rng.randint(-(2**62), 2**62) for _ in range(500)],
    }
    df = spark.createDataFrame([(g, s) for g, v in groups.items() for s in v] + [(None, 1), ("one", None)], "g string, score long")
    for p in (0.75, 0.5, 0.1):
        got = {r["g"]: r["threshold"] for r in selection.score_threshold(df, "g", p).collect()}
        # a missing score counts as 0
        assert got == {g: place([*v, 0] if g == "one" else v, p) for g, v in groups.items()}


def test_pick_posts_order(spark):
    rows = [(1, "s", 10), (2, "s", 30), (3, "s", 20), (4, "s", 40), (4, "s", 40)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "post_id int, subreddit string, score int, position int")
    assert {r["post_id"] for r in selection.pick_posts(df, p=0.5).collect()} == {2, 3}
    assert {r["post_id"] for r in selection.pick_posts(df, p=0.5, order="score").collect()} == {2, 4}


def test_cap_by_column_and_salted_cap(spark):
    df = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"))
    plain = selection.cap_per_group(df, "g", 50, [F.col("id")])
    salted = selection.cap_per_group(df, "g", 50, [F.col("id")], spread_by=["id"])
    assert sorted(plain.collect()) == sorted(salted.collect())
    by_column = selection.cap_per_group(df.withColumn("cap", F.when(F.col("g") == "hot", 3).otherwise(1)), "g", F.col("cap"), [F.col("id")], max_n=3)
    assert by_column.filter("g = 'hot'").count() == 3
    with pytest.raises(ValueError):
        selection.cap_per_group(df, "g", F.lit(2), [F.col("id")])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_with_a_hot_key(spark, how):
    facts = spark.range(50_000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.createDataFrame([(1, "a"), (4, "b"), (7, "c"), (7, "d")], "k long, v string")

    def rows():
        return sorted(map(tuple, joining.lookup_join(facts, lookup, "k", how).collect()), key=repr)

    want = rows()
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    }
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        joined = joining.lookup_join(facts, lookup, "k", how)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Generate" not in plan and "InMemory" not in plan
        assert rows() == want
    finally:
        for key in small:
            spark.conf.unset(key)


def test_dense_index(spark):
    df = spark.range(1000).select(F.concat(F.lit("v"), "id").alias("v"))
    indexed = joining.dense_index(df, "v", "i", buckets=16).collect()
    assert sorted(r["i"] for r in indexed) == list(range(1000))


def test_attach_meta(spark):
    comments = spark.createDataFrame([(1, "a"), (2, "b")], "video_id int, comment_id string")
    videos = spark.createDataFrame([(1, "cat", "US", "T", 5, None)], "video_id int, category string, region string, title string, view_count int, like_count int")
    out = {r["comment_id"]: r for r in selection.attach_video_meta(comments, videos).collect()}
    assert (out["a"]["post_title"], out["a"]["view_count"], out["a"]["like_count"]) == ("T", 5, 0)
    assert (out["b"]["category"], out["b"]["region"], out["b"]["view_count"]) == ("", "", 0)
    assert [r["comment_id"] for r in selection.only_selected(comments, videos).collect()] == ["a"]


LEXICON = [("great", 3.0), ("bad", -2.5), ("ok", 0.5)]


def test_lexicon_sentiment(spark):
    texts = ["great stuff", "not great", "not so very great", "not a b c great", "no words", "", "great bad", "GREAT!"]
    df = spark.createDataFrame([("s", str(i), t) for i, t in enumerate(texts)], "source string, comment_id string, comment string")
    lexicon = spark.createDataFrame(LEXICON, "word string, valence double")
    out = {int(r["comment_id"]): r for r in sentiment.lexicon_sentiment(df, lexicon).collect()}
    assert len(out) == 8
    assert out[0]["compound"] == pytest.approx(3 / (9 + 15) ** 0.5, abs=1e-4)
    for negated in (1, 2):
        assert out[negated]["compound"] == pytest.approx(-2.22 / (2.22**2 + 15) ** 0.5, abs=1e-4)
        assert out[negated]["sentiment_label"] == "negative"
    assert out[3]["sentiment_label"] == "positive"
    assert (out[4]["neu"], out[4]["compound"], out[5]["neu"], out[5]["sentiment_label"]) == (1.0, 0.0, 0.0, "neutral")
    assert (out[0]["pos"], out[0]["neu"], out[0]["neg"]) == (0.8, 0.2, 0.0)
    assert out[7]["compound"] == out[0]["compound"]


def test_copies_and_two_texts_of_one_id(spark):
    rows = [("s", "1", "great"), ("s", "1", "great"), ("s", "1", "bad")]
    df = spark.createDataFrame(rows, "source string, comment_id string, comment string")
    lexicon = spark.createDataFrame(LEXICON, "word string, valence double")
    labels = sorted(r["sentiment_label"] for r in sentiment.with_sentiment(df, lexicon).collect())
    assert labels == ["negative", "positive", "positive"]
    scored = {r["sentiment_label"]: r["compound"] for r in sentiment.lexicon_sentiment(df, lexicon).collect()}
    assert scored["positive"] == pytest.approx(3 / 24**0.5, abs=1e-4)


def test_labels_of_changed_texts_and_null_ids(spark):
    rows = [("s", "1", "great"), ("s", "1", "great"), ("s", "1", "bad"), ("s", None, "bad"), (None, None, "great"), ("s", "2", None)]
    df = spark.createDataFrame(rows, "source string, comment_id string, comment string")
    lexicon = spark.createDataFrame([*LEXICON, ("great", 1.0), (None, 2.0), ("x", None)], "word string, valence double")
    want = sorted(["positive", "positive", "negative", "negative", "positive", "neutral"])
    stored = sentiment.lexicon_sentiment(df, lexicon)
    assert sorted(r["sentiment_label"] for r in sentiment.join_labels(df, stored).collect()) == want
    assert sentiment.join_labels(df, stored.drop("text_hash")).count() == len(rows)
    in_row = sentiment.with_sentiment(df, lexicon)
    by_words = sentiment.with_sentiment(df, lexicon, most=2)
    assert sorted(map(repr, in_row.collect())) == sorted(map(repr, by_words.collect()))
    assert "Exchange" not in in_row._jdf.queryExecution().executedPlan().toString()


def test_comment_metrics_without_label(spark):
    df = spark.createDataFrame([("ab",), (None,)], "comment string")
    assert kpis.comment_metrics(df).first().asDict() == {"total": 2, "avg_len": 1.0, "pos": 0, "neg": 0, "neu": 2}
    assert kpis.comment_metrics(df.limit(0)).first()["avg_len"] == 0.0


def test_weekly_and_topics(spark):
    start, end = kpis.date_window(7, dt.datetime(2024, 3, 10))
    times = [start, end, start - dt.timedelta(seconds=1), end - dt.timedelta(seconds=1)]
    sent = spark.createDataFrame([(t, "positive") for t in times], "created_utc timestamp_ntz, sentiment_label string")
    summary = spark.createDataFrame([("b", 2), ("a", 2), ("a", 1), ("c", 3)], "Name string, Count long")
    row = kpis.weekly_rollup(sent, summary, start, end).first()
    assert (row["week_start"], row["total"], row["pos"], row["neu"], row["top5"]) == ("2024-03-03", 2, 2, 0, "a (3); c (3); b (2)")
    assert [r["Name"] for r in kpis.top_topics(summary, 2, mode="rows").collect()] == ["a", "b"]
    empty = kpis.weekly_rollup(sent.limit(0), summary.limit(0), start, end).first()
    assert (empty["total"], empty["top5"], empty["names"]) == (0, "", [])


def test_variants(spark):
    df = spark.createDataFrame([("1", "x" * 120, None)], "comment_id string, comment string, source string")
    out = variants.make_variants(df).orderBy("variant_id").collect()
    assert [r["variant_id"] for r in out] == ["1_0", "1_1", "1_2", "1_3"]
    assert out[3]["variant_text"] == "Short: " + "x" * 100 + "..." and "[topic]" in out[1]["variant_text"]
    assert out[0]["source"] == ""


def test_drafts_of_two_sources_and_failures(spark):
    summary = spark.createDataFrame([("0", "n", ["d"], "a"), ("0", "n", ["d"], "b")], "Topic string, Name string, Representative_Docs array<string>, source string")
    drafts = variants.generate_drafts(summary, AS_OF).collect()
    assert {r["topic_group"] for r in drafts} == {"a", "b"} and len({r["variant_id"] for r in drafts}) == 2

    def write(prompt):
        raise RuntimeError("no service")

    failed = variants.failed_drafts(summary, write).collect()
    assert [(r["topic"], r["error"]) for r in failed] == [("0", "RuntimeError: no service")] * 2
    assert {r["error"] for r in variants.failed_drafts(summary, lambda prompt: "").collect()} == {"no answer"}


def test_generated_drafts_skip_failures(spark):
    summary = spark.createDataFrame([(1, "good", ["d"]), (2, "bad", []), (3, "none", [])], "Topic int, Name string, Representative_Docs array<string>")

    def write(prompt):
        if "name: bad" in prompt:
            raise RuntimeError
        return "" if "name: none" in prompt else '"c" || go'

    out = variants.generate_drafts(summary, AS_OF, write).collect()
    assert [(r["topic"], r["caption"], r["cta"], r["representative_doc"]) for r in out] == [("1", "c", "go", "d")]
    own = {r["topic"]: r for r in variants.generate_drafts(summary, AS_OF).collect()}
    assert (own["1"]["caption"], own["2"]["caption"], own["1"]["cta"]) == ("good: d", "bad: bad", "Learn more")


def test_ranking_prompt(spark):
    cands = spark.createDataFrame([("a", "t\nu")], "variant_id string, variant_text string")
    log = spark.createDataFrame([("p", "v", dt.datetime(2024, 1, 1), 1, None, 0.5)], "post_id string, variant_id string, ts timestamp_ntz, replies long, likes long, ctr double")
    prompt = variants.ranking_prompt(cands, log).first()[0]
    assert "History:\nv replies=1 likes= ctr=0.5\n\nCandidates:\na: t u\n\nReturn JSON only." in prompt
    many = spark.range(30).select(F.format_string("v%02d", "id").alias("variant_id"), F.lit("x").alias("variant_text"))
    past = spark.range(30).select(
        F.format_string("p%02d", "id").alias("post_id"), F.format_string("h%02d", "id").alias("variant_id"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), F.lit(1).alias("replies"), F.lit(1).alias("likes"), F.lit(0.1).alias("ctr"),
    )
    short = variants.ranking_prompt(many, past).first()[0]
    assert short.count(": x") == 10 and short.count("replies=") == 8 and "h29" in short and "v09" in short and "v10" not in short


LOG = "post_id string, topic string, variant_id string, variant_text string, ts timestamp_ntz, replies long, likes long, ctr double"


def log_rows(spark):
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = [("p1", "t", "a", "", t[0], 1, 1, 0.1), ("p1", "t", "b", "", t[1], 2, 2, None), ("p2", "u", "c", "", t[2], 3, 3, 0.1)]
    return spark.createDataFrame(rows, LOG)


def test_record_metrics(spark):
    updates = spark.createDataFrame(
        [("p1", dt.datetime(2024, 2, 1), 9, None, 0.9), ("p1", dt.datetime(2024, 2, 2), 8, None, None), ("nope", dt.datetime(2024, 2, 2), 1, 1, 1.0)],
        "post_id string, ts timestamp_ntz, replies long, likes long, ctr double",
    )
    out = {r["variant_id"]: r for r in experiments.record_metrics(log_rows(spark), updates).collect()}
    assert len(out) == 3
    assert (out["a"]["replies"], out["a"]["likes"], out["a"]["ctr"]) == (8, 0, 0.9)
    assert (out["b"]["replies"], out["b"]["ctr"], out["c"]["replies"]) == (8, 0.9, 3)


def test_winner(spark):
    assert experiments.pick_winner(log_rows(spark)).first()["variant_id"] == "a"
    blank = log_rows(spark).withColumn("ctr", F.lit("abc"))
    assert experiments.pick_winner(blank).first()["variant_id"] == "a"
    nan = log_rows(spark).withColumn("ctr", F.when(F.col("variant_id") == "a", float("nan")).otherwise(0.01))
    assert experiments.pick_winner(nan).first()["variant_id"] == "b"
    assert {r["topic"]: r["variant_id"] for r in experiments.pick_winner(log_rows(spark), "topic").collect()} == {"t": "a", "u": "c"}
    assert experiments.unscored(log_rows(spark)).first()["variant_id"] == "b"


def test_bandit(spark):
    events = spark.range(2000).withColumnRenamed("id", "event_id")
    offered = spark.createDataFrame([(f"v{i}", f"t{i}") for i in range(4)], "variant_id string, variant_text string")
    scores = spark.createDataFrame([("v2", 0.9), ("v1", 0.5)], "variant_id string, score double")
    none = scores.limit(0)
    unknown = spark.createDataFrame([("zz", 1.0)], "variant_id string, score double")

    def share(df, value):
        return df.filter(F.col("variant_id") == value).count() / 2000

    assert share(experiments.assign_variants(events, offered, scores, eps=0.0), "v2") == 1.0
    mixed = experiments.assign_variants(events, offered, scores, eps=0.1)
    assert mixed.count() == 2000 and 0.9 < share(mixed, "v2") < 0.96
    for rest in (none, unknown):
        spread = experiments.assign_variants(events, offered, rest)
        assert spread.count() == 2000 and 0.2 < share(spread, "v0") < 0.3
    again = experiments.assign_variants(events, offered, scores, eps=0.1)
    assert sorted(mixed.collect()) == sorted(again.collect())
    assert share(experiments.assign_variants(events, offered, scores, eps=1.0), "v2") < 0.35
    odd = spark.createDataFrame([("v0", float("nan")), ("v1", None), ("v3", 0.2)], "variant_id string, score double")
    assert share(experiments.assign_variants(events, offered, odd, eps=0.0), "v3") == 1.0
    with pytest.raises(Exception, match="no variants"):
        experiments.assign_variants(events, offered.limit(0), scores).collect()


def test_candidates_rank_and_log(spark):
    rows = [("", "n", "buy this", None), ("b", "n", "", "ai " * 300), ("c", "n", "plain", "x")]
    df = spark.createDataFrame(rows, "variant_id string, topic_name string, caption string, raw_text string")
    chosen = variants.candidates(df, 3)
    assert {len(r["variant_text"]) for r in chosen.collect()} == {8, 800, 5}
    assert all(r["variant_id"] for r in chosen.collect())
    ranked = experiments.rank_candidates(chosen, 2).collect()
    assert ranked[0]["variant_id"] == "b" and ranked[0]["reason"] == "heuristic"
    logged = experiments.log_prediction(chosen, AS_OF).first()
    assert logged["variant_id"] == "b" and logged["post_id"].startswith("pred_") and logged["ctr"] is None
    enrolled = experiments.enrol_variants(chosen, AS_OF).collect()
    assert len({r["post_id"] for r in enrolled}) == 3 and enrolled[0]["ts"] == AS_OF
