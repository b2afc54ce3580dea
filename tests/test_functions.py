import datetime as dt

import pytest
from pyspark.sql import functions as F

from audience_engine.functions import clock, drafts, scoring, text
from audience_engine.vocabulary import SIGNAL_PHRASES

AS_OF = dt.datetime(2024, 3, 31)


def test_longer_than(values):
    assert values(text.longer_than, ["123456", "1234567", None, "12345😀", "123456😀"]) == [False, True, False, False, True]


def test_is_english_boundary(values):
    cases = ["a" * 19 + "é", "a" * 20, "a" * 39 + "é", "", None, "日本語", "a" * 97 + "日本語", "a" * 300 + "😀" * 10]
    assert values(text.is_english, cases) == [False, True, True, False, False, False, True, True]


def test_is_english_equals_plain_ratio(values):
    cases = ["x" * a + "é" * b + "日" * c for a in range(0, 120, 7) for b in range(4) for c in range(4)]
    plain = [bool(s) and sum(ord(ch) < 128 for ch in s) / len(s) > 0.95 for s in cases]
    assert values(text.is_english, cases) == plain


def test_toxicity_and_sentiment(values):
    cases = ["whatever", "a great but worst thing", None, "USELESS", "fine"]
    assert values(text.toxicity, cases) == [0.6, 0.6, 0.05, 0.05, 0.05]
    assert values(text.rule_sentiment, cases) == [-0.6, 0.7, 0.1, -0.6, 0.1]


def test_hashtags(values):
    cases = ["#A #a #B", "#Über #日本", "# alone", "none", None, "#a_1-b"]
    assert values(text.hashtags, cases) == [["#a", "#b"], ["#über", "#日本"], [], [], [], ["#a_1"]]


def test_signals_in_list_order(values):
    cases = ["SHORT-FORM reel", "a dropdown", None, "story and launch"]
    assert values(text.marketing_signals, cases) == [["short-form", "reel", "short"], ["drop"], [], ["launch", "story"]]
    assert values(text.has_signal, cases) == [True, True, False, True]
    assert len(SIGNAL_PHRASES) == 29


def test_not_removed(values):
    assert values(text.not_removed, ["", " \n", "[Removed]", " [removed] ", None, "ok"]) == [False] * 5 + [True]


def test_coalesce_text_skips_empty(spark):
    df = spark.createDataFrame([(None, "", "c"), ("a", "b", "c"), (None, None, None)], "x string, y string, z string")
    assert [r[0] for r in df.select(text.coalesce_text("x", "y", "z")).collect()] == ["c", "a", ""]


def test_normalise(values):
    cases = [
        "See https://a.b/c?d=1 NOW!", "mail me: a.b+c@d-e.org, ok", "call +49 (30) 123-4567 today", "a_b  -- c\n\td",
        None, "www.x.com", "Ünï'cødé", "12 34",
    ]
    assert values(text.normalise_text, cases) == [
        "see now", "mail me ok", "call today", "a_b c d", "", "", "ünï cødé", "12 34",
    ]


def test_tokens_and_bigrams(values):
    assert values(lambda c: text.tokens(c, ("the", "very")), ["the very big 123 ox cat ½½½"]) == [["big", "cat"]]
    assert values(lambda c: text.with_bigrams(F.split(c, " ")), ["a b c", "a"]) == [["a", "b", "c", "a b", "b c"], ["a"]]
    assert values(lambda c: text.with_bigrams(F.filter(F.split(c, " "), lambda w: w != "")), [""]) == [[]]


def test_snippet_and_template(values):
    cases = ["x" * 100, "y" * 101, "z" * 99 + " end", "\n" + "w" * 98 + "\t\u00a0", None]
    assert values(lambda c: text.snippet(c, 100), cases) == ["x" * 100, "y" * 100 + "...", "z" * 99 + "...", "w" * 98 + "...", ""]
    assert values(text.strip, [" \n\t\u00a0a b\u3000\r\n", "", None]) == ["a b", "", None]
    assert values(lambda c: text.fill_template("[topic] {snippet} {x}", c), [r"a$1\b"]) == [r"[topic] a$1\b {x}"]


def test_json_lists(values):
    cases = ['["a","b"]', "[]", "not json", '[1, "é"]', None, '{"a":1}', "[broken"]
    assert values(text.parse_json_list, cases) == [["a", "b"], [], [], ["1", "é"], [], [], []]


def test_hours_and_density(spark):
    rows = [(0, 0), (1, 30), (2, 90), (3, -60), (4, 600)]
    df = spark.createDataFrame(rows, "i int, minutes int").select(
        "i", (F.lit(AS_OF).cast("timestamp_ntz") - F.make_dt_interval(mins="minutes")).alias("ts")
    )
    out = df.select("i", clock.hours_since("ts", AS_OF).alias("h")).orderBy("i").collect()
    assert [r["h"] for r in out] == [1.0, 1.0, 1.5, 1.0, 10.0]
    density = scoring.engagement_density(F.lit(0), F.lit(2), F.lit(0), "ts", AS_OF)
    assert [r[0] for r in df.orderBy("i").select(density).collect()][4] == pytest.approx(0.20)


def test_recent_days(values):
    ages = [dt.timedelta(days=60), dt.timedelta(days=60, hours=23), dt.timedelta(days=61), dt.timedelta(days=-1)]
    cases = [AS_OF - a for a in ages] + [None]
    assert values(lambda c: clock.recent_days(c, AS_OF), cases, "timestamp_ntz") == [True, True, False, True, False]


def test_week_label_matches_strftime(values):
    days = [dt.datetime(y, m, d) for y in (2017, 2018, 2023, 2024) for m, d in ((1, 1), (1, 2), (1, 7), (1, 8), (7, 14), (12, 31))]
    assert values(clock.week_label, days, "timestamp_ntz") == [d.strftime("%Y-Week-%W") for d in days]


def test_iso_z(values):
    assert values(clock.iso_z, [dt.datetime(2024, 1, 2, 3, 4, 5)], "timestamp_ntz") == ["2024-01-02T03:04:05Z"]


def test_event_time(values):
    out = values(clock.event_time, ["2024-01-02T03:04:05Z", "bad", None, ""], "string")
    assert [v is None for v in out] == [False, True, True, True]


def test_rank_score_and_prior(values):
    def rank(t):
        t = t.lower()
        s = 0.03 if any(w in t for w in ("buy", "subscribe", "click", "signup")) else 0
        return round(s + min(0.05, len(t) / 2000) + (0.02 if "ai" in t or "gpt" in t else 0), 4)

    cases = ["Buy now", "again", "GPT " * 50, "plain", "", "x" * 99 + " click"]
    assert values(scoring.rank_score, cases) == pytest.approx([rank(c) for c in cases])
    assert values(scoring.ctr_prior, ["buy ai", "x" * 80, "cta" * 40, ""]) == pytest.approx([0.055, 0.01, 0.03, 0.02])
    assert values(lambda c: scoring.rank_score(c, whole_word=True), ["again", "my ai"]) == pytest.approx([0.0025, 0.0225])


def test_ctr_value(values):
    assert values(scoring.ctr_value, ["0.5", "abc", "", "NaN", None, " 1 "]) == [0.5, 0.0, 0.0, 0.0, 0.0, 1.0]


def test_cosine_distance(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(scoring.cosine_distance("a", "b")).collect()] == pytest.approx([1.0, 0.0, 1.0])


def test_magnitude_bin_keeps_order(values):
    numbers = sorted({0, 1, -1, 5, 1022, 1023, 1024, 1025, 2047, 2048, 2**31, 2**40 + 7, 2**62, 2**63 - 1, -(2**63), -1024, -1025, -(2**40)})
    bins = values(scoring.magnitude_bin, numbers, "long")
    assert bins == sorted(bins)
    assert values(scoring.magnitude_bin, [0, 7, 1023, -1], "long") == [0, 7, 1023, -1]


def test_topic_label(spark):
    rows = [
        (["growth", "seo", "google", "reach", "link"], "SEO / growth / reach"),
        (["google", "seo"], "Google"),
        (["one thing", "two", "three", "four"], "One Thing Two Three"),
        ([], "topic_4"),
        (None, "topic_5"),
    ]
    df = spark.createDataFrame([(i + 1, t, w) for i, (t, w) in enumerate(rows)], "i int, t array<string>, want string")
    for row in df.select("want", drafts.topic_label("t", "i").alias("got")).collect():
        assert row["got"] == row["want"]
    empty = df.filter("i = 4").select(drafts.topic_label("t")).first()[0]
    assert empty == "Unknown"


def test_sentiment_label(values):
    out = values(drafts.sentiment_label, [0.05, 0.0499, -0.05, -0.0499], "double")
    assert out == ["positive", "neutral", "negative", "neutral"]


def test_split_caption(values):
    cases = ['"a" || "b" || c', " cap ||cta ", "one\n\n two \nthree", "single", "", None, "||x", "line\n"]
    got = [tuple(v) for v in values(drafts.split_caption_cta, cases)]
    assert got == [("a", 'b" || c'), ("cap", "cta"), ("one", "two"), ("single", ""), ("", ""), ("", ""), ("", "x"), ("line\n", "")]


def test_prompt(spark):
    df = spark.createDataFrame([("N", ["a", "b", "c", "d"], "neutral", "x"), ("M", [], "negative", "")], "n string, d array<string>, s string, p string")
    first, second = [r[0] for r in df.select(drafts.build_prompt("n", "d", "s", "p")).collect()]
    assert "platform=x.\nTone should match sentiment: neutral.\nTopic name: N\n" in first
    assert "(signal): a | b | c\n\nReturn strictly" in first
    assert "(signal): \n\nReturn" in second


def test_parse_ranking(values):
    cases = [
        'Here:\n[{"variant_id":"a",\n"score":0.5,"reason":"r"},{"variant_id":"b","score":1}]\nok', "no json", "[]", None,
    ]
    got = values(drafts.parse_ranking, cases)
    assert [(r["variant_id"], r["score"]) for r in got[0]] == [("a", 0.5), ("b", 1.0)]
    assert got[1:] == [[], [], []]


def test_parse_approval(values):
    cases = [
        '{"user":{"username":"u","id":"1"},"actions":[{"value":"t||v"}]}',
        '{"user":{"id":"1"},"actions":[{"value":"t||v||w"}]}',
        '{"user":{"username":"","id":"2"},"actions":[{"value":"only"}]}',
        '{"user":{"username":"u"},"actions":[]}',
    ]
    assert [tuple(v) for v in values(drafts.parse_approval, cases)] == [("u", "t", "v"), ("1", "t", "v||w"), ("2", "only", ""), ("u", "", "")]


def test_messages(spark):
    df = spark.createDataFrame([("", "7", None, "", "raw", "go")], "n string, t string, p string, c string, r string, cta string")
    assert df.select(drafts.draft_message("n", "t", "p", "c", "r", "cta")).first()[0] == "*7* — _generic_\n• Caption: raw\n• CTA: go"
    week = df.select(
        drafts.weekly_message(
            clock.instant(dt.datetime(2024, 3, 3)), clock.instant(dt.datetime(2024, 3, 10)), F.lit(3), F.lit(1), F.lit(1), F.lit(1),
            F.array().cast("array<string>"),
        )
    ).first()[0]
    assert week == "*Weekly snapshot* (2024-03-03 → 2024-03-10)\nTotal comments: 3 | Pos 1 | Neu 1 | Neg 1\nTop topics: N/A"


def test_ids_repeat(spark):
    df = spark.range(2)
    assert df.select(drafts.short_id("id")).collect() == df.select(drafts.short_id("id")).collect()
    assert [r[0] for r in df.select(drafts.variant_id("id", F.lit(3))).collect()] == ["0_3", "1_3"]
