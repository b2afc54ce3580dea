import math
import random

from audience_engine.llm import mixing


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string").repartition(4)


def test_targets_stop_at_the_cap():
    got = mixing.targets({"a": 1000, "b": 10, None: 500, "c": 0}, share=1.5)
    assert got["b"] == 20 and got["c"] == 0 and got[None] <= 1000 and got["a"] <= 2000
    assert math.isclose(sum(got.values()), 1.5 * 1510)
    # weights by code point order: a 3, b 1, c 2, null 3; b and c are full, a and null share what is left
    assert math.isclose(got["a"], got[None] if got[None] < 1000 else 1.5 * 1510 - 1020)
    assert mixing.targets({}) == {}


def rates_by_bisection(sizes, target, cap):
    mean = sum(sizes) / len(sizes)
    total = lambda tilt: sum(s * min(cap, math.exp(min(50, tilt * s / mean))) for s in sizes)
    low, high = -200.0, 200.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if total(middle) < target else (low, middle)
    return {s: min(cap, math.exp(min(50, low * s / mean))) for s in set(sizes)}


def test_rates_and_copies(spark):
    draw = random.Random(6)
    rows = [(i, " ".join("w" * draw.choice([1, 2]) for _ in range(draw.choice([1, 5, 60, 60, 300]))), draw.choice(["a", "a", "b", "c", "d", None]), "x") for i in range(600)]
    rows += [(1000 + i, "the same text", "a", "x") for i in range(300)] + [(5000, None, "b", "x"), (6000, "", "e", "x"), (5000, " one ", "b", "x"), (None, "two words", "b", "x"), rows[9], rows[9]]
    docs = docs_of(spark, rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, by = {}, {}
    for _, text, source, _ in rows:
        n = len((text or "").encode().split())
        sizes[source] = sizes.get(source, 0) + n
        by.setdefault(source, []).append(n)
    goal = mixing.targets(sizes)
    taken = {}
    source_of = {(r[0], len((r[1] or "").encode().split())): r[2] for r in rows}
    expected = {}
    for r in got:
        source = source_of[r.doc_id, r.size]
        assert r.source_size == sizes[source] and math.isclose(r.target, goal[source])
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size
        taken[source] = taken.get(source, 0) + r.taken
        expected.setdefault((source, r.size), []).append(r.copies)
    for source, words in taken.items():
        assert abs(words - goal[source]) <= max(by[source])
        if 0 < goal[source] < 2 * sizes[source]:
            rates = rates_by_bisection(by[source], goal[source], 2.0)
            for size in set(by[source]) - {0}:
                copies = expected[source, size]
                assert abs(sum(copies) - rates[size] * len(copies)) <= 1.001
                assert max(copies) - min(copies) <= 1
    again = mixing.mix(docs_of(spark, rows[::-1]).repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_rows_as_often_as_taken(spark):
    rows = [(i, "some words in here " * (i % 7), "a" if i % 3 else "b", str(i)) for i in range(120)] + [(1, "equal rows", "a", "x")] * 5 + [(None, "no id", None, None)]
    docs = docs_of(spark, rows)
    report = mixing.mix(docs).collect()
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in report if r.size)
    words = sum(len(r.text.split()) for r in out.collect())
    assert words == sum(r.taken for r in report)
    empty = docs.limit(0)
    assert mixing.mix(empty).count() == 0 and mixing.apply_mix(empty).count() == 0


def test_equal_rows_are_one_class(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 64)
    monkeypatch.setattr(mixing, "PART_ROWS", 1)
    rows = [(i, "some words in here " * (i % 7 + 1), "a" if i % 2 else "b", "x") for i in range(400)] + [(None, "hot row of five words", "a", "x")] * 300
    docs = docs_of(spark, rows)
    report = mixing.mix(docs).collect()
    assert len(report) == len(rows) and sum(r.doc_id is None for r in report) == 300
    hot = [r.copies for r in report if r.doc_id is None]
    assert max(hot) - min(hot) <= 1
    out = mixing.apply_mix(docs).collect()
    assert sum(r.doc_id is None for r in out) == sum(hot) and len(out) == sum(r.copies for r in report)
    classes, _ = mixing._copies(docs.selectExpr("doc_id", "coalesce(doc_id, -1L) _d", "crc32(text) _t", "source _s", "5L size"), ("doc_id",), mixing.WEIGHTS, 1.5, 2.0)
    assert classes.filter("doc_id is null").count() == 1 and classes.filter("doc_id is null").first().n == 300


def test_texts_are_not_staged_for_the_mix(spark, monkeypatch):
    """Single and repeated rows meet the plan in one join, so their texts are shuffled once and not written besides."""
    staged, cut = [], mixing.cut_lineage
    monkeypatch.setattr(mixing, "cut_lineage", lambda df: staged.append(df.columns) or cut(df))
    rows = [(i % 40, f"text {i % 40} " + "w " * (i % 40 % 7 + 1), "ab"[i % 2], None) for i in range(120)] + [(None, "n n", None, None)] * 3
    docs = docs_of(spark, rows)
    got = mixing.apply_mix(docs).collect()
    taken = mixing.mix(docs).groupBy("doc_id").sum("copies").collect()
    assert {r[0]: r[1] for r in taken if r[1]} == {d: sum(r.doc_id == d for r in got) for d in {r.doc_id for r in got}}
    assert staged and not any("_row" in columns for columns in staged)
