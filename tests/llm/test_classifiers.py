import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from audience_engine.llm import language, quality_classifier as qc


def test_ftrl_agrees_with_the_rule_written_out():
    draw = np.random.default_rng(2)
    rows = [(np.sort(draw.choice(50, 6, replace=False)), draw.random(6), float(draw.integers(2))) for _ in range(40)]
    z, n = np.zeros(50), np.zeros(50)
    qc.ftrl_pass(rows, z, n)
    want_z, want_n = [0.0] * 50, [0.0] * 50
    for places, values, label in rows:
        weights = []
        for i in places:
            sign = 1 if want_z[i] > 0 else -1
            weights.append(0.0 if abs(want_z[i]) <= qc.L1 else -(want_z[i] - sign * qc.L1) / ((qc.BETA + want_n[i] ** 0.5) / qc.ALPHA + qc.L2))
        p = 1 / (1 + np.exp(-sum(w * v for w, v in zip(weights, values, strict=True))))
        for i, v, w in zip(places, values, weights, strict=True):
            g = (p - label) * v
            sigma = ((want_n[i] + g * g) ** 0.5 - want_n[i] ** 0.5) / qc.ALPHA
            want_z[i] += g - sigma * w
            want_n[i] += g * g
    assert np.allclose(z, want_z) and np.allclose(n, want_n)


def test_features_sum_to_one_per_kind():
    for text in (b"one", b"two words", b"Some MORE words, words words!! 12"):
        places, values = qc._sparse(text)
        assert np.isclose(values.sum(), len(qc.features(text)) + 1) and places[-1] == 1 << qc.BITS
        weights = np.random.default_rng(1).standard_normal((1 << qc.BITS) + 1)
        assert np.isclose(qc.dot(weights, text), weights[places] @ values)
    assert qc.features(None) == [] and qc.shape("ONHA,!!") == "X,!!" and qc.shape("Word.") == "Xx."


def labelled(spark, n=120):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(draw.choice(words) + ("!!" if i % 3 == 0 else "") for _ in range(40))) for i in range(n)]
    docs = spark.createDataFrame(rows + [(n, None), (n + 1, ""), (0, "again under a used id"), (None, "no id")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(n)] + [(n, None), (None, 1), (9999, 0)], "doc_id long, quality int")
    return docs, labels


def test_shards_are_even_and_a_hot_id_does_not_crowd_out_others(spark, monkeypatch):
    docs, labels = labelled(spark, 400)
    rows = []
    monkeypatch.setattr(qc, "ROUNDS", 1)
    kept = qc.cut_lineage
    monkeypatch.setattr(qc, "cut_lineage", lambda df: rows.append(kept(df)) or rows[-1])
    alike = spark.createDataFrame([(7, "one text of one id, very often")] * 10_000, "doc_id long, text string")
    weights = qc.train(docs.unionByName(alike), labels, max_rows=300)
    taught = rows[-1].groupBy("_shard").count().collect()
    assert len(taught) == qc.SHARDS and max(r["count"] for r in taught) <= 3 * min(r["count"] for r in taught)
    assert sum(r["count"] for r in taught) <= 300 and rows[-1].filter("doc_id = 7").count() <= 2
    dealt = rows[-1].repartitionById(qc.SHARDS, "_shard").rdd.glom().map(len).collect()
    assert sorted(dealt) == sorted(r["count"] for r in taught)
    assert np.count_nonzero(weights)
    clash = docs.withColumns({"_label": F.lit("x"), "_hash": F.lit(1), "quality": F.lit(0), "score": F.lit("y")})
    assert (qc.train(clash, labels) == qc.train(docs, labels)).all() and qc.score(clash, weights).columns == ["doc_id", "score"]


def test_classifier_learns_and_scores_every_row(spark):
    docs, labels = labelled(spark)
    weights = qc.train(docs, labels)
    scored = qc.score(docs, weights).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    own = {r.doc_id: r.score for r in scored if r.doc_id is not None and 0 < r.doc_id < 120}
    assert all((s > 0.5) == (i % 3 != 0) for i, s in own.items())
    again = qc.score(docs.repartition(5), qc.train(docs.repartition(3), labels.repartition(2))).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, scored))
    few = qc.train(docs, labels, max_rows=10)
    assert np.count_nonzero(few) < np.count_nonzero(weights)
    nothing = qc.train(docs, labels.limit(0))
    assert {r.score for r in qc.score(docs, nothing).collect()} == {0.5}
    assert qc.score(docs.limit(0), nothing).count() == 0


def test_proportions_agree_with_a_fine_grid():
    draw = np.random.default_rng(3)
    likelihood = draw.dirichlet(np.ones(40), 2).T
    counts = draw.multinomial(500, likelihood @ np.array([0.7, 0.3])).astype(float)
    share, fit = language.proportions(counts, likelihood)
    grid = [(counts @ np.log(likelihood @ np.array([x, 1 - x])), x) for x in np.linspace(0.001, 0.999, 999)]
    best, x = max(grid)
    assert abs(share[0] - x) < 0.01 and fit >= best - 0.01


WORDS = {"aa": "kato liro menu sopa", "bb": "wurz gripf stumm knack", "cc": "oui eau feu lieu"}


def language_docs(spark):
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choice(WORDS[k].split()) for _ in range(30)), k) for i, k in enumerate(sorted(WORDS) * 20)]
    odd = [(900, None, "aa"), (901, "", None), (902, "12 34 !?", "bb"), (900, "kato liro", None), (None, "gripf knack " * 2000, None)]
    return spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")


def test_languages_and_mixtures(spark):
    docs = language_docs(spark)
    languages, model = language.train(docs)
    assert languages == sorted(WORDS) and np.allclose(model.sum(axis=0), 1)
    found = language.identify(docs, languages, model).collect()
    assert len(found) == docs.count()
    by = {(r.doc_id, r.lang_pred) for r in found}
    assert {(i, k) for i, k in enumerate(sorted(WORDS) * 20)} <= by
    assert {(901, "und"), (902, "und"), (900, "und"), (900, "aa"), (None, "bb")} <= by
    assert all(0 <= r.score <= 1 and (r.score == 0) == (r.lang_pred == "und") for r in found)
    mixed = spark.createDataFrame([(1, WORDS["aa"] * 8 + " " + WORDS["bb"] * 5)], "doc_id long, text string")
    (row,) = language.identify(mixed, languages, model).collect()
    assert [x.lang for x in row.languages] == ["aa", "bb"] and abs(sum(x.share for x in row.languages) - 1) < 1e-6
    assert sorted(map(repr, language.identify(docs.repartition(5), *language.train(docs.repartition(2))).collect())) == sorted(map(repr, found))


@pytest.mark.parametrize("which", ["no rows", "no languages"])
def test_nothing_learned(spark, which):
    docs = language_docs(spark)
    learned = language.train(docs.limit(0) if which == "no rows" else docs.withColumn("lang", docs["lang"].substr(1, 0)).filter("lang is null"))
    assert learned[0] == []
    assert {r.lang_pred for r in language.identify(docs, *learned).collect()} == {"und"}
    assert language.identify(docs.limit(0), *learned).count() == 0
