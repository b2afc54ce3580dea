import hashlib
from collections import Counter
import math
import os
import time
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from audience_engine.operators import model, topics
from audience_engine.plans import topic_queries
from audience_engine.session import laid_out
from audience_engine.settings import Settings

THEMES = {
    "cooking": "recipe oven flour butter sugar bread cake dough",
    "football": "goal striker match league referee penalty keeper pitch",
    "travel": "airport luggage hotel beach passport flight island museum",
}
CFG = Settings(topic_count=3, topic_min_size=4, topic_dims=5)


def documents(spark, each=12):
    rows = []
    for t, (theme, words) in enumerate(THEMES.items()):
        bag = words.split()
        for i in range(each):
            rows.append((t * 100 + i, theme, " ".join(bag[(i + j) % len(bag)] for j in range(6))))
    rows.append((900, "none", "[removed]"))
    return spark.createDataFrame(rows, "comment_id long, theme string, text string")


def test_term_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), (["a"],), ([],)], "terms array<string>")
    assert {r["term"]: (r["tf"], r["df"]) for r in topics.term_counts(df).collect()} == {"a": (2, 2), "b": (2, 1)}


def test_term_idf_bounds(spark):
    docs = [["all", f"w{i}", f"w{i % 3}"] for i in range(100)]
    df = spark.createDataFrame([(d,) for d in docs], "terms array<string>")
    full = topics.term_idf(df).collect()
    assert "all" not in {r["term"] for r in full}
    one = next(r for r in full if r["term"] == "w50")
    assert one["idf"] == pytest.approx(math.log(101 / 2) + 1)
    cut = topics.term_idf(df, vocabulary=5).collect()
    assert sorted(r["term"] for r in cut) == sorted([r["term"] for r in sorted(full, key=lambda r: (-r["tf"], hashlib.md5(r["term"].encode()).hexdigest()))][:5])


def test_class_tfidf(spark):
    df = spark.createDataFrame([("x", ["a", "a", "b"]), ("y", ["b", "c"])], "label string, terms array<string>")
    got = {(r["label"], r["term"]): r["weight"] for r in topics.class_tfidf(df, "label", n=None).collect()}
    assert got[("x", "a")] == pytest.approx(2 * math.log(1 + 2.5 / 2))
    assert got[("y", "b")] == pytest.approx(math.log(1 + 2.5 / 2))


def test_tfidf_vectors_are_unit(spark):
    df = topics.document_terms(documents(spark), "text", CFG.stop_words)
    weighed = topics.fit_tfidf(df, CFG).transform(df)
    norms = [r["tfidf"].norm(2) for r in weighed.collect() if r["tfidf"].numNonzeros()]
    assert norms == pytest.approx([1.0] * len(norms))


def test_singular_vectors_match_numpy(spark):
    rng = np.random.default_rng(3)
    dense = rng.standard_normal((60, 4)) @ rng.standard_normal((4, 30)) * np.where(rng.random((60, 30)) < 0.6, 1.0, 0.0)
    rows = [(i, Vectors.sparse(30, [(j, float(v)) for j, v in enumerate(row) if v])) for i, row in enumerate(dense)]
    df = spark.createDataFrame(rows, ["i", "v"])
    latent = np.array([r["z"] for r in topics.fit_lsa(df, "v", 3, "z").orderBy("i").collect()])
    u, s, _ = np.linalg.svd(dense, full_matrices=False)
    want = u[:, :3] * s[:3]
    for k in range(3):
        assert abs(np.dot(latent[:, k], want[:, k])) == pytest.approx(s[k] ** 2, rel=1e-2)


def test_products_go_by_small_parts():
    """All products of 32,768 values with the basis were made at once, 43 MB of them that no cache holds."""
    draw = np.random.default_rng(5)
    sizes = [0, 3, 0, 700, 5000, 1, *draw.integers(0, 300, 200).tolist(), 0]
    terms = [np.sort(draw.choice(6000, n, replace=False)) for n in sizes]
    values = [draw.normal(size=n) for n in sizes]
    right = draw.normal(size=(6000, 110)).astype("float32")
    offsets, every, weights = np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(terms), np.concatenate(values)
    tracemalloc.start()
    product = np.concatenate([part for *_, part in topics._products(offsets, every, weights, right)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12e6
    # to the last digit what all products at once add up to
    some = np.flatnonzero(sizes)
    want = np.zeros((len(sizes), 110))
    want[some] = np.add.reduceat(weights[:, None] * right[every], offsets[some], axis=0)
    assert (product == want).all()
    assert list(topics._products(np.zeros(1, int), np.empty(0, int), np.empty(0), right)) == []


def test_topics_find_themes(spark):
    docs = documents(spark)
    built = topics.build_topics({"src": docs, "none": docs.limit(0)}, "comment_id", "text", CFG)
    members = built.members.join(docs.select("comment_id", "theme"), "comment_id").collect()
    assert len(members) == len({r["comment_id"] for r in members}) == 36
    themes = {}
    for r in members:
        themes.setdefault(r["topic"], set()).add(r["theme"])
    assert all(len(t) == 1 for t in themes.values())
    summary = built.summary.collect()
    assert sum(r["Count"] for r in summary) == 36 and all(r["Count"] >= 4 for r in summary)
    text_of = {}
    for r in members:
        text_of.setdefault(r["topic"], set()).add(r["document"])
    for r in summary:
        assert len(r["Representative_Docs"]) == 3 and set(r["Representative_Docs"]) <= text_of[r["Topic"]]
        assert r["Name"] in {m["topic_name"] for m in members if m["topic"] == r["Topic"]}
    again = topics.build_topics({"src": docs}, "comment_id", "text", CFG)
    assert {r["comment_id"]: r["topic"] for r in again.members.collect()} == {r["comment_id"]: r["topic"] for r in members}


def test_texts_are_spread_over_more_tasks(spark, monkeypatch):
    """Up to 400,000 texts were eight partitions, whatever the cores."""
    seen, laid = [], topics.laid_out

    def counted(*args, **options):
        seen.append(laid(*args, **options))
        return seen[-1]

    monkeypatch.setattr(topics, "laid_out", counted)
    # the width a run would have, in two-thousandths of its rows
    monkeypatch.setattr(topics, "TEXTS_PER_PART", topics.TEXTS_PER_PART // 2000)
    built = topics.build_topics({"src": documents(spark, 40)}, "comment_id", "text", CFG)
    assert built.members.count() == 120
    assert [rows.rdd.getNumPartitions() for rows in seen] == [12, 12]


def test_every_document_stays_one_row(spark):
    docs = documents(spark)
    odd = spark.createDataFrame([(1, "x", "recipe oven flour"), (1, "x", "recipe oven flour"), (None, "x", "goal striker match"), (950, "x", "the and of")], docs.schema)
    every = Settings(topic_count=3, topic_min_size=1, topic_dims=5, topic_starts=2)
    rows = docs.unionByName(odd)
    built = topics.build_topics({"src": rows}, "comment_id", "text", every)
    members = built.members.collect()
    assert len(members) == rows.count() - 1 == sum(r["Count"] for r in built.summary.collect())  # without the removed one
    assert sorted(str(r["comment_id"]) for r in members) == sorted(str(r["comment_id"]) for r in rows.filter("text <> '[removed]'").collect())
    again = topics.build_topics({"src": rows.repartition(7)}, "comment_id", "text", every).members.collect()
    assert sorted((str(r["comment_id"]), r["topic"]) for r in again) == sorted((str(r["comment_id"]), r["topic"]) for r in members)


def test_most_frequent_narrows_ties(spark):
    terms = [(f"t{i}", 1 + i % 3) for i in range(3000)]
    df = spark.createDataFrame(terms, "term string, tf long")
    ranked = sorted(terms, key=lambda r: (-r[1], hashlib.md5(r[0].encode()).hexdigest()))
    for n in (1, 999, 1000, 1001, 2500, 3000, 5000):
        assert sorted(r["term"] for r in topics.most_frequent(df, n).collect()) == sorted(t for t, _ in ranked[:n])


def test_few_terms_are_taken_without_a_staged_table(spark, monkeypatch):
    """All distinct terms were written and passed four more times for a vocabulary of a few rows."""
    docs = [[f"w{i % 50}", f"w{i % 7}", f"x{i}"] for i in range(400)] + [[], None]
    df = spark.createDataFrame([(d,) for d in docs], "terms array<string>").repartition(5)
    counted = Counter(w for d in docs for w in d or [])
    ranked = sorted(counted.items(), key=lambda r: (-r[1], hashlib.md5(r[0].encode()).hexdigest()))
    staged, stage = [], topics.cut_lineage
    monkeypatch.setattr(topics, "cut_lineage", lambda rows: staged.append(rows) or stage(rows))
    for n in (1, 7, 53, 200, 1000):
        assert sorted((r["term"], r["tf"]) for r in topics.term_idf(df, max_share=1.0, vocabulary=n).collect()) == sorted(ranked[:n])
    assert not staged
    monkeypatch.setattr(topics, "TAKEN_AT_ONCE", 100)
    assert sorted((r["term"], r["tf"]) for r in topics.term_idf(df, max_share=1.0, vocabulary=200).collect()) == sorted(ranked[:200])
    assert len(staged) == 1


def test_keep_clusters(spark):
    sizes = spark.createDataFrame([(0, 3), (1, 9), (2, 5), (3, 4)], "topic int, size long")
    assert sorted(r["topic"] for r in topics.keep_clusters(sizes, 5).collect()) == [1, 2]
    assert sorted(r["topic"] for r in topics.keep_clusters(sizes, 50, fallback=2).collect()) == [1, 2]


def test_nearest_docs(spark):
    rows = [(i, i % 2, [float(i % 2), 1.0, i / 100]) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, label int, v array<double>")
    near = topics.nearest_docs(df, topics.centroids(df, "v", "label"), "v", "label", "id", 3).collect()
    assert len(near) == 6 and all(r["id"] % 2 == r["label"] for r in near)
    center = np.mean([r[2] for r in rows if r[1] == 0], axis=0)

    def cosine(v):
        return 1 - np.dot(v, center) / np.linalg.norm(v) / np.linalg.norm(center)

    want = sorted((round(cosine(r[2]), 6), r[0]) for r in rows if r[1] == 0)[:3]
    assert [(r["distance"], r["id"]) for r in sorted(near, key=lambda r: r["rank"]) if r["label"] == 0] == want


def test_embedding_topics(spark):
    docs = documents(spark, 30).filter("theme <> 'none'")
    axis = F.when(F.col("theme") == "cooking", 0).when(F.col("theme") == "football", 1).otherwise(2)
    noise = (F.col("comment_id") % 7) / 100.0
    vec = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.when(i == axis, 1.0 + noise).otherwise(noise * i))
    rows = docs.withColumn("v", vec)
    built = topics.embedding_topics(rows, "src", "v", "text", "comment_id", 3, Settings(), min_size=10, outlier_quantile=0.9)
    members = built.members.join(docs.select("comment_id", "theme"), "comment_id").collect()
    assert len(members) == 90
    by_topic = {}
    for r in members:
        by_topic.setdefault(r["topic"], set()).add(r["theme"])
        assert 0.0 <= r["topic_prob"] <= 1.0
    assert all(len(t) == 1 for k, t in by_topic.items() if k >= 0) and len([k for k in by_topic if k >= 0]) == 3
    for r in members:
        if r["topic"] < 0:
            assert r["topic_name"] == "outlier" and r["topic_prob"] == 0.0
        else:
            assert set(r["topic_name"].split(", ")) <= set(THEMES[r["theme"]].split())
    assert sum(r["Count"] for r in built.summary.collect()) == 90
    small = topics.embedding_topics(rows, "src", "v", "text", "comment_id", 3, Settings(), min_size=1000)
    assert {r["topic"] for r in small.members.collect()} == {-1}


def test_embedding_topics_per_source(spark):
    rows = documents(spark, 20).filter("theme <> 'none'").withColumn("v", F.array(F.length("text").cast("double"), (F.col("comment_id") % 5).cast("double")))
    built = topics.build_embedding_topics({"a": rows, "b": rows.filter("comment_id % 2 = 0"), "none": rows.limit(0)}, "v", "text", "comment_id", 2, CFG, min_size=1)
    counts = {r["source"]: r["n"] for r in built.members.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert counts == {"a": 60, "b": 30} == {r["source"]: r["n"] for r in built.summary.groupBy("source").agg(F.sum("Count").alias("n")).collect()}
    with pytest.raises(ValueError):
        topics.embedding_topics(rows, "a", "v", "text", "comment_id", 1, CFG)


def test_scores_keep_ids(spark):
    df = spark.range(60).select(
        F.when(F.col("id") % 7 != 0, F.col("id")).alias("id"), F.when(F.col("id") % 5 != 0, F.col("id") % 20).cast("double").alias("a"),
        F.when(F.col("id") % 9 != 0, F.col("id")).cast("double").alias("target"),
    )
    fitted, _ = model.train_virality(df.select("a", "target").dropna(subset=["target"]), rounds=2)
    scored = model.score_virality(df, fitted)
    assert scored.columns == ["id", "a", "target", "prediction"]
    assert sorted(map(repr, scored.drop("prediction").collect())) == sorted(map(repr, df.collect()))


def test_virality_beats_the_mean(spark, tmp_path):
    df = spark.range(400).select(
        (F.col("id") % 20).cast("double").alias("a"), (F.col("id") % 7).alias("b"), F.lit("x").alias("c"),
        ((F.col("id") % 20) * 3 + (F.col("id") % 7)).cast("double").alias("target"),
    )
    path = str(tmp_path / "model")
    fitted, rmse = model.train_virality(df, path, rounds=10)
    spread = df.agg(F.stddev_pop("target")).first()[0]
    assert rmse < spread / 4
    scored = model.score_virality(df, path)
    direct = model.score_virality(df, fitted)
    assert [r["prediction"] for r in scored.collect()] == [r["prediction"] for r in direct.collect()]
    assert "prediction" in scored.columns and "_features" not in scored.columns


def test_trees_read_few_partitions(spark, monkeypatch):
    """Each level of each tree is a job over all partitions: their number must not follow the rows one for 50,000."""
    seen = []
    laid = model.laid_out

    def counted(*args, **options):
        seen.append(laid(*args, **options))
        return seen[-1]

    monkeypatch.setattr(model, "laid_out", counted)
    # the widths a run would have, in thousandths of its rows
    monkeypatch.setattr(model, "ROWS_PER_PART", 50)
    monkeypatch.setattr(model, "MOST_ROWS_PER_PART", 1000)
    df = spark.range(6000).select((F.col("id") % 20).cast("double").alias("a"), (F.col("id") % 20 * 3).cast("double").alias("target"))
    _, rmse = model.train_virality(df, rounds=2)
    assert rmse < df.agg(F.stddev_pop("target")).first()[0]
    assert seen[0].rdd.getNumPartitions() == 64
    assert model.rows_per_part(400) == 50 and model.rows_per_part(36_000) == 563 and model.rows_per_part(216_000) == 1000
    assert not spark._jsparkSession.sharedState().cacheManager().lookupCachedData(seen[0]._jdf).isDefined()


def test_clusters_are_found_whatever_the_partitions(spark):
    draw = np.random.default_rng(3)
    middles = draw.normal(size=(6, 5)) * 20
    rows = [(i, (middles[i % 6] + draw.normal(size=5)).tolist()) for i in range(600)] + [(600, [0.0] * 5), (601, [0.0] * 5)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    placed, centers = topics.fit_clusters(laid_out(df, "id"), 6, "v", starts=3)
    got = {r["id"]: r["topic"] for r in placed.collect()}
    x = np.array([r[1] for r in rows])
    far = ((x[:, None] - centers[None]) ** 2).sum(axis=2)
    assert [got[i] for i, _ in rows] == far.argmin(axis=1).tolist()
    assert len({got[i] for i in range(6)}) == 6 and all(got[i] == got[i % 6] for i in range(600))
    # a further full step moves nothing and costs no less
    label = far.argmin(axis=1)
    means = np.stack([x[label == c].mean(axis=0) for c in range(6)])
    assert np.abs(means - centers).max() < 1e-3
    again, same = topics.fit_clusters(laid_out(df.repartition(7), "id"), 6, "v", starts=3)
    assert (same == centers).all() and {r["id"]: r["topic"] for r in again.collect()} == got
    # more centres than different rows: all rows have one, those without rows stay
    few, _ = topics.fit_clusters(spark.createDataFrame([(1, [1.0]), (2, [1.0]), (3, [2.0])], "id int, v array<double>"), 3, "v", starts=2)
    assert len({r["topic"] for r in few.filter("id < 3").collect()}) == 1 and few.count() == 3


def test_dictionary_numbers_terms_as_they_are_written(spark, monkeypatch):
    """All terms were shuffled by a bucket of their md5 and sorted there to be numbered."""
    seen, stage = [], topics.cut_lineage
    monkeypatch.setattr(topics, "cut_lineage", lambda rows: seen.append(stage(rows)) or seen[-1])
    weights = spark.range(1000).select(F.concat(F.lit("w"), "id").alias("term"), (F.col("id") / 7).alias("idf")).filter("idf > 3")
    for rows in (weights.repartition(9), weights.repartition(3, F.col("idf") > 100), weights.limit(0), weights.coalesce(1)):
        found = topics.term_dictionary(rows)
        assert found.columns == ["term", "idf", "index"] and dict(found.dtypes)["index"] == "bigint"
        got = found.collect()
        assert sorted(r["index"] for r in got) == list(range(len(got)))
        assert sorted((r["term"], r["idf"]) for r in got) == sorted((r["term"], r["idf"]) for r in rows.collect())
        assert {r["term"]: r["index"] for r in found.collect()} == {r["term"]: r["index"] for r in got}
    assert len(seen) == 4
    plan = topics.term_dictionary(weights.repartition(9))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "hashpartitioning(term" not in plan


def test_weights_of_more_terms_than_the_vocabulary(spark):
    texts = ["apple banana cherry apple", "banana durian", "cherry", None, "elder fig grape " * 3]
    rows = topics.document_terms(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "text", ())
    weights = topics.term_dictionary(topics.term_idf(rows, max_share=1.0))
    terms = {r["term"]: (r["index"], r["idf"]) for r in weights.collect()}
    assert sorted(i for i, _ in terms.values()) == list(range(len(terms))) and len(terms) > 5
    found = {r["id"]: r for r in topics.sparse_rows(topics.unit_weights(rows, weights, "id"), "id").collect()}
    assert sorted(found) == [0, 1, 2, 4]
    small = topics.fit_tfidf(rows, Settings(topic_vocabulary=5))
    assert len(small.vocabulary) == 5
    for i, text in enumerate(texts):
        words = (text or "").split()
        counted = Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
        plain = {terms[w][0]: n * terms[w][1] for w, n in counted.items()}
        norm = np.sqrt(sum(v * v for v in plain.values()))
        if plain:
            assert found[i]["indices"] == sorted(plain)
            assert np.allclose(found[i]["values"], [plain[k] / norm for k in sorted(plain)])


def test_weights_read_words_that_are_written_once(spark):
    texts = [(1, "de", "alpha beta alpha gamma"), (2, "en", "beta beta delta"), (2, "en", "alpha"), (None, None, "gamma delta epsilon"), (3, "de", None), (4, "en", "zeta")]
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string").withColumn("source", F.lit("s"))
    rows, weights = topic_queries.every_weight(SimpleNamespace(documents=docs))
    assert rows.columns == ["doc_id", "lang", "terms"] and weights.columns == ["term", "idf"]
    for reader in (rows, weights):  # neither normalises the texts again, and no occurrences are counted for the weights
        plan = reader._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_replace" not in plan and "text#" not in plan and "sort_array" not in plan
    plain = topics.document_terms(docs, "text", topic_queries.CFG.stop_words).select("doc_id", "lang", "terms")
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, plain.collect()))
    want = {r["term"]: r["idf"] for r in topics.term_idf(plain, max_share=0.98).collect()}
    assert {r["term"]: r["idf"] for r in weights.collect()} == want and "alpha beta" in want
    counted = {r["term"]: (r["tf"], r["df"]) for r in topics.term_counts(plain).collect()}
    assert {r["term"]: r["df"] for r in topics.term_counts(plain, tf=False).collect()} == {t: df for t, (_, df) in counted.items()}
    assert any(tf > df for tf, df in counted.values())
    with pytest.raises(ValueError):
        topics.term_idf(plain, vocabulary=3, tf=False)


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = manager.getAllBlocks().mkString("\n").split("\n")
    return {n.split("_")[1] for n in names if n.startswith("shuffle_")}


def test_topics_leave_few_tables_and_no_shuffles(spark, monkeypatch):
    """Every step's tables and shuffles lay on disk until the run was over, all with the texts and term weights."""
    staged, stage = [], topics.cut_lineage
    monkeypatch.setattr(topics, "cut_lineage", lambda rows: staged.append(stage(rows)) or staged[-1])
    monkeypatch.setattr(topics, "TAKEN_AT_ONCE", 5)
    docs = documents(spark)
    before = shuffle_files(spark)
    built = topics.build_topics({"a": docs, "b": docs.filter("comment_id % 2 = 0")}, "comment_id", "text", CFG)
    until = time.time() + 20
    while len(left := shuffle_files(spark) - before) > 2 and time.time() < until:
        time.sleep(0.2)
    assert len(left) <= 2  # a stage that a query no longer needed may still write a few rows when it ends
    kept = [t for t in staged if any(os.path.exists(f.removeprefix("file:").replace("//", "/")) for f in t.inputFiles())]
    texts = [t for t in kept if "document" in t.columns]
    # each source's texts with their latent vectors, not with their terms or term weights
    assert len(texts) == 2 and all({"lsa", "document"} <= set(t.columns) for t in texts)
    assert not [t.columns for t in kept if {"terms", "tfidf", "tf", "_features"} & set(t.columns)]
    assert built.members.count() == 54
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_weights_by_slices_of_the_terms(spark, monkeypatch):
    """All pairs of documents and terms were shuffled three times in one go, 19 times the input on disk."""
    monkeypatch.setattr(topics, "ROWS_PER_SLICE", 3)
    texts = [(i if i % 7 else None, "de" if i % 3 else None, " ".join(f"w{(i * j) % 23:03d}" for j in range(i % 11))) for i in range(40)]
    docs = spark.createDataFrame([*texts, texts[5], (3, "en", "w001 w002 w001")], "doc_id long, lang string, text string")
    given = SimpleNamespace(documents=docs.withColumn("source", F.lit("s")))
    plain = topics.document_terms(docs, "text", topic_queries.CFG.stop_words)
    n, held, counts = docs.count(), Counter(), {}
    for r in plain.collect():
        held.update(set(r["terms"]))
        counts.setdefault(r["doc_id"], []).append((r["lang"], Counter(r["terms"])))
    idf = {t: math.log((1 + n) / (1 + k)) + 1 for t, k in held.items() if k <= 0.98 * n}
    sums, want = Counter(), {}
    for key, rows in counts.items():
        own = [(lang, t, k * idf[t]) for lang, c in rows for t, k in c.items() if t in idf]
        norm = math.sqrt(sum(w * w for *_, w in own))
        for lang, t, w in own:
            sums[lang, t] += w / norm
        if own:
            want[key] = (len(own), sum(w for *_, w in own) / norm, max(w for *_, w in own) / norm)
    staged, stage = [], topics.staged_by
    monkeypatch.setattr(topics, "staged_by", lambda *given: staged.append(stage(*given)) or staged[-1])
    got = {r["doc_id"]: r for r in topic_queries.tfidf_of_documents(given).collect()}
    assert set(got) == set(want) and None in got
    for key, (terms, total, largest) in want.items():
        assert got[key]["terms"] == terms
        assert (got[key]["total"], got[key]["largest"]) == pytest.approx((total, largest), abs=2e-6)
    assert len(staged) == 1 and len(got) == len(want)
    slices = {r["_slice"] for r in staged[0].select("_slice").distinct().collect()}
    assert 4 < len(slices) <= 15
    best = {r["lang"]: r["terms"].split("|") for r in topic_queries.language_terms(given).collect()}
    for lang in (None, "de", "en"):
        ranked = sorted(((-round(v, 9), t) for (g, t), v in sums.items() if g == lang))[:6]
        assert best[lang] == [t for _, t in ranked]


def test_members_are_checked_without_the_tables_they_came_from(spark, monkeypatch):
    """The texts lay on disk a second time, with their latent vectors, while the members were compared with the summary."""
    staged = []
    for module in (topics, topic_queries):
        monkeypatch.setattr(module, "cut_lineage", lambda rows, stage=module.cut_lineage: staged.append(stage(rows)) or staged[-1])
    monkeypatch.setattr(topic_queries, "CFG", CFG)
    docs = documents(spark).withColumn("source", F.when(F.col("comment_id") % 2 == 0, "youtube").otherwise("reddit"))
    found = topic_queries.topic_members(SimpleNamespace(comments=docs))
    kept = [t for t in staged if any(os.path.exists(f.removeprefix("file:").replace("//", "/")) for f in t.inputFiles())]
    assert [t.columns for t in kept if "document" in t.columns] == [["topic", "topic_prob", "topic_name", "document", "source", "comment_id"]]
    rows = {r["source"]: (r["n"], r["ids"], r["wrong_counts"], r["strangers"]) for r in found.collect()}
    assert rows == {"youtube": (18, 18, 0, 0), "reddit": (18, 18, 0, 0)}
