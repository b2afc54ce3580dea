import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from audience_engine.llm import near_texts
from tests.llm.test_near_groups import components_of


def plain_set(text, n=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def plain_pairs(texts):
    sets = [plain_set(t) for t in texts]
    near = lambda a, b: a == b or (a and b and len(a & b) / len(a | b) >= 0.8)
    return [(i, j) for i in range(len(sets)) for j in range(i) if near(sets[i], sets[j])]


def plain_kept(rows):
    """Ids that stay of (id, text) rows."""
    return {rows[r][0] for r in components_of(len(rows), plain_pairs([t for _, t in rows]))}


def some_texts(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(25):
        base = [draw.choice(words) for _ in range(draw.choice([8, 40, 150, 400]))]
        texts.append(" ".join(base))
        for changes in (1, 2, 3, 4, 5, 6, 8):
            copy = list(base)
            for _ in range(max(1, changes * len(base) // 200)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append(" ".join(copy))
    chain = [draw.choice(words) for _ in range(600)]
    texts += [" ".join(chain[i : i + 200]) for i in range(0, 400, 10)]  # each is near the next ones only
    return [*texts, *texts[:5], None, "", "  \n", "one", "One", "two words", "a b c d e", "A b c d  e"]


@pytest.mark.parametrize("chunk", [4, 512])
def test_near_texts_agree_with_all_pairs(spark, chunk):
    rows = list(enumerate(some_texts(3)))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string")
    kept = near_texts.apply_dedup(docs, chunk=chunk).collect()
    assert len(kept) < len(rows) - 50 and kept[0].__fields__ == ["doc_id", "text", "node"]
    assert sorted(r.doc_id for r in kept) == sorted(plain_kept(rows))
    assert near_texts.apply_dedup(docs.limit(0)).count() == 0


def test_repeated_and_null_ids(spark):
    rows = [(None, "a b c d e f g"), (2, "a b c d e f g"), (2, "other words in this text here"), (2, "other words in this text here"), (None, "alone")]
    kept = near_texts.apply_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([rows[1], rows[2], rows[4]], key=repr)


def test_stage_links_what_is_similar_and_nothing_else(spark):
    # documents 1 and 177 are similar by 0.83, and their fingerprints differ in 9 bits
    sf = "/root/testdata/sf0.001"
    rows = corpus_pipeline.lines(spark, corpus_pipeline.quality(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf), sf)
    plain = sorted((r.doc_id, r.text) for r in rows.collect())
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, rows, sf).collect()}
    assert kept == plain_kept(plain) and {1, 177} & kept == {1}


def test_bands_recall_at_the_threshold():
    draw = np.random.default_rng(5)
    met = 0
    for _ in range(400):
        both, left, right = np.split(draw.integers(0, 2**64, 500, np.uint64), [400, 450])
        a, b = np.concatenate([both, left]), np.concatenate([both, right])
        met += bool((near_texts.band_keys(a) == near_texts.band_keys(b)).any())  # 400 of 500 are common
    assert met >= 398


def test_near_fingerprints_are_candidates(spark, monkeypatch):
    """The tries propose pairs of their own: without any min-hash key, copies that differ in few bits are still found."""
    words = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, " ".join(f"x{i}" for i in range(300))), (4, None), (5, "")]
    prints = [near_texts.fingerprint(near_texts.shingle_set((t or "").encode())) for _, t in rows[:2]]
    assert 0 < ((prints[0] ^ prints[1]) & (2**64 - 1)).bit_count() <= 4 or prints[0] == prints[1]
    sketched = near_texts._sketched
    bare = lambda keyed, n: sketched(keyed, n).withColumn("bands", F.array().cast("array<long>"))
    monkeypatch.setattr(near_texts, "_sketched", bare)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in near_texts.apply_dedup(docs).collect()} == {1, 3, 4}
