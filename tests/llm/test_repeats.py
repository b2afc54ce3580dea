import random

import pytest

from audience_engine.llm import repeats


def plain(texts, window):
    """(words, kept words) of each text by looking at all windows."""
    words = [(t or "").encode().split() for t in texts]
    places = {}
    for i, own in enumerate(words):
        for s in range(len(own) - window + 1):
            places.setdefault(tuple(own[s : s + window]), []).append((i, s))
    gone = [set() for _ in words]
    for found in places.values():
        if len(found) > 1:
            for i, s in found:
                gone[i].update(range(s, s + window))
    return [(len(own), b" ".join(w for k, w in enumerate(own) if k not in g).decode()) for own, g in zip(words, gone, strict=True)]


def corpus(seed, n_words):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(n_words)]
    passage = [" ".join(draw.choice(vocabulary) for _ in range(draw.choice([6, 9, 10, 11, 14, 40]))) for _ in range(6)]
    texts = []
    for _ in range(120):
        parts = [" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(25))) for _ in range(3)]
        parts.insert(draw.randrange(4), draw.choice(passage))
        texts.append(" \n".join(parts))
    return [*texts, *texts[:10], texts[3], "same " * 80, "a b " * 50, "same " * 9, None, "", " \t ", "z " * 4000]


@pytest.mark.parametrize(("seed", "n_words", "window", "size", "share"), [(1, 500, 10, 4, 0.01), (2, 3, 10, 4, 0.01), (3, 40, 9, 3, 0.2), (4, 500, 10, 8, 0.0)])
def test_agrees_with_all_windows(spark, monkeypatch, seed, n_words, window, size, share):
    monkeypatch.setattr(repeats, "HOT_SHARE", share)
    texts = corpus(seed, n_words)
    rows = [(i if i != 5 else None, t, "x") for i, t in enumerate(texts)]
    rows += [(7, "another text under a used id", "x"), rows[8], rows[8]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string").repartition(5)
    want = plain([r[1] for r in rows], window)
    got = repeats.without_repeats(docs, window, size).collect()
    expected = sorted(((r[0], n, kept) for r, (n, kept) in zip(rows, want, strict=True)), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.text) for r in got), key=repr) == expected
    assert all(r.n_removed == sum(s.stop - s.start for s in r.spans) for r in got)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.without_repeats(docs).count() == 0
