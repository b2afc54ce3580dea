import random
import re

import numpy as np
import pytest

from audience_engine.llm import contamination
from audience_engine.llm.contamination import Index, suffix_array
from tools.check import compare

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(texts, items, window):
    """(words, hit places, item ids) of each text, by looking at every place."""
    windows = {}
    for item, text in items:
        words = plain_words(text)
        for i in range(max(1, len(words) - window + 1)) if words else ():
            windows.setdefault(tuple(words[i : i + window]), set()).add(item)
    out = []
    for text in texts:
        words, hit, found = plain_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if (own := windows.get(tuple(words[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own - {None}
        out.append((len(words), hit, sorted(map(str, found))))
    return out


def some_corpus(seed, n_words):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(n_words)] + ["é", "Ünder", "a1"]
    some = lambda n: " ".join(draw.choice(words) for _ in range(n))
    items = [(i, some(draw.choice([1, 2, 4, 9, 10, 11, 30]) if i else 30)) for i in range(12)] + [(3, some(20)), (None, some(15)), (50, ""), (51, None), (52, " ?! ")]
    texts = []
    for _ in range(150):
        parts = [some(draw.randrange(30)) for _ in range(3)]
        item = plain_words(draw.choice(items)[1])
        low = draw.randrange(len(item) + 1)
        parts.insert(draw.randrange(4), draw.choice([", ", " ", "\n"]).join(item[low : low + draw.randrange(40)]).upper())
        texts.append("-".join(parts))
    return [*texts, *texts[:10], *[texts[0]] * 40, None, "", "... \x00 \x7f", "x" * 5000, " ".join(texts[:60])], items


@pytest.mark.parametrize(("seed", "n_words", "settings"), [(1, 4, {}), (2, 60, {"shard_words": 300}), (3, 900, {"shard_words": 2000, "block_bytes": 700}), (4, 30, {"window": 4})])
def test_hits_agree_with_every_place(spark, seed, n_words, settings):
    texts, items = some_corpus(seed, n_words)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, items string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in contamination.find(docs, bench, **settings).collect()}
    want = plain(texts, items, settings.get("window", 10))
    assert len(got) == len(texts) and any(hit for _, hit, _ in want) and (seed != 3 or not all(hit for _, hit, _ in want))
    for i, (n, hit, found) in enumerate(want):
        spans = {p for s in got[i].spans for p in range(s.start, s.stop)}
        assert (got[i].n_words, got[i].n_hit, spans, got[i]["items"]) == (n, len(hit), hit, found)


@pytest.mark.parametrize("n_words", [1, 2, 40, 3000])
def test_index_counts_and_locates(n_words):
    draw = np.random.default_rng(n_words)
    sizes = draw.integers(1, 200, 30)
    symbols = np.concatenate([np.append(draw.integers(1, n_words + 1, n), 0) for n in sizes] * 2)  # every text twice
    starts = np.concatenate([[0], np.flatnonzero(symbols == 0)[:-1] + 1])
    index = Index.unpacked(Index.build(symbols, starts).packed())
    order = suffix_array(symbols)
    assert sorted(order.tolist()) == list(range(len(symbols)))
    number = np.where(symbols == 0, np.cumsum(symbols == 0) - 10**6, symbols).tolist()
    assert all(number[a:] <= number[b:] for a, b in zip(order[::7].tolist(), order[1::7].tolist(), strict=False))
    for n in (1, 2, 5):
        asked = [symbols[p : p + n] for p in draw.integers(0, len(symbols) - n, 40)]
        asked = np.array([a for a in asked if (a > 0).all()] + [np.full(n, 1), draw.integers(1, n_words + 1, n)]).clip(max=int(symbols.max()))
        found, low, high = index.search(asked)
        places = {int(i): sorted(index.locate(np.arange(a, b)).tolist()) for i, a, b in zip(found, low, high, strict=True)}
        for i, window in enumerate(asked):
            assert places.get(i, []) == [p for p in range(len(symbols) - n + 1) if (symbols[p : p + n] == window).all()]


def test_clean_cuts_passages_and_nothing_else(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    rows = [(1, f"Before it, {passage.upper()}! After it", "a"), (1, f"Before it, {passage.upper()}! After it", "b"), (None, None, "c"), (2, "clean text", None), (2, passage, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    items = spark.createDataFrame([(7, passage)], "item_id long, text string")
    got = contamination.clean(docs, items)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, "Before it, ! After it", "a"), (1, "Before it, ! After it", "b"), (None, None, "c"), (2, "clean text", None), (2, "", "d")], key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "b")], "item_id long, text string")
    assert contamination.find(docs.limit(0), items).count() == 0
    assert [tuple(r) for r in contamination.find(docs, items.limit(0)).collect()] == [(1, 3, 0, [], [])]
    assert [(r.n_hit, r["items"]) for r in contamination.find(docs, items).collect()] == [(1, ["7"])]


def test_query_agrees_with_sql(spark):
    agrees, note = compare(spark, "/root/testdata/sf0.001", "op13_contamination")
    assert agrees, note
