import random
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest

import __spark_entry__ as contract
from audience_engine.llm import periodic_runs
from audience_engine.llm.periodic_runs import Catcher

SF = "/root/testdata/sf0.001"


def plain_runs(words, min_length=24, exponent=3):
    """Runs by comparing the words at every distance."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = q
        while i < len(words):
            stop = i
            while stop < len(words) and words[stop] == words[stop - q]:
                stop += 1
            if stop > i and stop - i + q >= max(min_length, exponent * q):
                found.setdefault((i - q, stop), q)
            i = max(stop, i + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    listed = "".join(f"{a},{b},{q}\n" for a, b, q in runs)
    return (doc_id, len(runs), *best, sha256(listed.encode()).hexdigest(), sha256(kept).hexdigest())


def some_words(draw):
    words = []
    for _ in range(draw.randrange(1, 6)):
        words += [draw.randrange(draw.choice([1, 2, 3, 50])) for _ in range(draw.randrange(40))]
        unit = [draw.randrange(draw.choice([1, 2, 40])) for _ in range(draw.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 70]))] * draw.choice([1, 2])
        words += unit * draw.randrange(1, 6) + unit[: draw.randrange(len(unit))]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_agree_with_all_distances_however_appended(seed):
    draw = random.Random(seed)
    for _ in range(40):
        words = some_words(draw)
        want = plain_runs(words)
        whole, online, at = Catcher(), Catcher(), 0
        whole.append(np.array(words, np.int32))
        while at < len(words):
            size = draw.choice([1, 1, 2, 5, 30, 100])
            online.append(np.array(words[at : at + size], np.int32))
            at += size
            if draw.random() < 0.05:
                assert online.runs() == plain_runs(words[:at])
        assert whole.runs() == online.runs() == want


def test_hashes_that_collide_only_propose(monkeypatch):
    monkeypatch.setattr(periodic_runs, "_spread", lambda numbers: np.zeros(len(numbers), np.uint64))
    draw = random.Random(9)
    for _ in range(20):
        words = some_words(draw)
        catcher = Catcher()
        catcher.append(np.array(words, np.int32))
        assert catcher.runs() == plain_runs(words)


def test_long_texts_in_slices(monkeypatch):
    monkeypatch.setattr(periodic_runs, "SLICE", 64)
    unit = "alpha beta\tgamma\ndelta epsilon"
    text = "lead words here " + " ".join([unit] * 400) + " tail é x"
    n, runs = periodic_runs.found_runs(text.encode())
    assert n == len(text.encode().split()) and runs == [(3, 2000, 5)]
    kept = b"".join(periodic_runs.collapsed(text.encode(), periodic_runs.repeats_of(runs, n))).decode()
    assert kept == "lead words here alpha beta gamma delta epsilon tail é x"
    same = Catcher()
    same.append(np.zeros(300_000, np.int32))
    assert same.runs() == [(0, 300_000, 1)]


def test_query_agrees_with_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = contract.queries()["op12_periodic_runs"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(plain_row(r.doc_id, r.text) for r in docs)
    assert any(r.n_runs for r in got) and any(not r.n_runs for r in got)


def test_defined_cases(spark):
    loop = "a b c " * 20
    rows = [(None, loop, "x"), (1, None, "x"), (2, "", "x"), (3, loop, "y"), (3, loop, "y"), (4, loop + "z " + "q " * 60, "y"), (5, "w " * 30 + "v " * 30, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    found = periodic_runs.find(docs).collect()
    assert [(r.doc_id, r.n_words, len(r.runs), r.collapsed) for r in found] == [
        (None, 60, 1, "a b c"), (1, 0, 0, ""), (2, 0, 0, ""), (3, 60, 1, "a b c"), (3, 60, 1, "a b c"), (4, 121, 2, "a b c z q"), (5, 60, 2, "w v"),
    ]
    assert found[5].strongest.period == 1 and found[6].strongest.start == 0
    carried = periodic_runs.find(docs, carry=("runs", "doc_id"), texts=False)
    assert carried.columns == ["runs", "doc_id", "n_words", "runs", "strongest", "collapsed_sha256"]
    assert periodic_runs.find(docs.limit(0)).count() == 0
    assert sorted(map(tuple, periodic_runs.looped(docs.select("doc_id", "text")).collect()), key=repr)[0][0] == 1
    with pytest.raises(ValueError):
        periodic_runs.find(docs, min_length=10)
