import random
from collections import Counter

import numpy as np
import pytest

from audience_engine.llm import line_dedup as ld


def plain(texts, min_docs, min_chars=1):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    seen = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and seen[key(x)] >= min_docs)]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def corpus():
    draw = random.Random(3)
    lines = ["", "  ", "É", "é", "Home", " home\t", "HOME\r", "x", "many words in a line", "\x85odd", " nbsp"] + [f"line {i}" for i in range(60)]
    texts = ["\n".join(draw.choice(lines) for _ in range(draw.randrange(12))) for _ in range(150)]
    return [*texts, None, "", "\n\n", "home\nhome\nhome", "y" * 200_000]


@pytest.mark.parametrize(("min_chars", "shard", "probes"), [(1, 7, 1 << 20), (3, 200_000, 1 << 20), (1, 7, 10), (3, 7, 3)])
def test_agrees_with_plain_python(spark, monkeypatch, min_chars, shard, probes):
    monkeypatch.setattr(ld, "SHARD_KEYS", shard)
    monkeypatch.setattr(ld, "SHARD_PROBES", probes)
    texts = corpus()
    rows = [(i, t, "x", i) for i, t in enumerate(texts)] + [(3, "home\nhere", "x", 1), (4, texts[4], "x", 4), (None, "home", None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, h1 long").repartition(4)
    want = plain([r[1] for r in rows], 10, min_chars)
    got = ld.dedup_lines(docs, 10, min_chars).collect()
    expected = sorted(((r[0], *w) for r, w in zip(rows, want, strict=True)), key=repr)
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got), key=repr) == expected
    whole = ld.apply_dedup(docs, 10, min_chars)
    assert whole.columns == docs.columns
    assert sorted(((r.doc_id, r.text, r.n_lines, r.h1) for r in whole.collect()), key=repr) == sorted(
        ((r[0], None if r[1] is None else w[2], r[2], r[3]) for r, w in zip(rows, want, strict=True)), key=repr
    )


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ld.dedup_lines(docs).count() == 0 and ld.apply_dedup(docs).count() == 0


def test_perfect_hash_is_minimal():
    draw = np.random.default_rng(1)
    for n in (1, 2, 1000, 50_000):
        h1, h2 = draw.integers(0, 2**63, (2, n), dtype=np.uint64)
        h1[: n // 2] = h1[0]  # half of the keys differ in one word only
        perfect = ld.PerfectHash.unpacked(ld.PerfectHash(h1, h2).packed())
        assert perfect.size == n and sorted(perfect.index(h1, h2).tolist()) == list(range(n))


def test_shards_index_every_distinct_line(spark):
    texts = corpus()
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    counts = ld.key_counts(docs)
    rows = ld.build_shards(counts, 5).collect()
    held = {r.shard: ld.Shard(r.perfect, r.prints, r.counts) for r in rows}
    want = counts.withColumn("shard", ld.shard_of(5)).collect()
    distinct = {x.strip(" \t\r").encode().lower() for t in texts for x in (t or "").split("\n")} - {b""}
    assert sum(s.perfect.size for s in held.values()) == len(want) == len(distinct)
    for shard, own in held.items():
        keys = [r for r in want if r.shard == shard]
        h1, h2 = (np.array([getattr(r, c) for r in keys], np.int64).view(np.uint64) for c in ("h1", "h2"))
        assert own.counts(h1, h2).tolist() == [r.docs for r in keys]
        assert not own.counts(h1, h2 + np.uint64(1)).any()
    assert sum(r.probes for r in rows) == sum(r.docs for r in want)


def test_hot_line_is_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(ld, "SHARD_PROBES", 100)
    rows = [(i, f"the same line\nown line {i}") for i in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    counts = ld.key_counts(docs)
    index = ld.build_shards(counts, 1)
    asked = ld._probes(docs.selectExpr("doc_id _a", "0L _b", "text"), 1)
    goes = ld.probed(asked, index, 1, 10)
    seen = goes.groupBy(ld.F.spark_partition_id()).count().collect()
    assert sum(r[1] for r in seen) == 2_000 and max(r[1] for r in seen) < 1_000
    out = ld.dedup_lines(docs).collect()
    assert all(r.n_dropped == 1 and r.text == f"own line {r.doc_id}" for r in out) and len(out) == 2_000
