import random

import numpy as np
import pytest
import xxhash

from audience_engine.llm import simhash, vectors


def components_of(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("chunk", [4, 2048])
def test_trie_join_agrees_with_all_pairs(spark, chunk):
    draw = random.Random(chunk)
    base = [draw.getrandbits(64) for _ in range(40)]
    values = set(base)
    for b in base:
        for _ in range(12):
            v = b
            for _ in range(draw.choice([1, 3, 5, 6])):
                v ^= 1 << draw.randrange(64)
            values.add(v)
    values |= {i for i in range(64)} | {0, 2**64 - 1}  # a dense subtree
    values = sorted(values)
    want = components_of(len(values), [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4])
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    edges = simhash.forest(spark.createDataFrame([(v,) for v in signed], "fp long"), chunk=chunk).collect()
    place = {v: i for i, v in enumerate(signed)}
    assert all((values[place[e.a]] ^ values[place[e.b]]) for e in edges)
    got = components_of(len(values), [(place[e.a], place[e.b]) for e in edges])
    assert got == want


def test_near_groups_of_texts(spark):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(draw.choice(words) for _ in range(120)) for _ in range(12)]
    texts = [*base, *base[:4], *(b + " end" for b in base[4:8]), *(b.upper() for b in base[8:]), None, "", "  \n", "one", "two words", "One"]
    rows = [(i if i != 3 else None, t, "x") for i, t in enumerate(texts)]
    rows += [(5, texts[5], "x"), (7, "other text for a used id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    out = simhash.near_groups(docs.select("doc_id", "text")).collect()
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    want = components_of(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    least = {}
    for (i, _, _), c in zip(rows, want, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    expected = sorted(((i, p, least.get(c)) for (i, _, _), p, c in zip(rows, prints, want, strict=True)), key=repr)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component) for r in out), key=repr) == expected
    kept = simhash.apply_dedup(docs).collect()
    assert len(kept) == len(set(want)) and kept[0].__fields__ == ["doc_id", "text", "fp"]
    assert simhash.near_groups(docs.limit(0).select("doc_id", "text")).count() == 0
    assert simhash.apply_dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [3, 2048])
def test_vectors_agree_with_all_pairs(spark, chunk):
    draw = np.random.default_rng(chunk)
    base = draw.standard_normal((30, 16))
    near = [b + s * draw.standard_normal(16) for b in base[:15] for s in (0.02, 0.1, 0.15, 0.2)]
    data = [v.tolist() for v in [*base, *near, base[0], base[0], 2 * base[1]]]
    data += [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [1.0, 2.0], [float("inf")] * 16, [1e300] * 16]
    rows = [(i, v, 1) for i, v in enumerate(data)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int")
    out = {r.vec_id: r for r in vectors.near_groups(table, chunk=chunk).collect()}
    usable = [vectors.usable(v) for v in data]
    units = [None if v is None else vectors.scaled(v[None])[0] for v in usable]
    linked = [
        (i, j)
        for i in range(len(data))
        for j in range(i)
        if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.9
    ]
    found = sum(r.n_links for r in out.values())
    assert len(out) == len(data) and 0.97 * 2 * len(linked) <= found <= 2 * len(linked)
    if found == 2 * len(linked):
        want = components_of(len(data), linked)
        assert [out[i].component for i in range(len(data))] == want
    assert vectors.near_groups(table.limit(0)).count() == 0
