import itertools
import random

import numpy as np
import pytest

from audience_engine.llm import pieces, queries


@pytest.fixture(scope="module")
def own():
    return pieces.lattice(pieces.model_bytes())


def every_path(own, text):
    """All segmentations of a whole text, by brute force."""
    text = " " + text
    starts = {}
    for i, j, piece, score in own.edges(text):
        starts.setdefault(i, []).append((j, piece, score))

    def walk(at):
        if at == len(text):
            yield 0.0, []
            return
        for j, piece, score in starts[at]:
            for rest, ids in walk(j):
                yield score + rest, own.spelled(text, at, j, piece) + ids

    return sorted(walk(0), key=lambda p: -p[0])


@pytest.mark.parametrize("text", ["the cat", "aab b", "a\nb", "été 😀", "  two", "x▁y", "onon on", "aaaaaa"])
def test_n_best_agree_with_all_paths(own, text):
    want = every_path(own, text)
    ((ids, score, ways),) = own.encode([text], 4)
    got = [score, *(s for s, _ in ways)]
    assert np.allclose(got, [s for s, _ in want[:4]])
    scores = {tuple(p): s for s, p in want}
    assert np.isclose(scores[tuple(ids.tolist())], score)
    seen = [tuple(ids.tolist()), *(tuple(pieces.swapped(ids.tolist(), swaps)) for _, swaps in ways)]
    assert len(set(seen)) == len(seen)
    assert all(np.isclose(scores[p], s) for p, s in zip(seen, got, strict=True))


def test_round_trip_and_a_star_agree_with_viterbi(own):
    draw = random.Random(5)
    alphabet = ["a", "the", " ", "  ", "\n", "é", "▁", "😀", "\t", "ing", "Z", "\x00", "一"]
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.choice([0, 1, 7, 300]))) for _ in range(60)] + ["q" * 5000, " " * 999]
    for text, (ids, score, _) in zip(texts, own.encode(texts, 2), strict=True):
        assert own.decode(ids.tolist()).decode() == text
        if 0 < len(text) <= 300:
            total = sum(next(own.paths(c))[0] for c in own.chunks(" " + text))
            assert np.isclose(total, score)


def test_frames(spark):
    rows = [(1, "the cat sat", "p"), (2, None, "p"), (3, "", None), (3, "", None), (None, "x " * 3000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pieces string")
    coded = pieces.encode(docs)
    assert coded.columns == ["doc_id", "text", "pieces"]
    got = {(r.doc_id, r.text): r.pieces for r in coded.collect()}
    assert got[2, None].ids is None and got[3, ""].ids == [] and got[1, "the cat sat"].alternatives
    back = pieces.decode(coded.withColumn("ids", coded["pieces.ids"]), "ids", carry=("doc_id", "text")).collect()
    assert len(back) == 5 and all(r.text == r.decoded for r in back)
    assert pieces.encode(docs.limit(0)).count() == 0
    assert list(itertools.islice(pieces.lattice(pieces.model_bytes()).paths(" a"), 1))


def test_query_returns_and_decodes_all_of_the_n_best(spark, tmp_path, own):
    texts = ["the cat sat on the mat", None, "", "a", "été 😀\n x▁y", "onon on " * 40]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.QUERIES["op6_pieces"](spark, str(tmp_path)).collect()}
    assert len(got) == len(texts) and all(r.round_trip for r in got.values())
    assert got[1].other_scores is None and got[1].other_hashes is None and got[2].other_hashes == []
    lists = [(i, [pieces.swapped(ids.tolist(), swaps) for _, swaps in ways]) for i, (ids, _, ways) in zip((0, 3, 4, 5), own.encode([texts[i] for i in (0, 3, 4, 5)]))]
    want = spark.createDataFrame(lists, "i long, w array<array<int>>").selectExpr("i", "transform(w, x -> xxhash64(x)) AS h", "w").collect()
    for r in want:
        assert got[r.i].other_hashes == r.h and len(got[r.i].other_scores) == len(r.h) and (not r.h or got[r.i].second_score == got[r.i].other_scores[0])
        assert all(own.decode(w).decode() == texts[r.i] for w in r.w)
    assert len(want[0].h) == pieces.N_BEST - 1
    # a wrong list among the alternatives shows
    docs = spark.createDataFrame([(1, [[5, 6], [7]]), (2, None), (3, [])], "doc_id long, ids array<array<int>>")
    back = {r.doc_id: r.decoded for r in pieces.decode(docs, "ids").collect()}
    assert back[2] is None and back[3] == [] and len(back[1]) == 2 and back[1][0].encode() == own.decode([5, 6])


def test_id_lists_are_decoded_side_by_side_and_whole_lists_come_from_the_encoding_task(spark, own, monkeypatch):
    monkeypatch.setattr(pieces, "_IDS", 7)  # several parts, and lists longer than one
    texts = ["the cat sat", "", " x▁y\n😀", "q " * 50, "a"]
    lists = [ids for ids, _, _ in own.encode(texts)] + [np.array([own.bytes[65]], np.int32)]
    got = own.decode_lists(np.concatenate(lists), np.array([len(x) for x in lists]))
    assert got.to_pylist() == [own.decode(x.tolist()) for x in lists] == [*(t.encode() for t in texts), b""]
    assert own.decode_lists(np.empty(0, np.int32), np.zeros(2, np.int64)).to_pylist() == [b"", b""]
    assert own.decode_lists(np.empty(0, np.int32), np.empty(0, np.int64)).to_pylist() == []
    for bad in (-1, len(own.score), next(i for i in range(len(own.score)) if i not in own.texts)):
        with pytest.raises(KeyError):
            own.decode_lists(np.array([bad], np.int32), np.array([1]))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i long, text string")
    rows = {r.i: r.pieces for r in pieces.encode(docs, whole=True, check=True).collect()}
    for i, text in enumerate(texts):
        p = rows[i]
        assert p.round_trip and p.n_best == [p.ids, *(pieces.swapped(p.ids, w.swaps) for w in p.alternatives)]
        assert all(own.decode(ids).decode() == text for ids in p.n_best) and len(p.n_best) == (1 + len(p.alternatives))
    assert rows[len(texts)].n_best is None and rows[len(texts)].round_trip
    # the plan builds no list with columns: what the encoding task returns is what is decoded
    plan = pieces.encode(docs, whole=True).select("pieces.n_best")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "lambda" not in plan
