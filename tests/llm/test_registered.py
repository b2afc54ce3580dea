"""Every registered query of the numbered operators over the whole small tables, against SQL or plain Python."""

import math
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece

import __spark_entry__ as contract
import corpus_pipeline
from audience_engine.llm import mixing, pieces, simhash, token_counts, vectors
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_mixing import rates_by_bisection
from tests.llm.test_near_groups import components_of, plain_fingerprint
from tests.llm.test_near_texts import plain_kept
from tests.llm.test_quality_rules import plain_verdicts
from tests.llm.test_repeats import plain as plain_repeats
from tools.check import compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def rows_of(spark, name):
    return contract.queries()[name](spark, SF).collect()


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_all_are_registered():
    names = set(contract.queries())
    assert all(len([n for n in names if n.startswith(f"op{i}_")]) == 1 for i in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", ["op1_quality_rules", "op4_line_dedup"])
def test_agrees_with_sql(spark, name):
    agrees, note = compare(spark, SF, name)
    assert agrees, note


def test_quality_scores_hold_out(spark):
    got = rows_of(spark, "op2_quality_classifier")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [r for r in contract.queries()["op2_quality_classifier"](spark, sf).collect() if r.held_out and labels.get(r.doc_id) is not None]
    assert len(held) > 500 and np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.98


def test_token_counts_agree_with_encoding(spark, docs):
    encoding = token_counts.counter(token_counts.rank_bytes()).encoding
    text = {r.doc_id: r.text or "" for r in docs}
    got = rows_of(spark, "op3_token_counts")
    assert len(got) == len(docs)
    for r in got:
        edited = text[r.doc_id]
        for e in token_counts.scrubbing(edited):
            edited = edited[: e["start"]] + e["new"] + edited[e["stop"] :]
        assert r.n_tokens == len(encoding.encode_ordinary(text[r.doc_id]))
        assert r.n_tokens_edited == len(encoding.encode_ordinary(edited)) and r.edited_sha256 == sha256(edited.encode()).hexdigest()
    assert any(r.n_edits for r in got)


def test_simhash_agrees_with_all_pairs(spark, docs):
    prints = [plain_fingerprint(r.text) for r in docs]
    roots = components_of(len(docs), [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    least = {}
    for r, root in zip(docs, roots, strict=True):
        least[root] = min(r.doc_id, least.get(root, r.doc_id))
    want = {r.doc_id: (f"{p:016x}", least[root]) for r, p, root in zip(docs, prints, roots, strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows_of(spark, "op5_simhash")} == want


def test_pieces_give_texts_back(spark, docs):
    got = {r.doc_id: r for r in rows_of(spark, "op6_pieces")}
    assert len(got) == len(docs) and all(r.round_trip for r in got.values())
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    own = pieces.lattice(pieces.model_bytes())
    for r in docs[:40]:
        # the library's own segmentation is one path of the lattice, so it cannot score higher
        lead = [i for i in model.encode(r.text) if not model.is_byte(i) or own.bytes.index(i) & 0xC0 != 0x80]
        theirs = sum(own.fallback if model.is_byte(i) else model.get_score(i) for i in lead)
        assert got[r.doc_id].score >= theirs - 1e-6 and (got[r.doc_id].second_score or -math.inf) <= got[r.doc_id].score


def test_embeddings_agree_with_all_pairs(spark, tmp_path):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    draw = np.random.default_rng(7)
    given = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in rows.collect()]
    for i, (_, v, label) in enumerate(given[:200]):
        noise = draw.standard_normal(len(v)) * np.linalg.norm(v) / len(v) ** 0.5
        given.append((10_000 + i, (np.array(v) + draw.choice([0.0, 0.1, 0.3, 0.45]) * noise).tolist(), label))
    spark.createDataFrame(given, rows.schema).write.parquet(str(tmp_path / "embeddings.parquet"))
    table = sorted(spark.read.parquet(str(tmp_path / "embeddings.parquet")).collect(), key=lambda r: r.vec_id)
    unit = np.vstack([vectors.scaled(np.asarray([r.embedding], np.float32))[0] for r in table])
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in contract.queries()["op7_embeddings"](spark, str(tmp_path)).collect()}
    found = sum(r.n_links for r in got.values())
    assert len(got) == len(table) and near.sum() > 0 and 0.97 * near.sum() <= found <= near.sum()
    if found == near.sum():
        roots = components_of(len(table), list(zip(*np.nonzero(np.tril(near)), strict=True)))
        assert all(got[r.vec_id].component_id == table[root].vec_id for r, root in zip(table, roots, strict=True))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_languages_hold_out(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = contract.queries()["op8_language"](spark, sf).collect()
    assert len(got) == len(lang) and all(r.held_out == (crc(r.doc_id) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and lang[r.doc_id]]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_repeats_agree_with_all_windows(spark, docs):
    want = plain_repeats([r.text for r in docs], 35)
    expected = {r.doc_id: (n, n - len(kept.split(" ")) if kept else n, sha256(kept.encode()).hexdigest()) for r, (n, kept) in zip(docs, want, strict=True)}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows_of(spark, "op9_repeats")} == expected
    assert any(removed for _, removed, _ in expected.values())


def plain_mix(rows):
    """Source to (target, words by size) of (id, text, source) rows."""
    sizes, by = Counter(), {}
    for _, text, source in rows:
        n = len((text or "").encode().split())
        sizes[source] += n
        by.setdefault(source, []).append(n)
    return sizes, by, mixing.targets(dict(sizes))


def test_mix_meets_its_targets(spark, docs):
    sizes, by, goal = plain_mix([(r.doc_id, r.text, r.source) for r in docs])
    source = {r.doc_id: r.source for r in docs}
    taken = Counter()
    for r in rows_of(spark, "op10_mixing"):
        assert r.source_size == sizes[source[r.doc_id]] and math.isclose(r.target, goal[source[r.doc_id]])
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - goal[s]) <= max(by[s]) for s in goal)


def test_pipeline_agrees_with_plain_python(spark, docs):
    # rules
    rows = [(r.doc_id, r.text, r.source) for r in docs]
    rows = [(v[0], v[5], r[2]) for v, r in zip(plain_verdicts(rows, 10, 0.1, 0.5), rows, strict=True) if v[4]]
    # lines
    rows = [(r[0], kept, r[2]) for r, (_, _, kept) in zip(rows, plain_lines([r[1] for r in rows], 10), strict=True)]
    # near copies
    kept = plain_kept([(r[0], r[1]) for r in rows])
    rows = [r for r in rows if r[0] in kept]
    # copies by size, which the mix's ties don't change
    _, by, goal = plain_mix(rows)
    got = corpus_pipeline.run(spark, SF).collect()
    text = {r[0]: r for r in rows}
    copies = Counter(r.doc_id for r in got)
    assert set(copies) <= set(text) and max(copies.values()) <= 2
    for source, sizes in by.items():
        own = [r for r in rows if r[2] == source]
        words = sum(copies[r[0]] * len(r[1].encode().split()) for r in own)
        assert abs(words - goal[source]) <= max(sizes)
        rates = rates_by_bisection(sizes, goal[source], 2.0) if goal[source] < 2 * sum(sizes) else dict.fromkeys(sizes, 2.0)
        for size in set(sizes) - {0}:
            same = [copies[r[0]] for r in own if len(r[1].encode().split()) == size]
            assert abs(sum(same) - rates[size] * len(same)) <= 1.001
    # pieces
    lattice = pieces.lattice(pieces.model_bytes())
    for r in got:
        assert lattice.decode(r.ids).decode() == text[r.doc_id][1] and r.n_pieces == len(r.ids)


def test_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    odd = spark.createDataFrame(
        [(1, None, None, None, None, "x"), (1, "", "en", "s", 0, "y"), (2, "same words " * 30, "en", "s", 1, "z"), (2, "same words " * 30, "en", "s", 1, "z")],
        "doc_id long, text string, lang string, source string, n_chars long, _d string",
    )
    for start in (empty, odd):
        rows = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, SF)
            assert rows.columns == start.columns
        assert corpus_pipeline.STAGES[-1][1](spark, rows, SF).count() == rows.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF).count() <= 8
