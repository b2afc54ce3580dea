import random

import pytest

from audience_engine.llm import token_counts as tc

ALPHABET = ["a", "b", " ", "  ", "\n", "'", "'s", "'ll", "9", "é", "!", "word", "\t", " the", " ", "😀", "x1"]


@pytest.fixture(scope="module")
def count():
    return tc.counter(tc.rank_bytes()).__getitem__


def text_of(draw, n):
    return "".join(draw.choice(ALPHABET) for _ in range(n))


@pytest.mark.parametrize("seed", range(40))
def test_edits_agree_with_encoding_the_whole_text(count, seed, monkeypatch):
    monkeypatch.setattr(tc, "BLOCK", 4)
    draw = random.Random(seed)
    text = text_of(draw, draw.choice([0, 1, 5, 60, 400]))
    tree = tc.SegmentTree(*tc.leaves(text, count))
    encoding = tc.counter(tc.rank_bytes()).encoding
    for _ in range(12):
        start = draw.randrange(len(text) + 1)
        stop = min(len(text), start + draw.choice([0, 0, 1, 3, 40]))
        new = text_of(draw, draw.choice([0, 1, 3, 20]))
        want = text[:start] + new + text[stop:]
        text, _ = tree.edit(text, start, stop, new, count)
        assert text == want
        assert tree.n_tokens == len(encoding.encode_ordinary(text))
        assert tree.n_chars == len(text)
        chars, tokens = tc.leaves(text, count)
        assert [c for block in tree.chars for c in block] == chars.tolist()
        assert [t for block in tree.tokens for t in block] == tokens.tolist()
        again = tc.SegmentTree.unpacked(tree.packed())
        assert again.token_sums == tree.token_sums and again.char_sums == tree.char_sums


def test_only_the_touched_region_is_encoded_again(count):
    text = "some words here " * 2000
    tree = tc.SegmentTree(*tc.leaves(text, count))
    _, fresh = tree.edit(text, 16_000, 16_004, "other", count)
    assert fresh < 8


def test_build_and_apply(spark, count):
    rows = [(1, "write to me@mail.example.org or 555 123 4567 now", "x"), (2, None, "y"), (3, "", None), (3, "plain text", "z"), (3, "plain text", "z"), (None, "a" * 50_000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = tc.apply_edits(tc.with_scrubbing(tc.build(docs))).collect()
    assert len(out) == 6
    by = {(r.doc_id, r.text): r for r in out}
    encoding = tc.counter(tc.rank_bytes()).encoding
    first = by[1, "write to <MAIL> or <NUMBER> now"]
    assert first.n_edits == 2 and first.n_tokens == len(encoding.encode_ordinary(first.text))
    assert by[2, None].n_tokens == 0 and by[3, ""].n_tokens == 0
    assert all(r.n_tokens == len(encoding.encode_ordinary(r.text or "")) for r in out)
    assert tc.apply_edits(tc.with_scrubbing(tc.build(docs.limit(0)))).count() == 0
    at_once = sorted(((r.doc_id, r.text, r.n_tokens_edited, r.n_edits, r.n_encoded) for r in tc.counts_after(docs).collect()), key=repr)
    assert at_once == sorted(((r.doc_id, r.text, r.n_tokens, r.n_edits, r.n_encoded) for r in out), key=repr)
    assert tc.counts_after(docs.limit(0)).count() == 0


def test_many_edits_of_one_long_text():
    """Edits from either end, with pieces that shrink to nothing and grow over blocks, agree with a fresh count."""
    count = tc.counter(tc.rank_bytes()).__getitem__
    text = "call 030 1234567 or  write to a@b.org\n\n   now " * 4000
    for edits in (tc.scrubbing(text), [{"start": i * 7, "stop": i * 7 + 3, "new": " " * (i % 9) + "x" * (i % 4)} for i in range(3000)]):
        tree, want = tc.SegmentTree(*tc.leaves(text, count)), text
        for e in edits:
            want = want[: e["start"]] + e["new"] + want[e["stop"] :]
        got, _ = tc._edited(text, tree, edits, count)
        assert got == want and tree.n_tokens == int(tc.leaves(want, count)[1].sum()) and tree.n_chars == len(want)
        assert "".join(tree.texts) == want and [len(x) for x in tree.texts] == [sum(c) for c in tree.chars]


def test_a_run_of_blanks_longer_than_the_blocks():
    count = tc.counter(tc.rank_bytes()).__getitem__
    text = "word " * 200 + " " * 5000 + "end " * 200
    tree = tc.SegmentTree(*tc.leaves(text, count))
    for start, stop, new in ((999, 1003, "x"), (900, 5990, ""), (0, 0, "  "), (905, 905, " " * 3000), (0, 10**6, "")):
        want = text[:start] + new + text[stop:]
        text, _ = tree.edit(text, start, stop, new, count)
        assert text == want and tree.n_tokens == int(tc.leaves(text, count)[1].sum())
