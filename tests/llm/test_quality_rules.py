import random
from collections import Counter, defaultdict

import pytest

from audience_engine.llm import quality_rules as qr


def words_of(text):
    return (text or "").encode().split()


def plain_figures(text):
    words = words_of(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {i + j for i in range(len(words) - 7) for j in range(8) if windows[tuple(words[i : i + 8])] > 1}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_figures_agree_with_plain_python():
    draw = random.Random(2)
    for n in (0, 1, 7, 8, 9, 40, 600):
        for vocabulary in (["a", "b#", "é|"], [f"w{i}" for i in range(400)]):
            text = "".join(draw.choice(vocabulary) + draw.choice([" ", "\n", "\t", "  ", "\x1f", " "]) for _ in range(n))
            assert qr.figures(text.encode())[0] == plain_figures(text)
    assert qr.figures(None)[0] == (0, 0, 0, 0, 0)


def plain_verdicts(rows, min_docs, share, depleted):
    texts = defaultdict(set)
    for _, text, source, *_ in rows:
        texts[source].add(text or "")
    often = {}
    for source, own in texts.items():
        counts = Counter(k for t in own for k in {b" ".join(x.split()).lower() for x in t.encode().split(b"\n") if x.split()})
        often[source] = {k for k, n in counts.items() if n > min_docs and n > share * len(own)}
    out = []
    for row in rows:
        text, source = row[1] or "", row[2]
        gone = [x for x in text.encode().split(b"\n") if x.split() and b" ".join(x.split()).lower() in often[source]]
        n, _, _, _, repeated = plain_figures(text)
        failed = n < 20 or 100 * repeated > 30 * n
        lost = sum(len(x.split()) for x in gone)
        kept = not failed and lost <= depleted * n
        left = "\n".join(x for x in text.split("\n") if not x.encode().split() or b" ".join(x.encode().split()).lower() not in often[source])
        out.append((row[0], failed, len(gone), lost, kept, left))
    return out


@pytest.mark.parametrize("max_lines", [0, 1000])
def test_verdicts_agree_with_plain_python(spark, max_lines):
    draw = random.Random(4)
    own = lambda n: " ".join(f"w{draw.randrange(9999)}" for _ in range(n))
    rows = []
    for i in range(90):
        lines = [own(draw.choice([3, 30]))] + draw.choice([[], ["Menu  Home", "menu home " + " ".join(f"m{j}" for j in range(30))], ["MENU home", own(4)]])
        draw.shuffle(lines)
        rows.append((i, "\n".join(lines), draw.choice(["s0", "s0", "s1", None]), i))
    rows += [(200 + i, rows[1][1], "s0", i) for i in range(30)] + [(1, None, None, 0), (1, "", "s1", 0), (1, own(30), "s1", 1), (None, own(25), "s1", 2), rows[5], rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words long").repartition(3)
    want = plain_verdicts(rows, 5, 0.2, 0.5)
    assert any(w[2] for w in want) and any(not w[1] and not w[4] for w in want)
    got = qr.judge(docs, 5, 0.2, 0.5, max_lines).collect()
    assert sorted(((r.doc_id, r.base_failed, r.n_removed_lines, r.n_removed_words, r.kept) for r in got), key=repr) == sorted((w[:5] for w in want), key=repr)
    kept = qr.apply_rules(docs, 5, 0.2, 0.5, max_lines)
    assert kept.columns == docs.columns
    expected = sorted(((w[0], w[5], r[2], r[3]) for w, r in zip(want, rows, strict=True) if w[4]), key=repr)
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == expected


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert qr.judge(docs).count() == 0 and qr.apply_rules(docs).count() == 0
