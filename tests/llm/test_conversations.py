import random
import re
import zlib
from hashlib import sha256

import duckdb
import pytest

import __spark_entry__ as contract
from audience_engine.llm import conversations
from audience_engine.llm.conversations import align, damaged, repair, repaired_turns
from tools.check import compare

GAP = " \t\n\x0b\x0c\r"


def plain_align(codes):
    """(cost, audit) by the least of all edits, one turn after the other; states: nothing yet, system, user, assistant."""
    insert = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "")}

    def grown(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                new = (cost + 3, audit + "I")
                best[insert[state]] = min(best.get(insert[state], new), new)
        return best

    for code in codes.decode():
        after = {}
        for state, (cost, audit) in grown(best).items():
            extra = 3 if code.isupper() else 0
            moves = [(state, 4, "D")]
            if code != "-":
                moves.append((insert[state], 3 + extra, "R"))
                if code.lower() == insert[state] or (code.lower() == "s" and not state):
                    moves.append((code.lower(), extra, "K"))
            for to, price, letter in moves:
                new = (cost + price, audit + letter)
                after[to] = min(after.get(to, new), new)
        best = after
    grown(best)
    return min(best[s] for s in ("", "a") if s in best)


def plain_damage(rows):
    out, ids = [], []
    for conv_id, turn, role, text in rows:
        ids.append(conv_id)
        role, text = (" " if x is None else x for x in (role, text))
        x = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if x == 1 else re.sub("[.!?]", "", text) if x == 2 else text
        out += [(conv_id, turn, "user" if x == 4 else role, text)] * (0 if x == 0 else 2 if x == 3 else 1)
    return out, ids


def plain_repair(rows, ids):
    """Rows as ``repair`` returns them, with the repaired turns."""
    out = {}
    for conv in set(ids):
        own = sorted(((r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()) for r in rows if r[0] == conv))
        turns = {r[1] for r in own if r[0]}
        counts, codes, seen = dict.fromkeys(("blank", "duplicate", "truncated"), 0), "", set()
        for _, _, role, text in own:
            fault, body = None, text.decode().strip(GAP)
            if not body:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif body[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            letter = role.decode()[:1] if role.decode()[:1] in ("s", "u", "a") else "x"
            codes += {None: letter, "truncated": letter.upper()}.get(fault, "-")
            if fault:
                counts[fault] += 1
        first = [r[2].decode()[:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))
        cost, audit = plain_align(codes.encode())
        repaired, at, roles = [], 0, ("user", "assistant")
        for letter in audit:
            role, text = (own[at][2].decode(), own[at][3].decode()) if letter != "I" else (None, "")
            at += letter != "I"
            if letter == "D":
                continue
            lead = bool(repaired) and repaired[0][0][:1] == "s"
            repaired.append((role if letter == "K" else roles[(len(repaired) - lead) % 2], text))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0][0] for r in repaired))
        digest = sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = ((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest), repaired)
    return out


def some_codes(draw, n):
    pool = draw.choice(["ua", "uaUA-", "suaxSUAX-", "su", "s-x", "u", "ssuua"])
    return "".join(draw.choice(pool) if draw.random() < 0.3 else "ua"[i % 2] for i in range(n)).encode()


@pytest.mark.parametrize("segment", [1, 2, 3, 7, 128])
def test_least_edits_and_audits(segment):
    draw = random.Random(segment)
    for _ in range(400):
        codes = some_codes(draw, draw.randrange(14)) if draw.random() < 0.6 else bytes(draw.choice(b"suaxSUAX-") for _ in range(draw.randrange(12)))
        assert align(codes, segment) == plain_align(codes), codes
    for _ in range(6):
        codes = some_codes(draw, draw.choice([40, 130, 300]))
        assert align(codes, segment) == plain_align(codes)


def some_rows(seed, n=60):
    draw = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(draw.choice([1, 1, 2, 5, 8, 30])):
            role = draw.choice(["system", "user", "assistant"]) if draw.random() < 0.2 else ("user", "assistant")[turn % 2]
            role = draw.choice([None, "", "tool", "élan"]) if draw.random() < 0.05 else role
            text = draw.choice([None, "", " \n", "Same.", "cut", "Line one.\nLine two!", f"Text {draw.randrange(99)} é. \t", "u" * 200 + "?"])
            rows.append((conv, None if draw.random() < 0.05 else turn * draw.choice([1, 1, 1, 2]), role, text))
    return rows + rows[:10]


@pytest.mark.parametrize("held", [conversations.HELD_BYTES, 200, 0])
def test_repair_agrees_with_plain_python(spark, held):
    rows = some_rows(5)
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, audit string").repartition(3)
    want = plain_repair(*plain_damage(rows))
    got = repair(damaged(frame), "dropped", held).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((w[0] for w in want.values()), key=repr)
    turns = {}
    for r in sorted(repaired_turns(damaged(frame), "dropped", held).collect(), key=lambda r: r.place):
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns == {conv: w[1] for conv, w in want.items() if w[1]}


def test_long_conversation_and_empty_table(spark):
    rows = [(1, i, ("user", "assistant")[i % 2 if i % 11 else 0], f"Turn {i}." if i % 13 else "Again.") for i in range(3000)] + [(2, 0, "user", "Hi.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = sorted(w[0] for w in plain_repair(rows, [1, 2]).values())
    for held in (conversations.HELD_BYTES, 1000):
        assert sorted(map(tuple, repair(frame, held_bytes=held).collect())) == want
    assert repair(frame.limit(0)).count() == 0 and repaired_turns(frame.limit(0)).count() == 0


def test_hashes_met_before():
    draw = random.Random(2)
    seen, met = conversations.Seen(), set()
    for _ in range(50):
        values = [draw.randrange(300) for _ in range(draw.randrange(1, 40))]
        want = []
        for v in values:
            want.append(v not in met)
            met.add(v)
        assert seen.new(conversations.np.array(values, "u8")).tolist() == want


def test_query_agrees_with_sql_and_plain_python(spark, tmp_path):
    agrees, note = compare(spark, "/root/testdata/sf0.01", "op11_conversations")
    assert agrees, note
    spark.createDataFrame(some_rows(8), "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = contract.queries()["op11_conversations"](spark, str(tmp_path)).collect()
    want = plain_repair(*plain_damage(some_rows(8)))
    assert sorted(map(tuple, got), key=repr) == sorted((w[0] for w in want.values()), key=repr)
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
        names = got[0].__fields__
        rows = con.execute(f"SELECT {', '.join(names)} FROM ({contract.oracle_sql()['op11_conversations']}) q").fetchall()
    assert sorted(rows, key=repr) == sorted((w[0] for w in want.values()), key=repr)
