"""Conversation structure repair: turns aligned to every feasible length of the alternating role string at the least cost.

The roles of a repaired conversation read ``(s?(ua)+)?``, by their initials. An edit keeps a turn, gives it the role user or assistant,
deletes it, or inserts an empty turn of one of these roles. Blank turns and repeated ones (role and text as in an earlier turn) must go;
a truncated turn that stays costs extra.

Wagner-Fischer tables hold the cost of aligning the turns from ``i`` on with the last ``j`` roles of the alternating string, so one table
serves all lengths. A first pass in a narrow band gives an incumbent; what that costs above the deletions that nothing can avoid bounds
how far an alignment strays from the diagonal (Ukkonen), and a second pass in that band is exact, ties included. Each length of the
least cost is traced back to its audit (the edits' initials in order), letters in ASCII order first, and the least audit is taken.

Turns are aligned ``SEGMENT`` at a time from the end on; a segment hands on the least costs of what follows, for an odd number of
roles, an even one, and an even one above zero, and may not end with an insertion, as that belongs to the next one. So time and memory grow with
the number of turns, not with its square. A leading system turn is tried at each place where everything before it is deleted.

One shuffle brings the turns of a conversation together, in order. A task holds one code byte and a 64-bit hash per turn, and the texts
of one conversation up to ``HELD_BYTES``. The turns of a longer one are passed on with their numbers and its edits in slices,
and hashed as a stream in a second, small step; the result is the same. A digest of the whole repaired text can only be
computed in order, so one task reads such a conversation, but never holds it.

Defined cases: a null role or text is one space; turns are ordered by turn (null first), then role and text; a null conversation id is a
conversation of its own; equal rows of one turn are duplicates; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audience_engine.llm.common import SPACES, utf8
from audience_engine.session import cut_lineage

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SEGMENT = 128
HELD_BYTES = 32 * 1024 * 1024
SLICE = 4096
_BLANK = SPACES.encode()
_FAR = 1 << 40
_ROLES = (b"user", b"assistant")


class Table:
    """Least costs of aligning a segment's turns from ``i`` on with the last ``j`` roles that it takes.

    ``odd`` says whether an odd number of roles follows the segment; the role with ``k`` left, itself included, is user for even ``k``.
    """

    def __init__(self, codes: bytes, odd: int, last: bool):
        self.codes, self.odd, self.last = codes, odd, last
        must = codes.count(b"-")
        slack = 12
        while True:
            self._fill(slack)
            top = self.cost[0]
            best = max(int(top[2::2].min(initial=_FAR)), int(top[1::2].min(initial=_FAR)))
            over = best - DELETE * must + 2 * INSERT  # a start further on may have to insert a pair
            if best < _FAR and over <= slack:
                break
            slack = over if best < _FAR else 2 * slack
        self.rows: list[list[int]] = self.cost.tolist()

    def _fill(self, slack: int) -> None:
        codes, n = self.codes, len(self.codes)
        free = np.cumsum([0, *(c != 45 for c in reversed(codes))])[::-1]
        width = int(free[0]) + slack // INSERT + 2
        self.cost = np.full((n + 1, width + 1), _FAR, np.int64)
        steps = INSERT * np.arange(width + 1)
        if self.last:
            self.cost[n, : slack // INSERT + 2] = steps[: slack // INSERT + 2]
        else:
            self.cost[n, 0] = 0
        user = (np.arange(width + 1) + self.odd) % 2 == 0
        for i in range(n - 1, -1, -1):
            low, high = max(0, int(free[i]) - slack // DELETE - 1), min(width, int(free[i]) + slack // INSERT + 1)
            after = self.cost[i + 1]
            row = after[low : high + 1] + DELETE
            if codes[i] != 45:
                extra, letter = _letter(codes[i])
                fits = user[low : high + 1] if letter == "u" else ~user[low : high + 1] if letter == "a" else False
                moved = np.concatenate([after[low - 1 : high] if low else [_FAR, *after[:high]]])
                row = np.minimum(row, moved + np.where(fits, extra, extra + REROLE))
            own = steps[low : high + 1]
            self.cost[i, low : high + 1] = np.minimum(np.minimum.accumulate(row - own) + own, _FAR)

    def trace(self, i: int, j: int) -> str:
        """The ASCII-least edits of least cost from turn ``i`` on that leave ``j`` roles to this segment."""
        rows, codes, n, out = self.rows, self.codes, len(self.codes), []
        while i < n or j:
            cost = rows[i][j]
            if i < n and rows[i + 1][j] + DELETE == cost:
                out.append("D")
                i += 1
            elif j and (i < n or self.last) and rows[i][j - 1] + INSERT == cost:
                out.append("I")
                j -= 1
            else:
                extra, letter = _letter(codes[i])
                kept = letter == "ua"[(j + self.odd) % 2] and rows[i + 1][j - 1] + extra == cost
                out.append("K" if kept else "R")
                i, j = i + 1, j - 1
        return "".join(out)


def _letter(code: int) -> tuple[int, str]:
    letter = chr(code)
    return (TRUNCATED if letter.isupper() else 0), letter.lower()


class _Segment:
    """A segment's tables and the least costs (even, even above zero, odd) of what follows it."""

    def __init__(self, codes: bytes, after: tuple[int, int, int], last: bool):
        self.codes, self.after = codes, after
        self.even = Table(codes, 0, last)
        self.odd = None if last else Table(codes, 1, last)

    def ways(self, i: int, odd: bool) -> Iterator[tuple[int, Table | None, int, int]]:
        """(cost, table, roles in the segment, what follows) from turn ``i`` on, for an odd number of roles or an even one above zero."""
        every, some, single = self.after
        if not odd and some < _FAR:
            yield DELETE * (len(self.codes) - i) + some, None, 0, 1
        for j in range(1 if odd else 2, len(self.even.rows[i]), 2):
            yield self.even.rows[i][j] + every, self.even, j, 0
        if self.odd:
            for j in range(0 if odd else 1, len(self.odd.rows[i]), 2):
                yield self.odd.rows[i][j] + single, self.odd, j, 2

    def least(self, i: int, odd: bool) -> int:
        return min(way[0] for way in self.ways(i, odd))

    def audit(self, i: int, odd: bool) -> tuple[str, int]:
        """(least audit of least cost, what follows)."""
        best = self.least(i, odd)
        tied = [(t.trace(i, j) if t else "D" * (len(self.codes) - i), follows) for cost, t, j, follows in self.ways(i, odd) if cost == best]
        return min(tied)


def align(codes: bytes, segment: int = SEGMENT) -> tuple[int, str]:
    """(cost, audit) of a conversation.

    A code is the initial of a turn's role (``x`` for others), in upper case if the turn is truncated, or ``-`` if it must go.
    """
    n = len(codes)
    if not n:
        return 0, ""
    starts = range(0, n, segment)
    after = (0, _FAR, _FAR)
    follows: list[tuple[int, int, int]] = []
    lead, lead_at = _FAR, -1
    for start in reversed(starts):
        part = _Segment(codes[start : start + segment], after, start + segment >= n)
        follows.append(after)
        for i in range(len(part.codes) - 1, -1, -1):
            if part.codes[i] in b"sS":
                cost = DELETE * (start + i) + _letter(part.codes[i])[0] + part.least(i + 1, False)
                if cost < lead:  # of equal costs the later place has more D in front
                    lead, lead_at = cost, start + i
        some, single = part.least(0, False), part.least(0, True)
        after = (min(DELETE * (n - start), some), some, single)
    follows.reverse()
    none, some = DELETE * n, after[1]
    best = min(none, some, lead)
    if none == best:
        return best, "D" * n

    def traced(at: int) -> str:
        out, state = [], 1
        while at < n:
            if state == 0:  # nothing more is needed
                rest = DELETE * (n - at)
                part = _Segment(codes[at : at + segment], follows[at // segment], at + segment >= n)
                if rest <= part.least(0, False):
                    out.append("D" * (n - at))
                    break
                state = 1
            first = at // segment
            part = _Segment(codes[first * segment : (first + 1) * segment], follows[first], (first + 1) * segment >= n)
            audit, state = part.audit(at - first * segment, state == 2)
            out.append(audit)
            at = (first + 1) * segment
        else:
            if at == n and not out:  # the system turn is the last one
                out.append("II")
        return "".join(out)

    audits = [traced(0)] if some == best else []
    if lead == best:
        audits.append("D" * lead_at + "K" + traced(lead_at + 1))
    return best, min(audits)


_known = lru_cache(maxsize=1 << 14)(align)


class Seen:
    """64-bit hashes met so far, in sorted arrays of growing size."""

    def __init__(self):
        self.sorted: list[np.ndarray] = []

    def new(self, hashes: np.ndarray) -> np.ndarray:
        """Which of ``hashes`` come for the first time."""
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        out = np.zeros(len(hashes), bool)
        out[order[np.concatenate([[True], ranked[1:] != ranked[:-1]])]] = True
        for run in self.sorted:
            out &= run[np.minimum(np.searchsorted(run, hashes), len(run) - 1)] != hashes
        fresh = np.sort(hashes[out])
        while self.sorted and len(self.sorted[-1]) <= 2 * len(fresh):
            fresh = np.sort(np.concatenate([self.sorted.pop(), fresh]))
        if len(fresh):
            self.sorted.append(fresh)
        return out


class Repair:
    """The repaired turns of a conversation, as its turns and edits come in order."""

    def __init__(self):
        self.place, self.lead = 0, False

    def _next(self) -> bytes:
        role = _ROLES[(self.place - self.lead) % 2]
        self.place += 1
        return role

    def turns(self, edits: str, role: bytes, text: bytes) -> Iterator[tuple[bytes, bytes]]:
        """``edits`` are those up to the one of this turn."""
        for edit in edits[:-1]:
            yield self._next(), b""
        if edits[-1:] == "R":
            yield self._next(), text
        elif edits[-1:] == "K":
            if not self.place and role[:1] == b"s":
                self.place, self.lead = 1, True
            else:
                self._next()
            yield role, text

    def rest(self, edits: str) -> Iterator[tuple[bytes, bytes]]:
        for _ in edits:
            yield self._next(), b""


def by_turn(audit: str) -> tuple[list[str], str]:
    """(the edits of each turn, with the insertions before it; insertions at the end)."""
    own, at = [], 0
    for i, edit in enumerate(audit):
        if edit != "I":
            own.append(audit[at : i + 1])
            at = i + 1
    return own, audit[at:]


class _Conversation:
    """What is gathered of a conversation while its turns come in order."""

    def __init__(self, conv_id, held_bytes: int):
        self.conv_id, self.held_bytes = conv_id, held_bytes
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.last_turn = self.last_initial = None
        self.codes, self.seen = bytearray(), Seen()
        self.held: list[tuple[bytes, bytes]] = []
        self.bytes, self.passed = 0, 0

    def add(self, turns: list, roles: list[bytes], texts: list[bytes]) -> None:
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(r + b"\x00" + t) for r, t in zip(roles, texts, strict=True)), np.uint64, len(roles))
        for turn, role, text, new in zip(turns, roles, texts, self.seen.new(hashes).tolist(), strict=True):
            if turn is not None and turn != self.last_turn:
                self.turns += 1
                self.least, self.most, self.last_turn = turn if self.least is None else self.least, turn, turn
            initial, code = role[:1], ord(role[:1]) if role[:1] in (b"s", b"u", b"a") else 120
            if self.last_initial is not None:
                self.illegal += self.last_initial + initial not in (b"su", b"ua", b"au")
            self.last_initial = initial
            body = text.strip(_BLANK)
            if not body:
                self.blank, code = self.blank + 1, 45
            elif not new:
                self.duplicate, code = self.duplicate + 1, 45
            elif body[-1] not in b".!?":
                self.truncated, code = self.truncated + 1, code - 32
            self.codes.append(code)
            self.held.append((role, text))
            self.bytes += len(text) + len(role)

    def passing(self, end: bool) -> Iterator[dict]:
        """The turns of a conversation too long to be held; at its end the edits, in slices."""
        if self.bytes > self.held_bytes or (end and self.passed):
            for role, text in self.held:
                yield {"conv_id": self.conv_id, "kind": 2, "n": self.passed, "role": role, "text": text}
                self.passed += 1
            self.held, self.bytes = [], 0

    def finished(self) -> Iterator[dict]:
        yield from self.passing(True)
        codes = bytes(self.codes)
        cost, audit = _known(codes) if len(codes) <= SEGMENT else align(codes)
        gaps = self.most - self.least + 1 - self.turns if self.least is not None else 0
        row = {"conv_id": self.conv_id, "kind": 0, "gaps": gaps, "cost": cost, "audit": audit, "held": not self.passed}
        row |= {c: getattr(self, c) for c in ("blank", "duplicate", "truncated", "illegal")}
        edits, rest = by_turn(audit)
        if self.passed:
            for n in range(0, len(edits), SLICE):
                part = edits[n : n + SLICE]
                yield {"conv_id": self.conv_id, "kind": 1, "n": n, "audit": "".join(part) + (rest if n + SLICE >= len(edits) else "")}
        else:
            repair = Repair()
            row["turns"] = [t for e, (role, text) in zip(edits, self.held, strict=True) for t in repair.turns(e, role, text)]
            row["turns"] += repair.rest(rest)
        yield row


def _digest(turns: list[tuple[bytes, bytes]]) -> str:
    return hashlib.sha256(b"\n".join(r + b":" + t for r, t in turns)).hexdigest()


def _by_conversation(batches, columns: tuple[str, ...]) -> Iterator[tuple[object, pa.RecordBatch]]:
    """(conversation, some of its rows), in order; the rows are sorted by conversation."""
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        at = 0
        for i in range(1, len(ids) + 1):
            if i == len(ids) or ids[i] != ids[at]:
                yield ids[at], batch.slice(at, i - at).select(columns)
                at = i


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _aligned(rows: DataFrame, absent: str | None, held_bytes: int, with_turns: bool) -> DataFrame:
    """Per conversation a row of kind 0; of long ones also their edits (kind 1) and turns (kind 2)."""
    plain = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.col(absent) if absent else F.lit(False)).alias("absent")
    )
    ordered = plain.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    turn = T.StructType().add("role", "string").add("text", "string")
    schema = T.StructType([rows.schema["conv_id"]]).add("kind", "integer").add("n", "long").add("role", "string").add("text", "string")
    for name in _COUNTS:
        schema = schema.add(name, "long")
    schema = schema.add("audit", "string").add("held", "boolean").add("sha256", "string")
    if with_turns:
        schema = schema.add("turns", T.ArrayType(turn))
    names = schema.names

    def run(batches):
        out: list[dict] = []
        size = 0
        kind = None

        def batch():
            columns = []
            for name in names:
                values = [r.get(name) for r in out]
                if name == "conv_id":
                    columns.append(pa.array(values, kind))
                elif name in ("role", "text"):
                    columns.append(pa.array(values, pa.binary()).cast(pa.string()))
                elif name == "turns":
                    own = [None if v is None else [{"role": r.decode(), "text": t.decode()} for r, t in v] for v in values]
                    columns.append(pa.array(own, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))))
                else:
                    columns.append(pa.array(values, pa.string() if name in ("audit", "sha256") else pa.bool_() if name == "held" else pa.int32() if name == "kind" else pa.int64()))
            return pa.RecordBatch.from_arrays(columns, names=names)

        def sized(made):
            nonlocal size
            for row in made:
                turns = row.pop("turns", None)
                if turns is not None:
                    row["sha256"] = _digest(turns)
                    if with_turns:
                        row["turns"] = turns
                size += len(row.get("text") or b"") + (sum(len(t) for _, t in turns) if with_turns and turns else 0) + len(row.get("audit") or "") + 100
                out.append(row)
                if size > 1 << 22:
                    yield batch()
                    out.clear()
                    size = 0

        own: _Conversation | None = None
        for conv_id, part in _by_conversation(batches, ("conv_id", "turn", "role", "text", "absent")):
            kind = part.column("conv_id").type
            if own is None or own.conv_id != conv_id:
                if own is not None:
                    yield from sized(own.finished())
                own = _Conversation(conv_id, held_bytes)
            there = part.filter(pa.compute.invert(part.column("absent")))
            for at in range(0, there.num_rows, SLICE):
                some = there.slice(at, SLICE)
                own.add(some.column("turn").to_pylist(), utf8(some.column("role")), utf8(some.column("text")))
                yield from sized(own.passing(False))
        if own is not None:
            yield from sized(own.finished())
        if out:
            yield batch()

    return ordered.mapInArrow(run, schema)


def _streamed(long: DataFrame, emit: bool) -> DataFrame:
    """Of the conversations that are not held: ``conv_id``, ``long_sha256``, or, to ``emit``, ``conv_id``, ``place``, ``role``, ``text``."""
    ordered = long.select("conv_id", "n", "kind", "role", "text", "audit").repartition("conv_id").sortWithinPartitions("conv_id", "n", "kind")
    key = T.StructType([long.schema["conv_id"]])
    schema = key.add("place", "long").add("role", "string").add("text", "string") if emit else key.add("long_sha256", "string")

    def run(batches):
        state = None

        def ended(state):
            conv_id, repair, digest, first, edits, rest = state
            made = list(repair.rest(rest))
            _hash(state, made)
            return pa.array([conv_id], kind), state[2].hexdigest(), made

        def _hash(state, turns):
            for role, text in turns:
                state[2].update((b"" if state[3] else b"\n") + role + b":" + text)
                state[3] = False

        def rows(kind, conv_id, place, turns):
            columns = [pa.array([conv_id] * len(turns), kind), pa.array(range(place, place + len(turns)), pa.int64())]
            columns += [pa.array([t[c] for t in turns], pa.binary()).cast(pa.string()) for c in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        kind = None
        for conv_id, part in _by_conversation(batches, ("conv_id", "kind", "role", "text", "audit")):
            if state is None or state[0] != conv_id:
                if state is not None:
                    ids, digest, made = ended(state)
                    yield rows(kind, state[0], state[1].place - len(made), made) if emit else pa.RecordBatch.from_arrays([ids, pa.array([digest])], names=schema.names)
                state = [conv_id, Repair(), hashlib.sha256(), True, iter(()), ""]
            kind = part.column("conv_id").type
            for at in range(0, part.num_rows, 256):
                some = part.slice(at, 256)
                turns: list[tuple[bytes, bytes]] = []
                place = state[1].place
                columns = (some.column("kind").to_pylist(), utf8(some.column("role")), utf8(some.column("text")), some.column("audit").to_pylist())
                for what, role, text, audit in zip(*columns, strict=True):
                    if what == 1:
                        edits, state[5] = by_turn(audit)
                        state[4] = iter(edits)
                    else:
                        turns += state[1].turns(next(state[4]), role, text)
                if emit:
                    if turns:
                        yield rows(kind, conv_id, place, turns)
                else:
                    _hash(state, turns)
        if state is not None:
            ids, digest, made = ended(state)
            yield rows(kind, state[0], state[1].place - len(made), made) if emit else pa.RecordBatch.from_arrays([ids, pa.array([digest])], names=schema.names)

    return ordered.mapInArrow(run, schema)


def repair(rows: DataFrame, absent: str | None = None, held_bytes: int = HELD_BYTES) -> DataFrame:
    """Per ``conv_id``: ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``.

    ``rows`` are turns (``conv_id``, ``turn``, ``role``, ``text``); those whose boolean column ``absent`` is true only name a conversation.
    """
    done = cut_lineage(_aligned(rows, absent, held_bytes, False))
    long = _streamed(done.filter("kind > 0"), False).withColumnRenamed("conv_id", "_id")
    short = done.filter("kind = 0")
    joined = short.join(long, ~F.col("held") & F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    return joined.select("conv_id", *_COUNTS, "audit", F.coalesce("sha256", "long_sha256").alias("repaired_sha256"))


def repaired_turns(rows: DataFrame, absent: str | None = None, held_bytes: int = HELD_BYTES) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` (from 0), ``role``, ``text``."""
    done = cut_lineage(_aligned(rows, absent, held_bytes, True))
    short = done.filter("kind = 0").select("conv_id", F.posexplode("turns").alias("place", "turn"))
    plain = short.select("conv_id", F.col("place").cast("long").alias("place"), "turn.role", "turn.text")
    return plain.unionByName(_streamed(done.filter("kind > 0"), True))


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``dropped``: turns spoilt by the CRC-32 of ``conv_id:turn`` modulo 20; nulls are one space.

    0 drops a turn, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 gives it to the user.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    plain = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_x"))
    x = F.col("_x")
    text = F.when(x == 1, "").when(x == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    spoilt = plain.select("conv_id", "turn", F.when(x == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (x == 0).alias("dropped"), "_x")
    times = F.when(x == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return spoilt.withColumn("_time", F.explode(times)).drop("_x", "_time")
