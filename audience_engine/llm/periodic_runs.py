"""Periodic runs of words, found by online dyadic square catching.

Words are appended to a ``Catcher`` in portions of any size. At level ``k`` every completed block of ``2**k`` words keeps a
catcher, which watches the windows that end at the appended words: a window that equals the block ``q`` words before it,
with ``2**k <= q < 2**(k + 1)``, is a catch. Each window has one such block, so a level costs one comparison of hashes a
word, and windows of a level are two windows of the level below. The lowest level has blocks of ``LEAST`` words and also
watches the distances below that.

A catch is compared word by word to both sides. Words equal to those ``q`` before them make a stretch; ``q`` or more of them
are squares, all of one stretch, which merge into one run candidate. A stretch that reaches the last word stays open, and the
next appended words advance it. Shorter periods are handled first; a stretch inside a run whose period divides ``q`` is that
run again and is left.

No run is missed: a run of at least ``max(min_length, 3 * q)`` words has ``2 * q`` equal words or more in its stretch (16 or
more for the shortest), and ``2 * size - 1`` words hold a whole aligned block of ``size`` words. Words are numbered by an exact
table, hashes only propose, and what they propose is compared, so the result is exact.

Memory: a level keeps its last two blocks of hashes, all levels together about 40 bytes a word of the longest text, and a
text is split into words in slices. No shuffle: each text is handled where it is read.

Defined cases: a null text, and one without words, has no runs; rows that repeat an id are handled each for itself; a tie of
the greatest exponent goes to the smallest start, then the smallest period; an empty table gives an empty result; of other
columns those named in ``carry`` are returned.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audience_engine.llm.common import WORD, utf8

MIN_LENGTH = 24
MIN_EXPONENT = 3
LEVEL = 3
LEAST = 1 << LEVEL
SLICE = 1 << 20
PORTION = 1 << 16
_FACTORS = [np.uint64(pow(0x9E3779B97F4A7C15, 1 << k, 1 << 64)) for k in range(48)]  # windows of 2**k words: one polynomial
_GAP = re.compile(rb"[ \t\n\x0b\x0c\r]")


class _Level:
    """The hashes of the windows of ``2**k`` words from place ``first`` on; earlier ones are no longer needed."""

    def __init__(self):
        self.first = 0
        self.hashes = np.empty(0, np.uint64)

    def stop(self) -> int:
        return self.first + len(self.hashes)

    def add(self, new: np.ndarray, keep: int) -> None:
        rest = self.hashes[max(0, len(self.hashes) - keep) :]
        self.first = self.stop() - len(rest)
        self.hashes = np.concatenate([rest, new]) if len(rest) else new

    def at(self, start: int, stop: int) -> np.ndarray:
        return self.hashes[start - self.first : stop - self.first]


class Catcher:
    """Squares and runs of a growing sequence of word numbers."""

    def __init__(self, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT):
        self.least = (min_length, min_exponent)
        self.words = np.empty(0, np.int32)
        self.n = 0
        self.base = _Level()
        self.levels: list[_Level] = []
        self.open: dict[int, int] = {}  # period to start of a stretch that reaches the last word
        self.closed: dict[int, list[tuple[int, int]]] = {}  # period to (start, stop) of finished squares
        self.known: dict[int, int] = {}  # period to the end of its last compared stretch

    def append(self, numbers: np.ndarray) -> None:
        for at in range(0, len(numbers), PORTION):
            self._portion(numbers[at : at + PORTION])

    def _portion(self, new: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(new)
        if self.n > len(self.words):
            grown = np.empty(self.n if not old else max(self.n, 2 * len(self.words)), np.int32)
            grown[:old] = self.words[:old]
            self.words = grown
        self.words[old : self.n] = new
        for q, start in list(self.open.items()):
            stop = self._right(old, q)
            if stop < self.n:
                del self.open[q]
                self._finish(q, start, stop)
        self._hash(new)
        for k, level in enumerate(self.levels, LEVEL):
            first, stop = self.done[k - LEVEL], level.stop()
            for back in (0, 1) if k == LEVEL else (1,):
                start = max(first, back << k)
                if start < stop:
                    low = (start >> k) - back
                    blocks = level.hashes[(low << k) - level.first :: 1 << k][: ((stop - 1) >> k) - back - low + 1]
                    before = np.repeat(blocks, 1 << k)[start - ((start >> k) << k) :][: stop - start]
                    hit = np.flatnonzero(before == level.at(start, stop))
                    if len(hit):
                        places = hit + start
                        self._catch(places, places - (((places >> k) - back) << k))

    def _catch(self, places: np.ndarray, periods: np.ndarray) -> None:
        """Compares what was caught, by period, once for each stretch."""
        for p, start in self.open.items():
            new = (periods % p != 0) | (places - periods < start)
            places, periods = places[new], periods[new]
        if not len(places):
            return
        order = np.lexsort((places, periods))
        places, periods = places[order], periods[order]
        edges = [0, *(np.flatnonzero(np.diff(periods)) + 1).tolist(), len(periods)]
        for low, high in zip(edges, edges[1:], strict=False):
            q, own, at = int(periods[low]), places[low:high], 0
            while q and at < len(own) and q not in self.open:
                place = int(own[at])
                done = max(self.known.get(q, 0), self._inside(q, place))
                if place < done:
                    at = int(np.searchsorted(own, done))
                else:
                    self._compare(q, place)
                    at += 1

    def _hash(self, new: np.ndarray) -> None:
        """Hashes of the windows that the new words complete; ``done`` has each level's first new one."""
        lower = self.base
        lower.add(_spread(new), 4 * LEAST)
        self.done = []
        k = LEVEL
        while 2 << k <= self.n:  # from here on a window has a block before it
            if len(self.levels) <= k - LEVEL:
                self.levels.append(_Level())
            level, half = self.levels[k - LEVEL], (1 << k) >> 1
            first, stop = level.stop(), self.n - (1 << k) + 1
            self.done.append(first)
            if k == LEVEL:
                made = lower.at(first, self.n)
                for j in range(LEVEL):
                    made = made[: -(1 << j)] * _FACTORS[j] + made[1 << j :]
            else:
                made = lower.at(first, stop) * _FACTORS[k - 1] + lower.at(first + half, stop + half)
            level.add(made, 4 << k)
            lower = level
            k += 1

    def _inside(self, q: int, place: int) -> int:
        """The end of a stretch whose period divides ``q`` and that holds ``place`` and the words up to ``q`` before; 0: none."""
        for p, start in self.open.items():
            if q % p == 0 and start <= place - q:
                return self.n
        for p, found in self.closed.items():
            if q % p == 0 and (at := bisect_right(found, (place - q, self.n))) and found[at - 1][1] > place:
                return found[at - 1][1]
        return 0

    def _right(self, place: int, q: int) -> int:
        """The first place from ``place`` on whose word differs from the one ``q`` before."""
        step = 64
        while place < self.n:
            stop = min(self.n, place + step)
            differ = self.words[place:stop] != self.words[place - q : stop - q]
            if differ.any():
                return place + int(differ.argmax())
            place, step = stop, step * 2
        return self.n

    def _left(self, place: int, q: int) -> int:
        """The first place of the equal words that end before ``place``."""
        step = 64
        while place > q:
            start = max(q, place - step)
            differ = self.words[start:place] != self.words[start - q : place - q]
            if differ.any():
                return place - int(differ[::-1].argmax())
            place, step = start, step * 2
        return place

    def _compare(self, q: int, place: int) -> None:
        start, stop = self._left(place, q) - q, self._right(place, q)
        self.known[q] = stop
        if stop == self.n:
            self.open[q] = start
        else:
            self._finish(q, start, stop)

    def _finish(self, q: int, start: int, stop: int) -> None:
        self.known[q] = max(self.known.get(q, 0), stop)
        if stop - start >= 2 * q:
            self.closed.setdefault(q, []).append((start, stop))

    def squares(self) -> Iterator[tuple[int, int, int]]:
        """(start, stop, half) of the merged squares so far: all of a stretch as one."""
        for q, found in self.closed.items():
            yield from ((a, b, q) for a, b in found)
        yield from ((a, self.n, q) for q, a in self.open.items() if self.n - a >= 2 * q)

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs so far, by start and period."""
        length, exponent = self.least
        found: dict[tuple[int, int], int] = {}
        for a, b, q in sorted(self.squares(), key=lambda s: s[2]):
            if b - a >= max(length, exponent * q) and (a, b) not in found:  # equal ends: the smaller period divides the larger one
                found[a, b] = q
        return sorted((a, b - a, q) for (a, b), q in found.items())


def _spread(numbers: np.ndarray) -> np.ndarray:
    h = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def slices(text: bytes, size: int = 0) -> Iterator[bytes]:
    """Parts of about ``size`` (else ``SLICE``) bytes that end between words."""
    size = size or SLICE
    at = 0
    while len(text) - at > size:
        gap = _GAP.search(text, at + size)
        stop = gap.start() if gap else len(text)
        yield text[at:stop]
        at = stop
    yield text[at:] if at else text


def found_runs(text: bytes | None, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> tuple[int, list[tuple[int, int, int]]]:
    """(words, runs) of a text."""
    catcher = Catcher(min_length, min_exponent)
    number: dict[bytes, int] = {}
    for part in slices(text or b""):
        words = part.split()
        catcher.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
    return catcher.n, catcher.runs()


def repeats_of(runs: Iterable[tuple[int, int, int]], n: int) -> np.ndarray:
    """Which words a run contains after its first period."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:n]) > 0


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length by period, then the smallest start and period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def collapsed(text: bytes, gone: np.ndarray) -> Iterator[bytes]:
    """The words that stay, joined by one space, in parts."""
    at, lead = 0, b""
    for part in slices(text):
        words = part.split()
        kept = [w for w, g in zip(words, gone[at : at + len(words)].tolist(), strict=True) if not g]
        at += len(words)
        if kept:
            yield lead + b" ".join(kept)
            lead = b" "


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUNS_SQL = T.ArrayType(T.StructType().add("start", "long").add("length", "long").add("period", "long"))


def find(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, texts: bool = True) -> DataFrame:
    """``carry``, ``n_words``, ``runs`` (by start, then period), ``strongest``, ``collapsed_sha256`` and, with ``texts``, the ``collapsed`` text.

    A collapsed text keeps each run's first period of words.
    """
    if min_length < MIN_LENGTH or min_exponent < MIN_EXPONENT:
        raise ValueError("blocks of eight words catch runs of three periods and 24 words or more")
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], F.col("text").alias("_text"))
    schema = T.StructType([*plain.schema.fields[:-1], T.StructField("n_words", T.LongType()), T.StructField("runs", _RUNS_SQL)])
    schema = schema.add("strongest", _RUNS_SQL.elementType).add("collapsed_sha256", "string")
    if texts:
        schema = schema.add("collapsed", "string")

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                sizes, rows, best, digests, kept = [], [], [], [], []
                for text in utf8(batch.column("_text")):
                    n, runs = found_runs(text, min_length, min_exponent)
                    digest, parts = hashlib.sha256(), []
                    for part in collapsed(text or b"", repeats_of(runs, n)):
                        digest.update(part)
                        if texts:
                            parts.append(part)
                    sizes.append(n)
                    rows.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                    top = strongest(runs)
                    best.append(top and dict(zip(("start", "length", "period"), top, strict=True)))
                    digests.append(digest.hexdigest())
                    kept.append(b"".join(parts))
                columns = [pa.array(sizes, pa.int64()), pa.array(rows, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(digests, pa.string())]
                if texts:
                    columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=schema.names)

    found = plain.mapInArrow(run, schema)
    return found.select(*[found[f"c{i}"].alias(c) for i, c in enumerate(carry)], *schema.names[len(carry) :])


def looped(docs: DataFrame) -> DataFrame:
    """``docs`` whose text, for every tenth hash of the id, ends in a loop: words from place ``a`` on repeat with period ``p``.

    With ``h`` the CRC-32 of the decimal id, ``g = h // 10`` and ``n`` words, ``a = g % n`` and ``p = 1 + (n - a) // (3 + g % 8)``.
    A null id has no hash, so its text stays.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    chosen = docs.withColumn("_h", h).withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    n, g = F.size("_words"), F.floor(F.col("_h") / 10)
    placed = chosen.withColumn("_a", F.when(n > 0, g % n).cast("int")).withColumn("_p", (1 + F.floor((n - F.col("_a")) / (3 + g % 8))).cast("int"))

    def original(i: Column) -> Column:
        return F.when(i < F.col("_a"), i).otherwise(F.col("_a") + F.pmod(i - F.col("_a"), F.col("_p")))

    looping = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("_words", original(i)))
    text = F.when(F.col("_a").isNotNull(), F.array_join(looping, " ")).otherwise(F.col("text"))
    return placed.withColumn("text", text).drop("_h", "_words", "_a", "_p")
