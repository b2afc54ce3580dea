"""Benchmark decontamination: an FM-index for every shard of the corpus, searched backward for the benchmark's windows.

A shard is what one task reads until it holds ``SHARD_WORDS`` words. Its words are numbered, one separator ends each text, and
the suffixes are sorted by prefix doubling. The word before each suffix (the Burrows-Wheeler transform) goes into a wavelet
matrix: one row of bits per binary digit of a word's number, with counts of ones per 64 bits, so that the occurrences of a word
before any place are counted in one step per digit. Every ``RATE``-th place of a text is kept as a sampled suffix position.
The index holds all words of all texts and does not depend on a benchmark; it is written once to the shared folder.

A benchmark item is cut into windows of ``WINDOW`` words; an item of fewer words is one window. All windows are searched
backward side by side, last word first; a window whose range of suffixes is empty is done. The suffixes of the ranges that
are left are walked back to the next sample, which gives their places. Overlapping places grow together into the spans
that are to be removed.

The windows go to the tasks as a broadcast of at most about ``BLOCK_BYTES``; a larger benchmark is searched in blocks, one after the other,
over the same index. Documents are not shuffled; what is found is one small row per document and block. A text of more words than
a shard holds is cut into pieces that overlap by ``WINDOW - 1`` words, so it takes no more memory than others.

Words are maximal runs of 0-9, a-z (A-Z is lower-cased) and all characters from U+0080 on. Defined cases: a null text has no words,
and an item without words has no window; rows that repeat a document id are documents of their own; items that repeat an id
are one item with all their windows, and those with a null id mark words but are not listed; an empty table of documents
or items gives an empty result or no hits; other columns are ignored (``find``) or carried along (``clean``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audience_engine.llm.common import id_key, row_key, utf8
from audience_engine.session import cut_lineage

WINDOW = 10
PLACE_BITS = 20
SHARD_WORDS = (1 << PLACE_BITS) - 1
RATE = 8
BLOCK_BYTES = 32 * 1024 * 1024
LOCATED = 1 << 17
_U = np.uint64
_BELOW = (_U(1) << np.arange(64, dtype=_U)) - _U(1)
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


class Numbers(dict):
    """Word to its number, from 1 on, as they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1
        return number


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The places of ``symbols`` in the order of their suffixes; 0 is a separator, and no two separators are equal.

    Prefix doubling: suffixes that agree in their first ``h`` symbols are told apart by the rank of what follows; those
    that stand alone are left as they are.
    """
    n, bits = len(symbols), _U(PLACE_BITS)
    low = (_U(1) << bits) - _U(1)
    ends = symbols == 0
    rank = np.where(ends, np.cumsum(ends) - 1, symbols + int(ends.sum())).astype(_U)
    places = np.arange(n, dtype=_U)
    order, slots, h = np.empty(n, np.int64), np.arange(n), 1
    while len(places):
        after = np.zeros(len(places), _U)
        inside = places + _U(h) < n
        after[inside] = rank[places[inside] + _U(h)]
        packed = np.sort((rank[places] << (bits + bits)) | (after << bits) | places)
        places = packed & low
        packed >>= bits
        head = np.concatenate([[True], packed[1:] != packed[:-1]])
        order[slots] = places
        starts = np.flatnonzero(head)
        sizes = np.diff(np.append(starts, len(places)))
        rank[places] = np.repeat(slots[starts], sizes).astype(_U)
        rest = np.repeat(sizes > 1, sizes)
        places, slots, h = places[rest], slots[rest], h * 2
    return order


class Bits:
    """A row of bits with the ones before each word of 64."""

    def __init__(self, words: np.ndarray):
        self.words = words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @classmethod
    def of(cls, flags: np.ndarray) -> Bits:
        return cls(np.packbits(np.pad(flags, (0, 64 - len(flags) % 64)), bitorder="little").view(_U))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many ones stand before each place."""
        word = at >> 6
        return self.before[word] + np.bitwise_count(self.words[word] & _BELOW[at & 63])

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(_U)) & _U(1)).astype(bool)


class Index:
    """The FM-index of a sequence of word numbers: wavelet matrix, first places by word, sampled positions."""

    def __init__(self, levels: list[Bits], zeros: list[int], first: np.ndarray, base: np.ndarray, sampled: Bits, positions: np.ndarray):
        self.levels, self.zeros, self.first, self.base, self.sampled, self.positions = levels, zeros, first, base, sampled, positions

    @classmethod
    def build(cls, symbols: np.ndarray, starts: np.ndarray, rate: int = RATE) -> Index:
        """``starts`` are the places where texts begin."""
        n, top = len(symbols), int(symbols.max(initial=0))
        order = suffix_array(symbols)
        first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))])
        rest, levels, zeros = symbols[order - 1], [], []
        for digit in reversed(range(max(1, top.bit_length()))):
            ones = (rest >> digit) & 1 == 1
            levels.append(Bits.of(ones))
            rest = np.concatenate([rest[~ones], rest[ones]])
            zeros.append(n - int(ones.sum()))
        heads = np.flatnonzero(np.concatenate([[True], rest[1:] != rest[:-1]]))
        base = np.zeros(top + 1, np.int64)
        base[rest[heads]] = heads
        offset = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        keep = (offset % rate == 0)[order]
        return cls(levels, zeros, first, base, Bits.of(keep), order[keep])

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places below the matrix of the occurrences of ``symbols`` before ``at``."""
        for digit, bits, zeros in zip(reversed(range(len(self.levels))), self.levels, self.zeros, strict=True):
            ones = bits.rank(at)
            at = np.where((symbols >> digit) & 1 == 1, zeros + ones, at - ones)
        return at

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, low, high): the suffixes that begin with each row of ``windows``; rows that occur nowhere are left out."""
        alive = np.arange(len(windows))
        last = windows[:, -1]
        low, high = self.first[last], self.first[last + 1]
        for column in reversed(range(windows.shape[1] - 1)):
            if not len(alive):
                break
            symbols = windows[alive, column]
            both = self._down(np.concatenate([symbols, symbols]), np.concatenate([low, high])) + np.tile(self.first[symbols] - self.base[symbols], 2)
            low, high = both[: len(alive)], both[len(alive) :]
            some = high > low
            alive, low, high = alive[some], low[some], high[some]
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places of the suffixes ``rows`` of the sorted order."""
        out, todo, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(todo):
            known = self.sampled.get(rows)
            out[todo[known]] = self.positions[self.sampled.rank(rows[known])] + steps
            todo, at = todo[~known], rows[~known]
            symbols = np.zeros(len(at), np.int64)
            for bits, zeros in zip(self.levels, self.zeros, strict=True):
                one, ones = bits.get(at), bits.rank(at)
                at = np.where(one, zeros + ones, at - ones)
                symbols = symbols * 2 + one
            rows, steps = at - self.base[symbols] + self.first[symbols], steps + 1
        return out

    def packed(self) -> dict[str, bytes]:
        return {
            "levels": np.concatenate([b.words for b in self.levels]).tobytes(),
            "first": self.first.astype(np.int32).tobytes(),
            "base": self.base.astype(np.int32).tobytes(),
            "sampled": self.sampled.words.tobytes(),
            "positions": self.positions.astype(np.int32).tobytes(),
        }

    @classmethod
    def unpacked(cls, row: dict[str, bytes]) -> Index:
        first, base = (np.frombuffer(row[c], np.int32).astype(np.int64) for c in ("first", "base"))
        n = int(first[-1])
        rows = np.frombuffer(row["levels"], _U).reshape(-1, n // 64 + 1)
        levels = [Bits(r) for r in rows]
        zeros = [n - int(b.rank(np.array([n]))[0]) for b in levels]
        return cls(levels, zeros, first, base, Bits(np.frombuffer(row["sampled"], _U)), np.frombuffer(row["positions"], np.int32).astype(np.int64))


_PARTS = ("levels", "first", "base", "sampled", "positions", "vocabulary", "starts", "offsets", "texts")


class _Shard:
    """Texts gathered for one index."""

    def __init__(self):
        self.numbers = Numbers()
        self.symbols: list[np.ndarray] = []
        self.n = 0
        self.starts, self.offsets, self.texts = [], [], []  # of the pieces: place, first word, text
        self.rows, self.ids, self.sizes = [], [], []  # of the texts

    def add(self, words: list[bytes], row: int, doc_id, size: int, offset: int) -> None:
        if not self.rows or self.rows[-1] != row:
            self.rows.append(row)
            self.ids.append(doc_id)
            self.sizes.append(size)
        if words:
            self.starts.append(self.n)
            self.offsets.append(offset)
            self.texts.append(len(self.rows) - 1)
            symbols = np.zeros(len(words) + 1, np.int32)
            symbols[:-1] = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
            self.symbols.append(symbols)
            self.n += len(symbols)

    def packed(self) -> dict:
        symbols = np.concatenate(self.symbols).astype(np.int64) if self.symbols else np.zeros(1, np.int64)
        out = Index.build(symbols, np.array(self.starts or [0])).packed()
        out |= {c: np.array(getattr(self, c), np.int32).tobytes() for c in ("starts", "offsets", "texts")}
        return out | {"vocabulary": b" ".join(self.numbers), "rows": self.rows, "ids": self.ids, "sizes": self.sizes}


def build_index(docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per shard of ``docs`` (``doc_id``, ``text``): its FM-index, and the row number, id and size of each text.

    Row numbers come from the partition and the place in it, so write the table before it is read more than once.
    """
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField(c, T.BinaryType()) for c in _PARTS])
    schema = schema.add("rows", T.ArrayType(T.LongType())).add("ids", T.ArrayType(kind)).add("sizes", T.ArrayType(T.LongType()))

    def run(batches):
        shard, row, types = _Shard(), TaskContext.get().partitionId() << 36, None

        def batch() -> pa.RecordBatch:
            data = shard.packed()
            return pa.RecordBatch.from_arrays([pa.array([data[f.name]], f.type) for f in types], schema=types)

        for part in batches:
            types = pa.schema([*((c, pa.binary()) for c in _PARTS), ("rows", pa.list_(pa.int64())), ("ids", pa.list_(part.schema.field("doc_id").type)), ("sizes", pa.list_(pa.int64()))])
            for doc_id, text in zip(part.column("doc_id").to_pylist(), utf8(part.column("text")), strict=True):
                words, at = words_of(text), 0
                while True:
                    room = shard_words - shard.n - 1
                    if (len(words) - at > room and shard.n) or 8 * len(shard.rows) > shard_words:
                        yield batch()
                        shard = _Shard()
                        continue
                    piece = words[at : at + room]
                    shard.add(piece, row, doc_id, len(words), at)
                    if at + len(piece) >= len(words):
                        break
                    at += len(piece) - window + 1
                row += 1
        if shard.rows:
            yield batch()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item`` (the id as text) and ``window`` (its words, joined by one space), each pair once."""

    def run(batches):
        for batch in batches:
            ids, windows = [], []
            for item, text in zip(batch.column("item").to_pylist(), utf8(batch.column("text")), strict=True):
                words = words_of(text)
                own = {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))} if words else ()
                ids += [item] * len(own)
                windows += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(windows, pa.binary())], names=["item", "window"])

    return items.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(run, "item string, window binary").distinct()


class Windows:
    """Distinct windows with their items, as numbers of the benchmark's own words."""

    def __init__(self, pairs: list[tuple[str | None, bytes]]):
        number: dict[bytes, int] = {}
        self.items: list[list[str]] = []
        for item, window in pairs:
            at = number.setdefault(window, len(number))
            if at == len(self.items):
                self.items.append([])
            if item is not None:
                self.items[at].append(item)
        words = Numbers()
        by_length: dict[int, list[tuple[int, list[int]]]] = {}
        for window, at in number.items():
            own = [words[w] for w in window.split(b" ")]
            by_length.setdefault(len(own), []).append((at, own))
        self.words = list(words)
        self.by_length = {n: (np.array([at for at, _ in rows]), np.array([own for _, own in rows])) for n, rows in by_length.items()}

    def hits(self, index: Index, numbers: dict[bytes, int]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(place, window, length) of the occurrences, in parts of bounded size."""
        known = np.array([0, *(numbers.get(w, 0) for w in self.words)])
        for length, (at, own) in self.by_length.items():
            symbols = known[own]
            there = np.flatnonzero((symbols > 0).all(axis=1))
            found, low, high = index.search(symbols[there])
            windows, sizes = at[there[found]], high - low
            ends = np.cumsum(sizes)
            for start in range(0, int(ends[-1]) if len(ends) else 0, LOCATED):
                rows = np.arange(start, min(start + LOCATED, int(ends[-1])))
                of = np.searchsorted(ends, rows, "right")
                yield index.locate(low[of] + rows - (ends[of] - sizes[of])), windows[of], length


_FOUND = "row long, doc_id {}, n_words long, starts array<int>, stops array<int>, items array<string>"


def _merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching spans of one text grown together."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def _search(index: DataFrame, pairs: list, kind: str, everything: bool) -> DataFrame:
    """What a block of (item, window) pairs hits; with ``everything`` also a row for each text without hits."""
    shared = index.sparkSession.sparkContext.broadcast(pairs)

    def run(batches):
        windows = Windows(shared.value)
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in (*_PARTS, "rows", "sizes")}
                ids = batch.column("ids")[at].values
                starts, offsets, texts = (np.frombuffer(row[c], np.int32).astype(np.int64) for c in ("starts", "offsets", "texts"))
                spans: dict[int, list] = {}
                items: dict[int, set[str]] = {}
                if len(starts):
                    numbers = {w: i for i, w in enumerate(row["vocabulary"].split(b" "), 1)}
                    for places, hit, length in windows.hits(Index.unpacked(row), numbers):
                        piece = np.searchsorted(starts, places, "right") - 1
                        text, first = texts[piece], places - starts[piece] + offsets[piece]
                        order = np.argsort(text, kind="stable")
                        edges = np.flatnonzero(np.diff(text[order])) + 1
                        for own in np.split(order, edges):
                            t = int(text[own[0]])
                            spans.setdefault(t, []).append(_merged(first[own], first[own] + length))
                            items.setdefault(t, set()).update(i for w in np.unique(hit[own]).tolist() for i in windows.items[w])
                chosen = range(len(row["rows"])) if everything else sorted(spans)
                for low in range(0, len(chosen), 4096):
                    part = chosen[low : low + 4096]
                    merged = [_merged(*map(np.concatenate, zip(*spans[t], strict=True))) if t in spans else ((), ()) for t in part]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["rows"][t] for t in part], pa.int64()),
                            ids.take(pa.array(part, pa.int64())),
                            pa.array([row["sizes"][t] for t in part], pa.int64()),
                            pa.array([m[0] for m in merged], pa.list_(pa.int32())),
                            pa.array([m[1] for m in merged], pa.list_(pa.int32())),
                            pa.array([sorted(items.get(t, ())) for t in part], pa.list_(pa.string())),
                        ],
                        names=["row", "doc_id", "n_words", "starts", "stops", "items"],
                    )

    return index.mapInArrow(run, _FOUND.format(kind))


def _blocks(pairs: DataFrame, block_bytes: int) -> Iterator[list]:
    """All pairs, in blocks of about ``block_bytes`` that are even by hash; none if there are no pairs."""
    total = pairs.agg(F.sum(F.length("window") + F.length(F.coalesce("item", F.lit("")))).alias("n")).first()["n"] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        yield [tuple(r) for r in pairs.filter(F.pmod(F.xxhash64("item", "window"), F.lit(n)) == k).collect()]  # about block_bytes


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``items`` (ids as text, sorted) and ``spans`` (word places) of each row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    index = cut_lineage(build_index(docs, window, shard_words))
    found = None
    for block in _blocks(cut_lineage(item_windows(items, window)), block_bytes):
        part = _search(index, block, kind, found is None)
        found = part if found is None else cut_lineage(found).unionByName(cut_lineage(part))
    if found is None:
        found = _search(index, [], kind, True)
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "stops", "items")]  # of one text: a list per piece and block
    rows = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), *lists)
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])

    def run(batches):
        for batch in batches:
            n_hit, spans, listed = [], [], []
            for starts, stops, own in zip(*(batch.column(c) for c in ("starts", "stops", "items")), strict=True):
                a, b = (np.asarray(x.values).astype(np.int64) for x in (starts, stops))
                a, b = _merged(a, b) if len(a) else (a, b)
                n_hit.append(int((b - a).sum()))
                spans.append([{"start": int(x), "stop": int(y)} for x, y in zip(a, b, strict=True)])
                listed.append(sorted(set(own.as_py())))
            columns = [pa.array(n_hit, pa.int64()), pa.array(listed, pa.list_(pa.string())), pa.array(spans, pa.list_(span))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), *columns], names=["doc_id", "n_words", "n_hit", "items", "spans"])

    schema = f"doc_id {kind}, n_words long, n_hit long, items array<string>, spans array<struct<start: int, stop: int>>"
    return rows.drop("row").mapInArrow(run, schema)


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the characters from the first to the last word of each span."""
    edges = [m.span() for m in _WORD.finditer(text.translate(_TABLE))]
    kept, at = [], 0
    for start, stop in spans:
        kept.append(text[at : edges[start][0]])
        at = edges[stop - 1][1]
    return b"".join([*kept, text[at:]])


def clean(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """All rows and columns of ``docs`` with the spans cut out of ``text``."""
    names = docs.columns
    carried = [f"c{i}" for i in range(len(names))]
    plain = docs.toDF(*carried)
    column, doc_id = (f"c{names.index(c)}" for c in ("text", "doc_id"))
    key = F.struct(id_key(doc_id).alias("d"), row_key(column).alias("t")).alias("doc_id")
    found = find(plain.select(key, F.col(column).alias("text")), items, **settings).filter("n_hit > 0").groupBy("doc_id").agg(F.first("spans").alias("spans"))
    spans = found.select(F.col("doc_id.d").alias("_d"), F.col("doc_id.t").alias("_t"), "spans")
    joined = plain.withColumns({"_d": id_key(doc_id), "_t": row_key(column)}).join(spans, ["_d", "_t"], "left").select(*carried, "spans")

    def run(batches):
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            new = [t if not s else without_spans(t, [(x["start"], x["stop"]) for x in s]) for t, s in zip(utf8(batch.column(column)), spans, strict=True)]
            changed = pa.array(new, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([changed if c == column else batch.column(c) for c in carried], names=carried)

    return joined.mapInArrow(run, plain.schema).toDF(*names)

