"""SentencePiece encoding and decoding with the N best segmentations of a text.

A text (with one leading space, as the model expects) is a lattice: an edge for every piece of the model that occurs at a
place, weighted by the piece's score; spaces match U+2581. A character that no piece matches is an edge of its UTF-8 byte
pieces, at a price below all pieces, and so is a literal U+2581, so decoding gives every text back exactly.

No piece of the model runs from another character into a space (checked on loading), so the lattice falls apart into
chunks, a run of spaces with what follows it, and the best path of a text is the best path of its chunks. The chunks that
a task has not met yet (it remembers a bounded number) are solved side by side: forward Viterbi scores place by place over all of them, and backward ones that
tell how far the second best segmentation of a chunk lies behind. The N best segmentations of a text can only deviate in
the N - 1 chunks with the smallest such gaps. For these, A* runs backward from the end of the chunk: a partial path to
place ``i`` is ranked by its score plus the forward Viterbi score of ``i``, which is exact, so complete paths come out best
first.

Defined cases: a null text has null ids, an empty text none; among equal scores the path with the longer last piece, then the
earlier chunk, comes first; rows that repeat an id are encoded each for itself; an empty table gives an empty result; other
columns are carried along, but for one named ``pieces``, which the result replaces.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from audience_engine.llm.common import utf8

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 3
SPACE = "▁"
FALLBACK = 10.0
MAX_MODEL_BYTES = 16 * 1024 * 1024
_CELLS = 1 << 20
_LOW = -1e18
_ROWS = 512
_KNOWN = 1 << 16
_IDS = 1 << 18


def model_bytes(path: str = MODEL) -> bytes:
    with open(path, "rb") as file:
        data = file.read()
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError("the model is too large to send to every task")
    return data


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ``sizes`` consecutive values from each of ``first``."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - first, sizes)


class Lattice:
    """The pieces of one model."""

    def __init__(self, proto: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        plain = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i).replace(SPACE, " "): i for i in plain}
        if any(" " in piece.lstrip(" ") for piece in self.ids):
            raise ValueError("a piece runs from another character into a space")
        self.score = np.array([model.get_score(i) for i in range(model.get_piece_size())], np.float64)
        self.longest = max(map(len, self.ids))
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # below every piece that holds a letter (the model keeps runs of spaces out by scores that are far lower still)
        self.fallback = float(self.score[[i for piece, i in self.ids.items() if piece.strip(" ")]].min()) - FALLBACK
        self.texts = {i: piece.encode() for piece, i in self.ids.items()} | {i: bytes([b]) for b, i in enumerate(self.bytes)}
        # by id, and once more without the first byte, for the start of a text
        plain = [self.texts.get(i) for i in range(model.get_piece_size())]
        self.by_id = pa.array([*plain, *(p and p[1:] for p in plain)], pa.large_binary())
        letters = {c for piece in self.ids for c in piece}
        breaks = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in letters)
        self.chunks = re.compile(f" *[^ {breaks}]+| +|[{breaks}]" if breaks else " *[^ ]+| +").findall
        # the prefixes of all pieces by hash, sorted; a prefix that is a piece has its id
        prefixes: dict[str, int] = {}
        for piece, i in self.ids.items():
            for n in range(1, len(piece)):
                prefixes.setdefault(piece[:n], -1)
            prefixes[piece] = i
        keys = np.array([self._hash(p) for p in prefixes], np.uint64)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], np.fromiter(prefixes.values(), np.int64, len(prefixes))[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two prefixes have one hash")
        self.known: defaultdict[str, int] = defaultdict()  # chunks, numbered as they come
        self.known.default_factory = self.known.__len__
        # the place of a key by its first bits; of several keys with the same ones, the last
        self.place = np.full(1 << 22, -1, np.int32)
        self.place[(self.keys >> np.uint64(42)).astype(np.int64)] = np.arange(len(self.keys))
        self.forget()

    def forget(self) -> None:
        """Drops the solved chunks."""
        self.known.clear()
        self.met: list[str] = []
        self.solved = (np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0), np.empty(0))

    @staticmethod
    def _step(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
        h = (h ^ codes) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(32))

    def _hash(self, piece: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = self._step(h, np.array([ord(c)], np.uint64))
        return int((h * np.uint64(0xC2B2AE3D27D4EB4F))[0])

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which hashes are prefixes, their piece or -1)."""
        h = h * np.uint64(0xC2B2AE3D27D4EB4F)
        at = self.place[(h >> np.uint64(42)).astype(np.int64)]
        hit = np.flatnonzero(at >= 0)
        at, h = at[hit], h[hit]
        exact = self.keys[at] == h
        while not exact.all():  # keys are sorted, so the others with the same first bits stand right before
            at = np.where(exact, at, at - 1)
            alive = exact | ((at >= 0) & (self.keys[at] >> np.uint64(42) == h >> np.uint64(42)))
            hit, at, h = hit[alive], at[alive], h[alive]
            exact = self.keys[at] == h
        return hit, self.values[at]

    def edges(self, chunk: str) -> list[tuple[int, int, int, float]]:
        """(start, stop, piece, score) of one chunk; a fallback character has piece -1."""
        out = []
        for i in range(len(chunk)):
            single = False
            for j in range(i + 1, min(len(chunk), i + self.longest) + 1):
                piece = self.ids.get(chunk[i:j])
                if piece is not None:
                    out.append((i, j, piece, float(self.score[piece])))
                    single |= j == i + 1
            if not single:
                out.append((i, i + 1, -1, self.fallback))
        return out

    def spelled(self, chunk: str, i: int, j: int, piece: int) -> list[int]:
        return [piece] if piece >= 0 else [self.bytes[b] for b in chunk[i:j].encode()]

    def paths(self, chunk: str) -> Iterator[tuple[float, list[int]]]:
        """All segmentations of a chunk, best first."""
        ending: list[list] = [[] for _ in range(len(chunk) + 1)]
        for edge in self.edges(chunk):
            ending[edge[1]].append(edge)
        ahead = [0.0] + [_LOW] * len(chunk)  # forward Viterbi
        for j in range(1, len(chunk) + 1):
            ahead[j] = max(ahead[i] + score for i, _, _, score in ending[j])
        turn = count()
        heap = [(-ahead[-1], len(chunk), next(turn), 0.0, None)]
        while heap:  # among equals, what is nearest to the start: ties then cost one path each
            _, at, _, behind, path = heapq.heappop(heap)
            if at == 0:
                pieces = []
                while path:
                    pieces += self.spelled(chunk, *path[0])
                    path = path[1]
                yield behind, pieces
                continue
            for i, j, piece, score in ending[at]:
                total = behind + score
                heapq.heappush(heap, (-(total + ahead[i]), i, next(turn), total, ((i, j, piece), path)))

    def solve(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids one after the other, ids of each chunk, best score, gap to the second best) of distinct chunks."""
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order = np.argsort(lengths, kind="stable")
        sizes, score, gap = np.empty(len(chunks), np.int64), np.empty(len(chunks)), np.empty(len(chunks))
        parts, at = [], 0
        while at < len(order):
            room = max(1, _CELLS // (self.longest * (int(lengths[order[at]]) + 1)))
            block = order[at : at + room]
            fits = (lengths[block] + 1) * (np.arange(len(block)) + 1) * self.longest <= _CELLS
            block = block[: max(1, int(np.argmin(fits)) if not fits.all() else len(block))]
            ids, sizes[block], score[block], gap[block] = self._solve_block([chunks[k] for k in block.tolist()])
            parts.append(ids)
            at += len(block)
        flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
        # from the order of lengths back to the chunks' own
        first = np.empty(len(chunks), np.int64)
        first[order] = np.cumsum(sizes[order]) - sizes[order]
        return flat[_ranges(first, sizes)], sizes, score, gap

    def _solve_block(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        width, lengths = len(chunks), np.fromiter(map(len, chunks), np.int64, len(chunks))
        longest = int(lengths.max())
        codes = np.zeros((longest, width), np.uint64)
        codes.T[np.arange(longest) < lengths[:, None]] = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)
        steps = min(self.longest, longest)
        ids = np.full((steps, longest, width), -1, np.int32)  # by length, start and chunk
        place, chunk = np.nonzero(codes)
        h = np.zeros(len(place), np.uint64)
        for n in range(steps):
            inside = place + n < lengths[chunk]
            place, chunk, h = place[inside], chunk[inside], h[inside]
            h = self._step(h, codes[place + n, chunk])
            hit, piece = self.find(h)
            place, chunk, h = place[hit], chunk[hit], h[hit]
            ids[n][place, chunk] = piece
            if not len(place):
                steps = n + 1
                break
        ids = ids[:steps]
        weight = np.where(ids >= 0, self.score[ids], _LOW)
        weight[0][ids[0] < 0] = self.fallback
        ahead = np.full((longest + 1, width), _LOW)
        ahead[0] = 0
        back = np.zeros((longest + 1, width), np.int16)
        for j in range(1, longest + 1):
            for n in range(min(steps, j)):
                total = ahead[j - 1 - n] + weight[n, j - 1 - n]
                better = total >= ahead[j]
                ahead[j][better] = total[better]
                back[j][better] = n + 1
        column = np.arange(width)
        best = ahead[lengths, column]
        behind = np.full((longest + 1, width), _LOW)
        behind[lengths, column] = 0
        for i in range(longest - 1, -1, -1):
            for n in range(min(steps, longest - i)):
                np.maximum(behind[i], behind[i + 1 + n] + weight[n, i], out=behind[i])
            behind[i][lengths == i] = 0
        taken = np.zeros((longest, width), np.int16)
        at, live = lengths.copy(), column
        pieces, owner = [], []
        while len(live):
            n = back[at[live], live].astype(np.int64)
            start = at[live] - n
            taken[start, live] = n
            piece = ids[n - 1, start, live].astype(np.int64)
            pieces.append(np.where(piece >= 0, piece, -2 - codes[start, live].astype(np.int64)))
            owner.append(live)
            at[live] = start
            live = live[start > 0]
        second = np.full(width, _LOW)
        for n in range(steps):
            rows = longest - n
            through = ahead[:rows] + weight[n, :rows] + behind[n + 1 : n + 1 + rows]
            through[taken[:rows] == n + 1] = _LOW
            np.maximum(second, through.max(axis=0), out=second)
        flat, whose = np.concatenate(pieces)[::-1], np.concatenate(owner)[::-1]
        turn = np.argsort(whose, kind="stable")
        flat, whose = flat[turn], whose[turn]
        if (flat < 0).any():
            spelled = [(x,) if x >= 0 else [self.bytes[b] for b in chr(-2 - x).encode()] for x in flat.tolist()]
            whose = np.repeat(whose, [len(x) for x in spelled])
            flat = np.array([i for x in spelled for i in x], np.int64)
        return flat.astype(np.int32), np.bincount(whose, minlength=width), best, np.where(second > _LOW / 2, best - second, np.inf)

    def encode(self, texts: list[str | None], n_best: int = N_BEST) -> list[tuple | None]:
        """(ids, score, alternatives) of each text; an alternative is (score, [(first piece, pieces replaced, new ids)])."""
        if len(self.known) > _KNOWN:
            self.forget()
        number = self.known.__getitem__
        rows = []
        for text in texts:
            own = self.chunks(" " + text) if text else []
            rows.append(np.fromiter(map(number, own), np.int64, len(own)))
        chunks = self.met
        chunks += islice(self.known, len(chunks), None)
        new = self.solve(chunks[len(self.solved[1]) :])
        self.solved = tuple(np.concatenate(pair) for pair in zip(self.solved, new, strict=True))
        ids, sizes, score, gap = self.solved
        first = np.cumsum(sizes) - sizes
        tried: dict[int, list] = {}
        out: list[tuple | None] = []
        for text, row in zip(texts, rows, strict=True):
            if text is None:
                out.append(None)
                continue
            n = sizes[row]
            starts = np.cumsum(n) - n
            total = float(score[row].sum())
            out.append((ids[_ranges(first[row], n)], total, self._alternatives(row, starts, (ids, first, sizes, score, gap), total, chunks, tried, n_best)))
        return out

    def _alternatives(self, row, starts, solved, total, chunks, tried, n_best: int) -> list[tuple]:
        ids, first, sizes, score, gap = solved
        if n_best < 2 or not len(row):
            return []
        gaps = gap[row]
        if len(row) > 4 * n_best:  # all that are as near as the (n - 1)-th nearest, then the earliest of them
            limit = np.partition(gaps, n_best - 2)[n_best - 2]
            near = np.flatnonzero(gaps <= limit)
        else:
            near = np.arange(len(row))
        near = near[np.argsort(gaps[near], kind="stable")][: n_best - 1]
        near = np.sort(near[np.isfinite(gaps[near])])
        ways = [(0.0, [])]
        for k in near.tolist():
            c = int(row[k])
            if c not in tried:
                viterbi = ids[first[c] : first[c] + sizes[c]].tolist()
                others = [(s, p) for s, p in islice(self.paths(chunks[c]), n_best) if p != viterbi]
                tried[c] = [(float(score[c]), viterbi), *others[: n_best - 1]]
            best = tried[c][0][0]
            ways = sorted(
                ((loss + best - s, [*swaps, (k, p)] if i else swaps) for loss, swaps in ways for i, (s, p) in enumerate(tried[c])), key=lambda w: w[0]
            )[:n_best]
        return [(total - loss, [(int(starts[k]), int(sizes[row[k]]), p) for k, p in swaps]) for loss, swaps in ways[1:]]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.texts.__getitem__, ids))[1:]

    def decode_lists(self, ids: np.ndarray, sizes: np.ndarray) -> pa.LargeBinaryArray:
        """What ``decode`` gives for each of the id lists that stand one after the other, about ``_IDS`` ids at a time."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.by_id) // 2):
            raise KeyError("an id that the model does not hold")
        ends = np.concatenate([[0], np.cumsum(sizes)])
        starts = ends[:-1][np.diff(ends) > 0]
        ids = ids.astype(np.int32)
        ids[starts] += len(self.by_id) // 2
        parts, first = [], 0
        while first < len(sizes):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + _IDS, "right")) - 1)
            taken = self.by_id.take(pa.array(ids[ends[first] : ends[last]]))  # their bytes stand side by side
            if taken.null_count:
                raise KeyError("an id without a text")
            _, places, data = taken.buffers()
            places = np.frombuffer(places, np.int64) if len(taken) else np.zeros(1, np.int64)
            places = pa.py_buffer(places[ends[first : last + 1] - ends[first]])
            parts.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), last - first, [None, places, data or pa.py_buffer(b"")]))
            first = last
        return pa.concat_arrays(parts) if parts else pa.array([], pa.large_binary())


@lru_cache(maxsize=2)
def lattice(proto: bytes) -> Lattice:
    return Lattice(proto)


_ALTERNATIVES = pa.list_(
    pa.struct(
        [
            ("score", pa.float64()),
            ("swaps", pa.list_(pa.struct([("first", pa.int32()), ("replaced", pa.int32()), ("ids", pa.list_(pa.int32()))]))),
        ]
    )
)
_ALTERNATIVES_SQL = T.ArrayType(
    T.StructType()
    .add("score", "double")
    .add("swaps", T.ArrayType(T.StructType().add("first", "integer").add("replaced", "integer").add("ids", T.ArrayType(T.IntegerType()))))
)


def _swapped(ids: np.ndarray, swaps) -> np.ndarray:
    parts, at = [], 0
    for first, replaced, new in sorted(swaps, key=lambda s: s[0]):
        parts += [ids[at:first], np.array(new, np.int32)]
        at = first + replaced
    return np.concatenate([*parts, ids[at:]])


def swapped(ids, swaps) -> list[int]:
    """The whole segmentation of an alternative."""
    return _swapped(np.asarray(ids, np.int32), swaps).tolist()


def _whole_lists(done: list[tuple | None]) -> pa.ListArray:
    """The ids of the best segmentation of each text and the whole ids of its alternatives; null for a null text."""
    lists = [None if d is None else [d[0], *(_swapped(d[0], swaps) for _, swaps in d[2])] for d in done]
    flat = _ragged([own for row in lists if row is not None for own in row], pa.int32())
    ends = np.concatenate([[0], np.cumsum([0 if row is None else len(row) for row in lists])])
    missing = np.append([row is None for row in lists], False)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32(), mask=missing), flat)


def _ragged(parts: list, kind: pa.DataType) -> pa.Array:
    lengths = [-1 if p is None else len(p) for p in parts]
    flat = np.concatenate([p for p in parts if p is not None]) if any(n > 0 for n in lengths) else np.empty(0, np.int32)
    ends = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])
    offsets = pa.array(ends, pa.int32(), mask=np.append(np.array(lengths) < 0, False)) if lengths else pa.array([0], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(flat, kind))


def encode(
    docs: DataFrame,
    model: str = MODEL,
    n_best: int = N_BEST,
    text: str = "text",
    carry: tuple[str, ...] | None = None,
    check: bool = False,
    whole: bool = False,
) -> DataFrame:
    """``docs`` plus ``pieces``: ``ids``, ``score`` and ``alternatives`` (the next best segmentations, as swaps in ``ids``).

    ``carry`` names the columns to return, if not all of them. ``check`` decodes each id list in the same task and adds to
    ``pieces`` whether it gives the text back (``round_trip``; null ids give a null text). ``whole`` adds ``n_best``, the
    whole id lists of all of them, the best first (null for a null text).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model_bytes(model))
    names = docs.columns
    place = names.index(text)
    out = T.StructType().add("ids", T.ArrayType(T.IntegerType())).add("score", "double").add("alternatives", _ALTERNATIVES_SQL)
    if check:
        out = out.add("round_trip", "boolean")
    if whole:
        out = out.add("n_best", T.ArrayType(T.ArrayType(T.IntegerType())))
    kept = [i for i, n in enumerate(names) if n.lower() != "pieces" and (carry is None or n in carry)]
    schema = T.StructType([*(T.StructField(f"c{i}", docs.schema[i].dataType) for i in kept), T.StructField("pieces", out)])

    def run(batches):
        own = lattice(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                given = utf8(part.column(place))
                done = own.encode([None if t is None else t.decode("utf-8", "replace") for t in given], n_best)
                ids = _ragged([None if d is None else d[0] for d in done], pa.int32())
                score = pa.array([None if d is None else d[1] for d in done], pa.float64())
                ways = [
                    None if d is None else [{"score": s, "swaps": [{"first": f, "replaced": r, "ids": p} for f, r, p in w]} for s, w in d[2]] for d in done
                ]
                columns = {"ids": ids, "score": score, "alternatives": pa.array(ways, _ALTERNATIVES)}
                if check:
                    back = own.decode_lists(ids.values.to_numpy(), np.array([0 if d is None else len(d[0]) for d in done], np.int64))
                    same = pc.equal(back, part.column(place).cast(pa.large_binary()))
                    columns["round_trip"] = same.fill_null(True)  # null texts have null ids
                if whole:
                    columns["n_best"] = _whole_lists(done)
                pieces = pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), pieces], names=schema.names)

    result = docs.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(run, schema)
    return result.select(*[result[f"c{i}"].alias(names[i]) for i in kept], "pieces")


def decode(coded: DataFrame, ids: str, model: str = MODEL, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` and ``decoded``, the text of the id lists in the column ``ids`` (an array of texts for an array of lists)."""
    shared = coded.sparkSession.sparkContext.broadcast(model_bytes(model))
    plain = coded.select(*carry, coded[ids].alias("_ids"))
    many = isinstance(plain.schema["_ids"].dataType.elementType, T.ArrayType)
    schema = T.StructType([*plain.schema.fields[:-1], T.StructField("decoded", T.ArrayType(T.StringType()) if many else T.StringType())])

    def texts_of(own: Lattice, column: pa.ListArray) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        texts = own.decode_lists(column.flatten().to_numpy(zero_copy_only=False), sizes).cast(pa.large_string()).cast(pa.string())
        return pc.if_else(column.is_valid(), texts, pa.scalar(None, pa.string())) if column.null_count else texts

    def run(batches):
        own = lattice(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                column = batch.column("_ids")
                if many:
                    lists = texts_of(own, column.flatten())
                    sizes = [0 if n is None else n for n in pc.list_value_length(column).to_pylist()]
                    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32(), mask=np.append(~np.asarray(column.is_valid()), False))
                    decoded = pa.ListArray.from_arrays(ends, lists)
                else:
                    decoded = texts_of(own, column)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], decoded], names=schema.names)

    return plain.mapInArrow(run, schema)
