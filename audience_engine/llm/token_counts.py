"""Token counts that follow edits: a segment tree over the pre-tokens of each document.

A text is cut into pre-tokens by the tokenizer's pattern and each is encoded by itself, so a text's tokens are the sum over
its pre-tokens. The leaves of a document's tree are blocks of ``BLOCK`` pre-tokens; every node holds the characters and the
tokens below it. An edit (characters ``start`` to ``stop`` become ``new``) goes down the tree by character sums to its first
block, cuts pre-tokens anew from a little before the edit (``CONTEXT`` characters, which is more than the pattern can look
ahead) until a cut falls on an old cut behind the edit, encodes only these, puts them into the first touched block, and
adds the differences to the sums above. The tree keeps its shape; all else stays as it was. While edits are applied the text
is held by blocks, so an edit copies the blocks that it touches and not the text: time grows with the edits, not with
edits times text.

Defined cases: a null text counts as empty (0 tokens); edits are applied in order, each to the text that the ones before it
left, and are cut to that text's ends; null edits are none; rows that repeat an id are counted each for itself; an empty
table gives an empty result; other columns are carried along, but for those that the result names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audience_engine.llm.common import utf8

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_RANK_BYTES = 16 * 1024 * 1024
# Fixed value: the pattern that belongs to the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 64
CONTEXT = 4
_KNOWN = 1 << 18
_FIND = regex.compile(PATTERN)

EDITS = T.ArrayType(T.StructType().add("start", "integer").add("stop", "integer").add("new", "string"))
TREE = T.StructType().add("chars", "binary").add("tokens", "binary").add("blocks", "binary")


def rank_bytes(path: str = RANKS) -> bytes:
    with open(path, "rb") as file:
        data = file.read()
    if len(data) > MAX_RANK_BYTES:
        raise ValueError("the rank file is too large to send to every task")
    return data


class Counter(dict):
    """Pre-token to its number of tokens; emptied when it holds too many, so its memory is bounded."""

    def __init__(self, ranks: bytes):
        super().__init__()
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})

    def __missing__(self, token: str) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        value = self[token] = len(self.encoding.encode_ordinary(token))
        return value


_COUNTERS: dict[bytes, Counter] = {}


def counter(ranks: bytes) -> Counter:
    key = hashlib.sha256(ranks).digest()
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(ranks)
    return _COUNTERS[key]


def leaves(text: str, count: Callable[[str], int]) -> tuple[np.ndarray, np.ndarray]:
    """(characters, tokens) of each pre-token."""
    tokens = _FIND.findall(text)
    n = len(tokens)
    return np.fromiter(map(len, tokens), np.int32, n), np.fromiter(map(count, tokens), np.int32, n)


class SegmentTree:
    """Sums of characters and tokens over blocks of pre-tokens."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray, blocks: np.ndarray | None = None):
        if blocks is None:
            blocks = np.full(-(-len(chars) // BLOCK) or 1, BLOCK, np.int32)
            blocks[-1] = len(chars) - BLOCK * (len(blocks) - 1)
        ends = np.cumsum(blocks)
        self.chars = [x.tolist() for x in np.split(chars, ends[:-1])]
        self.tokens = [x.tolist() for x in np.split(tokens, ends[:-1])]
        self.width = 1 << (len(blocks) - 1).bit_length()
        self.char_sums, self.token_sums = (self._sums(x, blocks) for x in (chars, tokens))

    def _sums(self, values: np.ndarray, blocks: np.ndarray) -> list[int]:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        ends = np.cumsum(blocks)
        level = np.zeros(self.width, np.int64)
        level[: len(blocks)] = total[ends] - total[ends - blocks]
        levels = [level]
        while len(level) > 1:
            level = level[0::2] + level[1::2]
            levels.append(level)
        return [0, *np.concatenate(levels[::-1]).tolist()]

    @property
    def n_tokens(self) -> int:
        return self.token_sums[1]

    @property
    def n_chars(self) -> int:
        return self.char_sums[1]

    def find(self, at: int) -> tuple[int, int]:
        """(block, its first character) of the character ``at``; the last block with characters for the text's end."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if at >= before + self.char_sums[node] and self.char_sums[node + 1]:
                before += self.char_sums[node]
                node += 1
        return node - self.width, before

    def _set(self, block: int, chars: list[int], tokens: list[int]) -> None:
        node = block + self.width
        more_chars, more_tokens = sum(chars) - self.char_sums[node], sum(tokens) - self.token_sums[node]
        self.chars[block], self.tokens[block] = chars, tokens
        while node:
            self.char_sums[node] += more_chars
            self.token_sums[node] += more_tokens
            node //= 2

    def edit(self, text: str, start: int, stop: int, new: str, count: Callable[[str], int]) -> tuple[str, int]:
        """The text after the edit and how many pre-tokens were encoded anew."""
        self.hold(text)
        fresh = self.replace(start, stop, new, count)
        return self.text, fresh

    def hold(self, text: str) -> None:
        """Take the text in, cut by blocks, so that ``replace`` copies only the blocks it touches."""
        self.texts, at = [], 0
        for block in range(len(self.chars)):
            size = self.char_sums[block + self.width]
            self.texts.append(text[at : at + size])
            at += size

    @property
    def text(self) -> str:
        return "".join(self.texts)

    def replace(self, start: int, stop: int, new: str, count: Callable[[str], int]) -> int:
        """Edit the text that is held; how many pre-tokens were encoded anew."""
        start = min(max(start, 0), self.n_chars)
        stop = min(max(stop, start), self.n_chars)
        shift = len(new) - (stop - start)
        first, base = self.find(max(0, start - CONTEXT - 1))
        at, keep = self._kept(first, base, start)
        if keep == 0 and first and at + CONTEXT > start:  # the cut before the edit lies in an earlier block
            first, base = self._back(first, base, start)
            at, keep = self._kept(first, base, start)
        upto, more = max(first, self.find(max(0, stop - 1))[0]) + 1, 1
        while (cut := self._cut(first, base, at, keep, upto, start, stop, new, count)) is None:
            upto, more = upto + more, more * 2  # no old cut was met in these blocks
        window, end, new_chars, new_tokens, block, place = cut
        tail = (self.chars[block][place:], self.tokens[block][place:]) if block < len(self.chars) else ([], [])
        rest = self.texts[block][sum(self.chars[block][:place]) :] if block < len(self.chars) else ""
        kept = self.chars[first][:keep], self.tokens[first][:keep]
        if block == first:
            self._set(first, kept[0] + new_chars + tail[0], kept[1] + new_tokens + tail[1])
            self.texts[first] = window[:end] + rest
        else:
            self._set(first, kept[0] + new_chars, kept[1] + new_tokens)
            self.texts[first] = window[:end]
            for gone in range(first + 1, min(block, len(self.chars))):
                self._set(gone, [], [])
                self.texts[gone] = ""
            if block < len(self.chars):
                self._set(block, *tail)
                self.texts[block] = rest
        return len(new_chars)

    def _kept(self, block: int, at: int, start: int) -> tuple[int, int]:
        """The last cut of the block far enough before ``start``: its character, and the pre-tokens before it."""
        keep = 0
        while keep < len(self.chars[block]) and at + self.chars[block][keep] + CONTEXT <= start:
            at += self.chars[block][keep]
            keep += 1
        return at, keep

    def _cut(self, first: int, base: int, at: int, keep: int, upto: int, start: int, stop: int, new: str, count: Callable[[str], int]):
        """Cut pre-tokens from ``at`` to an old cut behind the edit, inside the blocks ``first`` to ``upto``.

        Returns the blocks' text after the edit, where in it the cutting ended, the new characters and tokens, and the old
        block and place of that cut; None if a pre-token comes so near the end of the blocks that what follows may change it.
        """
        whole = upto >= len(self.chars)
        before = "".join(self.texts[first:upto])
        window = before[: start - base] + new + before[stop - base :]
        shift = len(new) - (stop - start)
        chars, tokens = [], []
        block, place, old = first, keep, at  # the old cut that is looked at
        for match in _FIND.finditer(window, at - base):
            here = base + match.start()
            if here >= stop + shift:
                while block < len(self.chars) and old < here - shift:
                    if place < len(self.chars[block]):
                        old += self.chars[block][place]
                        place += 1
                    else:
                        block, place = block + 1, 0
                if old == here - shift:
                    return window, match.start(), chars, tokens, block, place
            if not whole and match.end() + CONTEXT > len(window):
                return None
            chars.append(len(match[0]))
            tokens.append(count(match[0]))
        return (window, len(window), chars, tokens, len(self.chars), 0) if whole else None

    def _back(self, block: int, at: int, start: int) -> tuple[int, int]:
        """The nearest earlier block that has a cut far enough before ``start``, or the first block."""
        while block and at + CONTEXT > start:
            block -= 1
            at -= self.char_sums[block + self.width]
        return block, at

    def packed(self) -> dict[str, bytes]:
        flat = [np.fromiter((v for part in parts for v in part), np.int32) for parts in (self.chars, self.tokens)]
        return {"chars": flat[0].tobytes(), "tokens": flat[1].tobytes(), "blocks": np.fromiter(map(len, self.chars), np.int32).tobytes()}

    @classmethod
    def unpacked(cls, tree: dict[str, bytes]) -> SegmentTree:
        return cls(*(np.frombuffer(tree[k], np.int32) for k in ("chars", "tokens", "blocks")))


def _edited(text: str, tree: SegmentTree, edits: list[dict], count: Callable[[str], int]) -> tuple[str, int]:
    """The text after all edits, which the tree follows, and how many pre-tokens were encoded anew."""
    tree.hold(text)
    encoded = sum(tree.replace(e["start"] or 0, e["stop"] or 0, e["new"] or "", count) for e in edits)
    return tree.text, encoded


def _carried(docs: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])


def build(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``docs`` plus ``n_tokens``, ``n_pretokens`` and ``tree``, the leaves of each text's tree."""
    shared = docs.sparkSession.sparkContext.broadcast(rank_bytes(ranks))
    plain = _carried(docs, ("n_tokens", "n_pretokens", "tree"))
    schema = T.StructType([*plain.schema.fields, *T.StructType().add("n_tokens", "long").add("n_pretokens", "long").add("tree", TREE)])
    place = plain.columns.index("text")

    def run(batches):
        count = counter(shared.value).__getitem__
        for batch in batches:
            found = [leaves((t or b"").decode("utf-8", "replace"), count) for t in utf8(batch.column(place))]
            whole = [np.append(np.full(len(c) // BLOCK, BLOCK, np.int32), np.int32(len(c) % BLOCK))[: -(-len(c) // BLOCK) or 1] for c, _ in found]
            parts = [pa.array([c.tobytes() for c, _ in found], pa.binary()), pa.array([t.tobytes() for _, t in found], pa.binary()), pa.array([b.tobytes() for b in whole], pa.binary())]
            tree = pa.StructArray.from_arrays(parts, names=TREE.names)
            sums = [pa.array([int(t.sum()) for _, t in found], pa.int64()), pa.array([len(c) for c, _ in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums, tree], names=schema.names)

    return plain.mapInArrow(run, schema)


def apply_edits(trees: DataFrame, edits: str = "edits", ranks: str = RANKS) -> DataFrame:
    """``trees`` with text, tree, ``n_tokens`` and ``n_pretokens`` after the edits in its column ``edits``, plus ``n_edits`` and ``n_encoded`` (pre-tokens)."""
    shared = trees.sparkSession.sparkContext.broadcast(rank_bytes(ranks))
    plain = _carried(trees, ("n_edits", "n_encoded")).withColumn(edits, F.col(edits).cast(EDITS))
    schema = T.StructType([*plain.schema.fields, *T.StructType().add("n_edits", "long").add("n_encoded", "long")])
    names = plain.columns

    def run(batches):
        count = counter(shared.value).__getitem__
        for batch in batches:
            column = {n: batch.column(n) for n in names}
            texts, todo, trees = utf8(column["text"]), column[edits].to_pylist(), column["tree"]
            tokens, pretokens = column["n_tokens"].to_pylist(), column["n_pretokens"].to_pylist()
            done, encoded = [0] * len(texts), [0] * len(texts)
            touched: dict[int, dict] = {}
            for i, own in enumerate(todo):
                own = [e for e in own or () if e is not None]
                if not own:
                    continue
                tree = SegmentTree.unpacked(trees[i].as_py())
                text, encoded[i] = _edited((texts[i] or b"").decode("utf-8", "replace"), tree, own, count)
                texts[i], done[i], tokens[i], touched[i] = text.encode(), len(own), tree.n_tokens, tree.packed()
                pretokens[i] = sum(map(len, tree.chars))
            if touched:
                column["text"] = pa.array(texts, pa.binary()).cast(pa.string())
                column["n_tokens"], column["n_pretokens"] = pa.array(tokens, pa.int64()), pa.array(pretokens, pa.int64())
                fields = {k: trees.field(k).to_pylist() for k in TREE.names}
                for i, new in touched.items():
                    for k in TREE.names:
                        fields[k][i] = new[k]
                column["tree"] = pa.StructArray.from_arrays([pa.array(fields[k], pa.binary()) for k in TREE.names], names=TREE.names)
            yield pa.RecordBatch.from_arrays([*column.values(), pa.array(done, pa.int64()), pa.array(encoded, pa.int64())], names=schema.names)

    return plain.mapInArrow(run, schema)


# What a scrubbing pass replaces: mail addresses, then runs of seven or more digits with their separators.
PERSONAL = regex.compile(r"(?P<MAIL>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)|(?P<NUMBER>\+?\d(?:[ ().-]{0,2}\d){6,})")


def scrubbing(text: str) -> list[dict]:
    """Edits that replace mail addresses and long numbers, from the end of the text to its start."""
    return [{"start": m.start(), "stop": m.end(), "new": f"<{m.lastgroup}>"} for m in PERSONAL.finditer(text)][::-1]


def counts_after(docs: DataFrame, find: Callable[[str], list[dict]] = scrubbing, ranks: str = RANKS) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``n_pretokens`` of each text, then ``n_edits``, ``n_encoded``, ``n_tokens_edited`` and
    the ``text`` after the edits that ``find`` makes for it.

    The same as ``build`` and ``apply_edits`` in one pass, for when the trees are not kept: one document's tree at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(rank_bytes(ranks))
    plain = docs.select("doc_id", "text")
    numbers = ("n_tokens", "n_pretokens", "n_edits", "n_encoded", "n_tokens_edited")
    kind = plain.schema["doc_id"].dataType.simpleString()

    def run(batches):
        count = counter(shared.value).__getitem__
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                rows, texts = [], []
                for data in utf8(batch.column("text")):
                    text = (data or b"").decode("utf-8", "replace")
                    chars, tokens = leaves(text, count)
                    before, edits, encoded, after = int(tokens.sum()), find(text), 0, data
                    total = before
                    if edits:
                        tree = SegmentTree(chars, tokens)
                        text, encoded = _edited(text, tree, edits, count)
                        total, after = tree.n_tokens, text.encode()
                    rows.append((before, len(chars), len(edits), encoded, total))
                    texts.append(after)
                columns = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * len(numbers))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", *numbers, "text"])

    return plain.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in numbers) + ", text string")


def with_scrubbing(docs: DataFrame, edits: str = "edits") -> DataFrame:
    """``docs`` plus the edits that scrub its texts."""
    plain = _carried(docs, (edits,))
    schema = T.StructType([*plain.schema.fields, T.StructField(edits, EDITS)])
    place = plain.columns.index("text")
    item = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("new", pa.string())]))

    def run(batches):
        for batch in batches:
            found = [scrubbing((t or b"").decode("utf-8", "replace")) for t in utf8(batch.column(place))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, item)], names=schema.names)

    return plain.mapInArrow(run, schema)
