"""Byte-level BPE encoding and decoding with a segment tree over pair ranks.

A piece of text starts as one symbol per byte. The leaves of a segment tree
hold, for each symbol and its right neighbour, the rank of their merge and
the place; inner nodes hold the smaller child. So the root is the leftmost
pair of the lowest rank. A merge changes three leaves (its own, its left
neighbour's, and the absorbed symbol's), and each is carried up its path in
a logarithmic number of steps, until the root holds no mergeable pair.

Short pieces (words) go through many trees side by side, as the rows of one
numpy array, a merge in each at a time; a piece of over ROW_BYTES bytes gets
a tree of its own. Both give the same ids. Pieces that a task has met are
looked up; what it remembers is bounded. Vocabulary files are read on the
driver; their path is a parameter; tables (a few MB, the size of the
vocabulary) go to the tasks with the function.

Cases: null and empty texts have no ids and decode to ''; ids outside the
vocabulary decode to nothing, and bytes that aren't UTF-8 to U+FFFD; rows
may repeat; other columns aren't read; texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import column_function, whole_text

# Fixed value: how the vocabulary's pre-tokenizer splits text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer pieces get a tree of their own.
ROW_BYTES = 64
#: Pieces that a task remembers in each of two generations.
REMEMBERED = 120_000
#: Characters of a text's pieces handled at a time, so that many short texts share one call.
_GROUP = 1 << 20
_NONE = (1 << 62)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files:
    printable Latin-1 characters stand for themselves, the rest for the
    characters from U+0100 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Byte ids, merges as a hash table from a pair of ids to its rank and
    result, the bytes of each id, and special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.token = [b""] * self.size
        for text, k in vocab.items():
            self.token[k] = bytes(alphabet[c] for c in text)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, k in self.special.items():
            self.token[k] = text.encode()
        self.byte_id = np.zeros(256, np.int64)
        for c, b in alphabet.items():
            self.byte_id[b] = vocab[c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs] + [0], np.int64)
        self._table(left * self.size + right)

    def _table(self, keys: np.ndarray) -> None:
        """Open addressing: 8 slots a key, linear steps."""
        bits = max(4, int(len(keys) * 8).bit_length())
        self.shift, self.mask = 64 - bits, (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, len(keys), np.int64)
        self.steps = 1
        for rank, (key, at) in enumerate(zip(keys.tolist(), self._slot(keys).tolist(), strict=True)):
            step = 1
            while self.keys[at] not in (-1, key):
                at, step = (at + 1) & self.mask, step + 1
            if self.keys[at] == -1:
                self.keys[at], self.ranks[at] = key, rank
            self.steps = max(self.steps, step)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; the number of merges where there is none."""
        key = left * self.size + right
        at = self._slot(key)
        out = np.where(self.keys[at] == key, self.ranks[at], len(self.merged) - 1)
        seek = np.nonzero((self.keys[at] != key) & (self.keys[at] != -1))[0]
        for step in range(1, self.steps):
            if not len(seek):
                break
            at2 = (at[seek] + step) & self.mask
            hit = self.keys[at2] == key[seek]
            out[seek[hit]] = self.ranks[at2[hit]]
            seek = seek[~hit & (self.keys[at2] != -1)]
        return out


def encode_rows(pieces: list[bytes], vocab: Vocabulary) -> list[bytes]:
    """Ids of pieces of at most ROW_BYTES bytes, as little-endian unsigned
    32-bit integers: one tree per row."""
    out = [b""] * len(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    width = 2
    while width <= ROW_BYTES:
        mine = np.nonzero((sizes > width // 2 if width > 2 else sizes > 0) & (sizes <= width))[0]
        if len(mine):
            for k, ids in zip(mine.tolist(), _trees([pieces[k] for k in mine], width, vocab), strict=True):
                out[k] = ids
        width *= 2
    return out


def _trees(pieces: list[bytes], width: int, vocab: Vocabulary) -> list[bytes]:
    n, none = len(pieces), (len(vocab.merged) - 1) * width
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
    size = np.fromiter(map(len, pieces), np.int64, n)
    place = np.arange(width)
    ids = np.where(place < size[:, None], vocab.byte_id[raw], -1)
    after = np.where(place + 1 < size[:, None], place + 1, -1)  # the next live symbol
    before = np.broadcast_to(place - 1, (n, width)).copy()
    # Node 1 is the root, the leaves are width..2*width-1; a leaf is rank * width + place.
    tree = np.full((n, 2 * width), none, np.int64)
    pair = (after >= 0)
    tree[:, width:][pair] = vocab.rank(ids[:, :-1][pair[:, :-1]], ids[:, 1:][pair[:, :-1]]) * width + np.broadcast_to(place, (n, width))[pair]
    level = width // 2
    while level:
        tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
        level //= 2
    row = np.nonzero(tree[:, 1] < none)[0]
    while len(row):
        rank, at = np.divmod(tree[row, 1], width)
        gone = after[row, at]
        ids[row, at] = vocab.merged[rank]
        ids[row, gone] = -1
        nxt = after[row, gone]
        after[row, at] = nxt
        has = nxt >= 0
        before[row[has], nxt[has]] = at[has]
        prev = before[row, at]
        _update(tree, row, gone, np.full(len(row), none), width)
        own = np.full(len(row), none)
        own[has] = vocab.rank(ids[row[has], at[has]], ids[row[has], nxt[has]]) * width + at[has]
        _update(tree, row, at, own, width)
        has = prev >= 0
        r, p = row[has], prev[has]
        _update(tree, r, p, vocab.rank(ids[r, p], ids[r, at[has]]) * width + p, width)
        row = row[tree[row, 1] < none]
    live = ids >= 0
    flat = ids[live].astype("<u4").tobytes()
    ends = (4 * np.cumsum(live.sum(1))).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _update(tree: np.ndarray, row: np.ndarray, leaf: np.ndarray, value: np.ndarray, width: int) -> None:
    """Sets a leaf in each row and carries it up to the root."""
    node = leaf + width
    tree[row, node] = value
    while width > 1:
        node = node >> 1
        tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
        width //= 2


def encode_long(piece: bytes, vocab: Vocabulary) -> bytes:
    """Ids of one piece of any length: a tree in flat lists."""
    n = len(piece)
    width = 1 << max(1, (n - 1).bit_length())
    ids = vocab.byte_id[np.frombuffer(piece, np.uint8)]
    leaves = np.full(width, _NONE, np.int64)
    ranks = vocab.rank(ids[:-1], ids[1:])
    top = len(vocab.merged) - 1
    leaves[:n - 1] = np.where(ranks < top, ranks * width + np.arange(n - 1), _NONE)
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].reshape(-1, 2).min(axis=1))
    tree = [_NONE, *np.concatenate(levels[::-1]).tolist()]
    keys: dict[int, int] = {}
    sym, merged = ids.tolist(), vocab.merged.tolist()
    after, before = [*range(1, n), -1], list(range(-1, n - 1))

    def rank(a: int, b: int) -> int:
        key = a * vocab.size + b
        if (r := keys.get(key)) is None:
            r = keys[key] = int(vocab.rank(np.array([a]), np.array([b]))[0])
        return r

    def put(leaf: int, value: int) -> None:
        node = leaf + width
        tree[node] = value
        while node > 1:
            node >>= 1
            a, b = tree[2 * node], tree[2 * node + 1]
            low = a if a < b else b
            if tree[node] == low:
                return
            tree[node] = low

    while tree[1] < _NONE:
        r, at = divmod(tree[1], width)
        gone = after[at]
        nxt = after[gone]
        sym[at], sym[gone] = merged[r], -1
        after[at] = nxt
        put(gone, _NONE)
        if nxt >= 0:
            before[nxt] = at
        r = rank(sym[at], sym[nxt]) if nxt >= 0 else top
        put(at, r * width + at if r < top else _NONE)
        prev = before[at]
        if prev >= 0:
            r = rank(sym[prev], sym[at])
            put(prev, r * width + prev if r < top else _NONE)
    return np.array([s for s in sym if s >= 0], "<u4").tobytes()


class Encoder:
    """Encodes texts; remembers pieces in two bounded generations."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.young, self.old = vocab, {}, {}
        self.split = regex.compile(SPLIT)
        self.special = regex.compile("|".join(map(regex.escape, sorted(vocab.special, key=len, reverse=True)))) if vocab.special else None

    def _learn(self, pieces: set[str]) -> None:
        young, old = self.young, self.old
        new = []
        for p in pieces.difference(young):
            if p in old:
                young[p] = old[p]
            else:
                new.append(p)
        raw = [p.encode() for p in new]
        short = [k for k, b in enumerate(raw) if len(b) <= ROW_BYTES]
        young.update(zip([new[k] for k in short], encode_rows([raw[k] for k in short], self.vocab), strict=True))
        young.update((p, encode_long(b, self.vocab)) for p, b in zip(new, raw, strict=True) if len(b) > ROW_BYTES)

    def _parts(self, text: str) -> list[tuple[list[str], bytes]]:
        """Runs of pieces to merge, each with the id of the special token after it."""
        if self.special is None or not self.special.search(text):
            return [(self.split.findall(text), b"")]
        out, at = [], 0
        for m in self.special.finditer(text):
            out.append((self.split.findall(text[at:m.start()]), np.array([self.vocab.special[m[0]]], "<u4").tobytes()))
            at = m.end()
        return [*out, (self.split.findall(text[at:]), b"")]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out, group, size = [], [], 0
        for k, text in enumerate(texts):
            group.append(self._parts(text))
            size += len(text)
            if size >= _GROUP or k == len(texts) - 1:
                self._learn(set().union(*(pieces for parts in group for pieces, _ in parts)))
                known = self.young.__getitem__
                for parts in group:
                    out.append(b"".join(b"".join(map(known, pieces)) + special for pieces, special in parts))
                group, size = [], 0
                if len(self.young) > REMEMBERED:
                    self.young, self.old = {}, self.young
        return out


def decode(ids: bytes, vocab: Vocabulary) -> str:
    """The text of ids given as little-endian unsigned 32-bit integers."""
    token, size = vocab.token, vocab.size
    return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist() if i < size]).decode("utf-8", "replace")


def _id_lists(ids: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def encoded(text: Column, path: str) -> Column:
    """The ids of a text, array<int>."""
    vocab = Vocabulary(path)

    def make():
        encoder = Encoder(vocab)

        def apply(batch: pa.Array) -> pa.Array:
            ids = encoder.encode([t or "" for t in batch.to_pylist()])
            return _id_lists(ids)
        return apply
    return column_function(make, "array<int>")(text)


def decoded(ids: Column, path: str) -> Column:
    """The text of an id array."""
    vocab = Vocabulary(path)

    def make():
        def apply(batch: pa.Array) -> pa.Array:
            return pa.array([decode(np.array(x or [], "<u4").tobytes(), vocab) for x in batch.to_pylist()], pa.string())
        return apply
    return column_function(make, "string")(ids)


def _round_trip(text: Column, path: str, keep_ids: bool) -> Column:
    """A struct per text: n_tokens, ids_sha256, decoded_sha256, and the ids
    where they are kept. Encodes, then decodes the ids."""
    vocab = Vocabulary(path)

    def make():
        encoder = Encoder(vocab)

        def apply(batch: pa.Array) -> pa.Array:
            ids = encoder.encode([t or "" for t in batch.to_pylist()])
            columns = {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                       "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                       "decoded_sha256": pa.array([hashlib.sha256(decode(x, vocab).encode()).hexdigest() for x in ids], pa.string())}
            if keep_ids:
                columns["ids"] = _id_lists(ids)
            return pa.StructArray.from_arrays([*columns.values()], [*columns])
        return apply
    kind = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return column_function(make, kind)(text)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array<int>) and decoded text per document."""
    rows = docs.select("doc_id", encoded(whole_text(), path).alias("ids"))
    return rows.select("doc_id", "ids", decoded(F.col("ids"), path).alias("decoded"))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per document."""
    return docs.select("doc_id", _round_trip(whole_text(), path, False).alias("d")).select("doc_id", "d.*")


def encode_with_digests(docs: DataFrame, path: str) -> DataFrame:
    """The same and the ids themselves, array<int>."""
    return docs.select("doc_id", _round_trip(whole_text(), path, True).alias("d")).select("doc_id", "d.*")
