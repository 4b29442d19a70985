"""Byte-level BPE encoding and decoding over a rank file.

Each match of the splitting pattern is encoded alone: it is a token as a whole or its
bytes are merged, always the leftmost pair of the lowest rank first. A segment tree
over byte positions holds, at every node, the least ``rank * size + position`` of the
pairs that start below it; its root names the next merge. A merge changes the pairs
of the merged position and its live left neighbour and removes that of the right one:
three point updates up the tree. Short matches of one batch are merged side by side,
a tree per row of an array; long ones one by one in a plain list.

A null or empty text has no tokens; decoding null or no ids gives empty bytes. An id
outside the ranks is an error. Each row is handled alone, so ties, repeated rows and
the order of rows do not matter; other columns are not passed on.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tradewind.llm.frames import mapped, slices
from tradewind.llm.units import Encoder

# Matches up to this many bytes are merged side by side.
SIDE_BY_SIDE = 64
ROWS_SIDE_BY_SIDE = 8192
# Beyond every key of a pair.
_NONE, _FAR = 2**62, np.int32(2**31 - 1)


class Ranks:
    """A vocabulary: bytes by rank, and which two tokens make a third."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(word): int(number)
                         for word, number in (line.split() for line in lines if line.strip())}
        self.token = {number: word for word, number in self.rank.items()}
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int32)
        self.shift = max(self.token).bit_length()
        self.pairs: dict[int, int] = {}
        for word, number in self.rank.items():
            for cut in range(1, len(word)):
                left, right = self.rank.get(word[:cut]), self.rank.get(word[cut:])
                if left is not None and right is not None:
                    self.pairs[left << self.shift | right] = number
        self._fill()

    def _fill(self) -> None:
        """Pairs in an open table of 64-bit slots: the pair above, its rank below."""
        self.slots = 1 << max(len(self.pairs) * 4, 16).bit_length()
        self.table = np.full(self.slots, -1, dtype=np.int64)
        keys = np.fromiter(self.pairs, dtype=np.int64, count=len(self.pairs))
        found = np.fromiter(self.pairs.values(), dtype=np.int64, count=len(self.pairs))
        place = self._place(keys)
        while len(keys):
            free = self.table[place] < 0
            # Of pairs that meet in a slot the last written stays; the rest move on.
            entry = keys << np.int64(self.shift) | found
            self.table[place[free]] = entry[free]
            moved = self.table[place] != entry
            keys, found = keys[moved], found[moved]
            place = (place[moved] + 1) & (self.slots - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(65 - self.slots.bit_length())).astype(np.int64)

    def made_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each two tokens together, -1 where there is none."""
        wanted = left.astype(np.int64) << np.int64(self.shift) | right
        place = self._place(wanted)
        entry = self.table[place]
        out = np.where(entry >> np.int64(self.shift) == wanted,
                       entry & np.int64((1 << self.shift) - 1), -1)
        open_ = np.flatnonzero((entry >= 0) & (out < 0))
        while len(open_):
            place[open_] = (place[open_] + 1) & (self.slots - 1)
            entry = self.table[place[open_]]
            fits = entry >> np.int64(self.shift) == wanted[open_]
            out[open_[fits]] = entry[fits] & np.int64((1 << self.shift) - 1)
            open_ = open_[(entry >= 0) & ~fits]
        return out


def merge_long(ranks: Ranks, word: bytes) -> list[int]:
    """Tokens of one word by a segment tree in a list."""
    n = len(word)
    size = 1 << max(n - 1, 1).bit_length()
    token = ranks.byte[np.frombuffer(word, dtype=np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    none, pairs, shift = _NONE, ranks.pairs, ranks.shift
    tree = [none] * (2 * size)

    def key(i: int) -> int:
        j = after[i]
        rank = pairs.get(token[i] << shift | token[j]) if j < n else None
        return none if rank is None else rank * size + i

    for i in range(n):
        tree[size + i] = key(i)
    for x in range(size - 1, 0, -1):
        tree[x] = min(tree[2 * x], tree[2 * x + 1])

    def put(i: int, value: int) -> None:
        x = size + i
        tree[x] = value
        x >>= 1
        while x:
            low = min(tree[2 * x], tree[2 * x + 1])
            if tree[x] == low:
                break
            tree[x] = low
            x >>= 1

    while tree[1] < none:
        rank, i = divmod(tree[1], size)
        j = after[i]
        k = after[j]
        token[i], after[i] = rank, k
        if k < n:
            before[k] = i
        put(j, none)
        put(i, key(i))
        if before[i] >= 0:
            put(before[i], key(before[i]))
    out, i = [], 0
    while i < n:
        out.append(token[i])
        i = after[i]
    return out


def merge_many(ranks: Ranks, words: list[bytes], size: int) -> list[bytes]:
    """Token bytes of words of 2 to ``size`` bytes (a power of two), a tree per row.

    All arrays are flat: row ``w`` holds position ``i`` at ``w * size + i`` and node ``x``
    of its tree at ``w * 2 * size + x``.
    """
    rows = len(words)
    lengths = np.fromiter(map(len, words), dtype=np.int32, count=rows)
    place = np.arange(size, dtype=np.int32)
    live = place < lengths[:, None]
    token = np.zeros((rows, size), dtype=np.int32)
    token[live] = ranks.byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
    made = np.full((rows, size), -1, dtype=np.int32)
    paired = place + 1 < lengths[:, None]
    rest = paired[:, :-1]
    made[:, :-1][rest] = ranks.made_of(token[:, :-1][rest], token[:, 1:][rest])
    tree = np.full((rows, 2 * size), _FAR, dtype=np.int32)
    tree[:, size:] = np.where(made >= 0, made * size + place, _FAR)
    width = size
    while width > 1:
        level = tree[:, width:2 * width]
        width //= 2
        np.minimum(level[:, 0::2], level[:, 1::2], out=tree[:, width:2 * width])
    after = np.broadcast_to(place + 1, (rows, size)).ravel().copy()
    before = np.broadcast_to(place - 1, (rows, size)).ravel().copy()
    alive, token, tree = live.ravel(), token.ravel(), tree.ravel()

    def keys(base: np.ndarray, end: np.ndarray, i: np.ndarray) -> np.ndarray:
        j = after[base + i]
        inner = np.flatnonzero(j < end)
        out = np.full(len(i), _FAR, dtype=np.int32)
        at = base[inner]
        made = ranks.made_of(token[at + i[inner]], token[at + j[inner]])
        out[inner] = np.where(made >= 0, made * size + i[inner], _FAR)
        return out

    row = np.flatnonzero(tree[1::2 * size] < _FAR)
    while len(row):
        base, end = row * size, lengths[row]
        made, i = np.divmod(tree[base * 2 + 1], size)
        j = after[base + i]
        k = after[base + j]
        token[base + i] = made
        after[base + i] = k
        alive[base + j] = False
        inner = k < end
        before[(base + k)[inner]] = i[inner]
        p = before[base + i]
        left = p >= 0
        # The three changed leaves, then all their nodes, level by level.
        base3 = np.concatenate([base, base, base[left]])
        leaf3 = np.concatenate([j, i, p[left]])
        end2 = np.concatenate([end, end[left]])
        value3 = np.concatenate([np.full(len(row), _FAR, np.int32),
                                 keys(base3[len(row):], end2, leaf3[len(row):])])
        x = base3 * 2 + size + leaf3
        top = base3 * 2
        tree[x] = value3
        x -= top
        width = size
        while width > 1:
            x >>= 1
            width >>= 1
            child = top + 2 * x
            tree[top + x] = np.minimum(tree[child], tree[child + 1])
        row = row[tree[base * 2 + 1] < _FAR]
    flat = token[alive].astype("<u4").tobytes()
    ends = np.cumsum(alive.reshape(rows, size).sum(axis=1)) * 4
    starts = np.concatenate([[0], ends[:-1]])
    return [flat[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def merge(ranks: Ranks, words: list[bytes]) -> dict[bytes, bytes]:
    """Token bytes of distinct words."""
    out: dict[bytes, bytes] = {}
    by_size: dict[int, list[bytes]] = {}
    for word in words:
        whole = ranks.rank.get(word)
        if whole is not None:
            out[word] = whole.to_bytes(4, "little")
        elif len(word) > SIDE_BY_SIDE:
            out[word] = np.array(merge_long(ranks, word), dtype="<u4").tobytes()
        else:
            by_size.setdefault(1 << (len(word) - 1).bit_length(), []).append(word)
    for size, group in by_size.items():
        for at in range(0, len(group), ROWS_SIDE_BY_SIDE):
            part = group[at:at + ROWS_SIDE_BY_SIDE]
            out.update(zip(part, merge_many(ranks, part, size)))
    return out


# Up to here the classes of letters, digits and white space are the same in every
# Unicode version the installed libraries hold.
_SETTLED = "ԯ"


@lru_cache(maxsize=4)
def _splitters(pattern: str) -> tuple[regex.Pattern, regex.Pattern]:
    """The pattern, and the pattern with the letters and digits that tiktoken knows."""
    import tiktoken

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    ranks = {bytes([b]): b for b in range(256)}
    exact = pattern
    for name in (r"\p{L}", r"\p{N}"):
        known = tiktoken.Encoding("class", pat_str=name + "+", mergeable_ranks=ranks,
                                  special_tokens={})
        codes = np.array([ord(c) for c in known.decode(known.encode_ordinary(every))])
        cuts = np.flatnonzero(np.diff(codes) > 1)
        firsts, lasts = codes[np.r_[0, cuts + 1]], codes[np.r_[cuts, len(codes) - 1]]
        inner = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(firsts.tolist(), lasts.tolist()))
        exact = exact.replace(f"[^\\s\\p{{L}}\\p{{N}}]", "[^\\s{L}{N}]")
        exact = exact.replace("{" + name[3] + "}]", inner + "]") if name[3] == "N" else exact
        exact = exact.replace("{L}{N}]", inner + "{N}]") if name[3] == "L" else exact
        exact = exact.replace(name, f"[{inner}]")
    return regex.compile(pattern), regex.compile(exact)


def matches(text: str, pattern: str) -> list[str]:
    """Matches of the splitting pattern, with the character classes of tiktoken."""
    if text.isascii() or max(text) <= _SETTLED:
        return _plain(pattern).findall(text)
    return _splitters(pattern)[1].findall(text)


@lru_cache(maxsize=4)
def _plain(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


@lru_cache(maxsize=2)
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of this process; tokens of units are kept between tasks."""
    ranks = ranks_of(path)

    def encode_units(units: list[str]) -> list[bytes]:
        cut = [matches(u, pattern) for u in units]
        found = list(set().union(*cut))
        words = [m.encode() for m in found]
        merged = merge(ranks, words)
        known = dict(zip(found, map(merged.__getitem__, words)))
        return [b"".join(map(known.__getitem__, parts)) for parts in cut]

    return Encoder(encode_units)


def _id_lists(tokens: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *[len(t) // 4 for t in tokens]])
    values = np.frombuffer(b"".join(tokens), dtype="<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def encoded(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Columns ``id_col`` and ``ids``: the token ids of each whole text."""
    kind = df.schema[id_col].dataType.simpleString()
    plain = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in slices(batches, 512):
            tokens = own.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), _id_lists(tokens)],
                                             names=["id", "ids"])

    return mapped(plain, work, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decoded(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Columns ``id_col``, ``ids`` and ``content``: the bytes that the ids stand for."""
    kind = df.schema[id_col].dataType.simpleString()
    plain = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = ranks_of(path).token.__getitem__
        for batch in slices(batches, 128):
            lists = batch.column("ids")
            content = [b"".join(map(token, ids or ())) for ids in
                       (x.as_py() if x.values is None else x.values.to_numpy(False).tolist()
                        for x in lists)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), lists, pa.array(content, pa.binary())],
                names=["id", "ids", "content"])

    return mapped(plain, work, f"id {kind}, ids array<int>, content binary"
                  ).withColumnRenamed("id", id_col).withColumnRenamed("ids", ids_col)
