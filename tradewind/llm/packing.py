"""Packing token sequences into as few bins as can be certified.

``pieces`` cuts token sequences to the capacity, ``packed`` places pieces. Pieces as long
as a bin fill one each. The rest is dealt into groups of about ``group_size`` pieces and
packed there by best-fit decreasing. Dual feasible functions give each group a lower
bound on its bins. A group that meets its bound is certified: its bins stay, but for those
with more than a 64th of room, which other groups' pieces may fill. A group with a gap
keeps only bins with less than a 256th. All leftover pieces are dealt anew, into fewer
groups, and packed again; the last round is the one with a single group, or the one after
``rounds``.

Every round's rows are written to the shared folder before they are dealt, and dealt by
a hash of their row numbers there, so equal rows spread like others and a lost task
repeats exactly. A group's rows are lengths and small columns only.

Defined results: a null or empty text is a sequence of the end token alone; an empty
table gives no rows; repeated rows are packed as rows of their own.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradewind.llm.frames import kept, mapped, slices
from tradewind.llm.units import Encoder

CAPACITY = 2048
GROUP_SIZE = 2000
ROUNDS = 8
# A bin with more than this part of its capacity free is packed again.
CLOSED = 64


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """Encoder for a byte-level BPE tokenizer file, without its special tokens.

    The file's vocabulary lists tokens in the order of their merges, so their ids are
    merge ranks; units not met before are merged by them.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    byte_of = _bytes_of_letters()
    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
    ranks = {bytes(byte_of[c] for c in word): number for word, number in vocabulary.items()
             if all(c in byte_of for c in word) and not word.startswith("<|")}
    merging = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                special_tokens={})
    ids_of = merging.encode_ordinary
    return Encoder(lambda new: [array("I", ids_of(u)).tobytes() for u in new])


@lru_cache(maxsize=2)
def as_loaded(path: str) -> _WithAdded:
    """As ``encoder``, but the file's added tokens in a text are one id each."""
    return _WithAdded(path)


class _WithAdded:
    """Texts that hold an added token go to the library whole, others to ``encoder``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.plain, self.library = encoder(path), Tokenizer.from_file(path)
        added = sorted(t.content for t in self.library.get_added_tokens_decoder().values())
        self.added = re.compile("|".join(map(re.escape, added))) if added else None

    def encode(self, texts: list[str | None]) -> list[bytes]:
        held = [n for n, t in enumerate(texts) if t and self.added and self.added.search(t)]
        rest = list(texts)
        for n in held:
            rest[n] = None
        out = self.plain.encode(rest)
        for n in held:
            ids = self.library.encode(texts[n], add_special_tokens=False).ids
            out[n] = array("I", ids).tobytes()
        return out


def _bytes_of_letters() -> dict[str, int]:
    """Byte-level files write printable Latin-1 bytes as themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def cut_points(length: int, capacity: int) -> list[int]:
    """Starts of the pieces: all but the first are full."""
    first = length % capacity
    return [0, *range(first or capacity, length, capacity)] if length else []


def pieces(df: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of whole texts: id, piece, start, length, ids (binary, 32-bit LE).

    A text's tokens are followed by ``end_id``. A sequence longer than the capacity is
    cut so that only its first piece may be shorter.
    """
    kind = df.schema[id_col].dataType.simpleString()
    plain = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    end = array("I", [end_id]).tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = as_loaded(path)
        for batch in slices(batches, 512):
            row, piece, start, length, ids = [], [], [], [], []
            for n, tokens in enumerate(own.encode(batch.column("text").to_pylist())):
                tokens += end
                total = len(tokens) // 4
                cuts = cut_points(total, capacity)
                for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], total])):
                    row.append(n)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    ids.append(tokens[4 * a:4 * b])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(ids, pa.binary())],
                names=["id", "piece", "start", "length", "ids"])

    return mapped(plain, work, f"id {kind}, piece int, start long, length long, ids binary"
                  ).withColumnRenamed("id", id_col)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that no packing can do without, by dual feasible functions, in whole numbers.

    Tried are the plain sum, the functions that round up pieces over half a bin and drop
    those below a limit, for every limit, and the rounding functions for 1 to 8 parts.
    """
    if not len(lengths):
        return 0
    sizes, counts = np.unique(lengths, return_counts=True)
    best = math.ceil(Fraction(int(sizes @ counts), capacity))
    large = sizes * 2 > capacity
    for limit in np.concatenate([[1], sizes[~large]]).tolist():
        weight = np.where(sizes > capacity - limit, capacity,
                          np.where(sizes >= limit, sizes, 0))
        best = max(best, -(-int(weight @ counts) // capacity))
    for parts in range(1, 9):
        # (k+1)x whole: weight x; else its floor by k.
        scaled = sizes * (parts + 1)
        whole = scaled % capacity == 0
        total = sum(Fraction(int(s), capacity) * int(c) if w
                    else Fraction(int(s) * (parts + 1) // capacity, parts) * int(c)
                    for s, c, w in zip(sizes, counts, whole))
        best = max(best, math.ceil(total))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the free room of each bin; largest pieces first.

    Bins wait in a stack for each amount of free room; the bits of one whole number tell
    which stacks hold any.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[int] = []
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0
    for at, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = some >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            stack = waiting[free]
            own = stack.pop()
            if not stack:
                some ^= 1 << free
        else:
            own, free = len(room), capacity
            room.append(capacity)
        bins[at], offsets[at] = own, capacity - free
        free -= size
        room[own] = free
        if free:
            if not waiting[free]:
                some |= 1 << free
            waiting[free].append(own)
    return bins, offsets, np.array(room, dtype=np.int64)


def packed(df: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP_SIZE,
           rounds: int = ROUNDS) -> DataFrame:
    """``df`` with ``sequence_id`` and ``offset``; needs a column ``length`` of 1 to capacity.

    Columns ``sequence_id``, ``offset`` and those that start with ``pack_`` in ``df`` are
    replaced. Give it few, small columns: they are shuffled with their rows.
    """
    own = [c for c in df.columns if c not in ("sequence_id", "offset")
           and not c.startswith("pack_")]
    rest = kept(df.select(*own), "pieces")
    tag = F.monotonically_increasing_id()
    full = rest.where(F.col("length") == capacity)
    done = [full.select(*own, (F.lit(1 << 62) + tag).alias("sequence_id"),
                        F.lit(0).cast("long").alias("offset"))]
    rest = rest.where(F.col("length") < capacity)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    for turn in range(rounds):
        n = rest.count()
        if not n:
            break
        groups = max(1, math.ceil(n / group_size))
        last = groups == 1 or turn == rounds - 1
        dealt = rest.select(*own, F.pmod(F.xxhash64(tag, F.lit(turn)), F.lit(groups))
                            .cast("long").alias("pack_group"))
        result = kept(dealt.groupBy("pack_group").applyInPandas(
            _packer(capacity, turn, last, own),
            f"{schema}, sequence_id long, offset long, pack_left boolean"), f"packed-{turn}")
        done.append(result.where("not pack_left").select(*own, "sequence_id", "offset"))
        if last:
            break
        rest = result.where("pack_left").select(*own)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _packer(capacity: int, turn: int, last: bool, own: list[str]):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy(np.int64)
        bins, offsets, room = best_fit(lengths, capacity)
        left = np.zeros(len(room), dtype=bool)
        if not last:
            certified = len(room) <= lower_bound(lengths, capacity)
            left = room > capacity // (CLOSED if certified else 4 * CLOSED)
        out = rows[own].copy()
        group = int(rows["pack_group"].iloc[0])
        out["sequence_id"] = (turn << 56) + (group << 16) + bins
        out["offset"] = offsets
        out["pack_left"] = left[bins]
        return out

    return pack
