"""Words of Arrow text columns as 64-bit hashes, without a Python object per word.

A word is a run of bytes other than the six ASCII white-space bytes, as in
``[^\\x20\\x09-\\x0D]+``; in UTF-8 such bytes never occur inside a character.
Hashes depend on a word's bytes alone, so they agree between tasks and runs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute

SHINGLE = 5

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**64, 256, dtype=np.uint64, endpoint=False)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACES = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A"):ord("Z") + 1] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """Words of several texts, one after the other."""

    hashes: np.ndarray  # uint64 per word
    starts: np.ndarray  # byte where the word starts, from the start of its text
    ends: np.ndarray    # byte after its end
    first: np.ndarray   # per text: number of its first word; one entry more than texts

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the texts' offsets into them; null is empty."""
    column = pa.compute.fill_null(column, "") if column.null_count else column
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(column: pa.Array, fold: bool = True) -> Words:
    """Words of each text; ``fold`` lower-cases A-Z before hashing."""
    raw, offsets = utf8(column)
    n = len(raw)
    if n == 0:
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint64), none, none, np.zeros(len(offsets), np.int64))
    inside = ~_SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < n]
    begins[cuts] |= inside[cuts]
    starts = np.flatnonzero(begins)
    # A word ends where white space, another text or the column ends it.
    ending = np.zeros(n + 1, dtype=bool)
    ending[1:n] = inside[:-1] & ~inside[1:]
    ending[n] = inside[-1]
    cuts = cuts[cuts > 0]
    ending[cuts] |= inside[cuts - 1]
    ends = np.flatnonzero(ending)
    codes = _BYTE[_FOLDED[raw] if fold else raw]
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(codes * _powers(_BACK, n), out=total[1:])
    lift = _powers(_STEP, n + 1)
    hashes = mixed((total[ends] - total[starts]) * lift[ends] + (ends - starts).astype(np.uint64))
    first = np.searchsorted(starts, offsets)
    base = np.repeat(offsets[:-1], np.diff(first))
    return Words(hashes, starts - base, ends - base, first)


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` neighbouring hashes; the caller drops those across texts."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out += hashes[k:k + n] * _PLACES[k % len(_PLACES)]
    return mixed(out)


def shingle_sets(w: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, and the offsets of the texts' sets.

    A text of fewer than ``size`` words is one shingle as a whole; one without words
    has none.
    """
    counts = np.diff(w.first)
    n = len(counts)
    all_runs = runs(w.hashes, size)
    if len(all_runs):
        place = np.arange(len(all_runs))
        owner = w.text_of()[:len(all_runs)]
        keep = place + size <= w.first[owner + 1]
        owner, values = owner[keep], all_runs[keep]
    else:
        owner, values = np.empty(0, np.int64), np.empty(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = np.array(
            [_whole(w.hashes[w.first[i]:w.first[i + 1]]) for i in short], dtype=np.uint64)
        owner = np.concatenate([owner, short])
        values = np.concatenate([values, whole])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    if len(values):
        fresh = np.ones(len(values), dtype=bool)
        fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        owner, values = owner[fresh], values[fresh]
    return values, np.searchsorted(owner, np.arange(n + 1))


def _whole(hashes: np.ndarray) -> np.uint64:
    """One hash of a short text, apart from those of full shingles by its length."""
    return runs(hashes, len(hashes))[0] ^ np.uint64(len(hashes))
