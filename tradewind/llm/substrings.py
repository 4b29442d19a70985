"""Passages that repeat across documents, by compact windows under several hash functions.

A text is its sequence of five-word shingles. Under a hash function a compact window
(left, centre, right) stands for all subsequences between left and right that hold the
centre, whose hash is the least of each of them. The windows that are as long as a passage
of ``least`` words come from the Cartesian tree of the hashes: centres are the arguments of
sliding minima, and a stack gives the nearest smaller values beside them.

Two passages that share 0.8 of their shingles have the same least hash under a function
with a chance of 0.8. So windows meet by (function, least hash): the first holder, by
document id, meets all others; holders in one batch meet there before anything is
shuffled, so a passage in a third of all documents costs a row per batch. A pair of
documents is proposed if windows of ``ENOUGH`` functions overlap in a whole passage.

Proposed pairs are verified on the words. A hit grows to the longest run of equal words by
binary search over prefix hashes, for all hits of a batch at once; runs go on over edits
of up to ``GAP`` words while the passages share ``percent`` of their shingles. Passages of
``least`` words or more are repeats of the earlier document. First holders are streamed
past their partners, those with many in several places, and never copied to each.

A first holder may share too little around its centre. So windows that no verified passage
covers meet again in rounds, without the first holders they have met, and by finer keys:
windows of two functions, then of all, then of twice as many each time are intersected, and
those long enough for a passage are joined by all their least hashes. Common lines thus
part from their neighbourhoods after few rounds. Rounds end when no two such windows meet. A verbatim
passage has every key; an edited one fewer of them the finer they are.

Defined results: null, empty and short texts have no windows and no repeats, nor have
rows without an id. Repeats within one document do not count. Ids are meant to be
unique: rows that share an id count as one document, whose text is the one with the
least hash, and only rows with that text get its spans. Other columns are not passed on.
A window that a verified passage covers looks for no other partner, so words beyond that
passage's ends, fewer than a window apart, may stay. Long texts are worked through alone,
in memory proportional to the longest one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, functions as F

from tradewind.llm.frames import bloom, gathered, kept, mapped, parted, passing, slices
from tradewind.llm.words import SHINGLE, Words, mixed, runs, utf8, words

LEAST = 50
PERCENT = 80
FUNCTIONS = 6
# Functions whose windows must overlap for two documents to be compared.
ENOUGH = 2
# Words beyond the outermost hits that are compared.
REACH = 128
# Words of an edit between two equal runs of one passage.
GAP = 8
# Partners that one copy of a first holder meets.
PARTNERS = 1000
# Text worked on at once.
TEXT_BYTES = 1 << 20

_RNG = np.random.default_rng(9)
# Odd factors of hash functions; rounds that need more than these do not occur: passages that
# differ at all share the least hashes of so many functions once in 10**9.
_FACTORS = _RNG.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _sliding(best, values: np.ndarray, width: int) -> np.ndarray:
    """Least or greatest of every ``width`` neighbours, by doubling."""
    span = 1
    while span * 2 <= width:
        values = best(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return best(values[:-rest], values[rest:]) if rest else values


def compact_windows(values: np.ndarray, starts: np.ndarray, width: int):
    """Centre, left and right of all compact windows of at least ``width`` places.

    ``values`` are positive hashes of several sequences, ``starts`` the sequences'
    first places with the total length at the end.
    """
    n = len(values)
    # A zero before each sequence keeps windows within it.
    counts = np.diff(starts)
    shift = np.repeat(np.arange(1, len(counts) + 1), counts)
    y = np.zeros(n + len(counts) + 1, dtype=np.uint64)
    y[np.arange(n) + shift] = values
    if len(y) < width:
        none = np.empty(0, np.int64)
        return none, none, none
    low = _sliding(np.minimum, y, width)
    padded = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
    centre = np.flatnonzero((_sliding(np.maximum, padded, width) == y) & (y > 0))
    edges = np.flatnonzero(y == 0)
    places = np.sort(np.concatenate([centre, edges]))
    heights = y[places]
    left, right = _smaller_beside(heights.tolist(), places.tolist())
    keep = heights > 0
    places, left, right = places[keep], left[keep] + 1, right[keep] - 1
    keep = right - left + 1 >= width
    places, left, right = places[keep], left[keep], right[keep]
    back = np.searchsorted(edges, places)
    return places - back, left - back, right - back


def _smaller_beside(heights: list[int], places: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest height before each that is no larger, and of the nearest smaller one
    after it; both ends are zeros."""
    n = len(heights)
    left, right = [0] * n, [0] * n
    stack: list[int] = []
    for k in range(n):
        height = heights[k]
        while stack and heights[stack[-1]] > height:
            right[stack.pop()] = places[k]
        j = stack[-1] if stack else k
        # Of equal heights the first one counts, so every subsequence has one window.
        left[k] = places[j]
        stack.append(k)
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


class Windows:
    """Windows of several texts under one function, or common ones under several.

    A window stands for the subsequences that start between ``left`` and ``low`` and end
    between ``high`` and ``right``; ``low`` and ``high`` are its first and last centre.
    Places count shingles over all texts; ``centre`` is that of the first function.
    """

    _COLUMNS = ("key", "centre", "left", "low", "high", "right")

    def __init__(self, **columns: np.ndarray):
        for name in self._COLUMNS:
            setattr(self, name, columns[name])

    @classmethod
    def of(cls, shingles: np.ndarray, starts: np.ndarray, width: int, function: int) -> "Windows":
        hashed = np.maximum(mixed(shingles * _FACTORS[function]), np.uint64(1))
        centre, left, right = compact_windows(hashed, starts, width)
        return cls(key=mixed(hashed[centre] + _FACTORS[function]), centre=centre, left=left,
                   low=centre, high=centre, right=right)

    def chosen(self, which: np.ndarray) -> "Windows":
        return Windows(**{name: getattr(self, name)[which] for name in self._COLUMNS})

    def _beside(self, other: "Windows") -> tuple[np.ndarray, np.ndarray]:
        """Pairs of windows whose ranges of starts may overlap, all that do included.

        The other's ranges are looked up by classes of length, so that a long one does not
        widen the search for the short ones.
        """
        size = np.frexp((other.low - other.left + 1).astype(np.float64))[1]
        mine, theirs = [], []
        for k in np.unique(size):
            own = np.flatnonzero(size == k)
            own = own[np.argsort(other.low[own], kind="stable")]
            first = np.searchsorted(other.low[own], self.left)
            last = np.searchsorted(other.low[own], self.low + (1 << int(k)))
            n = np.maximum(last - first, 0)
            mine.append(np.repeat(np.arange(len(n)), n))
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
            theirs.append(own[at])
        none = np.empty(0, np.int64)
        return np.concatenate([none, *mine]), np.concatenate([none, *theirs])

    def intersected(self, other: "Windows", width: int) -> "Windows":
        """Common subsequences of at least ``width`` places; each is in one of the results."""
        mine, theirs = self._beside(other)
        left = np.maximum(self.left[mine], other.left[theirs])
        low = np.minimum(self.low[mine], other.low[theirs])
        high = np.maximum(self.high[mine], other.high[theirs])
        right = np.minimum(self.right[mine], other.right[theirs])
        common = np.flatnonzero((left <= low) & (high <= right) & (right - left + 1 >= width))
        mine, theirs = mine[common], theirs[common]
        return Windows(key=mixed(self.key[mine] ^ mixed(other.key[theirs] * _STEP)),
                       centre=self.centre[mine], left=left[common], low=low[common],
                       high=high[common], right=right[common])


def windows_of(w: Words, least: int, functions: int, joint: int,
               open_: list | None = None) -> dict[str, np.ndarray]:
    """Windows of all texts: key, text, function, place, left and right (in its shingles).

    Functions are taken ``joint`` at a time and their windows intersected; of the first one
    only those with an ``open_`` number (function * 2**40 + place) in the text's list.
    """
    width = least - SHINGLE + 1
    counts = np.diff(w.first)
    long = np.flatnonzero(counts >= least)
    n = counts[long] - SHINGLE + 1
    starts = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    text = np.repeat(long, n)
    own = np.arange(starts[-1]) - np.repeat(starts[:-1], n)
    shingles = runs(w.hashes, SHINGLE)[w.first[text] + own] if len(long) else np.empty(0, np.uint64)
    out = {name: [] for name in ("key", "text", "function", "place", "left", "right")}
    wanted = None
    if open_ is not None:
        offset = {int(t): int(a) for t, a in zip(long, starts)}
        wanted = [np.array(sorted(offset[t] + (x & (1 << 40) - 1) for t, xs in enumerate(open_)
                                  if t in offset for x in xs if x >> 40 == f), np.int64)
                  for f in range(functions)]
    for f in range(0, functions - joint + 1, joint):
        found = Windows.of(shingles, starts, width, f)
        if wanted is not None:
            found = found.chosen(np.isin(found.centre, wanted[f]))
        for more in range(f + 1, f + joint):
            found = found.intersected(Windows.of(shingles, starts, width, more), width)
        at = np.searchsorted(starts, found.centre, side="right") - 1
        out["key"].append(found.key)
        out["text"].append(long[at])
        out["function"].append(np.full(len(at), f))
        for name, place in (("place", found.centre), ("left", found.left), ("right", found.right)):
            out[name].append(place - starts[at])
    return {name: np.concatenate(x) for name, x in out.items()}


_HIT = "struct<place:int,left:int,right:int,function:int,shift:int>"


def hits(df: DataFrame, id_col: str, text_col: str, least: int, functions: int, joint: int,
         open_: DataFrame | None = None) -> DataFrame:
    """id, an earlier id, and a hit: a window that both have, at ``place`` and ``place - shift``.

    ``open_`` (id, places) names the windows that take part; None is all.
    """
    kind = df.schema[id_col].dataType.simpleString()
    plain = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        "id is not null")
    all_take_part = open_ is None
    if not all_take_part:
        plain = parted(plain, F.col("id"), open_, F.col("id"))[0].join(open_, "id")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, 1 << 16, TEXT_BYTES):
            # Texts in order of their ids, so that the first of a key is the earliest.
            batch = batch.take(pa.compute.sort_indices(batch.column("id")))
            ids = batch.column("id")
            number = np.unique(ids.dictionary_encode().indices.to_numpy(), return_inverse=True)[1]
            found = windows_of(words(batch.column("text")), least, functions, joint,
                               None if all_take_part else batch.column("places").to_pylist())
            order = np.lexsort((found["place"], found["text"], found["key"]))
            if not len(order):
                continue
            found = {name: x[order] for name, x in found.items()}
            key, text, place = found["key"], found["text"], found["place"]
            fresh = np.r_[True, key[1:] != key[:-1]]
            head = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            differs = number[text] != number[text[head]]
            other = pa.compute.if_else(pa.array(differs), ids.take(pa.array(text[head])),
                                       pa.scalar(None, ids.type))
            # Pairs found here need no meeting place any more and go anywhere.
            spread = np.where(differs, mixed(np.arange(len(key), dtype=np.uint64)), np.uint64(0))
            rows = pa.RecordBatch.from_arrays(
                [pa.array(spread.view(np.int64)), pa.array(key.view(np.int64)),
                 ids.take(pa.array(text)), other, pa.array(place - place[head], pa.int32()),
                 *(pa.array(found[c], pa.int32()) for c in ("place", "left", "right", "function"))],
                names=["spread", "key", "id", "other", "shift", "place", "left", "right",
                       "function"])
            for at in range(0, rows.num_rows, 1 << 15):
                yield rows.slice(at, 1 << 15)

    met = mapped(plain, local, f"spread long, key long, id {kind}, other {kind}, shift int, "
                               "place int, left int, right int, function int")
    sorted_ = met.repartition("key", "spread").sortWithinPartitions(
        "key", F.col("other").isNotNull(), "id", "place")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in gathered(batches, 1 << 15):
            if last is not None:
                batch = pa.concat_batches([last, batch])
            key = batch.column("key").to_numpy()
            fresh = np.r_[True, key[1:] != key[:-1]]
            head = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            place = batch.column("place").to_numpy().astype(np.int64)
            ids = batch.column("id")
            heads = ids.take(pa.array(head))
            given = pa.compute.is_valid(batch.column("other")).to_numpy(False)
            differs = pa.compute.not_equal(ids, heads).to_numpy(False)
            meets = ~fresh & ~given & differs
            if last is not None:
                given[0] = False  # told with the batch before
            shift = np.where(given, batch.column("shift").to_numpy(), place - place[head])
            hit = [*(batch.column(c) for c in ("place", "left", "right", "function")),
                   pa.array(shift, pa.int32())]
            out = pa.RecordBatch.from_arrays(
                [ids, pa.compute.coalesce(batch.column("other"), heads), pa.StructArray.from_arrays(
                    hit, ["place", "left", "right", "function", "shift"])],
                names=["id", "other", "hit"])
            yield out.filter(pa.array(given | meets))
            last = batch.slice(int(head[-1]), 1)

    return mapped(sorted_, joined, f"id {kind}, other {kind}, hit {_HIT}")


class Ladder:
    """Words of several texts whose stretches can be compared by prefix hashes."""

    def __init__(self, parts: list[np.ndarray]):
        self.first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        whole = np.concatenate([np.empty(0, np.uint32), *parts]).astype(np.uint64)
        n = len(whole)
        back = np.full(n, _BACK, np.uint64)
        back[:1] = 1
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed(whole + np.uint64(1)) * np.multiply.accumulate(back), out=self.sums[1:])
        lift = np.full(n + 1, _STEP, np.uint64)
        lift[:1] = 1
        self.lift = np.multiply.accumulate(lift)

    def stretch(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Hash of ``length`` words from ``start`` on, wherever they stand."""
        return (self.sums[start + length] - self.sums[start]) * self.lift[start]


def common(a: Ladder, i: np.ndarray, b: Ladder, j: np.ndarray, most: np.ndarray,
           back: bool = False) -> np.ndarray:
    """Equal words from ``i`` and ``j`` on (or before them, ``back``), at most ``most``."""
    out = np.zeros(len(i), np.int64)
    step = 1 << int(most.max(initial=0)).bit_length()
    while step:
        ok = np.flatnonzero(out + step <= most)
        go = out[ok]
        x, y = (i[ok] - go - step, j[ok] - go - step) if back else (i[ok] + go, j[ok] + go)
        size = np.full(len(ok), step)
        out[ok[a.stretch(x, size) == b.stretch(y, size)]] += step
        step >>= 1
    return out


# Words left out on both sides of an edit, smallest edits first.
_EDITS = sorted(((x, y) for x in range(GAP + 1) for y in range(GAP + 1) if x or y),
                key=lambda e: (max(e), sum(e), e))


def passages(own: Ladder, other: Ladder, which: np.ndarray, partner: np.ndarray, i: np.ndarray,
             j: np.ndarray, least: int, percent: int) -> tuple[np.ndarray, ...]:
    """Passages (which, start, end) around hits at word ``i`` of ``own`` and ``j`` of ``other``.

    ``which`` and ``partner`` are the texts the hits lie in.
    """
    low, high = own.first[which], own.first[which + 1]
    olow, ohigh = other.first[partner], other.first[partner + 1]
    fits = (i >= low) & (j >= olow) & (i + SHINGLE <= high) & (j + SHINGLE <= ohigh)
    which, i, j, low, high, olow, ohigh = (x[fits] for x in (which, i, j, low, high, olow, ohigh))
    after = common(own, i, other, j, np.minimum(high - i, ohigh - j))
    before = common(own, i, other, j, np.minimum(i - low, j - olow), back=True)
    start, end, ostart, oend = i - before, i + after, j - before, j + after
    # Hits of one run tell it once; chance hits have no run.
    _, once = np.unique(np.stack([which, start, ostart]), axis=1, return_index=True)
    once = once[(after >= SHINGLE)[once]]
    which, start, end, ostart, oend, low, high, olow, ohigh = (
        x[once] for x in (which, start, end, ostart, oend, low, high, olow, ohigh))
    shared = end - start - SHINGLE + 1
    five = np.int64(SHINGLE)
    active = {True: np.arange(len(which)), False: np.arange(len(which))}
    while len(active[True]) or len(active[False]):
        for forward in (True, False):
            at = active[forward]
            found = np.zeros(len(at), bool)
            x, y = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            rest = np.arange(len(at))
            for dx, dy in _EDITS:
                k = at[rest]
                if forward:
                    u, v = end[k] + dx, oend[k] + dy
                    inside = (u + five <= high[k]) & (v + five <= ohigh[k])
                else:
                    u, v = start[k] - dx - five, ostart[k] - dy - five
                    inside = (u >= low[k]) & (v >= olow[k])
                inside = np.flatnonzero(inside)
                size = np.full(len(inside), five)
                good = inside[own.stretch(u[inside], size) == other.stretch(v[inside], size)]
                found[rest[good]], x[rest[good]], y[rest[good]] = True, u[good], v[good]
                rest = np.delete(rest, good)
                if not len(rest):
                    break
            at, x, y = at[found], x[found], y[found]
            if forward:
                more = common(own, x, other, y, np.minimum(high[at] - x, ohigh[at] - y))
                new = (start[at], x + more, ostart[at], y + more)
            else:
                x, y = x + five, y + five
                more = common(own, x, other, y, np.minimum(x - low[at], y - olow[at]), back=True)
                new = (x - more, end[at], y - more, oend[at])
            both = shared[at] + more - SHINGLE + 1
            n, m = new[1] - new[0] - SHINGLE + 1, new[3] - new[2] - SHINGLE + 1
            ok = 100 * both >= percent * (n + m - both)
            at = at[ok]
            start[at], end[at], ostart[at], oend[at] = (x[ok] for x in new)
            shared[at] = both[ok]
            active[forward] = at
    whole = (end - start >= least) & (oend - ostart >= least)
    return which[whole], start[whole] - low[whole], end[whole] - low[whole]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _words_of(df: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, word hashes (32 bits each) and a hash of the text, of the ids in ``wanted``."""
    kind = df.schema[id_col].dataType.simpleString()
    wanted = wanted.select(F.xxhash64("id").alias("h")).distinct()
    may = df.sparkSession.sparkContext.broadcast(bloom(wanted, wanted.count()))
    plain = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(
        "id", "text", F.xxhash64("id").alias("h"), F.xxhash64("text").alias("text_hash"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, 1 << 16, TEXT_BYTES):
            chosen = may.value.may_hold(batch.column("h").to_numpy().view(np.uint64))
            batch = batch.filter(pa.array(chosen))
            w = words(batch.column("text"))
            short = w.hashes.astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"),
                 pa.array([short[a:b].tobytes() for a, b in
                           zip(w.first[:-1].tolist(), w.first[1:].tolist())], pa.binary())],
                names=["id", "text_hash", "words"])

    found = mapped(plain, work, f"id {kind}, text_hash long, words binary")
    return found.groupBy("id").agg(F.min(F.struct("text_hash", "words")).alias("own"))


_SPANS = "array<struct<start:int,end:int>>"
_PLACES = "array<struct<place:int,shift:int>>"


def verified(df: DataFrame, pairs: DataFrame, id_col: str, text_col: str, least: int,
             percent: int) -> DataFrame:
    """id, text_hash, other and spans of pairs (id, other, hits)."""
    kind = df.schema[id_col].dataType.simpleString()
    everyone = pairs.select("id").unionByName(pairs.select(F.col("other").alias("id")))
    texts = kept(_words_of(df, everyone, id_col, text_col), "words")
    copies = pairs.groupBy("other").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("copies"))
    copies = kept(copies, "copies")
    empty = F.array().cast(_PLACES)
    firsts = copies.join(texts, copies["other"] == texts["id"]).select(
        "other", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"),
        F.lit(None).cast(kind).alias("id"), F.lit(0).cast("long").alias("text_hash"),
        F.col("own.words").alias("words"), F.lit(0).alias("from"), empty.alias("hits"))
    begin = F.greatest(F.array_min("hits.place") - REACH, F.lit(0))
    end = F.array_max("hits.place") + REACH
    partners = pairs.join(copies, "other").join(texts, "id").select(
        "other", F.pmod(F.hash("id"), F.col("copies")).alias("copy"), "id", "own.text_hash",
        # Only the words between the outermost hits and a reach beyond.
        F.col("own.words").substr(begin * 4 + 1, (end - begin) * 4).alias("words"),
        begin.alias("from"), F.expr("transform(hits, h -> named_struct('place', h.place, 'shift', "
                                    "h.shift))").alias("hits"))
    streamed = firsts.unionByName(partners).repartition("other", "copy").sortWithinPartitions(
        "other", "copy", F.col("id").isNotNull())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None  # the first holder that was streamed last
        for batch in gathered(batches, 512, 4 << 20):
            firsts, own, rows, seeds = [], [], [], []
            if current is not None:
                firsts.append(current)
            is_first = (~pa.compute.is_valid(batch.column("id")).to_numpy(False)).tolist()
            starts = batch.column("from").to_pylist()
            lists = batch.column("hits")
            places, shifts = (lists.flatten().field(c).to_numpy(False).astype(np.int64)
                              for c in ("place", "shift"))
            edges = np.concatenate([[0], np.cumsum(
                pa.compute.list_value_length(lists).to_numpy(False))]).astype(np.int64)
            for n, data in enumerate(batch.column("words")):
                held = np.frombuffer(data.as_buffer(), np.uint32)
                if is_first[n]:
                    current = held
                    firsts.append(held)
                    continue
                place, shift = places[edges[n]:edges[n + 1]], shifts[edges[n]:edges[n + 1]]
                size = np.ones(len(place), np.int64)
                seeds.append((size * len(own), size * (len(firsts) - 1), place - starts[n],
                              place - shift))
                own.append(held)
                rows.append(n)
            if not rows:
                continue
            a, b = Ladder(own), Ladder(firsts)
            which, partner, i, j = (np.concatenate(x) for x in zip(*seeds))
            # Hits lie by their texts; a stretch that was cut starts at ``from``.
            which, start, end = passages(a, b, which, partner, i + a.first[which],
                                         j + b.first[partner], least, percent)
            spans: list[list] = [[] for _ in rows]
            for k, x, y in zip(which.tolist(), start.tolist(), end.tolist()):
                spans[k].append((x + starts[rows[k]], y + starts[rows[k]]))
            taken = pa.array([n for n, own_ in zip(rows, spans) if own_], pa.int64())
            out = [[{"start": x, "end": y} for x, y in _merged(own_)] for own_ in spans if own_]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(taken) for c in ("id", "text_hash", "other")),
                 pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                names=["id", "text_hash", "other", "spans"])

    return mapped(streamed.select("other", "id", "text_hash", "words", "from", "hits"), work,
                  f"id {kind}, text_hash long, other {kind}, spans {_SPANS}")


def _one_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with the text that counts for their id; only repeated ids' texts are looked at."""
    plain = df.select(id_col, text_col)
    several = kept(plain.groupBy(id_col).count().where("count > 1").select(id_col), "several")
    if several.isEmpty():
        return plain
    chosen = plain.join(several, id_col).groupBy(id_col).agg(
        F.min(F.xxhash64(text_col)).alias("_text_hash"))
    return plain.join(chosen, id_col, "left").where(
        F.coalesce(F.col("_text_hash") == F.xxhash64(text_col), F.lit(True))).select(id_col, text_col)


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
            percent: int = PERCENT, functions: int = FUNCTIONS) -> DataFrame:
    """id, text_hash and spans (start, end in words, of: an earlier id), if there are any."""
    df = _one_text(df, id_col, text_col)
    width, joint, open_, found = least - SHINGLE + 1, 1, None, []
    # Windows of two functions that overlap in a passage.
    overlap = ("size(hits) > 1 and exists(hits, a -> exists(hits, b -> a.function < b.function and "
               f"least(a.right, b.right) - greatest(a.left, b.left) + 1 >= {width}))")
    while True:
        with passing(df.sparkSession) as lasting:
            met = hits(df, id_col, text_col, least, max(functions, joint), joint, open_)
            enough = F.lit(True) if joint >= ENOUGH else F.expr(overlap)
            pairs = kept(met.groupBy("id", "other").agg(F.collect_list("hit").alias("hits"))
                         .withColumn("enough", enough), "pairs")
            if found and pairs.isEmpty():
                break
            found.append(lasting(verified(df, pairs.where("enough").drop("enough"), id_col,
                                          text_col, least, percent), "found"))
            # What no passage of the document covers may have another partner.
            covered = found[-1].groupBy("id").agg(
                F.flatten(F.collect_list("spans")).alias("spans"))
            uncovered = ("filter(hits, h -> not exists(spans, s -> h.place >= s.start and "
                         "h.place < s.end))")
            left = pairs.join(covered, "id", "left").withColumn(
                "spans", F.coalesce("spans", F.array().cast(_SPANS))).select(
                "id", F.explode(F.expr(uncovered)).alias("hit"))
            # Functions are taken together: two of the first ones, then all, then twice as many.
            joint = (2 * joint if joint >= functions else 2 if joint == 1 < functions // 2
                     else functions)
            if joint <= functions:
                left = left.where(F.col("hit.function") % joint == 0)
            open_ = lasting(left.groupBy("id").agg(F.collect_set(
                F.col("hit.function").cast("long") * F.lit(1 << 40) + F.col("hit.place"))
                .alias("places")), "open")
        if open_.isEmpty():
            break
        if joint > 2:
            # Later rounds read only the texts that still take part.
            df = kept(df.select(id_col, text_col).join(
                open_.select(F.col("id").alias(id_col)), id_col, "left_semi"), "texts")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    each = whole.select("id", "text_hash", "other", F.explode("spans").alias("span"))
    # Several rounds may tell parts of one passage of a pair.
    told = each.groupBy("id", "text_hash", "other").agg(F.sort_array(F.collect_set("span"))
                                                        .alias("spans"))
    each = told.select("id", "text_hash", "other", F.explode(_joined_spans("spans")).alias("span"))
    return each.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set(F.struct(
        F.col("span.start").alias("start"), F.col("span.end").alias("end"),
        F.col("other").alias("of")))).alias("spans")).withColumnRenamed("id", id_col)


def _joined_spans(spans: str):
    """Sorted spans, those that touch made one."""
    kind = "array<struct<start:int,end:int>>"
    return F.expr(
        f"aggregate({spans}, cast(array() as {kind}), (done, s) -> "
        "if(size(done) > 0 and s.start <= element_at(done, -1).end, "
        "concat(slice(done, 1, size(done) - 1), array(named_struct('start', "
        "element_at(done, -1).start, 'end', greatest(s.end, element_at(done, -1).end)))), "
        "concat(done, array(s))))")


def without_repeats(df: DataFrame, found: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``df`` with the spans of ``repeats`` cut out of the texts; first copies stay.

    Adds n_words_cut. White space before a cut goes with it. Texts without spans are not
    shuffled; ``found`` is kept, as it is read several times.
    """
    names, found = df.columns, kept(found, "repeats")
    spans = found.select(F.col(id_col).alias("_repeats_cut_id"), F.col("text_hash").alias("_repeats_cut_hash"),
                         F.col("spans").alias("_repeats_cut_spans"))
    may, others = parted(df, F.col(f"`{id_col}`"), spans, F.col("_repeats_cut_id"))
    texts = may.withColumn("_repeats_cut_hash", F.xxhash64(F.col(text_col)))
    joined = texts.join(spans, (F.col(id_col) == F.col("_repeats_cut_id")) & (
        texts["_repeats_cut_hash"] == spans["_repeats_cut_hash"]), "left").select(
        *[F.col(f"`{c}`") for c in names], "_repeats_cut_spans")
    at = names.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            column, spans = batch.column(at), batch.column(len(names)).to_pylist()
            lengths = np.zeros(len(spans), np.int64)
            some = [n for n, s in enumerate(spans) if s]
            if some:
                texts = column.to_pylist()
                w = words(column)
                raw, offsets = utf8(column)
                for n in some:
                    own = raw[offsets[n]:offsets[n + 1]].tobytes()
                    starts, ends = (x[w.first[n]:w.first[n + 1]] for x in (w.starts, w.ends))
                    kept_parts, last = [], 0
                    for a, b in _merged([(s["start"], s["end"]) for s in spans[n]]):
                        kept_parts.append(own[last:ends[a - 1] if a else 0])
                        last = ends[b - 1]
                        lengths[n] += b - a
                    kept_parts.append(own[last:])
                    texts[n] = b"".join(kept_parts).decode()
                column = pa.array(texts, column.type)
            arrays = [column if k == at else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(lengths)],
                                             names=[*names, "n_words_cut"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return mapped(joined, cut, f"{schema}, n_words_cut long").unionByName(
        others.withColumn("n_words_cut", F.lit(0).cast("long")))
