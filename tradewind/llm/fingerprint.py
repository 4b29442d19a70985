"""Document fingerprints: invertible Bloom lookup sketches of paragraph pieces.

A paragraph is a line; a longer one is cut behind words whose hash says so, about every
four words and after eight at most, so an edit changes the pieces it touches and few
others. Each piece, with the
number of times it came before, has a 64-bit digest. A sketch has cells in three parts;
a digest is added to one cell of each part: its count, the exclusive or of the digests,
and that of their checks. Sketches of two versions subtract cell by cell, and peeling
recovers the digests that only one of them has: a cell with one digest gives it away,
which takes it out of its other cells.

A sketch too small for the difference does not peel to nothing. Both are then rebuilt
eight times as large, from the texts, until they do; the number of digests bounds it.
Stored fingerprints are compared without the texts (``subtracted``), which gives the
differing digests of either side, or tells that larger sketches are needed;
``differing`` rebuilds them from the texts.

Likeness is the share of digests, of all that either text has, that both have; two texts
without a piece are alike. Equal texts have equal fingerprints. A null text is an empty
one. All texts of a batch are sketched and peeled side by side.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, functions as F

from tradewind.llm.frames import gathered, mapped, slices
from tradewind.llm.words import mixed, utf8, words

CELLS = 48
PARTS = 3
GROWTH = 8
CUT_EVERY = 4
LONGEST = 8
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_CHECK = np.uint64(0x27D4EB2F165667C5)
_WHOLE = np.uint64(0xFFFFFFFFFFFFFFFF)


def piece_digests(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the pieces of each text, and where each text's digests start."""
    w = words(column, fold=False)
    n_texts, n = len(w.first) - 1, len(w.hashes)
    if not n:
        return np.empty(0, np.uint64), np.zeros(n_texts + 1, np.int64)
    text = w.text_of()
    raw, offsets = utf8(column)
    lines = np.concatenate([[0], np.cumsum(raw == 0x0A)])
    line = lines[offsets[:-1][text] + w.starts]
    # A piece ends at the end of a line or text, or behind a word of a fitting hash.
    last = np.ones(n, dtype=bool)
    last[:-1] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
    last |= w.hashes % np.uint64(CUT_EVERY) == 0
    ends = np.flatnonzero(last) + 1
    starts = np.concatenate([[0], ends[:-1]])
    place = np.arange(n) - np.repeat(starts, ends - starts)
    starts = np.flatnonzero(place % LONGEST == 0)
    place %= LONGEST
    # The order of the words within their piece counts.
    digest = mixed(np.add.reduceat(mixed(w.hashes + place.astype(np.uint64) * _CHECK), starts))
    owner = text[starts]
    # The second copy of a piece is a digest of its own, and so on.
    order = np.lexsort((digest, owner))
    d, o = digest[order], owner[order]
    fresh = np.r_[True, (d[1:] != d[:-1]) | (o[1:] != o[:-1])]
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    copy = (np.arange(len(d)) - first).astype(np.uint64)
    return mixed(d + copy * _SEEDS[0]), np.searchsorted(o, np.arange(n_texts + 1))


def _cells(digests: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The cell of each digest in each part (digests x parts), ``sizes`` cells per part."""
    hashed = np.stack([mixed(digests ^ s) for s in _SEEDS], axis=1)
    sizes = sizes.astype(np.uint64)[:, None]
    return (hashed % sizes + np.arange(PARTS, dtype=np.uint64) * sizes).astype(np.int64)


class Sketches:
    """Sketches of several texts, one after the other; ``sizes`` cells per part."""

    def __init__(self, digests: np.ndarray, first: np.ndarray, sizes: np.ndarray):
        self.sizes = sizes
        self.base = np.concatenate([[0], np.cumsum(sizes * PARTS)])
        owner = np.repeat(np.arange(len(sizes)), np.diff(first))
        at = (_cells(digests, sizes[owner]) + self.base[owner][:, None]).ravel()
        total = int(self.base[-1])
        self.count = np.bincount(at, minlength=total).astype(np.int64)
        self.keys, self.checks = (_xor_at(at, np.repeat(v, PARTS), total)
                                  for v in (digests, mixed(digests + _CHECK)))
        self.mask = _WHOLE

    @classmethod
    def parsed(cls, texts: list[str]) -> Sketches:
        """Sketches from their texts, which hold the lower half of each check."""
        own = cls.__new__(cls)
        heads, bodies = zip(*(t.split(":", 1) for t in texts)) if texts else ((), ())
        own.sizes = np.array([int(h) for h in heads], dtype=np.int64)
        own.base = np.concatenate([[0], np.cumsum(own.sizes * PARTS)]).astype(np.int64)
        count, keys, checks = [], [], []
        for n, body in zip(own.sizes.tolist(), bodies):
            cells, raw = n * PARTS, base64.b64decode(body)
            if len(raw) != cells * 16:
                raise ValueError("a fingerprint whose length does not fit its size")
            count.append(np.frombuffer(raw, "<u4", cells))
            keys.append(np.frombuffer(raw, "<u8", cells, 4 * cells))
            checks.append(np.frombuffer(raw, "<u4", cells, 12 * cells))
        own.count = np.concatenate([*count, np.empty(0, np.uint32)]).astype(np.int64)
        own.keys = np.concatenate([*keys, np.empty(0, np.uint64)]).astype(np.uint64)
        own.checks = np.concatenate([*checks, np.empty(0, np.uint32)]).astype(np.uint64)
        own.mask = np.uint64(0xFFFFFFFF)
        return own

    def text(self, n: int) -> str:
        """One sketch as text: cells per part, then counts, digests and checks."""
        a, b = self.base[n], self.base[n + 1]
        body = b"".join((self.count[a:b].astype("<u4").tobytes(),
                         self.keys[a:b].astype("<u8").tobytes(),
                         self.checks[a:b].astype("<u4").tobytes()))
        return f"{self.sizes[n]}:{base64.b64encode(body).decode()}"


def _xor_at(at: np.ndarray, values: np.ndarray, total: int) -> np.ndarray:
    """Exclusive or of the values of each place."""
    out = np.zeros(total, dtype=np.uint64)
    np.bitwise_xor.at(out, at, values)
    return out


def peeled(a: Sketches, b: Sketches) -> tuple[np.ndarray, np.ndarray]:
    """Of each pair of sketches: how many digests differ, and whether all were recovered."""
    owner, _, _, whole = recovered(a, b)
    return np.bincount(owner, minlength=len(whole)), whole


def recovered(a: Sketches, b: Sketches) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Differing digests of pairs of sketches: number of the pair, digest, and 1 where the
    first sketch has it, -1 where the second has; and whether all of a pair were recovered."""
    mask = a.mask & b.mask
    count, keys, checks = a.count - b.count, a.keys ^ b.keys, a.checks ^ b.checks
    n = len(a.sizes)
    owner_of_cell = np.repeat(np.arange(n), a.sizes * PARTS)
    owners, digests, signs = ([np.empty(0, t)] for t in (np.int64, np.uint64, np.int64))
    at = np.flatnonzero(np.abs(count) == 1)
    while len(at):
        at = at[(checks[at] ^ mixed(keys[at] + _CHECK)) & mask == 0]
        if not len(at):
            break
        owner, key, sign = owner_of_cell[at], keys[at], count[at]
        # A digest that stands alone in several cells is taken out once.
        _, once = np.unique(mixed(key ^ owner.astype(np.uint64) * _SEEDS[2]), return_index=True)
        owner, key, sign = owner[once], key[once], sign[once]
        owners.append(owner)
        digests.append(key)
        signs.append(sign)
        cells = (_cells(key, a.sizes[owner]) + a.base[owner][:, None]).ravel()
        np.subtract.at(count, cells, np.repeat(sign, PARTS))
        np.bitwise_xor.at(keys, cells, np.repeat(key, PARTS))
        np.bitwise_xor.at(checks, cells, np.repeat(mixed(key + _CHECK), PARTS))
        at = np.unique(cells)
        at = at[np.abs(count[at]) == 1]
    left = np.bincount(owner_of_cell, weights=(count != 0) | (keys != 0), minlength=n)
    return np.concatenate(owners), np.concatenate(digests), np.concatenate(signs), left == 0


def likeness(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray],
             cells: int = CELLS) -> np.ndarray:
    """Shares of common digests of texts pair by pair, from peeled differences."""
    (dx, fx), (dy, fy) = x, y
    nx, ny = np.diff(fx), np.diff(fy)
    differ = np.zeros(len(nx), dtype=np.int64)
    open_ = np.arange(len(nx))
    size = np.full(len(nx), -(-cells // PARTS))
    while len(open_):
        own = [Sketches(*_chosen(d, f, open_), size) for d, f in ((dx, fx), (dy, fy))]
        found, whole = peeled(*own)
        differ[open_[whole]] = found[whole]
        # More cells than any difference needs peel; no sketch grows beyond them for good.
        open_, size = open_[~whole], size[~whole] * GROWTH
    both = (nx + ny - differ) / 2
    return np.where(nx + ny > 0, both / np.maximum(nx + ny - both, 1), 1.0)


def _chosen(digests: np.ndarray, first: np.ndarray, rows: np.ndarray):
    """Digests of some texts only."""
    counts = np.diff(first)[rows]
    starts = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(starts[-1]) + np.repeat(first[rows] - starts[:-1], counts)
    return digests[at], starts


def sketch_texts(digests: tuple[np.ndarray, np.ndarray], cells: int = CELLS) -> list[str]:
    values, first = digests
    own = Sketches(values, first, np.full(len(first) - 1, -(-cells // PARTS)))
    return [own.text(n) for n in range(len(first) - 1)]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 cells: int = CELLS) -> DataFrame:
    """id and fingerprint of each whole text."""
    kind = df.schema[id_col].dataType.simpleString()
    plain = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"),
                 pa.array(sketch_texts(piece_digests(batch.column("text")), cells))],
                names=["id", "fingerprint"])

    return mapped(plain, work, f"id {kind}, fingerprint string").withColumnRenamed("id", id_col)


DIFFERENCE = "whole boolean, only_left array<long>, only_right array<long>"


def _difference(a: Sketches, b: Sketches) -> tuple[np.ndarray, list[list], list[list]]:
    """Per pair: whether all came back, and the digests of either side (null if not)."""
    owner, digest, sign, whole = recovered(a, b)
    digest = digest.view(np.int64)
    sides = []
    for side in (1, -1):
        rows = np.flatnonzero(sign == side)
        rows = rows[np.lexsort((digest[rows], owner[rows]))]
        cuts = np.searchsorted(owner[rows], np.arange(len(whole) + 1))
        sides.append([digest[rows[x:y]].tolist() if ok else None
                      for x, y, ok in zip(cuts, cuts[1:], whole)])
    return whole, *sides


def _with_difference(batch: pa.RecordBatch, names: list[str], found) -> pa.RecordBatch:
    whole, left, right = found
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array(whole, pa.bool_()), pa.array(left, longs),
         pa.array(right, longs)], names=[*names, "whole", "only_left", "only_right"])


def _appended(df: DataFrame, work) -> DataFrame:
    own = [c for c in df.columns if c not in ("whole", "only_left", "only_right")]
    plain = df.select(*[F.col(f"`{c}`") for c in own])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return mapped(plain, lambda batches: work(batches, own), f"{fields}, {DIFFERENCE}")


def subtracted(df: DataFrame, left_col: str, right_col: str) -> DataFrame:
    """``df`` with what two columns of stored fingerprints differ in, without their texts.

    ``only_left`` and ``only_right`` hold the digests of the pieces that one side alone has,
    ascending, and ``whole`` is true. Where the sketches are too small for the difference,
    or of different sizes, ``whole`` is false and both are null: larger sketches are
    needed. A null fingerprint gives three nulls; a text that is no fingerprint raises.
    """
    def work(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            pairs = list(zip(*(batch.column(names.index(c)).to_pylist()
                               for c in (left_col, right_col))))
            known = [None not in p for p in pairs]
            fit = [ok and p[0].split(":", 1)[0] == p[1].split(":", 1)[0]
                   for ok, p in zip(known, pairs)]
            both = [p for p, ok in zip(pairs, fit) if ok]
            found = _difference(*(Sketches.parsed([p[side] for p in both]) for side in (0, 1)))
            spread = zip(*(x for x in found))
            rows = [next(spread) if f else (False if k else None, None, None)
                    for k, f in zip(known, fit)]
            columns = [list(x) for x in zip(*rows)] or [[], [], []]
            columns[0] = [None if x is None else bool(x) for x in columns[0]]
            yield _with_difference(batch, names, columns)

    return _appended(df, work)


def differing(df: DataFrame, left_col: str, right_col: str, cells: int = CELLS) -> DataFrame:
    """``df`` with the digests that only one of two columns of whole texts has.

    Columns as in ``subtracted``; sketches that are too small are rebuilt larger, so
    ``whole`` is always true. A null text is an empty one.
    """
    def work(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            sides = [piece_digests(pa.array([t or "" for t in batch.column(names.index(c))
                                             .to_pylist()], pa.string()))
                     for c in (left_col, right_col)]
            n = batch.num_rows
            left, right = [None] * n, [None] * n
            open_, size = np.arange(n), np.full(n, -(-cells // PARTS))
            while len(open_):
                whole, a, b = _difference(*(Sketches(*_chosen(d, f, open_), size)
                                            for d, f in sides))
                for k, i in enumerate(open_.tolist()):
                    left[i], right[i] = a[k], b[k]
                open_, size = open_[~whole], size[~whole] * GROWTH
            yield _with_difference(batch, names, ([True] * n, left, right))

    return _appended(df, work)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by the first as many characters of the next text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def in_a_ring(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (run, extra, id, text), partitioned and sorted, each text followed by the next.

    Ids (numbers) in ascending order, null first, rows of one id by the hash of their
    text, are cut into a few runs per partition at quantiles of the ids. The first row of
    a run stands once more, with ``extra``, at the end of the run before; that of the
    first run at the end of the last. The driver gets one row per run, and a text is
    shuffled once, but for the first of each run.
    """
    spark = df.sparkSession
    plain = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    runs_wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.unique(plain.approxQuantile(
        "id", [k / runs_wanted for k in range(1, runs_wanted)], 0.1 / runs_wanted)
        if runs_wanted > 1 else [])

    @F.pandas_udf("int")
    def run_of(ids: pd.Series) -> pd.Series:
        places = np.searchsorted(bounds, ids.to_numpy(np.float64, na_value=-np.inf), side="right")
        return pd.Series(places.astype(np.int32))

    cut = plain.select("id", "text", F.xxhash64("text").alias("h"), run_of("id").alias("run"))
    place = F.struct(F.col("id").isNotNull().alias("given"), "id", "h")
    heads = sorted(cut.groupBy("run").agg(F.min(place).alias("head")).collect(),
                   key=lambda r: r["run"])
    before = [(r["run"], heads[k - 1]["run"], r["head"]["id"], r["head"]["h"])
              for k, r in enumerate(heads)]
    kind = df.schema[id_col].dataType.simpleString()
    known = F.broadcast(spark.createDataFrame(
        before, f"run int, run_before int, head_id {kind}, head_h long"))
    is_head = F.col("id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h"))
    own = F.struct("run", F.lit(False).alias("extra"))
    again = F.struct(F.col("run_before").alias("run"), F.lit(True).alias("extra"))
    dealt = cut.join(known, "run").select("id", "text", "h", F.explode(
        F.when(is_head, F.array(own, again)).otherwise(F.array(own))).alias("to"))
    return dealt.select("to.run", "to.extra", "id", "text", "h").repartition("run"
        ).sortWithinPartitions("run", "extra", F.col("id").isNotNull(), "id", "h").select(
        "run", "extra", "id", "text")


def compared(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             cells: int = CELLS) -> DataFrame:
    """Fingerprints of texts and of their edited versions, and what they have in common.

    id, n_chars, fingerprint, edited_fingerprint, edited_sha256, near_edited, near_next:
    ``edited`` takes the head of the text that follows in the order of the ids.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in gathered(batches, 256):
            if last is not None:
                batch = pa.concat_batches([last, batch])
            for at in range(0, batch.num_rows - 1, 256):
                yield _compared(batch.slice(at, 257), cells)
            last = batch.slice(batch.num_rows - 1, 1)

    return mapped(in_a_ring(df, id_col, text_col), work,
                  f"id {kind}, n_chars long, fingerprint string, edited_fingerprint string, "
                  "edited_sha256 string, near_edited double, near_next double"
                  ).withColumnRenamed("id", id_col)


def _compared(batch: pa.RecordBatch, cells: int) -> pa.RecordBatch:
    """Results of all rows of the batch but the last and the extra ones."""
    texts = [t or "" for t in batch.column("text").to_pylist()]
    versions = [edited(t, after) for t, after in zip(texts, texts[1:])]
    all_, changed = piece_digests(pa.array(texts)), piece_digests(pa.array(versions))
    n = len(versions)
    own, following = (all_[0][:all_[1][n]], all_[1][:n + 1]), (
        all_[0][all_[1][1]:], all_[1][1:] - all_[1][1])
    out = pa.RecordBatch.from_arrays(
        [batch.column("id").slice(0, n), pa.array([len(t) for t in texts[:n]], pa.int64()),
         pa.array(sketch_texts(own, cells), pa.string()),
         pa.array(sketch_texts(changed, cells), pa.string()),
         pa.array([hashlib.sha256(v.encode()).hexdigest() for v in versions], pa.string()),
         pa.array(likeness(own, changed, cells)), pa.array(likeness(own, following, cells))],
        names=["id", "n_chars", "fingerprint", "edited_fingerprint", "edited_sha256",
               "near_edited", "near_next"])
    return out.filter(pa.compute.invert(batch.column("extra").slice(0, n)))
