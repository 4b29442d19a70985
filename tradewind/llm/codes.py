"""Vectors as short codes: one codebook entry per part, found by slices and bitmasks.

A vector is cut into equal parts; a part is replaced by the number of the nearest of up to
64 entries of its codebook. To find it, the entries' coordinates are sorted per dimension,
and every place of that order carries a 64-bit mask of the entries before it. The distance
to entries that are near in one dimension gives a first radius; no entry within it can
differ by more in any dimension, so two binary searches per dimension select a range whose
mask is the difference of two prefix masks. The masks of all dimensions, ANDed, hold every
entry within the radius, the nearest one and its ties included; only these are measured.

Codebooks are improved in rounds: tasks sum up the parts of each entry over all rows they
read, Spark adds the sums, and the driver gets ``entries x components`` numbers, whatever
the number of rows. Everything is whole-number arithmetic, so results do not depend on
how rows are dealt to tasks.

Defined results: vectors that are null or hold null or non-finite components have no code.
Vectors shorter than the longest one, or than the next multiple of the number of parts,
count as filled up with zeros; an empty vector is all zeros. The first codebook has the
rows with the smallest ids, rows of one id in the order of their vectors, rows without
an id last. Repeated rows count each time. Ties go to the entry with the lower number.
Rows without a label have one error sum together. An empty table gives no rows. Other
columns are not passed on. Scaled components of 2**26 or more raise: their squares would
not add up exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tradewind.llm.frames import gathered, kept, mapped
from tradewind.llm.vectors import matrix, plain, widest

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
_ROWS = 4096
_LARGEST = 1 << 26
# Dimensions whose nearest entry is tried for the first radius.
_TRIED = 4


@dataclass
class Book:
    """The codebook of one part position: entries x dimensions."""

    entries: np.ndarray

    @cached_property
    def order(self) -> np.ndarray:
        return np.argsort(self.entries, axis=0, kind="stable")

    @cached_property
    def sorted(self) -> np.ndarray:
        return np.ascontiguousarray(np.take_along_axis(self.entries, self.order, axis=0).T)

    @cached_property
    def before(self) -> np.ndarray:
        """Per dimension and place: mask of the entries that stand before it."""
        bits = np.left_shift(np.uint64(1), self.order.T.astype(np.uint64))
        out = np.zeros((bits.shape[0], bits.shape[1] + 1), dtype=np.uint64)
        np.bitwise_or.accumulate(bits, axis=1, out=out[:, 1:])
        return out

    def distance(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return ((x - self.entries[entry]) ** 2).sum(axis=1)

    def radius(self, x: np.ndarray) -> np.ndarray:
        """Whole numbers no smaller than the distance to the nearest entry."""
        best = self.distance(x, np.zeros(len(x), np.int64))
        last = len(self.entries) - 1
        for d in range(min(x.shape[1], _TRIED)):
            place = np.minimum(np.searchsorted(self.sorted[d], x[:, d]), last)
            np.minimum(best, self.distance(x, self.order[place, d]), out=best)
        return np.floor(np.sqrt(best.astype(np.float64))).astype(np.int64) + 1

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """Masks of the entries that no dimension rules out."""
        reach = self.radius(x)
        mask = np.full(len(x), self.before[0, -1] if len(self.before) else
                       np.uint64((1 << len(self.entries)) - 1), dtype=np.uint64)
        for d, (values, before) in enumerate(zip(self.sorted, self.before)):
            low = np.searchsorted(values, x[:, d] - reach, side="left")
            high = np.searchsorted(values, x[:, d] + reach, side="right")
            mask &= before[high] ^ before[low]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry of each row and the squared distance to it."""
        mask, rows = self.candidates(x), np.arange(len(x))
        found = np.zeros(len(x), dtype=np.int64)
        best = np.full(len(x), np.iinfo(np.int64).max)
        while len(rows):
            lowest = mask & (~mask + np.uint64(1))
            entry = np.frexp(lowest.astype(np.float64))[1] - 1
            far = self.distance(x[rows], entry)
            # Entries come in ascending order, so an equal one does not replace the first.
            nearer = far < best[rows]
            best[rows[nearer]], found[rows[nearer]] = far[nearer], entry[nearer]
            mask = mask ^ lowest
            rows, mask = rows[mask != 0], mask[mask != 0]
        return found, best


@dataclass
class Codebooks:
    """parts x entries x dimensions of one part."""

    entries: np.ndarray
    scale: int = SCALE

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    @cached_property
    def books(self) -> list[Book]:
        return [Book(e) for e in self.entries]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1))).encode()).hexdigest()

    def cut(self, column: pa.Array) -> np.ndarray:
        """rows x parts x dimensions."""
        rows = matrix(column, self.width, self.scale)
        if np.abs(rows).max(initial=0) >= _LARGEST:
            raise ValueError(f"components times {self.scale} must stay below {_LARGEST}")
        return rows.astype(np.int64).reshape(len(rows), len(self.entries), -1)

    def assigned(self, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance per row and part."""
        both = [book.nearest(np.ascontiguousarray(cut[:, p]))
                for p, book in enumerate(self.books)]
        return np.stack([b[0] for b in both], 1), np.stack([b[1] for b in both], 1)


def first_books(rows: DataFrame, parts: int, entries: int, scale: int) -> Codebooks | None:
    """The parts of the rows with the smallest ids; None if there are no rows."""
    if not 1 <= entries <= 64:
        raise ValueError("a codebook has 1 to 64 entries, one per bit of its masks")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return None
    empty = np.zeros((parts, 1, -(-widest(rows) // parts)), np.int64)
    cut = Codebooks(empty, scale).cut(pa.array([r["vector"] for r in first],
                                               pa.list_(pa.float64())))
    return Codebooks(np.ascontiguousarray(cut.transpose(1, 0, 2)), scale)


def improved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry becomes the mean of the parts nearest to it, rounded down."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, _ = books.entries.shape
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros_like(books.entries)
        for batch in gathered(batches, _ROWS):
            cut = books.cut(batch.column("vector"))
            found, _ = books.assigned(cut)
            for p in range(parts):
                counts[p] += np.bincount(found[:, p], minlength=entries)
                np.add.at(sums[p], found[:, p], cut[:, p])
        used = np.flatnonzero(counts)
        place = np.arange(sums.shape[2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, len(place)), pa.int32()),
             pa.array(np.tile(place, len(used)), pa.int32()),
             pa.array(np.repeat(counts.reshape(-1)[used], len(place)), pa.int64()),
             pa.array(sums.reshape(counts.size, len(place))[used].reshape(-1), pa.int64())],
            names=["entry", "place", "n", "total"])

    totals = (mapped(rows.select("vector"), work, "entry int, place int, n long, total long")
              .groupBy("entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    parts, entries, size = books.entries.shape
    out = books.entries.copy().reshape(parts * entries, size)
    for r in totals.collect():  # at most entries x components rows
        out[r["entry"], r["place"]] = r["total"] // r["n"]
    return Codebooks(out.reshape(books.entries.shape), books.scale)


def trained(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
            scale: int = SCALE) -> Codebooks | None:
    """Codebooks of all ``rows`` (id, vector), as ``vectors.plain`` gives them."""
    books = first_books(rows, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = improved(rows, books)
    return books


def coded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``rows`` with entries (numbers by part) and error instead of the vector."""
    others = rows.drop("vector").schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, _ROWS):
            found, far = books.assigned(books.cut(batch.column("vector")))
            code = [row.tobytes() for row in found.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in others), pa.array(code, pa.binary()),
                 pa.array(far.sum(axis=1), pa.int64())],
                names=[*others.names, "code", "error"])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in others]
    return mapped(rows, work, ", ".join([*kinds, "code binary", "error long"]))


def restored(code: Column, books: Codebooks) -> Column:
    """The vector that a code stands for, in the scale of the codebooks."""
    per_part = [F.array(*(F.array(*map(F.lit, e.tolist())) for e in book))
                for book in books.entries]
    cells = [F.element_at(own, F.conv(F.hex(F.substring(code, p + 1, 1)), 16, 10).cast("int") + 1)
             for p, own in enumerate(per_part)]
    return F.flatten(F.array(*cells))


def compressed(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
               label_col: str = "label") -> DataFrame:
    """id, code (hex), error, label_error (summed over equal labels) and codebooks_sha256."""
    rows = plain(df, id_col, vector_col, label=F.col(label_col))
    books = trained(rows)
    if books is None:
        books = Codebooks(np.zeros((PARTS, 1, 0), np.int64))
    own = kept(coded(rows, books), "coded")
    sums = own.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return own.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_col), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"))
