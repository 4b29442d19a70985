"""Near-duplicates by min-max hashing, every link confirmed on the full shingle sets.

Each permutation of the 64-bit shingle hashes gives two signature values, the least and
the greatest hash of a set, so ``bands * rows`` values cost half as many hash
evaluations. Sets with equal values in a whole band meet in a bucket. At similarity
0.85 a pair misses all of 36 bands of 6 values once in 25 million pairs.

Documents of equal sets are one class from the start; the links between classes come
from ``buckets``, which leaves no partner out.

Documents have the shingle set of ``words``; fewer words than a shingle are one shingle.
Without words or text the set is empty: linked with nothing, its own component, kept.
Rows that repeat an id belong to whatever their texts belong to. A null id takes the
component of its class. An empty table gives no rows; other columns are not passed on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradewind.llm.buckets import SMALL, block_pairs, connected, members_of
from tradewind.llm.frames import bloom, kept, mapped, slices
from tradewind.llm.words import SHINGLE, mixed, shingle_sets, words

PERCENT = 85
BANDS, ROWS = 36, 6
# Sets, and shingles of all of them, that a block holds about.
BLOCK, BLOCK_SHINGLES = 256, 1 << 19


def multipliers(bands: int, rows: int) -> np.ndarray:
    """Odd factors: each permutes the 64-bit integers."""
    rng = np.random.default_rng(bands * 1000 + rows)
    n = -(-bands * rows // 2)
    return rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(values: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Bucket keys (sets x bands) of non-empty sets that start at ``starts``.

    The minima come first and the maxima after them, so the two values of a permutation
    stand in different bands.
    """
    factors = multipliers(bands, rows)
    signature = np.empty((2 * len(factors), len(starts)), dtype=np.uint64)
    for k, factor in enumerate(factors):
        hashed = values * factor
        signature[k] = np.minimum.reduceat(hashed, starts)
        signature[len(factors) + k] = np.maximum.reduceat(hashed, starts)
    keys = np.empty((len(starts), bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(len(starts), band + 1, dtype=np.uint64)
        for row in signature[band * rows:(band + 1) * rows]:
            key = mixed(key ^ row)
        keys[:, band] = key
    return keys


def digest_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """id, n_shingles, digest of the set (null if empty) and its bucket keys."""
    kind = df.schema[id_col].dataType.simpleString()
    plain = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            values, ends = shingle_sets(words(batch.column("text")), size)
            counts = np.diff(ends)
            filled = np.flatnonzero(counts)
            digests: list[bytes | None] = [None] * len(counts)
            for n in filled.tolist():
                digests[n] = digest_of(values[ends[n]:ends[n + 1]])
            if len(filled):
                keys = band_keys(values, ends[:-1][filled], bands, rows)
            else:
                keys = np.empty((0, bands), np.uint64)
            per_row = np.cumsum(np.r_[0, np.where(counts > 0, bands, 0)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(per_row, pa.int32()),
                                          pa.array(keys.ravel().view(np.int64)))],
                names=["id", "n_shingles", "digest", "keys"])

    return mapped(plain, work, f"id {kind}, n_shingles long, digest binary, keys array<long>")


def _short(digest):
    """The first eight bytes of a digest as a number."""
    return F.conv(F.hex(F.substring(digest, 1, 8)), 16, -10).cast("long")


def full_sets(df: DataFrame, wanted: DataFrame, text_col: str, size: int) -> DataFrame:
    """digest and shingles (binary) of the sets whose digest is in ``wanted``, once each.

    A filter of bounded size keeps most other texts from leaving their task.
    """
    wanted = wanted.select("digest").distinct()
    may = df.sparkSession.sparkContext.broadcast(
        bloom(wanted.select(_short("digest").alias("h")), wanted.count()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            values, ends = shingle_sets(words(batch.column("text")), size)
            filled = np.flatnonzero(np.diff(ends)).tolist()
            digests = [digest_of(values[ends[n]:ends[n + 1]]) for n in filled]
            heads = np.array([int.from_bytes(d[:8], "big") for d in digests], dtype=np.uint64)
            chosen = np.flatnonzero(may.value.may_hold(heads)) if filled else ()
            yield pa.RecordBatch.from_arrays(
                [pa.array([digests[k] for k in chosen], pa.binary()),
                 pa.array([values[ends[filled[k]]:ends[filled[k] + 1]].tobytes()
                           for k in chosen], pa.binary())],
                names=["digest", "shingles"])

    found = mapped(df.select(F.col(text_col).alias("text")), work,
                   "digest binary, shingles binary")
    return found.join(wanted, "digest", "left_semi").dropDuplicates(["digest"])


def _fits(a: str, b: str, percent: int) -> str:
    """Sizes that allow the similarity."""
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b of digests) whose full sets reach the similarity."""
    first = sets.select(F.col("digest").alias("a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("digest").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(second, "b").join(first, "a").select("a", "b", "set_a", "set_b")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            good = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return mapped(both, work, "a binary, b binary")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by columns of shared elements."""
    values = np.concatenate([*left, *right])
    _, column, counts = np.unique(values, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    shared = counts[column] > 1
    row, column = row[shared], column[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    width = 4096
    edges = np.searchsorted(column, np.arange(0, len(counts) + width, width))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        if a < b:
            block = np.zeros((len(left) + len(right), width), dtype=np.float32)
            block[row[a:b], column[a:b] - k * width] = 1
            out += block[:len(left)] @ block[len(left):].T
    return out


def block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across components within large buckets."""
    held = members.join(sets.withColumnRenamed("digest", "node"), "node")
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("load") / BLOCK_SHINGLES))
    both = block_pairs(held, "key", ["node", "component", "shingles"], blocks)

    def sets_of(own: list[dict]) -> list[np.ndarray]:
        return [np.frombuffer(x["shingles"], dtype=np.uint64) for x in own]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            a, b = batch.column("own_a")[0].as_py(), batch.column("own_b")[0].as_py()
            links = []
            if len({x["component"] for x in a} | {x["component"] for x in b}) > 1:
                sets_a, sets_b = sets_of(a), sets_of(b)
                shared = overlaps(sets_a, sets_b)
                total = np.add.outer([len(s) for s in sets_a], [len(s) for s in sets_b])
                links = [(a[i]["node"], b[j]["node"])
                         for i, j in np.argwhere(100 * shared >= percent * (total - shared))
                         if a[i]["component"] != b[j]["component"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in links], pa.binary()),
                 pa.array([y for _, y in links], pa.binary())], names=["a", "b"])

    return mapped(both.select("own_a", "own_b"), work, "a binary, b binary")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
                    small: int = SMALL, size: int = SHINGLE) -> DataFrame:
    """id, n_shingles, component_id (smallest id of the linked texts) and kept, per row."""
    signed = kept(signatures(df, id_col, text_col, bands, rows, size), "signatures")
    classes = kept(signed.where("n_shingles > 0").groupBy("digest").agg(
        F.min("id").alias("first_id"), F.max("n_shingles").alias("n"),
        F.min("keys").alias("keys")), "classes")
    members = members_of(classes.select(F.col("digest").alias("node"), "n",
                                        F.explode("keys").alias("key")))
    sets = kept(full_sets(df, members.select(F.col("node").alias("digest")), text_col, size),
                "sets")
    parts = connected(members, lambda pairs: confirmed(pairs, sets, percent),
                      lambda open_: block_links(open_, sets, percent),
                      lambda a, b: _fits(a, b, percent), small)

    named = classes.select("digest", "first_id").join(
        parts.withColumnRenamed("id", "digest"), "digest", "left").select(
        "digest", "first_id", F.coalesce("component", "digest").alias("component"))
    lowest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_class = named.join(lowest, "component").select("digest", "component_id")
    return signed.select("id", "n_shingles", "digest").join(of_class, "digest", "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component_id"))
        .alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
