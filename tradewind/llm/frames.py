"""What the operators share: reading, Arrow mapping, kept results, connected components."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewind.session import scratch_path, stored_at
from tradewind.sources.files import delete_path

# Rows and bytes handed to a Python worker at once: bounds its memory when texts are long.
ROWS_AT_ONCE, BYTES_AT_ONCE = 512, "1m"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def findable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Where executors have it elsewhere (installed, or by --py-files) this changes nothing.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])


def give_back() -> None:
    """Return what this process has freed to the system.

    Workers wait for their next task beside the executor's heap, and what a batch of long
    texts took would stay theirs.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mapped(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with batches of bounded length; memory is given back after each task."""
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    findable(df.sparkSession)
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_AT_ONCE)
    return df.mapInArrow(tidy, schema)


# Paths of the innermost ``passing`` block.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def kept(df: DataFrame, name: str) -> DataFrame:
    """Computed once, written to the shared folder and read back."""
    return _kept(df, name, _PASSING.get())


def _kept(df: DataFrame, name: str, paths: list[str] | None) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    if paths is not None:
        paths.append(path)
    return stored_at(df, path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """What is kept within the block is deleted when it ends.

    The block gets another ``kept``, for what is read after it: that lasts as long as what is
    kept around the block.
    """
    around, own = _PASSING.get(), []
    token = _PASSING.set(own)
    try:
        yield lambda df, name: _kept(df, name, around)
    finally:
        _PASSING.reset(token)
        for path in own:
            delete_path(spark, path)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def gathered(batches: Iterator[pa.RecordBatch], rows: int,
             most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``rows`` rows or ``most`` bytes."""
    held, n, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        size += batch.nbytes
        if n >= rows or size >= most:
            yield pa.concat_batches(held)
            held, n, size = [], 0, 0
    if n:
        yield pa.concat_batches(held)


# Links one task connects at once.
LINKS_PER_TASK = 500_000


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable id of every id that occurs in ``links``: columns id, component.

    Each task replaces the links it reads, a bounded number, by stars that connect the
    same ids. If that took one task, the stars are the components. Otherwise large-star
    and small-star rounds follow: a round sums up each node's neighbours to their minimum
    and joins it back, so no neighbourhood is ever gathered in one place, and its links
    are replaced by stars again. Every step is written to the shared folder.
    """
    edges = kept(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v"), "links")
    while True:
        tasks = -(-edges.count() // LINKS_PER_TASK)
        edges = kept(_as_stars(edges, tasks), "links")
        if tasks <= 1:
            return _labels(edges)
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = around.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        # Large star: larger neighbours are linked to the smallest one.
        large = (around.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # Small star: smaller neighbours and the node itself are linked to the smallest.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small, "u")
        edges = kept(joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(joined.select("u", F.col("m").alias("v")))
                     .where("u <> v").distinct(), "links")
        if _is_stars(edges):
            return _labels(edges)


def _as_stars(edges: DataFrame, tasks: int) -> DataFrame:
    """Links in as many tasks, each task's replaced by stars of the same components."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in edges.schema.fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= 2 * LINKS_PER_TASK:
                held, n = [_stars(held)], 0
        if held:
            yield _stars(held)

    # Neither the ids of one component nor anything else is shuffled here.
    return mapped(edges.coalesce(max(1, tasks)), work, schema)


def _stars(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    whole = pa.Table.from_batches(batches).combine_chunks()
    u, v = (whole.column(c).combine_chunks() for c in ("u", "v"))
    both = pa.concat_arrays([u, v]) if len(u) else u
    ids = pa.compute.unique(both)
    ids = ids.take(pa.compute.sort_indices(ids))
    codes = pa.compute.index_in(both, ids).to_numpy(False).astype(np.int64)
    a, b = codes[:len(u)], codes[len(u):]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all() and (label[a] == label[b]).all():
            break
    far = np.flatnonzero(label != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([ids.take(pa.array(far)), ids.take(pa.array(label[far]))],
                                      names=["u", "v"])


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour and no such neighbour has its own."""
    return edges.select("u", "v").groupBy("u").count().where("count > 1").isEmpty() and (
        edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty())


def _labels(edges: DataFrame) -> DataFrame:
    centres = edges.select("v").distinct().select(F.col("v").alias("id"),
                                                  F.col("v").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(centres)


# Bits of the largest filter that is sent to the tasks: 8 MB.
LARGEST_FILTER = 1 << 26
_PROBES = 4


class Bloom:
    """Which 64-bit hashes may belong to a set; of bounded size whatever the set.

    Beyond the largest size it passes more strangers, so what it lets through is always
    joined with the set itself afterwards.
    """

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(len(words) * 64 - 1)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), dtype=bool)
        for k in range(_PROBES):
            place = (hashes >> np.uint64(9 * k)) * np.uint64(2 * k + 1) & self.mask
            out &= (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))
                    & np.uint64(1)).astype(bool)
        return out


def bloom(hashes: DataFrame, count: int) -> Bloom:
    """Filter of the one long column of ``hashes``, of which there are about ``count``.

    The bits are put together by the aggregation; the driver gets one row per 64 bits.
    """
    bits = max(1 << 10, min(LARGEST_FILTER, 1 << (16 * max(count, 1)).bit_length()))
    name = hashes.columns[0]
    probes = F.array(*(
        (F.shiftrightunsigned(name, 9 * k) * F.lit(2 * k + 1)).bitwiseAND(F.lit(bits - 1))
        for k in range(_PROBES)))
    rows = (hashes.select(F.explode(probes).alias("place"))
            .groupBy(F.shiftright("place", 6).alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("word"))
            .collect())
    words = np.zeros(bits // 64, dtype=np.uint64)
    if rows:
        words[[r["at"] for r in rows]] = np.array([r["word"] for r in rows],
                                                  dtype=np.int64).view(np.uint64)
    return Bloom(words)


def parted(rows: DataFrame, key: Column, few: DataFrame, few_key: Column) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be among those of ``few``, and the others, which it lacks for sure.

    A join with ``few`` then shuffles the first ones only, not all rows with their texts.
    ``rows`` are read twice, and ``few`` twice besides the join. Keys of different types,
    whose hashes differ, are not told apart.
    """
    spark = rows.sparkSession
    if rows.select(key).schema[0].dataType != few.select(few_key).schema[0].dataType:
        return rows, rows.where(F.lit(False))
    findable(spark)
    hashes = few.select(F.xxhash64(few_key).alias("h")).distinct()
    shared = spark.sparkContext.broadcast(bloom(hashes, hashes.count()))

    @F.arrow_udf("boolean")
    def may(h: pa.Array) -> pa.Array:
        return pa.array(shared.value.may_hold(h.to_numpy(zero_copy_only=False).view(np.uint64)))

    marked = may(F.xxhash64(key))
    return rows.where(marked), rows.where(~marked)
