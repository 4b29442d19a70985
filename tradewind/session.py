"""Session settings, checkpoints and scratch tables.

Intermediate results that must not be computed twice (global orders, written
layers) go to the shared folder the session names in ``spark.checkpoint.dir``,
so they survive the loss of any executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession

T = TypeVar("T")

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# A hot join key is split at run time even when that costs one more shuffle.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time SQL settings the plans are designed for."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within the block shuffle files go with the query that read them, not with the
    driver's next garbage collection."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach.

    A temporary folder is used only for a local master with nothing configured.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="tradewind-")
        spark.sparkContext.setCheckpointDir(root)
        return root
    raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path below the shared folder."""
    return f"{shared_root(spark)}/tradewind/{name}-{uuid.uuid4().hex}"


def counted_write(
    df: DataFrame, counts: Mapping[str, Column], write: Callable[[DataFrame], None]
) -> dict[str, int]:
    """Write rows and count them in the same job; ``counts`` are aggregates by name.

    The counts are taken in the stage that writes, after every shuffle, so a task that is
    run again, or a lost executor, counts its rows once.
    """
    if not counts:
        write(df)
        return {}
    seen = Observation()
    names = {f"c{i}": name for i, name in enumerate(counts)}
    write(df.observe(seen, *(c.alias(short) for short, c in zip(names, counts.values()))))
    return {names[short]: n for short, n in seen.get.items()}


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a table in the shared folder and read it back.

    Unlike a checkpoint, the rows read back have a known size.
    """
    return stored_at(df, scratch_path(df.sparkSession, name))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """Write to a new table at ``path`` and read it back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(calls: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent actions side by side, so that small jobs fill the cluster.

    Results come back in the order given; the first failure is raised.
    """
    carry = inheritable_thread_target(SparkSession.getActiveSession())
    with ThreadPoolExecutor(max_workers=8) as pool:
        running = {name: pool.submit(carry(call)) for name, call in calls.items()}
        return {name: job.result() for name, job in running.items()}


def settle(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage with a reliable checkpoint."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)
