"""Writing tables: full refresh, append, keyed upsert, and the layered warehouse."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tradewind.operators.cleaning import DataQualityError
from tradewind.schemas import STAGED_TABLES
from tradewind.session import counted_write, scratch_path, stored, stored_at, together
from tradewind.sources.files import children, delete_path, path_exists

RFM_EXPORT = (
    "customer_id", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
    "rfm_score", "segment", "customer_city", "customer_state",
)

FACT_PARTITION = "order_purchase_ym"


class Scratch:
    """Tables stored for one step; leaving the ``with`` block deletes them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error: object) -> None:
        for path in self.paths:
            delete_path(self.spark, path)

    def place(self, name: str) -> str:
        """A new path that goes with the block."""
        self.paths.append(scratch_path(self.spark, name))
        return self.paths[-1]

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """As ``session.stored``, for as long as the block lasts."""
        return stored_at(df, self.place(name))


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  fmt: str = "parquet", counts: Mapping[str, Column] | None = None,
                  dealt: bool = False) -> dict[str, int]:
    """Full refresh; returns ``counts`` over the rows, taken by the job that writes.

    ``dealt`` rows are rebalanced by the partition columns already.
    """
    if partition_by and not dealt:
        # Rebalancing gives each partition value few files, and splits a value
        # that holds far more rows than the others.
        df = df.hint("rebalance", *partition_by)

    def write(rows: DataFrame) -> None:
        writer = rows.write.mode("overwrite").format(fmt).partitionBy(*partition_by)
        if fmt == "csv":
            writer = writer.option("header", True).option("escape", '"')
        writer.save(path)

    return counted_write(df, counts or {}, write)


def append_table(df: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """Add rows; with ``keys`` only rows whose key is not stored yet.

    A key may occur once in ``df`` and hold no null; otherwise it raises.
    """
    spark = df.sparkSession
    if keys:
        df = stored(df, "append")  # checked, matched and written
        require_keys(df, keys)
        if path_exists(spark, path):
            df = df.join(spark.read.parquet(path).select(*keys), list(keys), "left_anti")
    df.write.mode("append").parquet(path)


# --- bucketed tables ---------------------------------------------------------
#
# Spark knows the buckets of a table from the catalog, so the number of buckets and the
# key are written beside the rows, and a later session names the table anew.

BUCKET_NOTE = "_buckets"


def bucketed_table(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Full refresh of a table bucketed and sorted by ``key``, one file per bucket."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    note = spark.createDataFrame([(key, buckets, df.schema.json())], "key string, n int, fields string")
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, key).sortBy(key).option("path", f"{path}/rows").saveAsTable(name))
    note.write.mode("overwrite").parquet(f"{path}/{BUCKET_NOTE}")
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``bucketed_table`` has written, with its buckets known."""
    note = spark.read.parquet(f"{path}/{BUCKET_NOTE}").first()
    name = f"bucketed_{uuid.uuid4().hex}"
    fields = T.StructType.fromJson(json.loads(note["fields"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    place = f"{path}/rows".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{note['key']}`) "
              f"SORTED BY (`{note['key']}`) INTO {note['n']} BUCKETS LOCATION '{place}'")
    return spark.table(name)


# --- versioned tables ------------------------------------------------------
#
# A version is a folder v=<n>. It counts only once Spark has put its _SUCCESS
# marker there, so a reader sees the old or the new table and nothing between.


def _versions(spark: SparkSession, path: str) -> list[int]:
    numbers = sorted(int(n[2:]) for n in children(spark, path)
                     if n.startswith("v=") and n[2:].isdigit())
    return [n for n in numbers if path_exists(spark, f"{path}/v={n}/_SUCCESS")]


def latest_version(spark: SparkSession, path: str) -> int:
    """Number of the latest finished version; 0 before the first."""
    return max(_versions(spark, path), default=0)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """Latest finished version of a table."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no finished version below {path}")
    return spark.read.parquet(f"{path}/v={versions[-1]}")


def load_existing(spark: SparkSession, path: str) -> DataFrame | None:
    """Latest finished version, or None if there is none yet."""
    return read_current(spark, path) if _versions(spark, path) else None


def previous_version(spark: SparkSession, path: str) -> DataFrame | None:
    """The finished version before the latest, if it is still there."""
    versions = _versions(spark, path)
    return spark.read.parquet(f"{path}/v={versions[-2]}") if len(versions) > 1 else None


def write_version(df: DataFrame, path: str, keep: int = 2,
                  read_back: bool = True) -> DataFrame | None:
    """Store the rows as the next version, drop all but the last ``keep``, read it back.

    A reader that opened the version before may finish; older ones are gone.
    """
    spark = df.sparkSession
    versions = _versions(spark, path)
    # A failed write leaves no marker, so its folder is overwritten here.
    number = (versions[-1] if versions else 0) + 1
    df.write.mode("overwrite").parquet(f"{path}/v={number}")
    for old in [*versions, number][:-keep]:
        delete_path(spark, f"{path}/v={old}")
    return read_current(spark, path) if read_back else None


def require_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs more than once or holds a null."""
    if not keys:
        return
    empty = " or ".join(f"`{k}` is null" for k in keys)
    worst = df.groupBy(*keys).count().agg(
        F.max(F.expr(empty)).alias("empty"), F.max("count").alias("count")).head()
    if worst["empty"]:
        raise DataQualityError(f"a key of {list(keys)} holds a null")
    if (worst["count"] or 0) > 1:
        raise DataQualityError(f"updates repeat a key of {list(keys)}")


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with the rows of ``updates`` inserted or, on a known key, replaced.

    A key may occur once in ``updates`` and hold no null; otherwise the result would be
    open.
    """
    if not keys:
        return updates
    require_keys(updates, keys)
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(updates.select(*target.columns))


# --- layers ----------------------------------------------------------------


def write_layers(
    folder: str, tables: Mapping[str, DataFrame], dims: Mapping[str, DataFrame],
    aggregates: Mapping[str, DataFrame], fact: DataFrame, fmt: str = "parquet",
) -> dict[str, str]:
    """Staging tables, dimensions, fact and aggregates below one folder; returns paths."""
    layers = {f"staging/raw_{t}": tables[t] for t in STAGED_TABLES if t in tables}
    layers |= {f"dwh/{name}": df for name, df in {**dims, **aggregates}.items()}
    calls = {
        place: partial(replace_table, df, f"{folder}/{place}", fmt=fmt)
        for place, df in layers.items()
    }
    place = "dwh/fact_order_items"
    calls[place] = partial(replace_table, fact, f"{folder}/{place}", (FACT_PARTITION,), fmt)
    together(calls)
    return {place.split("/")[1]: f"{folder}/{place}" for place in calls}


def export_rfm(rfm: DataFrame, path: str, fmt: str = "csv") -> None:
    """The eleven named RFM columns."""
    replace_table(rfm.select(*RFM_EXPORT), path, fmt=fmt)


def read_back(spark: SparkSession, path: str, like: DataFrame, fmt: str = "parquet") -> DataFrame:
    """A written table with the schema of the frame it came from."""
    reader = spark.read.schema(like.schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    return reader.load(path).select(*[F.col(c) for c in like.columns])
