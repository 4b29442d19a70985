"""Reading the nine raw CSV tables, and small reports on what was read."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tradewind.functions.columns import half_up, percent
from tradewind.operators.cleaning import DataQualityError, null_shares
from tradewind.schemas import FILE_ORDER, MULTILINE_TABLES, RAW_SCHEMAS

log = logging.getLogger(__name__)

CORRUPT = "_corrupt_record"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the path names."""
    system, hadoop_path = _hadoop(spark, path)
    return system.exists(hadoop_path)


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it exists."""
    system, hadoop_path = _hadoop(spark, path)
    system.delete(hadoop_path, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names within a folder; none if it does not exist."""
    system, hadoop_path = _hadoop(spark, path)
    if not system.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in system.listStatus(hadoop_path)]


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, or of the first file of a folder."""
    head = spark.read.option("header", False).option("escape", '"').option("quote", '"').csv(path)
    first = head.limit(1).collect()
    return [str(c).lstrip("\ufeff").strip() for c in first[0] if c is not None] if first else []


def read_table(
    spark: SparkSession, path: str, table: str, mode: str = "FAILFAST",
    one_line_records: bool = False,
) -> DataFrame:
    """One raw CSV table with its declared schema, columns matched by their names.

    The header decides where a column stands; further columns are left out, and a
    declared one that the header lacks raises with its name. The files of a folder share
    one header. FAILFAST stops at a malformed row in every action: counts parse all
    columns, too. PERMISSIVE keeps such a row, padded with nulls, and puts its text into
    ``_corrupt_record``. Tables with free text are read as records of several lines, a
    file per task; ``one_line_records`` states that none has a line break, which makes
    large files splittable.
    """
    schema = RAW_SCHEMAS[table]
    header = read_header(spark, path)
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise DataQualityError(f"{path}: {table} lacks the columns {missing}; it has {header}")
    kinds = {f.name: f for f in schema.fields}
    in_file = T.StructType([kinds.get(c, T.StructField(f"_other_{k}", T.StringType()))
                            for k, c in enumerate(header)])
    if mode.upper() == "PERMISSIVE":
        in_file = in_file.add(CORRUPT, "string")
    rows = (
        spark.read.schema(in_file)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("escape", '"')
        # Without pruning a malformed row is met whatever columns a query asks for.
        .option("columnPruning", False)
        .option("multiLine", table in MULTILINE_TABLES and not one_line_records)
        .csv(path)
    )
    extra = [CORRUPT] if mode.upper() == "PERMISSIVE" else []
    return rows.select(*schema.names, *extra)


def read_tables(
    spark: SparkSession, folder: str, mode: str = "FAILFAST",
    files: Mapping[str, str] | None = None, file_order: bool = False,
) -> dict[str, DataFrame]:
    """All nine raw tables; a missing file raises before anything is read.

    With ``file_order`` rows know their place in the files, and cleaning keeps
    the first row of a key as it stands there.
    """
    names = {t: f"{t}.csv" for t in RAW_SCHEMAS} | dict(files or {})
    paths = {t: f"{folder.rstrip('/')}/{n}" for t, n in names.items()}
    for path in paths.values():
        if not path_exists(spark, path):
            raise FileNotFoundError(f"CSV file not found: {path}")
    tables = {t: read_table(spark, path, t, mode) for t, path in paths.items()}
    return {t: with_file_order(df) for t, df in tables.items()} if file_order else tables


def with_file_order(df: DataFrame, name: str = FILE_ORDER) -> DataFrame:
    """Position of each row in its source files, for keep-first rules.

    Row ids grow within a split, and splits are told apart by file and offset,
    so the order does not depend on how splits are scheduled.
    """
    return df.withColumn(
        name,
        F.struct("_metadata.file_path", "_metadata.file_block_start",
                 F.monotonically_increasing_id().alias("row")),
    )


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of every table."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    ])


def table_contents(tables: Mapping[str, DataFrame]) -> DataFrame:
    """What every column of every table holds: values, their sum or their characters."""
    parts = []
    for name, df in tables.items():
        sums = []
        for f in df.schema.fields:
            c = F.col(f"`{f.name}`")
            text = isinstance(f.dataType, T.StringType)
            sums.append(F.struct(
                F.lit(f.name).alias("column_name"), F.count("*").alias("n_rows"),
                F.count(c).alias("n_present"),
                (F.sum(F.length(c)) if text else F.lit(None)).cast("long").alias("n_characters"),
                (F.lit(None) if text else half_up(F.sum(c.cast("double")), 2)).cast("double")
                .alias("total"),
            ))
        parts.append(df.agg(F.array(*sums).alias("columns")).select(
            F.lit(name).alias("table_name"), F.explode("columns").alias("c")
        ).select("table_name", "c.*"))
    return reduce(DataFrame.unionByName, parts)


def dataset_info(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and share of null cells of every table."""
    parts = []
    for name, df in tables.items():
        empty = reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in df.columns])
        parts.append(null_shares(df, df.columns).select(
            F.lit(name).alias("table_name"), F.col("rows").alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"), empty.alias("empty"),
        ))
    cells = F.col("n_rows") * F.col("n_columns")
    return reduce(DataFrame.unionByName, parts).select(
        "table_name", "n_rows", "n_columns",
        percent(F.col("empty"), cells, 4).alias("null_percentage"),
    )


def write_dataset_info(tables: Mapping[str, DataFrame], path: str) -> DataFrame:
    """The same report, stored as JSON lines."""
    info = dataset_info(tables)
    info.coalesce(1).write.mode("overwrite").json(path)
    return info


def sample_rows(df: DataFrame, key: list[str], n: int = 1000) -> DataFrame:
    """First n rows in key order, so that the sample is the same on every run."""
    return df.orderBy(*key).limit(n)


