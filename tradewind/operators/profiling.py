"""Profiles of raw tables. Each report is one aggregate pass over its table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.columns import count_where, half_up, percent, ratio
from tradewind.operators.cleaning import coercion_failures, null_shares


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _long(counts: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """One row per entry from a one-row frame of counts."""
    return counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def profile_schema(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Type, filled and empty values of every column."""
    parts = []
    for name, df in tables.items():
        kinds = F.create_map(*[F.lit(x) for pair in _types(df) for x in pair])
        parts.append(
            null_shares(df, df.columns)
            .unpivot("rows", df.columns, "column_name", "null_count")
            .withColumns({
                "table_name": F.lit(name),
                "data_type": F.element_at(kinds, F.col("column_name")),
            })
        )
    return _union(parts).select(
        "table_name", "column_name", "data_type",
        (F.col("rows") - F.col("null_count")).alias("non_null_count"), "null_count",
        percent(F.col("null_count"), F.col("rows")).alias("null_pct"),
    )


def _types(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def missing_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Only the columns that have empty values."""
    return profile_schema(tables).filter(F.col("null_count") > 0).select(
        "table_name", "column_name", "null_count", "null_pct"
    )


# Fields that should never be empty, by table.
CRITICAL_FIELDS = {
    "orders": ("order_id", "customer_id", "order_purchase_timestamp", "order_status"),
    "order_items": ("order_id", "product_id", "seller_id", "price", "freight_value"),
    "customers": ("customer_id", "customer_city", "customer_state"),
    "products": ("product_id", "product_category_name"),
}


def critical_null_report(
    tables: Mapping[str, DataFrame], fields: Mapping[str, Sequence[str]] = CRITICAL_FIELDS
) -> DataFrame:
    parts = []
    for name, columns in fields.items():
        df = tables[name]
        present = [c for c in columns if c in df.columns]
        parts.append(_long(null_shares(df, present), [
            F.struct(
                F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                F.col(c).alias("null_count"),
            )
            for c in present
        ]))
    return _union(parts).withColumn(
        "status", F.when(F.col("null_count") == 0, "No missing").otherwise("Missing values")
    )


def null_correlation(
    df: DataFrame, looked_up: Sequence[tuple[DataFrame, str]] = ()
) -> DataFrame:
    """Correlation of the empty-value indicators of every pair of columns, over
    ``df`` left-joined with other tables on a shared key each.

    Every table is reduced to its keys and the numbers of its empty columns
    before it is joined, so no text travels. Rows are then counted per pattern
    of empty columns, and the pairs are worked out over few patterns. A column
    that is always or never empty has no correlation (null).
    """
    columns = list(df.columns)
    keys = [key for _, key in looked_up]
    # Entry 0 is in every pattern, so pairing with it counts rows and single columns.
    base = [F.lit(0), *_empty_numbers(columns, 1)]
    joined = df.select(*keys, F.array_compact(F.array(*base)).alias("empty"))
    for other, key in looked_up:
        names = [c for c in other.columns if c != key]
        first = len(columns) + 1
        # A missing row leaves all of its columns empty.
        absent = F.array(*[F.lit(i) for i in range(first, first + len(names))])
        part = other.select(
            key, F.array_compact(F.array(*_empty_numbers(names, first))).alias("part")
        )
        joined = joined.join(part, key, "left").withColumn(
            "empty", F.concat("empty", F.coalesce("part", absent))
        ).drop("part")
        columns += names
    patterns = joined.groupBy("empty").agg(F.count("*").alias("n"))
    together = (
        patterns.select("n", "empty", F.explode("empty").alias("a"))
        .select("n", "a", F.explode("empty").alias("b"))
        .filter("a <= b")
        .groupBy(F.struct("a", "b").alias("pair"))
        .agg(F.sum("n").alias("n"))
    )
    # At most one entry per pair of columns.
    counts = together.agg(F.map_from_entries(F.collect_list(F.struct("pair", "n"))).alias("m"))
    pairs = df.sparkSession.createDataFrame(
        [(a, b, i, j) for (i, a), (j, b) in combinations(enumerate(columns, 1), 2)],
        "column_a string, column_b string, i int, j int",
    )

    def rows_with(a: Column, b: Column) -> Column:
        found = F.try_element_at("m", F.struct(a.alias("a"), b.alias("b")))
        return F.coalesce(found, F.lit(0)).cast("double")

    zero = F.lit(0)
    rows, x, y, both = F.col("rows"), F.col("x"), F.col("y"), F.col("both")
    return (
        pairs.withColumn("m", counts.scalar())
        .select(
            "column_a", "column_b",
            rows_with(zero, zero).alias("rows"),
            rows_with(zero, F.col("i")).alias("x"),
            rows_with(zero, F.col("j")).alias("y"),
            rows_with(F.col("i"), F.col("j")).alias("both"),
        )
        .select(
            "column_a", "column_b",
            half_up(
                F.try_divide(
                    rows * both - x * y, F.sqrt(x * (rows - x)) * F.sqrt(y * (rows - y))
                ), 6,
            ).alias("correlation"),
        )
    )


def _empty_numbers(columns: Sequence[str], first: int) -> list[Column]:
    """Number of each column, counted from ``first``, where it is empty."""
    return [F.when(F.col(c).isNull(), F.lit(i)) for i, c in enumerate(columns, first)]


# The columns that identify a row, by table.
KEY_COLUMNS = {
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id"),
    "customers": ("customer_id",),
    "products": ("product_id",),
}


def duplicate_report(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] = KEY_COLUMNS
) -> DataFrame:
    """Rows beyond the first of each key."""
    parts = []
    for name, key in keys.items():
        per_key = tables[name].groupBy(*key).agg(F.count("*").alias("n"))
        extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
        parts.append(per_key.agg(extra.alias("duplicate_rows")).select(
            F.lit(name).alias("table_name"), "duplicate_rows",
            F.when(F.col("duplicate_rows") == 0, "No duplicates")
            .otherwise("DUPLICATES FOUND").alias("status"),
        ))
    return _union(parts)


# The timestamp columns to test, by table.
TIMESTAMP_COLUMNS = {
    "orders": ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date"),
    "payments": ("order_payment_time",),
    "reviews": ("review_creation_date", "review_answer_timestamp"),
}


def timestamp_report(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] = TIMESTAMP_COLUMNS
) -> DataFrame:
    """Unreadable timestamps per column; absent columns are left out."""
    parts = [
        coercion_failures(tables[name], name, names)
        for name, names in columns.items()
        if any(c in tables[name].columns for c in names)
    ]
    return _union(parts).withColumn(
        "status", F.when(F.col("invalid_count") == 0, "OK").otherwise("INVALID")
    )


def price_report(items: DataFrame) -> DataFrame:
    price, freight = F.col("price"), F.col("freight_value")
    return items.agg(
        count_where(price < 0).alias("negative_prices"),
        count_where(price == 0).alias("zero_prices"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        ratio(F.sum(price), F.count(price), 2).alias("mean_price"),
        count_where(freight < 0).alias("negative_freight"),
        F.min(freight).alias("min_freight"),
        F.max(freight).alias("max_freight"),
        ratio(F.sum(freight), F.count(freight), 2).alias("mean_freight"),
    )


def relationship(
    name: str, children: DataFrame, child_key: str, parents: DataFrame, parent_key: str
) -> DataFrame:
    """How the rows of one table refer to another.

    Both sides are reduced to one row per key before they meet, so the join is
    one to one however often a key is used.
    """
    used = children.groupBy(F.col(child_key).alias("key")).agg(F.count("*").alias("n"))
    known = parents.groupBy(F.col(parent_key).alias("key")).agg(F.lit(1).alias("known"))
    both = used.join(known, "key", "full")
    matched, linked = F.col("known").isNotNull(), F.col("n").isNotNull()
    return both.agg(
        count_where(linked & F.col("key").isNotNull()).alias("child_keys"),
        count_where(matched & F.col("key").isNotNull()).alias("parent_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("child_rows"),
        F.coalesce(F.sum(F.when(matched, F.col("n"))), F.lit(0)).alias("matched_rows"),
        count_where(linked & ~matched & F.col("key").isNotNull()).alias("orphan_keys"),
        ratio(F.sum("n"), F.count("n"), 2).alias("avg_children"),
        F.max("n").alias("max_children"),
        count_where(F.col("n") > 1).alias("parents_with_several"),
        count_where(matched & ~linked).alias("parents_without"),
    ).select(F.lit(name).alias("relationship"), "*")


def relationship_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The four relationships of the raw model."""
    links = (
        ("customers <- orders", "orders", "customer_id", "customers", "customer_id"),
        ("orders <- order_items", "order_items", "order_id", "orders", "order_id"),
        ("products <- order_items", "order_items", "product_id", "products", "product_id"),
        ("orders <- payments", "payments", "order_id", "orders", "order_id"),
    )
    return _union([
        relationship(name, tables[child], ck, tables[parent], pk)
        for name, child, ck, parent, pk in links
    ])
