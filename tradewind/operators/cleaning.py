"""Validation and repair of raw tables: flag first, then impute.

Checks that must stop a run cost one aggregate pass per table. Repairs are
lazy column expressions; only mean and median need a value from the data.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tradewind.functions.columns import count_where, half_up, parse_timestamp, ratio
from tradewind.functions.text import text_features
from tradewind.operators.ordering import column_quantiles
from tradewind.schemas import DEFAULT_RULES, FILE_ORDER, MAX_NULL_CRITICAL, CleaningRules
from tradewind.session import settle, stored, together

log = logging.getLogger(__name__)

Keep = Callable[[str, DataFrame], DataFrame]
# As Keep, and returns the counts too, taken by the job that stored the rows.
CountedKeep = Callable[[str, DataFrame, Mapping[str, Column]],
                       tuple[DataFrame, Mapping[str, int]]]


# Repeated keys that every task may hold.
FEW_KEYS = 100_000
# Share of distinct keys, less the error of its estimate, from which on repeated ones are sought.
MOSTLY = 0.9


class DataQualityError(ValueError):
    """A table breaks a rule that must stop the run."""


# --- fail-fast checks ------------------------------------------------------


def null_shares(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row: row count and the null count of each field."""
    return df.agg(
        F.count("*").alias("rows"),
        *[F.expr(f"count_if(`{c}` IS NULL)").alias(c) for c in fields],
    )


def validate_critical(
    df: DataFrame, table: str, fields: Sequence[str], max_null: float = MAX_NULL_CRITICAL
) -> bool:
    """Raise if a field is absent or its null share is above the limit."""
    _raise_critical(table, _critical_faults(df, table, fields, max_null))
    return True


def critical_report(
    df: DataFrame, table: str, fields: Sequence[str], max_null: float = MAX_NULL_CRITICAL
) -> DataFrame:
    """Null share of every critical field and whether it passes."""
    present = [c for c in fields if c in df.columns]
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("field"),
            (F.col(c) if c in present else F.lit(None).cast("long")).alias("null_count"),
        )
        for c in fields
    ])
    share = ratio(F.col("null_count"), F.col("rows"))
    return (
        null_shares(df, present)
        .select(F.lit(table).alias("table_name"), "rows", F.explode(entries).alias("r"))
        .select("table_name", "r.field", "rows", "r.null_count")
        .withColumns({
            "null_pct": half_up(share * 100, 4),
            # An absent field fails; an empty table has no share and passes.
            "passed": F.when(F.col("null_count").isNull(), 0).otherwise(
                F.coalesce((share <= max_null).cast("int"), F.lit(1))
            ),
        })
    )


def _critical_faults(df, table, fields, max_null) -> list[str]:
    missing = [f"{table}.{c} is missing" for c in fields if c not in df.columns]
    if missing:
        return missing
    counts = null_shares(df, fields).first()
    return [
        f"{table}.{c} has {100 * counts[c] / counts.rows:.1f}% nulls, allowed {100 * max_null:.1f}%"
        for c in fields
        if counts.rows and counts[c] / counts.rows > max_null
    ]


def _raise_critical(table: str, faults: list[str]) -> None:
    if faults:
        raise DataQualityError("; ".join(faults))
    log.info("%s: critical fields are valid", table)


def outside(column: str, low: float, high: float) -> Column:
    """True where a value lies outside the bounds; null passes."""
    return (F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high))


def range_report(df: DataFrame, table: str, ranges: Mapping[str, tuple]) -> DataFrame:
    """Values outside the bounds per column."""
    bounds = {c: b for c, b in ranges.items() if c in df.columns}
    counts = df.agg(*[count_where(outside(c, *b)).alias(c) for c, b in bounds.items()])
    rows = F.explode(
        F.array(*[
            F.struct(
                F.lit(c).alias("field"),
                F.lit(float(low)).alias("min_value"),
                F.lit(float(high)).alias("max_value"),
                F.col(c).alias("violations"),
            )
            for c, (low, high) in bounds.items()
        ])
    )
    return counts.select(rows.alias("r")).select(F.lit(table).alias("table_name"), "r.*")


def validate_ranges(df: DataFrame, table: str, ranges: Mapping[str, tuple]) -> DataFrame:
    """Raise if any value lies outside its bounds."""
    counts = range_counts(df, ranges)
    if counts:
        found = df.agg(*(n.alias(c) for c, n in counts.items())).first()
        _raise_ranges(table, ranges, found.asDict())
    return df


def range_counts(df: DataFrame, ranges: Mapping[str, tuple]) -> dict[str, Column]:
    """Aggregates that count the values outside the bounds, by column."""
    return {c: count_where(outside(c, *b)) for c, b in ranges.items() if c in df.columns}


def _raise_ranges(table: str, ranges: Mapping[str, tuple], found: Mapping[str, int]) -> None:
    bad = [f"{table}.{c}: {n} values outside [{float(ranges[c][0])}, {float(ranges[c][1])}]"
           for c, n in found.items() if n]
    if bad:
        raise DataQualityError("; ".join(bad))


# --- repairs ---------------------------------------------------------------


def missing_flags(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """1 where a value is present, 0 where it is null."""
    return df.withColumns(
        {flag: F.col(c).isNotNull().cast("int") for c, flag in flags.items() if c in df.columns}
    )


def dedupe_first(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """Keep the first row of each key; null keys equal each other.

    Without ``order_by`` the other columns, in order, decide which row is first,
    so the choice does not depend on how the data is split. Where nearly all keys
    differ by an estimate, those that repeat are found and stored. If they are few, only
    their rows are sorted and shuffled; all others stay in their task. If they are many,
    Spark keeps one candidate row per key in each task before the shuffle, so a hot key
    costs at most one row per task. The estimate chooses the plan, not the rows.
    """
    order = [c for c in (order_by or df.columns) if c not in keys]
    first = W.partitionBy(*keys).orderBy(*order) if order else W.partitionBy(*keys).orderBy(*keys)

    def firsts(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_place", F.row_number().over(first)).filter("_place = 1").drop(
            "_place")

    if not keys:
        return firsts(df)
    seen = df.agg(F.count("*").alias("rows"),
                  F.approx_count_distinct(F.xxhash64(*keys), 0.02).alias("keys")).first()
    if seen["keys"] < seen["rows"] * MOSTLY - FEW_KEYS:
        return firsts(df)
    again = [f"_again_{i}" for i in range(len(keys))]
    repeated = stored(
        df.groupBy(*[F.col(k).alias(a) for k, a in zip(keys, again)])
        .agg(F.count("*").alias("_n")).filter("_n > 1").select(*again), "repeated")
    if repeated.count() > FEW_KEYS:
        return firsts(df)
    same = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(a)) for k, a in zip(keys, again)])
    few = F.broadcast(repeated)
    return firsts(df.join(few, same, "left_semi")).unionByName(df.join(few, same, "left_anti"))


def coerce_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns to timestamps; unreadable values become null."""
    kinds = dict(df.dtypes)
    return df.withColumns(
        {c: parse_timestamp(F.col(c)) for c in columns if kinds.get(c) == "string"}
    )


def impute_drop(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def impute_zero(df: DataFrame, column: str) -> DataFrame:
    kind = df.schema[column].dataType
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(0).cast(kind)))


def impute_unknown(df: DataFrame, column: str) -> DataFrame:
    if not isinstance(df.schema[column].dataType, T.StringType):
        return df
    return df.withColumn(column, F.coalesce(F.col(column), F.lit("unknown")))


def impute_keep(df: DataFrame, column: str) -> DataFrame:
    return df


def impute_flag(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<column>_is_missing``: 1 where the value is null. Always added."""
    return df.withColumns(
        {f"{c}_is_missing": F.col(c).isNull().cast("int") for c in columns if c in df.columns}
    )


def impute_mean(df: DataFrame, column: str) -> DataFrame:
    """Fill with the column mean; the column becomes a double."""
    return _fill_numeric(df, {column: "mean"})


def impute_median(df: DataFrame, column: str) -> DataFrame:
    """Fill with the exact median; the column becomes a double."""
    return _fill_numeric(df, {column: "median"})


def _fill_numeric(df: DataFrame, actions: Mapping[str, str]) -> DataFrame:
    """Fill columns with their own mean or median; text columns stay as they are."""
    numeric = {
        c: a for c, a in actions.items() if isinstance(df.schema[c].dataType, T.NumericType)
    }
    means = [c for c, a in numeric.items() if a == "mean"]
    fills: dict[str, float | None] = {}
    if means:
        row = df.agg(
            *[ratio(F.sum(c), F.count(c)).alias(c) for c in means]
        ).first()
        fills.update({c: row[c] for c in means})
    medians = [c for c, a in numeric.items() if a == "median"]
    if medians:
        fills.update({c: v[0] for c, v in column_quantiles(df, medians, [0.5]).items()})
    return df.withColumns(
        {
            c: F.coalesce(F.col(c).cast("double"), F.lit(v).cast("double"))
            for c, v in fills.items()
        }
    )


def impute(df: DataFrame, table: str, strategy: Mapping[str, str]) -> DataFrame:
    """Apply the actions in order, each column flagged before it is filled.

    A drop changes every later mean or median, so values taken from the data
    are computed between drops and not once for the whole table.
    """
    simple = {"drop": impute_drop, "zero": impute_zero, "unknown": impute_unknown,
              "keep_null": impute_keep}
    waiting: dict[str, str] = {}
    for column, action in strategy.items():
        if column not in df.columns:
            continue
        if action in ("mean", "median"):
            df = impute_flag(df, [column])
            waiting[column] = action
            continue
        if action == "drop" and waiting:
            df, waiting = _fill_numeric(df, waiting), {}
        df = impute_flag(df, [column])
        if action not in simple:
            log.warning("%s.%s: unknown action %r, nulls kept", table, column, action)
        df = simple.get(action, impute_keep)(df, column)
    return _fill_numeric(df, waiting) if waiting else df


def fill_approved_at(orders: DataFrame) -> DataFrame:
    """A missing approval time is taken to be the purchase time."""
    return orders.withColumn(
        "order_approved_at", F.coalesce("order_approved_at", "order_purchase_timestamp")
    )


# --- whole tables ----------------------------------------------------------


def clean_table(
    df: DataFrame, table: str, rules: CleaningRules, max_null: float = MAX_NULL_CRITICAL,
    order_by: Sequence[str] | None = None, keep: Keep | None = None,
    counted_keep: CountedKeep | None = None,
) -> DataFrame:
    """Critical fields, duplicates, timestamps, flags, imputing, overrides, ranges.

    ``keep(table, rows)`` stores the finished rows and returns them as stored, so
    that the range check and every later reader share one computation. With
    ``counted_keep`` the job that stores also counts the values out of range. Without
    either, tables that need a range check are settled. Critical fields are judged on the
    raw rows, before repeated keys go, so they take a pass of their own.
    """
    _raise_critical(table, _critical_faults(df, table, rules.critical, max_null))
    if order_by is None and FILE_ORDER in df.columns:
        order_by = [FILE_ORDER]
    df = dedupe_first(df, rules.key, order_by).drop(FILE_ORDER)
    df = coerce_timestamps(df, rules.timestamps)
    if {"mean", "median"} & set(rules.missing.values()):
        # Fills taken from the data read the deduplicated rows several times.
        df = settle(df)
    df = missing_flags(df, rules.presence_flags)
    df = impute(df, table, rules.missing)
    if table == "orders" and "order_approved_at" in df.columns:
        df = fill_approved_at(df)
    if rules.text:
        df = text_features(df, rules.text)
    if counted_keep is not None:
        df, found = counted_keep(table, df, range_counts(df, rules.ranges))
        _raise_ranges(table, rules.ranges, found)
        return df
    if keep is not None:
        df = keep(table, df)
    elif rules.ranges:
        df = settle(df)
    return validate_ranges(df, table, rules.ranges)


def clean_all(
    tables: Mapping[str, DataFrame], rules: Mapping[str, CleaningRules] | None = None,
    max_null: float = MAX_NULL_CRITICAL, keep: Keep | None = None,
    counted_keep: CountedKeep | None = None,
) -> dict[str, DataFrame]:
    """Clean every table that has rules; the others pass through."""
    rules = DEFAULT_RULES if rules is None else rules
    cleaned = together({
        name: partial(clean_table, tables[name], name, rules[name], max_null, keep=keep,
                      counted_keep=counted_keep)
        for name in tables if name in rules
    })
    return {
        name: cleaned[name] if name in cleaned else _without_place(df)
        for name, df in tables.items()
    }


def _without_place(df: DataFrame) -> DataFrame:
    return df.drop(FILE_ORDER) if FILE_ORDER in df.columns else df


def null_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Null count of every column of every table, one row each."""
    return reduce(DataFrame.unionByName, [_null_rows(n, df) for n, df in tables.items()])


def _null_rows(table: str, df: DataFrame) -> DataFrame:
    columns = [f"`{c}`" for c in df.columns]
    return (
        null_shares(df, df.columns)
        .unpivot([], columns, "column_name", "null_count")
        .withColumn("table_name", F.lit(table))
        .select("table_name", "column_name", "null_count")
    )


def coercion_failures(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Values present as text that cannot be read as a timestamp, per column."""
    present = [c for c in columns if c in df.columns]
    counts = df.agg(*[
        count_where(F.col(c).isNotNull() & parse_timestamp(F.col(c).cast("string")).isNull()).alias(c)
        for c in present
    ])
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("invalid_count")) for c in present
    ])
    return counts.select(F.lit(table).alias("table_name"), F.explode(entries).alias("e")).select(
        "table_name", "e.*"
    )


# --- references ------------------------------------------------------------


def referential_filter(
    fact: DataFrame, dims: Mapping[str, DataFrame],
    keys_from: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Drop fact rows whose customer, product or seller is not in its dimension.

    The few keys without a dimension row are found first, at one row per key,
    and stored. Spark then knows their true size and broadcasts them if they are
    small, so the wide fact is not shuffled once per dimension; if they are many
    it falls back to a shuffled join. ``keys_from`` names narrower tables that
    hold the keys of the fact (orders, order items), to avoid building it twice.
    """
    return without_keys(fact, unknown_keys(fact, dims, keys_from))


def referential_flag(
    fact: DataFrame, dims: Mapping[str, DataFrame], flag: str
) -> tuple[DataFrame, bool]:
    """Fact rows with a column that tells which of them ``referential_filter`` keeps.

    Also returns whether the unknown keys are so few that every task holds them; the
    flag then costs no shuffle, however often it is read.
    """
    lost = unknown_keys(fact, dims)
    few = all(keys.count() <= FEW_KEYS for keys in lost.values())
    columns, known = fact.columns, F.lit(True)
    for i, (key, keys) in enumerate(lost.items()):
        unknown = keys.select(F.col(key).alias(f"_lost_{i}"))
        fact = fact.join(F.broadcast(unknown) if few else unknown,
                         F.col(key) == F.col(f"_lost_{i}"), "left")
        known = known & F.col(key).isNotNull() & F.col(f"_lost_{i}").isNull()
    return fact.select(*columns, known.alias(flag)), few


def unknown_keys(
    fact: DataFrame, dims: Mapping[str, DataFrame],
    keys_from: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """By key column, the stored keys that have no dimension row."""
    def lost_keys(key: str, dim: DataFrame) -> DataFrame:
        used = (keys_from or {}).get(key, fact).select(key).distinct()
        return stored(used.join(dim.select(key), key, "left_anti"), "orphans")

    return together({key: partial(lost_keys, key, dim) for key, dim in _references(dims)})


def without_keys(fact: DataFrame, lost: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows whose keys are neither null nor among the lost ones."""
    for key, orphans in lost.items():
        fact = fact.filter(F.col(key).isNotNull()).join(orphans, key, "left_anti")
    return fact


def orphan_report(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct keys of the fact without a dimension row, and the rows they hold."""
    parts = []
    for key, dim in _references(dims):
        # One row per key before the join, so no hot key is joined.
        keys = fact.groupBy(F.col(key)).agg(F.count("*").alias("n"))
        lost = keys.join(dim.select(key), key, "left_anti")
        parts.append(
            lost.agg(
                F.count(key).alias("orphan_keys"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
            ).select(F.lit(key).alias("key_column"), "orphan_keys", "orphan_rows")
        )
    return reduce(DataFrame.unionByName, parts)


def _references(dims: Mapping[str, DataFrame]) -> list[tuple[str, DataFrame]]:
    links = {"customer_id": "dim_customers", "product_id": "dim_products", "seller_id": "dim_sellers"}
    return [(key, dims[name]) for key, name in links.items() if name in dims]
