"""Expectations, integrity checks, the quality log and the load gate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tradewind.functions.columns import count_where, half_up, percent, ratio
from tradewind.operators.cleaning import null_shares, referential_filter
from tradewind.schemas import (
    GATE_RULES, MAX_DUPLICATES, MAX_FK_VIOLATIONS, MAX_INVALID, MAX_NULL_WARNING,
    ORDER_STATUSES, GateRules,
)
from tradewind.session import counted_write, scratch_path


@dataclass(frozen=True)
class Expectation:
    """One rule. ``failing`` counts rows that break it; without it the rule is
    about the schema and ``holds`` is already known."""

    name: str
    column: str
    failing: Column | None = None
    holds: bool = True
    detail: str = ""


def expect_column_exists(df: DataFrame, column: str) -> Expectation:
    return Expectation("expect_column_exists", column, holds=column in df.columns)


def expect_not_null(column: str) -> Expectation:
    return Expectation("expect_not_null", column, F.col(column).isNull())


def expect_in_set(column: str, allowed: Sequence, nulls_pass: bool = True) -> Expectation:
    bad = ~F.col(column).isin(list(allowed))
    return Expectation(
        "expect_in_set", column, bad if nulls_pass else F.coalesce(bad, F.lit(True))
    )


def expect_between(column: str, low=None, high=None) -> Expectation:
    """Null passes, as in a SQL CHECK."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < F.lit(low))
    if high is not None:
        bad = bad | (F.col(column) > F.lit(high))
    return Expectation("expect_between", column, bad)


def expect_type(df: DataFrame, column: str, expected: T.DataType) -> Expectation:
    actual = df.schema[column].dataType if column in df.columns else None
    return Expectation(
        "expect_type", column, holds=actual == expected,
        detail="absent" if actual is None else actual.simpleString(),
    )


def check_constraint(name: str, rule: Column) -> Expectation:
    """A row fails when the rule is false; unknown passes."""
    return Expectation("check_constraint", name, ~rule)


def validate_suite(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """One row per expectation, all counted in a single pass over the table."""
    counts = df.agg(
        F.count("*").alias("rows"),
        *[
            (F.lit(0).cast("long") if e.failing is None else count_where(e.failing)).alias(f"f{i}")
            for i, e in enumerate(suite)
        ],
    )
    entries = []
    for i, e in enumerate(suite):
        failed = F.col(f"f{i}")
        entries.append(F.struct(
            F.lit(e.name).alias("expectation"),
            F.lit(e.column).alias("column_name"),
            F.col("rows").alias("row_count"),
            F.lit(len(df.columns)).alias("column_count"),
            failed.alias("failed_rows"),
            ((failed == 0) & F.lit(e.holds)).cast("int").alias("success"),
        ))
    return counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def suite_passes(results: DataFrame) -> bool:
    return results.filter("success = 0").isEmpty()


# Rules of the warehouse tables, by table.
TABLE_CHECKS: dict[str, dict[str, str]] = {
    "dim_customers": {"state_has_two_letters": "length(customer_state) = 2"},
    "dim_products": {
        "weight_not_negative": "product_weight_g >= 0",
        "photos_not_negative": "product_photos_qty >= 0",
    },
    "dim_sellers": {"state_has_two_letters": "length(seller_state) = 2"},
    "dim_time": {
        "month_valid": "month between 1 and 12",
        "quarter_valid": "quarter between 1 and 4",
    },
    "fact_order_items": {
        "price_not_negative": "price >= 0",
        "freight_not_negative": "freight_value >= 0",
        "delayed_is_flag": "is_delayed in (0, 1)",
        "delivery_date_is_flag": "has_delivery_date in (0, 1)",
    },
    "agg_monthly_revenue": {"month_valid": "month between 1 and 12"},
}


def check_constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows breaking each declared rule of each table."""
    parts = []
    for name, rules in TABLE_CHECKS.items():
        if name in tables:
            suite = [check_constraint(rule, F.expr(text)) for rule, text in rules.items()]
            parts.append(validate_suite(tables[name], suite).select(
                F.lit(name).alias("table_name"), F.col("column_name").alias("constraint_name"),
                "row_count", "failed_rows", "success",
            ))
    return reduce(DataFrame.unionByName, parts)


# Keys, required and defaulted columns of the warehouse tables.
TABLE_KEYS = {
    "dim_customers": ("customer_id",),
    "dim_products": ("product_id",),
    "dim_sellers": ("seller_id",),
    "dim_time": ("date_key",),
    "fact_order_items": ("order_id", "order_item_id"),
    "agg_customer_metrics": ("customer_id",),
    "agg_product_metrics": ("product_id",),
    "agg_monthly_revenue": ("year", "month"),
}
REQUIRED_COLUMNS = {
    "dim_time": ("date_id", "year", "month"),
    "fact_order_items": (
        "order_id", "order_item_id", "product_id", "seller_id", "customer_id",
        "order_purchase_date", "price", "freight_value", "total_value",
        "order_purchase_timestamp", "etl_loaded_at",
    ),
}
DEFAULTS = {
    "fact_order_items": {"freight_value": 0},
    "dim_products": {
        "product_name_lenght": 0, "product_description_lenght": 0, "product_photos_qty": 0,
    },
}


def pk_uniqueness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Keys that occur more than once, and the rows holding them."""
    parts = []
    for name, key in TABLE_KEYS.items():
        if name in tables:
            per_key = tables[name].groupBy(*key).agg(F.count("*").alias("n"))
            repeated = F.col("n") > 1
            parts.append(per_key.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                count_where(repeated).alias("repeated_keys"),
                F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("repeated_rows"),
            ).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def not_null(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Null counts of the required columns."""
    parts = []
    for name, columns in REQUIRED_COLUMNS.items():
        if name in tables:
            suite = [expect_not_null(c) for c in columns]
            parts.append(validate_suite(tables[name], suite).select(
                F.lit(name).alias("table_name"), "column_name",
                F.col("failed_rows").alias("null_count"),
            ))
    return reduce(DataFrame.unionByName, parts)


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Nulls of defaulted columns replaced by the declared default."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c]))
        for c, v in DEFAULTS.get(table, {}).items() if c in kinds
    })


# --- warehouse checks ------------------------------------------------------


def fk_integrity(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows whose customer, product or seller is in no dimension row.

    Counted as the rows a reference filter would drop, so a row lost to several
    dimensions counts once and the fact is not shuffled.
    """
    keys = fact.select("customer_id", "product_id", "seller_id")
    kept = referential_filter(keys, dims).agg(F.count("*")).scalar()
    return keys.agg(
        F.lit("FK_INTEGRITY").alias("check_type"), F.count("*").alias("rows")
    ).select("check_type", (F.col("rows") - kept).alias("orphaned_records"))


def null_checks(
    fact: DataFrame, columns: Sequence[str] = ("order_id", "customer_id", "product_id", "price")
) -> DataFrame:
    return fact.agg(
        F.lit("NULL_CHECKS").alias("check_type"),
        *[count_where(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )


def value_validation(fact: DataFrame) -> DataFrame:
    bad = (F.col("price") < 0) | (F.col("freight_value") < 0) | (F.col("total_value") < 0)
    return fact.agg(
        F.lit("VALUE_VALIDATION").alias("check_type"), count_where(bad).alias("negative_price")
    )


def data_freshness(fact: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Last load and its age in hours at ``as_of``."""
    last = F.max("etl_loaded_at")
    seconds = F.timestamp_diff("SECOND", last, F.lit(as_of).cast("timestamp_ntz"))
    return fact.agg(
        F.lit("DATA_FRESHNESS").alias("check_type"),
        last.alias("last_load"),
        half_up(seconds / 3600.0, 4).alias("hours_since_load"),
    )


# --- log -------------------------------------------------------------------


def log_rows(
    checks: DataFrame, warning_share: float = 0.0, fail_share: float = MAX_INVALID,
    checked_at: dt.datetime | None = None,
) -> DataFrame:
    """Log rows from (check_name, table_name, records_checked, records_failed)."""
    share = F.coalesce(ratio(F.col("records_failed"), F.col("records_checked")), F.lit(0.0))
    at = F.localtimestamp() if checked_at is None else F.lit(checked_at).cast("timestamp_ntz")
    return checks.select(
        "check_name", "table_name", "records_checked", "records_failed",
        F.when(share > fail_share, "FAIL").when(share > warning_share, "WARNING")
        .otherwise("PASS").alias("check_result"),
        at.alias("check_timestamp"),
        F.concat(
            F.col("records_failed").cast("string"), F.lit(" of "),
            F.col("records_checked").cast("string"), F.lit(" rows"),
        ).alias("details"),
    )


def fact_check_counts(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The counts the quality log records for the fact."""
    nulls = reduce(lambda a, b: a | b, [
        F.col(c).isNull() for c in ("order_id", "customer_id", "product_id", "price")
    ])
    negative = (F.col("price") < 0) | (F.col("freight_value") < 0) | (F.col("total_value") < 0)
    unknown = F.coalesce(~F.col("order_status").isin(list(ORDER_STATUSES)), F.lit(True))
    counts = fact.agg(
        F.count("*").alias("rows"), count_where(nulls).alias("nulls"),
        count_where(negative).alias("negative"), count_where(unknown).alias("unknown"),
    )
    names = {"NULL_CHECKS": "nulls", "VALUE_VALIDATION": "negative", "STATUS_VALIDATION": "unknown"}
    rows = counts.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.col("rows").alias("records_checked"),
                 F.col(c).alias("records_failed"))
        for n, c in names.items()
    ])).alias("e")).select("e.*")
    orphans = fk_integrity(fact, dims).select(
        F.col("check_type").alias("check_name"),
        fact.agg(F.count("*")).scalar().alias("records_checked"),
        F.col("orphaned_records").alias("records_failed"),
    )
    return rows.unionByName(orphans).withColumn("table_name", F.lit("fact_order_items"))


def append_quality_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_quality_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# --- gate ------------------------------------------------------------------


def threshold_gate(
    tables: Mapping[str, DataFrame], rules: Mapping[str, GateRules] = GATE_RULES,
    counted: Mapping[str, Mapping[str, int]] | None = None,
    keys_at: Mapping[str, str] | None = None,
) -> DataFrame:
    """PASS, WARNING or FAIL for every limit of each table.

    Critical fields fail above the table's null limit and warn from the first
    null on; other columns only warn, above the general limit. Duplicates,
    broken references and negative amounts warn from the first row on. ``counted`` holds
    ``gate_counts`` that are known already, by table. A table with references is read
    once: its keys are stored while its rows are judged, so a join need not be stored whole.
    So is a table with a path of its own in ``keys_at``, where its keys then lie.
    """
    parts = []
    for name, rule in rules.items():
        if name in tables:
            counts = _gate_counts(tables[name], rule, tables, (counted or {}).get(name),
                                  (keys_at or {}).get(name))
            parts += [c.withColumn("table_name", F.lit(name)) for c in counts]
    share = F.coalesce(ratio(F.col("failed"), F.col("checked")), F.lit(0.0))
    return reduce(DataFrame.unionByName, parts).select(
        "table_name", "check_name", "checked", "failed",
        half_up(share * 100, 4).alias("failed_pct"),
        F.when(share > F.col("fail"), "FAIL").when(share > F.col("warn"), "WARNING")
        .otherwise("PASS").alias("result"),
    )


def load_gate(
    loaded: Mapping[str, DataFrame], tables: Mapping[str, DataFrame],
    max_broken: float = MAX_FK_VIOLATIONS, rules: Mapping[str, GateRules] = GATE_RULES,
    counted: Mapping[str, Mapping[str, int]] | None = None,
    lost: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The gate on a finished load: limits of each table, and references before the filter.

    The fact has lost its rows with unknown references by then, so these are counted
    where the keys come from, in the cleaned orders and items. ``counted`` holds counts
    that came with the writes, ``lost`` the unknown keys, if they were found already.
    """
    return row_gate(loaded, rules, counted).unionByName(
        reference_gate(tables, loaded, max_broken, rules, lost))


def row_gate(
    loaded: Mapping[str, DataFrame], rules: Mapping[str, GateRules] = GATE_RULES,
    counted: Mapping[str, Mapping[str, int]] | None = None,
    keys_at: Mapping[str, str] | None = None,
) -> DataFrame:
    """Limits of each table on its own."""
    own = {n: replace(r, foreign_keys={}) for n, r in rules.items()}
    return threshold_gate(loaded, own, counted, keys_at)


def reference_gate(
    tables: Mapping[str, DataFrame], dims: Mapping[str, DataFrame],
    max_broken: float = MAX_FK_VIOLATIONS, rules: Mapping[str, GateRules] = GATE_RULES,
    lost: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Rows of orders and items whose customer, product or seller is unknown."""
    parts = []
    origins = {"customer_id": "orders", "product_id": "order_items", "seller_id": "order_items"}
    for name, rule in rules.items():
        for key, dim in rule.foreign_keys.items():
            if origins.get(key) in tables and dim in dims:
                used = tables[origins[key]]
                if lost is not None and key in lost:
                    # The stored unknown keys are few and broadcast, or else joined by key.
                    unknown = lost[key].withColumn("_lost", F.lit(True))
                    bad = F.col(key).isNull() | F.col("_lost").isNotNull()
                    counts = used.select(key).join(unknown, key, "left").agg(
                        F.count("*").alias("checked"), count_where(bad).alias("failed"))
                else:
                    known = dims[dim].select(key).distinct().withColumn("_known", F.lit(True))
                    none = F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0))
                    counts = used.groupBy(key).agg(F.count("*").alias("n")).join(
                        known, key, "left").agg(
                        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"), none.alias("failed"))
                share = F.coalesce(ratio(F.col("failed"), F.col("checked")), F.lit(0.0))
                parts.append(counts.select(
                    F.lit(name).alias("table_name"), F.lit(f"reference:{key}").alias("check_name"),
                    "checked", "failed", half_up(share * 100, 4).alias("failed_pct"),
                    F.when(share > max_broken, "FAIL").when(share > 0, "WARNING").otherwise("PASS")
                    .alias("result")))
    return reduce(DataFrame.unionByName, parts)


def _bad_rows(df: DataFrame) -> dict[str, Column]:
    """Checks of single rows by name: true where the row fails."""
    bad = {f"null:{c}": F.col(c).isNull() for c in df.columns}
    amounts = [c for c in ("price", "freight_value", "total_value") if c in df.columns]
    if amounts:
        bad["negative amounts"] = reduce(lambda a, b: a | b, [F.col(c) < 0 for c in amounts])
    return bad


def gate_counts(df: DataFrame) -> dict[str, Column]:
    """Aggregates of the checks on single rows; a write can take them along."""
    return {"rows": F.count(F.lit(1)), **{n: count_where(b) for n, b in _bad_rows(df).items()}}


def _gate_counts(
    df: DataFrame, rule: GateRules, tables: Mapping[str, DataFrame],
    counted: Mapping[str, int] | None = None, keys_at: str | None = None,
) -> list[DataFrame]:
    """Checked and failed rows with the limits of each check."""

    def entry(check: str, checked: Column, failed: Column, warn: float, fail: float) -> list[Column]:
        return [
            F.lit(check).alias("check_name"), checked.cast("long").alias("checked"),
            failed.cast("long").alias("failed"), F.lit(warn).alias("warn"),
            F.lit(fail).alias("fail"),
        ]

    columns, checks = df.columns, gate_counts(df)
    if counted is None and (rule.foreign_keys or keys_at):
        # Read several times below: its keys are stored, its rows are judged on the way.
        df, counted = _keys_and_counts(df, rule, checks, keys_at)
    limits = {
        f"null:{c}": (0.0, rule.max_null) if c in rule.critical else (MAX_NULL_WARNING, 1.0)
        for c in columns
    }
    limits["negative amounts"] = (0.0, MAX_INVALID)
    short = {name: f"f{i}" for i, name in enumerate(checks)}
    if counted is None:
        # Row checks share one pass over the table.
        counts = df.agg(*[n.alias(short[name]) for name, n in checks.items()])
    else:
        counts = df.sparkSession.createDataFrame(
            [tuple(counted[name] for name in checks)],
            ", ".join(f"{short[name]} long" for name in checks))
    found = [counts.select(F.explode(F.array(*[
        F.struct(*entry(check, F.col(short["rows"]), F.col(short[check]), *limits[check]))
        for check in checks if check != "rows"
    ])).alias("e")).select("e.*")]

    per_key = df.groupBy(*rule.key).agg(F.count("*").alias("n"))
    found.append(per_key.agg(
        *entry("duplicates", F.coalesce(F.sum("n"), F.lit(0)),
               F.coalesce(F.sum(F.col("n") - 1), F.lit(0)), 0.0, MAX_DUPLICATES)
    ))
    for key, dim in rule.foreign_keys.items():
        used = df.groupBy(key).agg(F.count("*").alias("n"))
        known = tables[dim].select(key).distinct().withColumn("_known", F.lit(True))
        lost = F.sum(F.when(F.col("_known").isNull(), F.col("n")))
        found.append(used.join(known, key, "left").agg(
            *entry(f"reference:{key}", F.coalesce(F.sum("n"), F.lit(0)),
                   F.coalesce(lost, F.lit(0)), 0.0, MAX_FK_VIOLATIONS)
        ))
    return found


def _keys_and_counts(
    df: DataFrame, rule: GateRules, checks: Mapping[str, Column], path: str | None = None
) -> tuple[DataFrame, dict[str, int] | None]:
    """Stored keys of all rows, and the row checks counted by the job that stores them."""
    keys = list(dict.fromkeys([*rule.key, *rule.foreign_keys]))
    path = path or scratch_path(df.sparkSession, "gate-keys")
    found = counted_write(df, checks, lambda rows: rows.select(*keys).write.parquet(path))
    narrow = df.sparkSession.read.schema(df.select(*keys).schema).parquet(path)
    return narrow, found


def fact_metrics(fact: DataFrame) -> DataFrame:
    """Run metrics of the fact, one row each."""
    columns = fact.columns
    nulls = {c: count_where(F.col(c).isNull()) for c in columns}
    invalid = F.coalesce(~F.col("order_status").isin(list(ORDER_STATUSES)), F.lit(True))
    one = fact.agg(
        F.count("*").alias("rows"),
        F.sum("total_value").alias("value"),
        F.count("total_value").alias("valued"),
        count_where(F.col("price") < 0).alias("negative"),
        count_where(invalid).alias("invalid"),
        *[v.alias(f"null_{c}") for c, v in nulls.items()],
    )
    rows = F.col("rows")
    all_nulls = reduce(lambda a, b: a + b, [F.col(f"null_{c}") for c in columns])
    # Each metric is part / whole; shares are worked out once, after the rows are long.
    one_row, hundred = F.lit(1), F.lit(100.0)
    parts = {
        "fact_table_rows": (rows, one_row, None),
        "fact_table_null_percentage": (all_nulls * hundred, rows * len(columns), 4),
        "total_revenue": (F.coalesce(F.col("value"), F.lit(0)), one_row, None),
        "avg_order_value": (F.col("value"), F.col("valued"), 4),
        "negative_prices_count": (F.col("negative"), one_row, None),
        "invalid_order_statuses": (F.col("invalid"), one_row, None),
        **{f"null_pct_{c}": (F.col(f"null_{c}") * hundred, rows, 4) for c in columns},
    }
    entries = [
        F.struct(
            F.lit(name).alias("metric"), part.cast("double").alias("part"),
            whole.cast("double").alias("whole"), F.lit(digits is not None).alias("rounded"),
        )
        for name, (part, whole, digits) in parts.items()
    ]
    return one.select(F.explode(F.array(*entries)).alias("e")).select(
        "e.metric",
        F.when(F.col("e.rounded"), half_up(F.try_divide("e.part", "e.whole"), 4))
        .otherwise(F.col("e.part")).alias("value"),
    )
