"""Pre-aggregated tables, full and incremental.

The incremental form stores mergeable state: one row per key and order with
sums, counts and extremes. Two states merge by grouping their union, and the
exact number of orders is the number of state rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.columns import floor_days, ratio

STATE_KEYS = {
    "agg_customer_metrics": ["customer_id"],
    "agg_product_metrics": ["product_id"],
    "agg_monthly_revenue": ["order_purchase_ym", "customer_id"],
}

# How two states of the same key and order merge.
MERGE = {
    "items": F.sum, "line_sum": F.sum, "value": F.sum, "min_value": F.min, "max_value": F.max,
    "day_sum": F.sum, "day_count": F.sum, "delayed": F.sum, "first_at": F.min, "last_at": F.max,
}


def state_of(fact: DataFrame, table: str) -> DataFrame:
    """Mergeable state of delivered items for one aggregate table.

    Rows without the month, customer or product the table is about drop; a month also
    counts orders without a customer.
    """
    keys = STATE_KEYS[table]
    delivered = fact.filter(F.col("is_delivered") == 1).dropna(subset=keys[:1])
    return delivered.groupBy(*keys, "order_id").agg(
        F.count("*").alias("items"),
        F.sum("order_item_id").alias("line_sum"),
        F.sum("total_value").alias("value"),
        F.min("total_value").alias("min_value"),
        F.max("total_value").alias("max_value"),
        F.sum("delivery_time_days").alias("day_sum"),
        F.count("delivery_time_days").alias("day_count"),
        F.sum("is_delayed").alias("delayed"),
        F.min("order_purchase_timestamp").alias("first_at"),
        F.max("order_purchase_timestamp").alias("last_at"),
    )


def merge_rows(state: DataFrame, table: str) -> DataFrame:
    """One row per key and order from a state that may hold several."""
    kinds = {f.name: f.dataType for f in state.schema.fields}
    merged = state.groupBy(*STATE_KEYS[table], "order_id").agg(
        *[fn(name).alias(name) for name, fn in MERGE.items()]
    )
    # Sums widen the type; the stored type is kept so that states can merge again.
    return merged.select(*[F.col(c).cast(kinds[c]).alias(c) for c in state.columns])


def merge_states(stored: DataFrame, new: DataFrame, table: str) -> DataFrame:
    """State of old and new rows together."""
    return merge_rows(stored.unionByName(new), table)


def finish(state: DataFrame, table: str, run_ts: dt.datetime | None = None) -> DataFrame:
    """Aggregate table from its state."""
    shape = {
        "agg_customer_metrics": _finish_customers,
        "agg_product_metrics": _finish_products,
        "agg_monthly_revenue": _finish_months,
    }[table]
    loaded = F.localtimestamp() if run_ts is None else F.lit(run_ts).cast("timestamp_ntz")
    return shape(state).withColumn("etl_loaded_at", loaded)


def _means() -> list[Column]:
    return [
        ratio(F.sum("day_sum"), F.sum("day_count"), 2).alias("avg_delivery_days"),
        ratio(F.sum("delayed"), F.sum("items"), 2).alias("delayed_rate"),
    ]


def _finish_customers(state: DataFrame) -> DataFrame:
    return (
        state.groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.round(F.sum("value"), 2).alias("total_revenue"),
            # Mean over items keeps its customary name; aov is per order.
            ratio(F.sum("value"), F.sum("items"), 2).alias("avg_order_value"),
            ratio(F.sum("value"), F.count("order_id"), 2).alias("aov"),
            F.round(F.min("min_value"), 2).alias("min_order_value"),
            F.round(F.max("max_value"), 2).alias("max_order_value"),
            *_means(),
            F.min("first_at").alias("first_order_date"),
            F.max("last_at").alias("last_order_date"),
        )
        .withColumn(
            "days_as_customer", floor_days(F.col("first_order_date"), F.col("last_order_date"))
        )
    )


def _finish_products(state: DataFrame) -> DataFrame:
    return state.groupBy("product_id").agg(
        F.count("order_id").alias("orders_count"),
        F.sum("items").alias("units_sold"),
        F.sum("line_sum").alias("order_item_id_sum"),
        F.round(F.sum("value"), 2).alias("total_revenue"),
        ratio(F.sum("value"), F.sum("items"), 2).alias("avg_price"),
        *_means(),
        F.min("first_at").alias("first_sale_date"),
        F.max("last_at").alias("last_sale_date"),
    )


def _finish_months(state: DataFrame) -> DataFrame:
    return (
        state.groupBy(F.col("order_purchase_ym").alias("year_month"))
        .agg(
            F.round(F.sum("value"), 2).alias("total_revenue"),
            F.count("order_id").alias("order_count"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.sum("items").alias("item_count"),
            F.sum("line_sum").alias("order_item_id_sum"),
            ratio(F.sum("value"), F.count("order_id"), 2).alias("avg_order_value"),
        )
        .withColumns({
            "year": F.substring("year_month", 1, 4).cast("int"),
            "month": F.substring("year_month", 6, 2).cast("int"),
        })
    )


def aggregate(fact: DataFrame, table: str, run_ts: dt.datetime | None = None) -> DataFrame:
    """Aggregate table computed in full."""
    return finish(state_of(fact, table), table, run_ts)


def agg_customer_metrics(fact: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    return aggregate(fact, "agg_customer_metrics", run_ts)


def agg_product_metrics(fact: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    return aggregate(fact, "agg_product_metrics", run_ts)


def agg_monthly_revenue(fact: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    return aggregate(fact, "agg_monthly_revenue", run_ts)
