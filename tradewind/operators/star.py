"""Star schema: item-grain fact and its dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.columns import floor_days, year_month

ORDER_COLUMNS = (
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date", "is_approved", "is_shipped", "is_delivered",
)

DEFAULT_SOURCE = "commerce_csv"


def lineage(df: DataFrame, run_ts: dt.datetime | None, source: str) -> DataFrame:
    """Load time and source on every row; pass ``run_ts`` to repeat a run exactly."""
    loaded: Column = F.localtimestamp() if run_ts is None else F.lit(run_ts).cast("timestamp_ntz")
    return df.withColumns({"etl_loaded_at": loaded, "data_source": F.lit(source)})


def fact_order_items(
    orders: DataFrame, order_items: DataFrame,
    run_ts: dt.datetime | None = None, source: str = DEFAULT_SOURCE,
) -> DataFrame:
    """One row per item of an order: items left join their order, with measures.

    ``orders`` must be unique on order_id, which cleaning ensures. So an order
    has one customer and one purchase time, and reports may count orders after
    grouping items by order.
    """
    return measured(ordered_items(orders, order_items), run_ts, source)


def ordered_items(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Items with their order's columns, and the month that the fact is stored by."""
    joined = order_items.join(orders.select(*ORDER_COLUMNS), "order_id", "left")
    return joined.withColumn("order_purchase_ym", year_month(F.col("order_purchase_timestamp")))


def measured(
    joined: DataFrame, run_ts: dt.datetime | None = None, source: str = DEFAULT_SOURCE
) -> DataFrame:
    """The fact's measures and lineage, in its order of columns."""
    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    given = [c for c in joined.columns if c != "order_purchase_ym"]
    fact = joined.select(*given, F.col("order_purchase_ym").alias("_month")).withColumns({
        "total_value": F.col("price") + F.col("freight_value"),
        "order_purchase_date": purchased.cast("date"),
        "order_purchase_ym": F.col("_month"),
        "order_delivered_timestamp": delivered,
        "delivery_time_days": floor_days(purchased, delivered),
        "estimated_delivery_days": floor_days(purchased, estimated),
        "has_delivery_date": delivered.isNotNull().cast("int"),
    }).drop("_month").withColumn(
        "is_delayed",
        # Unknown times compare to null, which is not a delay.
        F.coalesce(
            (F.col("delivery_time_days") > F.col("estimated_delivery_days"))
            & (F.col("is_delivered") == 1),
            F.lit(False),
        ).cast("int"),
    )
    return lineage(fact, run_ts, source)


def dim_customers(customers: DataFrame, run_ts=None, source: str = DEFAULT_SOURCE) -> DataFrame:
    return lineage(customers, run_ts, source)


def dim_sellers(sellers: DataFrame, run_ts=None, source: str = DEFAULT_SOURCE) -> DataFrame:
    return lineage(sellers, run_ts, source)


def dim_products(
    products: DataFrame, translation: DataFrame | None = None,
    run_ts=None, source: str = DEFAULT_SOURCE,
) -> DataFrame:
    """Products with their category in English; no translation leaves null."""
    if translation is not None:
        english = translation.select(
            "product_category_name",
            F.col("product_category_name_english").alias("category_english"),
        )
        products = products.join(english, "product_category_name", "left")
    return lineage(products, run_ts, source)


def dim_time(moments: DataFrame, column: str = "order_purchase_timestamp") -> DataFrame:
    """Every day from the first to the last purchase with its calendar attributes."""
    day = F.col("date_id")
    bounds = moments.agg(
        F.min(column).cast("date").alias("first"), F.max(column).cast("date").alias("last")
    )
    days = bounds.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last")).alias("date_id")
    )
    return days.select(
        "date_id",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
        (F.weekday(day) >= 5).cast("int").alias("is_weekend"),
        (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).alias("date_key"),
    )


def dimensions(
    tables: Mapping[str, DataFrame], run_ts=None, source: str = DEFAULT_SOURCE
) -> dict[str, DataFrame]:
    return {
        "dim_customers": dim_customers(tables["customers"], run_ts, source),
        "dim_products": dim_products(
            tables["products"], tables.get("category_translation"), run_ts, source
        ),
        "dim_sellers": dim_sellers(tables["sellers"], run_ts, source),
        "dim_time": dim_time(tables["orders"]),
    }
