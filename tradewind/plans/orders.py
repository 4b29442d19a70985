"""Reports from a stored order grain.

One row per order, and one per order and payment type, are written once to tables that are
bucketed and sorted by ``order_id``. Rows of an order lie in the same bucket of both, so
what groups or joins by order needs no exchange. Items and payments are merged in the map
tasks before they are dealt, so an order with very many lines is one row like any other.

An order has one customer, one purchase date and one status, as cleaning sees to. Orders
without items are not in the grain. Empty tables give empty tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.plans.revenue import paid_by_order, payment_types, top_of_totals, totals_of_orders
from tradewind.sources.tables import bucketed_table, open_bucketed

BUCKETS = 200
KEY = "order_id"


def order_rows(fact: DataFrame) -> DataFrame:
    """What the reports need of each order, in one row."""
    return fact.groupBy(KEY).agg(
        F.min("customer_id").alias("customer_id"),
        F.min("order_purchase_date").alias("order_purchase_date"),
        F.min("order_purchase_ym").alias("order_purchase_ym"),
        F.min("order_status").alias("order_status"),
        F.count("*").alias("items"),
        F.sum("total_value").alias("value"),
        F.max("is_delayed").alias("is_delayed"),
        F.min("etl_loaded_at").alias("etl_loaded_at"),
    )


@dataclass(frozen=True)
class OrderGrain:
    orders: DataFrame
    payments: DataFrame

    def delivered(self) -> DataFrame:
        return self.orders.filter(F.col("order_status") == "delivered")


def kept(fact: DataFrame, payments: DataFrame, place: str, buckets: int = BUCKETS) -> OrderGrain:
    """Write both tables below ``place`` and open them; as many buckets as tasks should read.

    Tables that are there already are replaced.
    """
    return OrderGrain(
        bucketed_table(order_rows(fact), f"{place}/orders", KEY, buckets),
        bucketed_table(paid_by_order(payments), f"{place}/payments", KEY, buckets),
    )


def opened(spark: SparkSession, place: str) -> OrderGrain:
    """The tables an earlier session has written."""
    return OrderGrain(*(open_bucketed(spark, f"{place}/{t}") for t in ("orders", "payments")))


def v_order_metrics(grain: OrderGrain) -> DataFrame:
    return grain.orders.select(
        KEY, "customer_id", "order_purchase_date", F.col("items").alias("item_count"),
        F.col("value").alias("order_total"), F.col("is_delayed").alias("order_delayed"),
        "order_status", "etl_loaded_at",
    )


def top_customers(grain: OrderGrain, customers: DataFrame, limit: int = 10) -> DataFrame:
    day = F.col("order_purchase_date")
    dated = grain.delivered().withColumns({"first": day, "last": day})
    return top_of_totals(totals_of_orders(dated), customers, limit)


def payment_method(grain: OrderGrain, fanout: bool = False) -> DataFrame:
    """Payments by type; with ``fanout`` a payment counts once per item of its order."""
    delivered = grain.delivered().select(KEY, "customer_id", "items")
    return payment_types(delivered, grain.payments, F.col("items") if fanout else F.lit(1))
