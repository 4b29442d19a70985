"""The four reporting views over the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.columns import ratio
from tradewind.operators.grain import by_order


def day_after(fact: DataFrame) -> Column:
    """Stand-in for today: the day after the last purchase in the data.

    A one-row subquery, so no job runs before the report itself.
    """
    return fact.agg(F.date_add(F.max("order_purchase_date"), 1)).scalar()


def as_of_date(fact: DataFrame, as_of: dt.date | None) -> Column:
    return day_after(fact) if as_of is None else F.lit(as_of)


def v_order_metrics(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_id", "customer_id", "order_purchase_date").agg(
        F.count("*").alias("item_count"),
        F.sum("total_value").alias("order_total"),
        F.max("is_delayed").alias("order_delayed"),
        F.min("order_status").alias("order_status"),
        F.min("etl_loaded_at").alias("etl_loaded_at"),
    )


def v_customer_history(
    fact: DataFrame, customers: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    today = as_of_date(fact, as_of)
    delivered = fact.filter(F.col("is_delivered") == 1)
    per_customer = (
        by_order(delivered, "customer_id", day=F.min("order_purchase_date"),
                 last_day=F.max("order_purchase_date"))
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_purchases"),
            F.sum("value").alias("lifetime_value"),
            F.min("day").alias("first_purchase"),
            F.max("last_day").alias("last_purchase"),
            ratio(F.sum("value"), F.sum("items"), 2).alias("avg_order_value"),
        )
        .withColumn("days_since_last_purchase", F.datediff(today, F.col("last_purchase")))
    )
    places = customers.select("customer_id", "customer_city", "customer_state")
    return per_customer.join(places, "customer_id")


def v_product_performance(fact: DataFrame, products: DataFrame) -> DataFrame:
    per_product = (
        by_order(
            fact, "product_id",
            delivered=F.sum("is_delivered"), delayed=F.sum("is_delayed"),
            days=F.sum("delivery_time_days"), timed=F.count("delivery_time_days"),
        )
        .groupBy("product_id")
        .agg(
            F.count("order_id").alias("orders_sold"),
            F.coalesce(F.sum("delivered"), F.lit(0)).alias("delivered_count"),
            F.sum("value").alias("total_revenue"),
            ratio(F.sum("value"), F.sum("items"), 2).alias("avg_price"),
            ratio(F.sum("days"), F.sum("timed"), 1).alias("avg_delivery_days"),
            ratio(F.sum("delayed"), F.sum("items"), 3).alias("delayed_rate"),
        )
    )
    return per_product.join(products.select("product_id", "product_category_name"), "product_id")


def v_monthly_trend(fact: DataFrame, time: DataFrame) -> DataFrame:
    days = time.select("date_id", "year", "month", "month_name")
    per_order = by_order(
        fact.filter(F.col("is_delivered") == 1), "customer_id", "order_purchase_date"
    )
    return (
        per_order.join(days, F.col("order_purchase_date") == F.col("date_id"))
        .groupBy("year", "month", "month_name")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("value").alias("revenue"),
            F.countDistinct("customer_id").alias("unique_customers"),
            ratio(F.sum("value"), F.count("order_id"), 2).alias("avg_order_value"),
        )
        .orderBy(F.desc("year"), F.desc("month"))
    )
