"""Repeat purchase, cohorts and customer metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window as W, functions as F

from tradewind.functions.columns import count_where, month_number, percent, ratio
from tradewind.operators.grain import by_order
from tradewind.plans.revenue import delivered_orders


def repeat_purchase_rate(fact: DataFrame, customer_key: str = "customer_id") -> DataFrame:
    """One row: one-time and repeat buyers and what they are worth."""
    per_customer = (
        by_order(delivered_orders(fact), customer_key,
                 first=F.min("order_purchase_date"), last=F.max("order_purchase_date"))
        .groupBy(customer_key)
        .agg(
            F.count("order_id").alias("purchase_count"),
            F.sum("value").alias("total_spent"),
            F.datediff(F.max("last"), F.min("first")).alias("lifetime_days"),
        )
    )
    many = F.col("purchase_count")
    return per_customer.agg(
        F.count("*").alias("total_customers"),
        count_where(many == 1).alias("one_time_buyers"),
        count_where(many > 1).alias("repeat_customers"),
        percent(count_where(many > 1), F.count("*")).alias("repeat_purchase_rate_pct"),
        ratio(F.sum(many), F.count("*"), 2).alias("avg_purchases_per_customer"),
        ratio(F.sum("total_spent"), F.count("*"), 2).alias("avg_customer_lifetime_value"),
        F.coalesce(F.sum(F.when(many > 5, F.col("total_spent"))), F.lit(0))
        .alias("revenue_from_high_frequency_customers"),
        F.max(many).alias("max_purchases_by_single_customer"),
        ratio(F.sum("lifetime_days"), F.count("*"), 2).alias("avg_customer_lifetime_days"),
    )


def cohort_retention(
    fact: DataFrame, as_of: dt.date | None = None, customer_key: str = "customer_id"
) -> DataFrame:
    """Share of each first-purchase month still buying n calendar months later."""
    # A customer's months are one small set, however many items there are.
    active = (
        delivered_orders(fact)
        .groupBy(customer_key)
        .agg(F.collect_set(F.trunc("order_purchase_date", "MM")).alias("months"))
    )
    dated = active.select(customer_key, F.array_min("months").alias("cohort"),
                          F.explode("months").alias("month"))
    if as_of is not None:
        dated = dated.filter(F.col("month") <= F.trunc(F.lit(as_of), "MM"))
    offset = month_number(F.col("month")) - month_number(F.col("cohort"))
    sizes = (
        dated.groupBy("cohort", offset.alias("months_since_first_purchase"))
        .agg(F.count(customer_key).alias("customers_in_cohort"))
    )
    # Everyone of a cohort is active at offset 0, so that row is the cohort size.
    size = F.max(
        F.when(F.col("months_since_first_purchase") == 0, F.col("customers_in_cohort"))
    ).over(W.partitionBy("cohort"))
    return sizes.select(
        F.date_format("cohort", "yyyy-MM").alias("cohort_month"),
        "months_since_first_purchase",
        "customers_in_cohort",
        percent(F.col("customers_in_cohort"), size).alias("cohort_retention_pct"),
    ).orderBy("cohort_month", "months_since_first_purchase")


def retention_60d(fact: DataFrame, days: int = 60) -> DataFrame:
    """Share of each month's new customers who order again within the given days."""
    per_order = (
        delivered_orders(fact)
        .groupBy("customer_id", "order_id")
        .agg(F.min("order_purchase_date").alias("day"))
    )
    # The second order decides. Each task passes on two orders per customer at most.
    first_two = (
        per_order.withColumn(
            "_place", F.row_number().over(W.partitionBy("customer_id").orderBy("day", "order_id"))
        )
        .filter("_place <= 2")
        .groupBy("customer_id")
        .agg(F.min("day").alias("first"), F.max("day").alias("second"), F.count("*").alias("n"))
    )
    again = (F.col("n") > 1) & (F.datediff("second", "first") <= days)
    return first_two.groupBy(F.date_format("first", "yyyy-MM").alias("cohort_month")).agg(
        F.count("*").alias("new_customers"),
        count_where(again).alias("returned_customers"),
        percent(count_where(again), F.count("*")).alias("retention_pct"),
    )


def order_counts_per_customer(orders: DataFrame, customer_key: str = "customer_id") -> DataFrame:
    """Orders of every customer, all statuses; cleaning has made orders unique."""
    return orders.groupBy(customer_key).agg(F.count("order_id").alias("orders"))
