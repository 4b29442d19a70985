"""Named business metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tradewind.functions.columns import count_where, half_up, parse_timestamp, percent, ratio
from tradewind.operators.grain import by_order
from tradewind.operators.ordering import column_quantiles, rows_at
from tradewind.plans.customers import order_counts_per_customer
from tradewind.plans.revenue import customer_totals, delivered_orders
from tradewind.session import settle


def items_of_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Every order with the value of its items; orders without items stay."""
    per_order = items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("value")
    )
    return orders.select("order_id", "customer_id", "order_status").join(
        per_order, "order_id", "left"
    )


def _revenue() -> Column:
    return F.coalesce(F.sum("value"), F.lit(0))


def total_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    return items_of_orders(orders, items).agg(_revenue().alias("total_revenue"))


def aov(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue per distinct order."""
    return items_of_orders(orders, items).agg(
        _revenue().alias("total_revenue"),
        F.countDistinct("order_id").alias("orders"),
        ratio(_revenue(), F.countDistinct("order_id"), 2).alias("aov"),
    )


def repeat_rate(orders: DataFrame, customer_key: str = "customer_id") -> DataFrame:
    """Share of customers with more than one order, all statuses."""
    counts = order_counts_per_customer(orders, customer_key)
    repeat = count_where(F.col("orders") > 1)
    return counts.agg(
        F.count("*").alias("customers"), repeat.alias("repeat_customers"),
        percent(repeat, F.count("*")).alias("repeat_rate_pct"),
    )


def clv_distribution(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Mean, median and extremes of the value per customer."""
    value = settle(
        items_of_orders(orders, items).groupBy("customer_id").agg(_revenue().alias("clv"))
    )
    median = column_quantiles(value, ["clv"], [0.5])["clv"][0]
    return value.agg(
        ratio(F.sum("clv"), F.count("*"), 2).alias("mean_clv"),
        half_up(F.lit(median), 2).alias("median_clv"),
        F.min("clv").alias("min_clv"),
        F.max("clv").alias("max_clv"),
    )


def order_counts(orders: DataFrame, customer_key: str = "customer_id") -> DataFrame:
    per_customer = order_counts_per_customer(orders, customer_key)
    return per_customer.agg(
        F.sum("orders").alias("total_orders"), F.count("*").alias("unique_customers"),
        ratio(F.sum("orders"), F.count("*"), 2).alias("orders_per_customer"),
    )


def revenue_by_status(orders: DataFrame, items: DataFrame) -> DataFrame:
    per_status = items_of_orders(orders, items).groupBy("order_status").agg(
        _revenue().alias("revenue")
    )
    return per_status.withColumn(
        "revenue_pct", percent(F.col("revenue"), F.sum("revenue").over(W.partitionBy()), 1)
    ).orderBy(F.desc("revenue"))


def on_time_rate(orders: DataFrame) -> DataFrame:
    """Orders delivered on or before the estimate, in percent of all orders."""
    on_time = count_where(
        F.col("order_delivered_customer_date") <= F.col("order_estimated_delivery_date")
    )
    return orders.agg(
        F.count("*").alias("orders"), on_time.alias("on_time_orders"),
        percent(on_time, F.count("*")).alias("on_time_rate_pct"),
    )


def quality_rates(
    df: DataFrame, critical: list[str], key: list[str], timestamps: list[str]
) -> DataFrame:
    """Null rate of critical fields, duplicate rate of the key, and the share of
    timestamp texts that can be read, in percent."""
    distinct = df.groupBy(*key).agg(F.lit(1).alias("one")).agg(F.count("*")).scalar()

    def total(parts: list[Column]) -> Column:
        return reduce(lambda a, b: a + b, parts, F.lit(0))

    return df.agg(
        F.count("*").alias("rows"),
        total([count_where(F.col(c).isNull()) for c in critical]).alias("nulls"),
        total([count_where(parse_timestamp(F.col(c)).isNotNull()) for c in timestamps])
        .alias("readable"),
        total([F.count(c) for c in timestamps]).alias("present"),
    ).select(
        "rows",
        percent(F.col("nulls"), F.col("rows") * len(critical), 4).alias("null_rate_pct"),
        percent(F.col("rows") - distinct, F.col("rows"), 4).alias("duplicate_rate_pct"),
        percent(F.col("readable"), F.col("present"), 4).alias("type_compliance_pct"),
    )


def revenue_concentration(fact: DataFrame, top_share: float = 0.2) -> DataFrame:
    """Delivered revenue share of the best customers and of the best products."""
    customers = settle(customer_totals(fact).select("customer_id", "total_revenue"))
    n = customers.count()
    total = customers.agg(F.sum("total_revenue")).scalar()
    parts = [_top_customer_share(customers, max(int(n * top_share), 1), total)]
    in_order = [F.desc("total_revenue"), F.asc("product_id")]
    products = settle(
        delivered_orders(fact).groupBy("product_id")
        .agg(F.sum("total_value").alias("total_revenue")).orderBy(*in_order).limit(50)
    )
    for k in (10, 50):
        best = products.orderBy(*in_order).limit(k)
        parts.append(best.agg(
            F.lit(f"top_{k}_products").alias("part"),
            F.count("*").alias("members"),
            percent(F.sum("total_revenue"), total).alias("revenue_pct"),
        ))
    return reduce(DataFrame.unionByName, parts)


def _top_customer_share(customers: DataFrame, members: int, total: Column) -> DataFrame:
    """Share of the first ``members`` customers by revenue. Only the last of them
    is looked up; everyone not behind that customer is summed."""
    order = [F.desc("total_revenue"), F.asc("customer_id")]
    last = rows_at(customers, order, [members]).get(members)
    value, who = F.col("total_revenue"), F.col("customer_id")
    inside = F.lit(False) if last is None else (
        (value > F.lit(last["total_revenue"]))
        | ((value == F.lit(last["total_revenue"])) & (who <= F.lit(last["customer_id"])))
    )
    return customers.filter(inside).agg(
        F.lit("top_20pct_customers").alias("part"),
        F.count("*").alias("members"),
        percent(F.sum("total_revenue"), total).alias("revenue_pct"),
    )


def revenue_by_region(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivered revenue and its share by customer state."""
    per_customer = delivered_orders(fact).groupBy("customer_id").agg(
        F.sum("total_value").alias("value")
    )
    per_state = (
        per_customer.join(customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(F.sum("value").alias("revenue"), F.count("*").alias("customers"))
    )
    return per_state.withColumn(
        "revenue_pct", percent(F.col("revenue"), F.sum("revenue").over(W.partitionBy()))
    )


def installment_usage(payments: DataFrame) -> DataFrame:
    """Share of payments in several instalments, and their mean number."""
    split = count_where(F.col("payment_installments") > 1)
    return payments.agg(
        F.count("*").alias("payments"), split.alias("installment_payments"),
        percent(split, F.count("*")).alias("installment_pct"),
        ratio(F.sum("payment_installments"), F.count("payment_installments"), 2)
        .alias("avg_installments"),
    )


def seasonality(monthly: DataFrame) -> DataFrame:
    """Peak and trough month and the spread of monthly revenue."""
    best = F.struct("total_revenue", "year_month")
    return monthly.agg(F.max(best).alias("peak"), F.min(best).alias("trough"),
                       F.stddev_samp(F.col("total_revenue").cast("double")).alias("spread")).select(
        F.col("peak.year_month").alias("peak_month"),
        F.col("peak.total_revenue").alias("peak_revenue"),
        F.col("trough.year_month").alias("trough_month"),
        F.col("trough.total_revenue").alias("trough_revenue"),
        percent(F.col("peak.total_revenue") - F.col("trough.total_revenue"),
                F.col("trough.total_revenue")).alias("peak_to_trough_pct"),
        half_up(F.col("spread"), 2).alias("revenue_stddev"),
    )


def purchase_frequency_split(fact: DataFrame) -> DataFrame:
    """Shares of customers who bought once, at least twice, at least five times."""
    per_customer = by_order(delivered_orders(fact), "customer_id").groupBy("customer_id").agg(
        F.count("order_id").alias("orders")
    )
    n, many = F.count("*"), F.col("orders")
    return per_customer.agg(
        n.alias("customers"),
        percent(count_where(many == 1), n).alias("one_time_pct"),
        percent(count_where(many >= 2), n).alias("repeat_pct"),
        percent(count_where(many >= 5), n).alias("loyal_pct"),
    )
