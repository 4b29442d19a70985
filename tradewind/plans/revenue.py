"""Revenue, order value and payment questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tradewind.functions.columns import change_percent, count_where, half_up, percent, ratio
from tradewind.operators.grain import by_order, mean_item_value
from tradewind.operators.ordering import grouped_quantiles
from tradewind.session import settle


def delivered_orders(fact: DataFrame) -> DataFrame:
    """Items of orders whose status text says delivered."""
    return fact.filter(F.col("order_status") == "delivered")


def check_limit(limit: int, highest: int = 100) -> int:
    if not 1 <= limit <= highest:
        raise ValueError(f"limit must lie between 1 and {highest}, got {limit}")
    return limit


def customer_totals(fact: DataFrame, customer_key: str = "customer_id") -> DataFrame:
    """Delivered orders, items, value and dates per customer."""
    return totals_of_orders(by_order(
        delivered_orders(fact), customer_key,
        first=F.min("order_purchase_date"), last=F.max("order_purchase_date"),
    ), customer_key)


def totals_of_orders(per_order: DataFrame, customer_key: str = "customer_id") -> DataFrame:
    """The same from one row per delivered order."""
    return per_order.groupBy(customer_key).agg(
        F.count("order_id").alias("total_orders"),
        F.sum("items").alias("total_items"),
        F.sum("value").alias("total_revenue"),
        mean_item_value().alias("avg_item_value"),
        F.min("first").alias("first_order_date"),
        F.max("last").alias("last_order_date"),
    )


def top_customers(fact: DataFrame, customers: DataFrame, limit: int = 10) -> DataFrame:
    """Customers with the highest delivered revenue; ties by customer."""
    return top_of_totals(customer_totals(fact), customers, limit)


def top_of_totals(totals: DataFrame, customers: DataFrame, limit: int = 10) -> DataFrame:
    places = customers.select("customer_id", "customer_city", "customer_state")
    return (
        # One row per customer on both sides: a hot customer is gone before the join.
        totals
        .join(places, "customer_id")
        .withColumn(
            "customer_lifetime_days",
            F.datediff("last_order_date", "first_order_date"),
        )
        .orderBy(F.desc("total_revenue"), "customer_id")
        .limit(limit)
    )


def api_top_customers(fact: DataFrame, customers: DataFrame, limit: int = 10) -> DataFrame:
    return top_customers(fact, customers, check_limit(limit)).select(
        "customer_id", F.col("customer_city").alias("city"), F.col("customer_state").alias("state"),
        "total_orders", "total_items",
        F.col("total_revenue").cast("double").alias("total_revenue"),
        "avg_item_value",
    )


def monthly_totals(fact: DataFrame) -> DataFrame:
    """Delivered revenue, orders, customers and items per purchase month."""
    per_order = by_order(delivered_orders(fact), "customer_id", "order_purchase_ym")
    return per_order.groupBy(F.col("order_purchase_ym").alias("year_month")).agg(
        F.sum("value").alias("revenue"),
        F.count("order_id").alias("order_count"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum("items").alias("item_count"),
        mean_item_value().alias("avg_item_value"),
    )


def year_and_month(column: str) -> list[Column]:
    """Year and month number of a yyyy-MM text."""
    return [
        F.substring(column, 1, 4).cast("int").alias("year"),
        F.substring(column, 6, 2).cast("int").alias("month"),
    ]


def api_monthly_revenue(fact: DataFrame) -> DataFrame:
    return monthly_totals(fact).select(
        *year_and_month("year_month"), "year_month",
        F.col("revenue").cast("double").alias("revenue"),
        F.col("order_count").alias("orders"), F.col("unique_customers").alias("customers"),
    ).orderBy("year", "month")


def monthly_revenue_trend(fact: DataFrame) -> DataFrame:
    """Month over month, year over year and running revenue."""
    months = monthly_totals(fact).select("*", *year_and_month("year_month"))
    # Windows over calendar months: a few rows per year of history.
    in_time, same_month = W.orderBy("year", "month"), W.partitionBy("month").orderBy("year")
    revenue = F.col("revenue")
    return (
        months.withColumns({
            "prev_month_revenue": F.lag("revenue").over(in_time),
            "prev_year_same_month": F.lag("revenue").over(same_month),
            "cumulative_revenue": F.sum("revenue").over(in_time),
        })
        .withColumns({
            "mom_growth_pct": change_percent(revenue, F.col("prev_month_revenue")),
            "yoy_growth_pct": change_percent(revenue, F.col("prev_year_same_month")),
        })
        .orderBy(F.desc("year"), F.desc("month"))
    )


def order_values(fact: DataFrame) -> DataFrame:
    """Value and items of each delivered order."""
    return by_order(
        delivered_orders(fact), "customer_id", "order_purchase_date", "order_purchase_ym"
    ).withColumnRenamed("value", "order_value")


def aov_analysis(fact: DataFrame) -> DataFrame:
    """Order value per month: mean, spread, median, rank and distance to the mean month."""
    values = settle(order_values(fact).select(
        "order_id", "customer_id", "order_purchase_ym", "order_value"
    ))
    medians = grouped_quantiles(values, ["order_purchase_ym"], "order_value", [0.5])
    per_month = values.groupBy("order_purchase_ym").agg(
        F.count("order_id").alias("total_orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
        ratio(F.sum("order_value"), F.count("*")).alias("_mean"),
        F.stddev_samp(F.col("order_value").cast("double")).alias("_spread"),
        F.min("order_value").alias("min_order"),
        F.max("order_value").alias("max_order"),
    )
    median = _lookup({m: v[0] for (m,), v in medians.items()}, F.col("order_purchase_ym"))
    everything = W.partitionBy()
    return (
        per_month.select(
            *year_and_month("order_purchase_ym"),
            "total_orders", "unique_customers",
            half_up(F.col("_mean"), 2).alias("aov"),
            half_up(F.col("_spread"), 2).alias("aov_stddev"),
            "min_order", "max_order",
            half_up(median, 2).alias("median_aov"),
            F.rank().over(W.orderBy(F.desc("_mean"))).alias("aov_rank"),
            half_up(F.col("_mean") - F.avg("_mean").over(everything), 2).alias("aov_vs_average"),
        )
        .orderBy(F.desc("year"), F.desc("month"))
    )


def _lookup(values: dict, key: Column) -> Column:
    """Value of a small driver-side table (here: one entry per month)."""
    if not values:
        return F.lit(None).cast("double")
    entries = [F.lit(x) for pair in values.items() for x in pair]
    return F.element_at(F.create_map(*entries), key)


def payment_method(fact: DataFrame, payments: DataFrame) -> DataFrame:
    """Payments of delivered orders by type; every payment counts once."""
    return _by_payment_type(fact, payments, F.lit(1))


def payment_method_fanout(fact: DataFrame, payments: DataFrame) -> DataFrame:
    """The same question with a payment counted once per item of its order.

    The repeated rows are not made: sums are multiplied by the number of items.
    """
    return _by_payment_type(fact, payments, F.col("items"))


def _by_payment_type(fact: DataFrame, payments: DataFrame, times: Column) -> DataFrame:
    # An order has one customer, so grouping by order alone keeps the rows placed
    # for the join.
    delivered = delivered_orders(fact).groupBy("order_id").agg(
        F.min("customer_id").alias("customer_id"), F.count("*").alias("items")
    )
    return payment_types(delivered, paid_by_order(payments), times)


def paid_by_order(payments: DataFrame) -> DataFrame:
    """One row per order and payment type.

    An order with very many payments is merged inside the map tasks, and orders need no
    distinct count.
    """
    return payments.groupBy("order_id", "payment_type").agg(
        F.count("*").alias("n"),
        F.sum("payment_value").alias("value"),
        F.count("payment_value").alias("n_value"),
        F.sum("payment_installments").alias("installments"),
        F.count("payment_installments").alias("n_installments"),
    )


def payment_types(delivered: DataFrame, per_order: DataFrame, times: Column) -> DataFrame:
    """Payments by type, of one row per delivered order and ``paid_by_order``."""
    paid = delivered.join(per_order, "order_id").withColumns({
        c: F.col(c) * times for c in ("n", "value", "n_value", "installments", "n_installments")
    })
    per_type = paid.groupBy("payment_type").agg(
        F.count("order_id").alias("order_count"),
        F.sum("value").alias("total_payment_value"),
        ratio(F.sum("value"), F.sum("n_value"), 2).alias("avg_payment_value"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum("n").alias("total_payment_records"),
        ratio(F.sum("installments"), F.sum("n_installments"), 1).alias("avg_installments"),
    )
    # One row per payment type.
    total = F.sum("total_payment_value").over(W.partitionBy())
    return per_type.withColumns({
        "revenue_contribution_pct": percent(F.col("total_payment_value"), total),
        "payment_method_rank": F.rank().over(W.orderBy(F.desc("total_payment_value"))),
    }).orderBy(F.desc("total_payment_value"))


def delayed_orders(fact: DataFrame, grain: str = "item") -> DataFrame:
    """Delays per month. With ``grain="order"`` a late order counts once,
    otherwise each of its late items counts."""
    late = F.col("is_delayed") == 1
    per_order = by_order(
        delivered_orders(fact), "order_purchase_ym",
        late_items=count_where(late), late_order=F.max("is_delayed"),
        days=F.sum("delivery_time_days"), timed=F.count("delivery_time_days"),
        planned=F.sum("estimated_delivery_days"), planned_n=F.count("estimated_delivery_days"),
        late_value=F.sum(F.when(late, F.col("total_value"))),
    )
    counted = F.sum("late_order" if grain == "order" else "late_items")
    return (
        per_order.groupBy(F.col("order_purchase_ym").alias("order_month"))
        .agg(
            F.count("order_id").alias("total_orders"),
            counted.alias("delayed_orders"),
            percent(counted, F.count("order_id")).alias("delayed_rate_pct"),
            ratio(F.sum("days"), F.sum("timed"), 1).alias("avg_delivery_time_days"),
            ratio(F.sum("planned"), F.sum("planned_n"), 1).alias("avg_estimated_delivery_days"),
            F.coalesce(F.sum("late_value"), F.lit(0)).alias("revenue_from_delayed_orders"),
        )
        .withColumn(
            "prev_month_delayed_orders", F.lag("delayed_orders").over(W.orderBy("order_month"))
        )
        .orderBy(F.desc("order_month"))
    )


