"""Seller delivery performance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewind.functions.columns import count_where, ratio
from tradewind.operators.grain import by_order
from tradewind.operators.ordering import with_global_rank
from tradewind.session import settle


def seller_totals(
    fact: DataFrame, sellers: DataFrame, min_orders: int = 10, grain: str = "item"
) -> DataFrame:
    """Totals of sellers with enough orders. With ``grain="order"`` delivered and
    delayed count orders, otherwise items."""
    delivered = F.col("order_status") == "delivered"
    per_order = by_order(
        fact, "seller_id",
        delivered_items=count_where(delivered),
        late_items=count_where(F.col("is_delayed") == 1),
        delayed=F.sum("is_delayed"),
        days=F.sum("delivery_time_days"), timed=F.count("delivery_time_days"),
    )
    if grain == "order":
        done = count_where(F.col("delivered_items") > 0)
        late = count_where(F.col("late_items") > 0)
    else:
        done, late = F.sum("delivered_items"), F.sum("late_items")
    per_seller = (
        per_order.groupBy("seller_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("items").alias("total_items"),
            F.sum("value").alias("total_revenue"),
            done.alias("delivered_orders"),
            late.alias("delayed_orders"),
            ratio(F.sum("days"), F.sum("timed"), 1).alias("avg_delivery_time_days"),
            ratio(F.sum("delayed"), F.sum("items"), 4).alias("delayed_rate"),
        )
        .filter(F.col("total_orders") >= min_orders)
    )
    return per_seller.join(sellers.select("seller_id", "seller_city", "seller_state"), "seller_id")


def seller_performance(
    fact: DataFrame, sellers: DataFrame, min_orders: int = 10, grain: str = "item"
) -> DataFrame:
    """Seller totals ranked by revenue and by delay, with a performance tier."""
    totals = settle(seller_totals(fact, sellers, min_orders, grain))
    ranked = settle(
        with_global_rank(totals, "total_revenue", "seller_id", "revenue_rank", descending=True)
    )
    ranked = with_global_rank(ranked, "delayed_rate", "seller_id", "performance_rank")
    rate = F.col("delayed_rate")
    return ranked.withColumn(
        "performance_tier",
        F.when(rate <= 0.05, "Excellent").when(rate <= 0.10, "Good")
        .when(rate <= 0.20, "Fair").otherwise("Poor"),
    )
