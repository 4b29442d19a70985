"""Product and category questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tradewind.functions.columns import percent, ratio
from tradewind.operators.grain import by_order, mean_item_value
from tradewind.plans.revenue import check_limit, delivered_orders
from tradewind.session import settle


def _product_totals(fact: DataFrame) -> DataFrame:
    """Delivered totals per product. Items are grouped by order and customer
    first, so orders are counted and only customers need a distinct count."""
    per_order = by_order(
        delivered_orders(fact), "customer_id", "product_id",
        price=F.sum("price"), freight=F.sum("freight_value"), delayed=F.sum("is_delayed"),
        first=F.min("order_purchase_date"), last=F.max("order_purchase_date"),
    )
    return per_order.groupBy("product_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("items").alias("units_sold"),
        F.sum("price").alias("total_price_revenue"),
        F.sum("freight").alias("total_freight"),
        F.sum("value").alias("total_revenue"),
        ratio(F.sum("price"), F.sum("items"), 2).alias("avg_price"),
        mean_item_value(2).alias("avg_item_value"),
        F.countDistinct("customer_id").alias("unique_customers"),
        ratio(F.sum("delayed"), F.sum("items"), 4).alias("delayed_rate"),
        F.min("first").alias("first_sale_date"),
        F.max("last").alias("last_sale_date"),
    )


def top_products(
    fact: DataFrame, products: DataFrame, limit: int = 20, share_of: str = "top"
) -> DataFrame:
    """Best products by revenue with ranks and shares of the listed products,
    or with ``share_of="all"`` of all products."""
    totals = _product_totals(fact).join(
        products.select("product_id", "product_category_name"), "product_id"
    )
    if share_of == "all":
        totals = settle(totals)  # read for the best and for the sum
    best = totals.orderBy(F.desc("total_revenue"), "product_id").limit(limit)
    # The windows below see the listed products only.
    everything = W.partitionBy()
    in_order = W.orderBy(F.desc("total_revenue"), "product_id")
    if share_of == "all":
        whole = totals.agg(F.sum("total_revenue")).scalar()
    else:
        whole = F.sum("total_revenue").over(everything)
    running = F.sum("total_revenue").over(in_order.rowsBetween(W.unboundedPreceding, 0))
    return best.withColumns({
        "revenue_rank": F.rank().over(W.orderBy(F.desc("total_revenue"))),
        "volume_rank": F.rank().over(W.orderBy(F.desc("units_sold"))),
        "pct_of_total_revenue": percent(F.col("total_revenue"), whole),
        "cumulative_pct_of_revenue": percent(running, whole),
    }).orderBy("revenue_rank", "product_id")


def api_top_products(fact: DataFrame, products: DataFrame, limit: int = 10) -> DataFrame:
    """Delivered items, revenue and mean price of the best products."""
    check_limit(limit)
    per_product = delivered_orders(fact).groupBy("product_id").agg(
        F.count("*").alias("items_sold"),
        F.sum("total_value").alias("total_revenue"),
        ratio(F.sum("price"), F.count("price")).alias("avg_price"),
    )
    return (
        per_product.join(products.select("product_id", "product_category_name"), "product_id")
        .orderBy(F.desc("total_revenue"), "product_id")
        .limit(limit)
        .select(
            "product_id", F.col("product_category_name").alias("category"), "items_sold",
            F.col("total_revenue").cast("double").alias("total_revenue"), "avg_price",
        )
    )


def category_performance(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Delivered and shipped items per category with revenue rank and share."""
    wanted = fact.filter(F.col("order_status").isin("delivered", "shipped"))
    # The category comes first, so items are grouped once.
    per_order = by_order(
        wanted.join(products.select("product_id", "product_category_name"), "product_id"),
        "product_category_name", "customer_id",
        delayed=F.sum("is_delayed"), delivered=F.sum("is_delivered"),
    )
    per_category = per_order.groupBy("product_category_name").agg(
        F.count("order_id").alias("order_count"),
        F.sum("items").alias("units_sold"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum("value").alias("total_revenue"),
        mean_item_value(2).alias("avg_item_value"),
        ratio(F.sum("delayed"), F.sum("items"), 4).alias("delayed_rate"),
        percent(F.sum("delivered"), F.sum("items")).alias("delivery_rate_pct"),
    )
    # One row per category.
    return per_category.withColumns({
        "revenue_rank": F.rank().over(W.orderBy(F.desc("total_revenue"))),
        "revenue_contribution_pct": percent(
            F.col("total_revenue"), F.sum("total_revenue").over(W.partitionBy())
        ),
        "current_orders": F.col("order_count"),
    }).orderBy(F.desc("total_revenue"))
