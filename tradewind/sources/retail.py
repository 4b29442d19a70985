"""The nine raw commerce tables derived from the driver's retail tables.

Everything is a column expression over the given parquet files, so work grows
with them. Some values are blanked or spoiled on purpose (bad dates, missing
categories, unknown sellers), so that cleaning has something to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewind.schemas import DEFAULT_RULES

# Prices and payments of these tables go beyond the default bounds.
RULES = {
    **DEFAULT_RULES,
    "order_items": DEFAULT_RULES["order_items"].with_ranges(price=(0, 1_000_000)),
    "payments": DEFAULT_RULES["payments"].with_ranges(payment_value=(0, 10_000_000)),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    purchased = F.expr("timestampadd(SECOND, o_orderkey * 61 % 86400, o_orderdate)")
    key = F.col("o_orderkey")

    def later(days: str, hours: str) -> Column:
        return F.expr(
            "timestampadd(HOUR, 24 * (%s) + (%s), "
            "timestampadd(SECOND, o_orderkey * 61 %% 86400, o_orderdate))" % (days, hours)
        )

    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise("processing")
    )
    arrived = ((F.col("o_orderstatus") == "F") & (key % 20 != 0)) | (
        (F.col("o_orderstatus") == "O") & (key % 33 == 0)
    )
    return table(spark, folder, "orders").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        _text(purchased).alias("order_purchase_timestamp"),
        F.when(key % 50 == 0, None).when(key % 97 == 0, "unknown")
        .otherwise(_text(later("0", "o_orderkey % 48"))).alias("order_approved_at"),
        F.when(F.col("o_orderstatus") == "P", None).when(key % 89 == 0, "0000-00-00 00:00:00")
        .otherwise(_text(later("1 + o_orderkey % 5", "0"))).alias("order_delivered_carrier_date"),
        F.when(arrived, _text(later("3 + o_orderkey * 7 % 38", "o_orderkey % 24")))
        .alias("order_delivered_customer_date"),
        _text(F.expr("timestampadd(DAY, 14 + o_orderkey * 11 % 23, o_orderdate)"))
        .alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    freight = F.col("l_quantity").cast("int") * F.col("l_tax").cast("decimal(4,2)")
    return table(spark, folder, "lineitem").select(
        key.alias("order_id"),
        line.alias("order_item_id"),
        F.when((key % 200 == 0) & (line == 2), None).otherwise(F.col("l_partkey"))
        .alias("product_id"),
        F.when((key % 64 == 0) & (line == 1), -1 - F.col("l_suppkey"))
        .otherwise(F.col("l_suppkey")).alias("seller_id"),
        F.when((key % 3 == 0) & (line == 7), None).otherwise(_text(F.col("l_shipdate")))
        .alias("shipping_limit_date"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        freight.cast("decimal(10,2)").alias("freight_value"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    key = F.col("c_custkey")
    return (
        table(spark, folder, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            key.alias("customer_id"),
            (key - key % 2).alias("customer_unique_id"),
            F.lpad((key % 100000).cast("string"), 5, "0").alias("customer_zip_code_prefix"),
            F.when(key % 40 == 0, None).otherwise(F.col("n_name")).alias("customer_city"),
            F.substring("r_name", 1, 2).alias("customer_state"),
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    described, measured = key % 50 != 7, key % 61 != 0
    return table(spark, folder, "part").select(
        key.alias("product_id"),
        F.when(described, F.lower("p_type")).alias("product_category_name"),
        F.when(described, F.length("p_name")).alias("product_name_lenght"),
        F.when(described, size * 10).alias("product_description_lenght"),
        F.when(described, (key % 6 + 1).cast("int")).alias("product_photos_qty"),
        F.when(measured, F.floor("p_retailprice").cast("int")).alias("product_weight_g"),
        F.when(measured, size + 10).alias("product_length_cm"),
        F.when(measured, size + 2).alias("product_height_cm"),
        F.when(measured, size + 11).alias("product_width_cm"),
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    key = F.col("s_suppkey")
    return (
        table(spark, folder, "supplier")
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            key.alias("seller_id"),
            F.lpad((key % 100000).cast("string"), 5, "0").alias("seller_zip_code_prefix"),
            F.col("n_name").alias("seller_city"),
            F.substring("r_name", 1, 2).alias("seller_state"),
        )
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """One payment per order, and a voucher beside it on every tenth."""
    key = F.col("o_orderkey")
    main = F.struct(
        F.lit(1).alias("payment_sequential"),
        F.lower(F.substring("o_orderpriority", 3, 20)).alias("payment_type"),
        (key % 12 + 1).cast("int").alias("payment_installments"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("payment_value"),
    )
    voucher = F.struct(
        F.lit(2).alias("payment_sequential"),
        F.lit("voucher").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.lit("10.00").cast("decimal(10,2)").alias("payment_value"),
    )
    both = F.when(key % 10 == 0, F.array(main, voucher)).otherwise(F.array(main))
    return (
        table(spark, folder, "orders")
        .select(key.alias("order_id"), F.explode(both).alias("p"))
        .select("order_id", "p.*")
    )


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("doc_id")
    return (
        table(spark, folder, "documents")
        .join(table(spark, folder, "labels"), "doc_id", "left")
        .select(
            key.alias("review_id"),
            key.alias("order_id"),
            (1 + 3 * F.col("quality") + (1 - F.col("toxic"))).alias("review_score"),
            F.when(key % 9 == 0, F.col("source")).alias("review_comment_title"),
            F.when(key % 5 != 0, F.col("text")).alias("review_comment_message"),
            _text(F.expr("timestampadd(HOUR, doc_id, timestamp_ntz'2024-01-01 00:00:00')"))
            .alias("review_creation_date"),
            _text(F.expr(
                "timestampadd(HOUR, doc_id + n_chars % 240, timestamp_ntz'2024-01-01 00:00:00')"
            )).alias("review_answer_timestamp"),
        )
    )


def geolocation(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("geolocation_zip_code_prefix"),
            (F.col("n_nationkey") * 2.0 - 23.5).alias("geolocation_lat"),
            (F.col("n_nationkey") * -1.5 - 46.5).alias("geolocation_lng"),
            F.col("n_name").alias("geolocation_city"),
            F.substring("r_name", 1, 2).alias("geolocation_state"),
        )
    )


def category_translation(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(F.col("p_type")).distinct().select(
        F.lower("p_type").alias("product_category_name"),
        F.initcap(F.lower("p_type")).alias("product_category_name_english"),
    )


TABLES = {
    "orders": orders, "order_items": order_items, "customers": customers, "products": products,
    "payments": payments, "reviews": reviews, "sellers": sellers, "geolocation": geolocation,
    "category_translation": category_translation,
}


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: make(spark, folder) for name, make in TABLES.items()}
