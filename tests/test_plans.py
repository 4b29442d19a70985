"""What the physical plans must look like to hold on large tables."""

import re

import pytest
from pyspark.sql import functions as F

from tradewind import registry
from tradewind.operators import cleaning, star
from tradewind.plans import customers, pipeline, revenue, rfm, views
from tradewind.sources import retail

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


@pytest.fixture(scope="module")
def house(spark):
    return registry.house(spark, FOLDER)


def test_dedupe_prunes_rows_before_the_shuffle(spark):
    text = plan(cleaning.dedupe_first(retail.order_items(spark, FOLDER), ["order_id", "order_item_id"]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_second_order_is_found_before_the_shuffle(house):
    text = plan(customers.retention_60d(house.fact))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_reports_read_only_their_columns_and_push_the_filter(house):
    text = plan(revenue.monthly_totals(house.fact))
    [columns] = scans(text)
    assert {c.split(":")[0] for c in columns.split(",") if ":" in c} <= {
        "order_id", "customer_id", "order_status", "total_value"
    }
    assert "EqualTo(order_status,delivered)" in text


def test_month_filter_prunes_partitions(house):
    text = plan(revenue.monthly_totals(house.fact.filter("order_purchase_ym >= '1999-01'")))
    assert re.search(r"PartitionFilters: \[[^\]]*1999-01", text)


def test_top_n_does_not_sort_everything(house):
    text = plan(revenue.top_customers(house.fact, house.dims["dim_customers"]))
    assert "TakeOrderedAndProject" in text


def test_customer_scores_need_no_one_task_window(house):
    base = rfm.rfm_base(house.fact, house.dims["dim_customers"])
    for df in (rfm.rfm_scores(base), rfm.rfm_sql(house.fact, house.dims["dim_customers"])):
        assert "Window" not in plan(df)


def test_fact_join_shuffles_each_side_once(spark):
    orders = cleaning.coerce_timestamps(
        retail.orders(spark, FOLDER),
        [c for c in star.ORDER_COLUMNS if c.endswith(("_at", "_date", "_timestamp"))],
    ).withColumns({"is_approved": F.lit(1), "is_shipped": F.lit(1), "is_delivered": F.lit(1)})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(star.fact_order_items(orders, retail.order_items(spark, FOLDER)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(order_id") == 2


def test_reference_filter_does_not_shuffle_the_fact(house):
    text = plan(cleaning.referential_filter(house.fact, house.dims))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_only_bounded_tables_are_broadcast_by_hint(house):
    text = plan(views.v_monthly_trend(house.fact, house.dims["dim_time"]))
    assert "BroadcastHashJoin" in text


HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}


def test_an_order_with_a_third_of_the_items_is_split_in_the_join(spark):
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5_000)
    items = spark.range(60_000).select(
        hot.alias("order_id"), F.col("id").cast("int").alias("order_item_id"),
        F.xxhash64("id").cast("decimal(20,0)").alias("price"), F.lit(1).alias("freight_value"),
    ).repartition(16)
    at = F.lit("2023-01-01").cast("timestamp_ntz")
    orders = spark.range(5_000).select(
        F.col("id").alias("order_id"), (F.col("id") % 50).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        *[at.alias(c) for c in star.ORDER_COLUMNS if c.endswith(("_at", "_date", "_timestamp"))],
        *[F.lit(1).alias(c) for c in ("is_approved", "is_shipped", "is_delivered")],
    )
    for key, value in HOT.items():
        spark.conf.set(key, value)
    try:
        totals = revenue.customer_totals(star.fact_order_items(orders, items))
        rows = {r.customer_id: (r.total_orders, r.total_items) for r in totals.collect()}
        assert "SortMergeJoin(skew=true)" in plan(totals)
    finally:
        for key in HOT:
            spark.conf.unset(key)
    expected = {r.customer_id: (r.o, r.n) for r in items.groupBy(
        (F.col("order_id") % 50).alias("customer_id")
    ).agg(F.countDistinct("order_id").alias("o"), F.count("*").alias("n")).collect()}
    assert rows == expected


def test_measures_of_the_stored_fact_are_not_shuffled_for_its_months(spark, house):
    fact, _, _ = pipeline._star(house.tables, registry.RUN_TS, "commerce_csv", dealt=True)
    few = fact.select("order_id", "total_value", "delivery_time_days", "data_source")
    text = few._jdf.queryExecution().optimizedPlan().toString()
    above, below = text.split("RebalancePartitions", 1)
    for name in ("total_value", "delivery_time_days", "data_source"):
        assert name in above and name not in below
    assert fact.columns == pipeline.star(house.tables, registry.RUN_TS)[0].columns
    assert fact.exceptAll(house.fact.select(*fact.columns)).isEmpty()
    assert fact.count() == house.fact.count()
