"""Timings of the headline queries; prints one JSON line.

The warehouse is built once and timed as ``etl_flagship``. Reports then read the
stored star schema, as they would after a nightly load. Each query runs once to
warm up and its best of two further runs counts; every result is read in full.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "etl_flagship", "dedupe_first", "fact_order_items", "agg_customer_metrics",
    "agg_product_metrics", "agg_monthly_revenue", "incremental_refresh", "v_order_metrics",
    "v_customer_history", "v_product_performance", "v_monthly_trend", "top_customers",
    "monthly_revenue_trend", "aov_analysis", "repeat_purchase_rate", "cohort_retention",
    "rfm_sql", "top_products", "category_performance", "seller_performance", "delayed_orders",
    "payment_method", "payment_method_fanout", "rfm_scores", "segment_summary",
    "clv_distribution", "revenue_concentration", "retention_60d", "global_rank",
    "profile_schema", "null_correlation", "relationship_report", "threshold_gate",
    "fk_integrity", "text_features_nlp",
]


def run(spark: SparkSession, query) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tradewind-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from tradewind.registry import QUERIES, house

    start = time.perf_counter()
    house(spark, SF_DIR)
    first_load = time.perf_counter() - start
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        run(spark, QUERIES[name])
        seconds[name] = round(min(run(spark, QUERIES[name]) for _ in range(2)), 3)
    print(json.dumps({
        "metric": "headline queries, best of two warm runs, summed",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "first_load_sec": round(first_load, 3),
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
