"""Every operator by name, over the driver's tables.

``house`` runs the pipeline once per session and folder and stores the layers
below the shared folder, as a nightly load does; reports then read the stored
star schema. Operators on raw tables read those directly.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tradewind.functions import sentiment, text
from tradewind.operators import aggregates, cleaning, ordering, profiling, quality, star
from tradewind.plans import (
    customers, merge, metrics, orders, pipeline, products, revenue, rfm, sellers, views,
)
from tradewind.schemas import DEFAULT_RULES
from tradewind.session import configure, scratch_path, settle, stored
from tradewind.sources import files, keyed, retail, tables
from tradewind.streaming import refresh

# Load time written into lineage columns, fixed so that runs can be compared.
RUN_TS = dt.datetime(2024, 1, 1)
AS_OF = dt.datetime(2024, 1, 2, 6, 0, 0)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_HOUSES: dict[tuple[str, str], pipeline.Warehouse] = {}
_GRAINS: dict[tuple[str, str], orders.OrderGrain] = {}
_UNFILTERED: dict[tuple[str, str], DataFrame] = {}


def house(spark: SparkSession, folder: str) -> pipeline.Warehouse:
    """The loaded warehouse of this session and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _HOUSES:
        configure(spark)
        _HOUSES[key] = pipeline.run(
            spark, retail.raw_tables(spark, folder), scratch_path(spark, "house"),
            retail.RULES, RUN_TS,
        )
    return _HOUSES[key]


def flat(df: DataFrame) -> DataFrame:
    """Plain column types for readers: money as double, dates as text."""
    shapes = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegralType, T.BooleanType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        shapes.append(c.alias(f.name))
    return df.select(*shapes)


def query(fn: Query) -> Query:
    """Register under the function's name, with plain output types."""
    QUERIES[fn.__name__] = lambda spark, folder: flat(fn(configure(spark), folder))
    return fn


def _raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return retail.TABLES[name](spark, folder)


def _on_fact(fn: Callable[..., DataFrame], *dims: str, name: str | None = None, **options) -> None:
    """Register a report that takes the fact and some dimensions."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        h = house(spark, folder)
        inputs = [{**h.dims, **h.tables}[d] for d in dims]
        return flat(fn(h.fact, *inputs, **options))

    QUERIES[name or fn.__name__] = lambda spark, folder: run(configure(spark), folder)


# --- sources and sinks -----------------------------------------------------


@query
def read_tables(spark, folder):
    target = scratch_path(spark, "csv")
    for name, df in retail.raw_tables(spark, folder).items():
        tables.replace_table(df, f"{target}/{name}.csv", fmt="csv")
    return files.table_contents(files.read_tables(spark, target))


@query
def write_layers(spark, folder):
    h = house(spark, folder)
    paths = tables.write_layers(
        scratch_path(spark, "layers"), h.tables, h.dims, h.aggregates, h.fact
    )
    return files.table_sizes({n: spark.read.parquet(p) for n, p in paths.items()})


def _dim_updates(spark, folder):
    """Customers without a city get one, and every seller becomes a customer."""
    dims = house(spark, folder).dims
    dim = dims["dim_customers"].select("customer_id", "customer_city", "customer_state")
    repaired = dim.filter(F.col("customer_city").isNull()).withColumn(
        "customer_city", F.lit("unknown")
    )
    new = dims["dim_sellers"].select(
        (-1 - F.col("seller_id")).alias("customer_id"),
        F.col("seller_city").alias("customer_city"),
        F.col("seller_state").alias("customer_state"),
    )
    return dim, repaired.unionByName(new)


@query
def upsert_table(spark, folder):
    path = scratch_path(spark, "upsert")
    dim, updates = _dim_updates(spark, folder)
    keyed.upsert_table(spark, path, dim, ["customer_id"])
    return keyed.upsert_table(spark, path, updates, ["customer_id"])


@query
def replace_table(spark, folder):
    path = scratch_path(spark, "replace")
    dim, updates = _dim_updates(spark, folder)
    tables.replace_table(dim, path)
    tables.replace_table(updates, path)
    return spark.read.parquet(path)


@query
def append_table(spark, folder):
    path = scratch_path(spark, "append")
    dim, updates = _dim_updates(spark, folder)
    tables.append_table(dim, path, ["customer_id"])
    tables.append_table(updates, path, ["customer_id"])
    return spark.read.parquet(path)


@query
def export_rfm(spark, folder):
    path = scratch_path(spark, "rfm")
    segments = _segments(spark, folder)
    tables.export_rfm(segments, path)
    return tables.read_back(spark, path, segments.select(*tables.RFM_EXPORT), "csv")


@query
def sample_rows(spark, folder):
    fact = house(spark, folder).fact
    return files.sample_rows(fact, ["order_id", "order_item_id"]).select(
        "order_id", "order_item_id", "product_id", "customer_id", "total_value"
    )


@query
def dataset_info(spark, folder):
    path = scratch_path(spark, "info")
    info = files.write_dataset_info(retail.raw_tables(spark, folder), path)
    return spark.read.schema(info.schema).json(path)


# --- cleaning --------------------------------------------------------------


@query
def validate_critical(spark, folder):
    parts = [
        cleaning.critical_report(_raw(spark, folder, t), t, r.critical)
        for t, r in DEFAULT_RULES.items() if r.critical
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


@query
def missing_flags(spark, folder):
    orders = cleaning.coerce_timestamps(
        _raw(spark, folder, "orders"), DEFAULT_RULES["orders"].timestamps
    )
    flags = DEFAULT_RULES["orders"].presence_flags
    return cleaning.missing_flags(orders, flags).select("order_id", *flags.values())


@query
def dedupe_first(spark, folder):
    return cleaning.dedupe_first(
        _raw(spark, folder, "order_items"), DEFAULT_RULES["order_items"].key
    )


@query
def coerce_timestamps(spark, folder):
    stamps = DEFAULT_RULES["orders"].timestamps
    return cleaning.coerce_timestamps(_raw(spark, folder, "orders"), stamps).select(
        "order_id", *stamps
    )


@query
def impute_drop(spark, folder):
    return cleaning.impute_drop(_raw(spark, folder, "products"), "product_category_name").select(
        "product_id", "product_category_name"
    )


@query
def impute_zero(spark, folder):
    return cleaning.impute_zero(_raw(spark, folder, "products"), "product_photos_qty").select(
        "product_id", "product_photos_qty"
    )


@query
def impute_mean(spark, folder):
    filled = cleaning.impute_mean(_raw(spark, folder, "products"), "product_weight_g")
    return filled.select("product_id", F.round("product_weight_g", 6).alias("product_weight_g"))


@query
def impute_median(spark, folder):
    return cleaning.impute_median(_raw(spark, folder, "products"), "product_weight_g").select(
        "product_id", "product_weight_g"
    )


@query
def impute_unknown(spark, folder):
    return cleaning.impute_unknown(
        _raw(spark, folder, "products"), "product_category_name"
    ).select("product_id", "product_category_name")


@query
def impute_keep(spark, folder):
    return cleaning.impute_keep(_raw(spark, folder, "reviews"), "review_comment_title").select(
        "review_id", "review_comment_title"
    )


@query
def impute_flag(spark, folder):
    columns = ["product_category_name", "product_weight_g"]
    return cleaning.impute_flag(_raw(spark, folder, "products"), columns).select(
        "product_id", *[f"{c}_is_missing" for c in columns]
    )


@query
def impute_in_order(spark, folder):
    """A drop before a median: the median is taken over the rows left."""
    done = cleaning.impute(
        _raw(spark, folder, "products"), "products",
        {"product_category_name": "drop", "product_weight_g": "median",
         "product_photos_qty": "zero"},
    )
    return done.select(
        "product_id", "product_weight_g", "product_weight_g_is_missing", "product_photos_qty"
    )


@query
def validate_ranges(spark, folder):
    report = None
    for name, rules in DEFAULT_RULES.items():
        if rules.ranges:
            part = cleaning.range_report(_raw(spark, folder, name), name, rules.ranges)
            report = part if report is None else report.unionByName(part)
    return report


@query
def text_features(spark, folder):
    columns = DEFAULT_RULES["reviews"].text
    added = [f"{c}_{x}" for c in columns for x in ("length", "word_count")]
    return text.text_features(_raw(spark, folder, "reviews"), columns).select("review_id", *added)


@query
def fill_approved_at(spark, folder):
    orders = cleaning.coerce_timestamps(
        _raw(spark, folder, "orders"), ["order_purchase_timestamp", "order_approved_at"]
    )
    return cleaning.fill_approved_at(orders).select("order_id", "order_approved_at")


@query
def null_audit(spark, folder):
    cleaned = cleaning.clean_all(retail.raw_tables(spark, folder), retail.RULES)
    return cleaning.null_audit(cleaned)


@query
def clean_all(spark, folder):
    return files.table_sizes(cleaning.clean_all(retail.raw_tables(spark, folder), retail.RULES))


def _unfiltered(spark, folder):
    """The fact before its references are checked, and the dimensions."""
    h = house(spark, folder)
    return star.fact_order_items(h.tables["orders"], h.tables["order_items"], RUN_TS), h.dims


def _unfiltered_stored(spark, folder):
    """The same, stored once: checks read a loaded table several times."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _UNFILTERED:
        fact, _ = _unfiltered(spark, folder)
        _UNFILTERED[key] = stored(fact, "unfiltered")
    return _UNFILTERED[key], house(spark, folder).dims


@query
def referential_filter(spark, folder):
    fact, dims = _unfiltered(spark, folder)
    staged = house(spark, folder).tables
    keys = {"customer_id": staged["orders"], "product_id": staged["order_items"],
            "seller_id": staged["order_items"]}
    return cleaning.referential_filter(fact, dims, keys).select(
        "order_id", "order_item_id", "product_id", "seller_id", "customer_id"
    )


@query
def orphan_report(spark, folder):
    return cleaning.orphan_report(*_unfiltered_stored(spark, folder))


# --- profiling and quality -------------------------------------------------


@query
def profile_schema(spark, folder):
    return profiling.profile_schema(retail.raw_tables(spark, folder))


@query
def missing_report(spark, folder):
    return profiling.missing_report(retail.raw_tables(spark, folder))


@query
def critical_null_report(spark, folder):
    return profiling.critical_null_report(retail.raw_tables(spark, folder))


@query
def null_correlation(spark, folder):
    items, products, reviews = (
        _raw(spark, folder, t) for t in ("order_items", "products", "reviews")
    )
    return profiling.null_correlation(
        items, [(products, "product_id"), (reviews, "order_id")]
    )


@query
def duplicate_report(spark, folder):
    return profiling.duplicate_report(retail.raw_tables(spark, folder))


@query
def timestamp_report(spark, folder):
    return profiling.timestamp_report(retail.raw_tables(spark, folder))


@query
def price_report(spark, folder):
    return profiling.price_report(_raw(spark, folder, "order_items"))


@query
def relationship_report(spark, folder):
    return profiling.relationship_report(retail.raw_tables(spark, folder))


def _suite_result(spark, folder, table, make):
    df = _raw(spark, folder, table)
    return quality.validate_suite(df, make(df)).drop("column_count")


@query
def expect_column_exists(spark, folder):
    return _suite_result(spark, folder, "customers", lambda df: [
        quality.expect_column_exists(df, c) for c in ("customer_id", "no_such_column")
    ])


@query
def expect_not_null(spark, folder):
    return _suite_result(spark, folder, "customers", lambda df: [
        quality.expect_not_null(c) for c in ("customer_id", "customer_city")
    ])


@query
def expect_in_set(spark, folder):
    return _suite_result(spark, folder, "orders", lambda df: [
        quality.expect_in_set("order_status", quality.ORDER_STATUSES),
        quality.expect_in_set("order_approved_at", ["unknown"], nulls_pass=False),
    ])


@query
def expect_between(spark, folder):
    return _suite_result(spark, folder, "payments", lambda df: [
        quality.expect_between("payment_value", 0, 10000),
        quality.expect_between("payment_installments", 1, None),
    ])


@query
def check_constraint(spark, folder):
    h = house(spark, folder)
    return quality.check_constraints({**h.dims, **h.aggregates, "fact_order_items": h.fact})


@query
def expect_type(spark, folder):
    return _suite_result(spark, folder, "products", lambda df: [
        quality.expect_type(df, "product_weight_g", T.IntegerType()),
        quality.expect_type(df, "product_category_name", T.IntegerType()),
    ])


@query
def validate_suite(spark, folder):
    df = _raw(spark, folder, "customers")
    return quality.validate_suite(df, [
        quality.expect_column_exists(df, "customer_id"),
        quality.expect_not_null("customer_id"),
        quality.expect_not_null("customer_city"),
        quality.expect_in_set("customer_state", ["AF", "AM", "AS", "EU"]),
        quality.check_constraint("state_has_two_letters", F.expr("length(customer_state) = 2")),
    ])


@query
def fk_integrity(spark, folder):
    return quality.fk_integrity(*_unfiltered_stored(spark, folder))


@query
def null_checks(spark, folder):
    return quality.null_checks(_unfiltered_stored(spark, folder)[0])


_on_fact(quality.value_validation)
_on_fact(quality.data_freshness, as_of=AS_OF)
_on_fact(quality.fact_metrics)


@query
def quality_log(spark, folder):
    path = scratch_path(spark, "quality-log")
    fact, dims = _unfiltered_stored(spark, folder)
    counts = quality.fact_check_counts(fact, dims)
    quality.append_quality_log(quality.log_rows(counts, checked_at=RUN_TS), path)
    return quality.read_quality_log(spark, path)


@query
def pk_uniqueness(spark, folder):
    h = house(spark, folder)
    return quality.pk_uniqueness({**h.dims, **h.aggregates, "fact_order_items": h.fact})


@query
def not_null(spark, folder):
    fact, dims = _unfiltered_stored(spark, folder)
    return quality.not_null({**dims, "fact_order_items": fact})


@query
def column_defaults(spark, folder):
    filled = quality.with_defaults(_raw(spark, folder, "products"), "dim_products")
    return filled.select("product_id", *quality.DEFAULTS["dim_products"])


@query
def threshold_gate(spark, folder):
    # The gate reads the fact once, so it is stored whole only if another check did so.
    fact, dims = _unfiltered(spark, folder)
    fact = _UNFILTERED.get((spark.sparkContext.applicationId, folder), fact)
    return quality.threshold_gate({**dims, "fact_order_items": fact})


# --- review text -----------------------------------------------------------


@query
def review_sentiment(spark, folder):
    scored = text.review_sentiment(_raw(spark, folder, "reviews"), "review_comment_message")
    return scored.select("review_id", "sentiment_polarity", "sentiment_subjectivity")


@query
def sentiment_weights(spark, folder):
    return sentiment.word_weights(_raw(spark, folder, "reviews"))


@query
def review_sentiment_learned(spark, folder):
    reviews = _raw(spark, folder, "reviews")
    weights = stored(sentiment.word_weights(reviews), "weights")
    return sentiment.learned_sentiment(reviews, weights).select("review_id", "learned_polarity")


@query
def review_language(spark, folder):
    return text.review_language(_raw(spark, folder, "reviews"), "review_comment_message").select(
        "review_id", "review_language"
    )


@query
def emoji_count(spark, folder):
    return _raw(spark, folder, "reviews").select(
        "review_id", text.emoji_count("review_comment_message").alias("emoji_count")
    )


@query
def text_features_nlp(spark, folder):
    return text.text_features_nlp(_raw(spark, folder, "reviews")).select(
        "review_id", "sentiment_polarity", "sentiment_subjectivity", "review_language",
        "emoji_count",
    )


# --- star schema and aggregates --------------------------------------------


@query
def fact_order_items(spark, folder):
    return _unfiltered(spark, folder)[0]


@query
def dim_customers(spark, folder):
    return house(spark, folder).dims["dim_customers"]


@query
def dim_products(spark, folder):
    return house(spark, folder).dims["dim_products"]


@query
def dim_sellers(spark, folder):
    return house(spark, folder).dims["dim_sellers"]


@query
def dim_time(spark, folder):
    return house(spark, folder).dims["dim_time"]


@query
def etl_flagship(spark, folder):
    """The whole run from raw tables, reported as the monthly aggregate."""
    done = pipeline.run(
        spark, retail.raw_tables(spark, folder), scratch_path(spark, "run"), retail.RULES, RUN_TS
    )
    return done.aggregates["agg_monthly_revenue"]


@query
def etl_by_keys(spark, folder):
    """The years before 1998 as they were under way, then everything, merged by keys."""
    raw, path = retail.raw_tables(spark, folder), scratch_path(spark, "merged")
    early = raw["orders"].filter(F.col("order_purchase_timestamp") < "1998").withColumns({
        "order_delivered_customer_date": F.lit(None).cast("string"),
        "order_status": F.lit("shipped"),
    }).select(*raw["orders"].columns)
    items = raw["order_items"].join(early.select("order_id"), "order_id", "left_semi")
    with tables.Scratch(spark) as scratch:
        # A merge reads its raw tables several times, so the join is stored.
        items = scratch.stored(items.select(*raw["order_items"].columns), "early-items")
        merge.merge(spark, {**raw, "orders": early, "order_items": items}, path, retail.RULES,
                    RUN_TS)
    done = merge.merge(spark, raw, path, retail.RULES, RUN_TS)
    return done.aggregates["agg_monthly_revenue"]


_on_fact(aggregates.agg_customer_metrics, run_ts=RUN_TS)
_on_fact(aggregates.agg_product_metrics, run_ts=RUN_TS)
_on_fact(aggregates.agg_monthly_revenue, run_ts=RUN_TS)


@query
def load_existing(spark, folder):
    path = scratch_path(spark, "existing")
    assert tables.load_existing(spark, path) is None
    tables.write_version(house(spark, folder).aggregates["agg_monthly_revenue"], path)
    return tables.load_existing(spark, path)


@query
def incremental_refresh(spark, folder):
    """Two halves of the history, merged into the stored aggregates in calls of their own."""
    fact, path = house(spark, folder).fact, scratch_path(spark, "increments")
    late = F.col("order_purchase_date") >= F.lit(dt.date(1998, 1, 1))
    table = "agg_customer_metrics"
    refresh.incremental_refresh(spark, [fact.filter(~late)], path, table, RUN_TS)
    return refresh.incremental_refresh(spark, [fact.filter(late)], path, table, RUN_TS)


@query
def incremental_stream(spark, folder):
    fact, path = house(spark, folder).fact, scratch_path(spark, "stream")
    fact.write.parquet(f"{path}/in")
    refresh.incremental_stream(
        spark, f"{path}/in", fact, f"{path}/state", f"{path}/checkpoint", files_per_batch=20,
        run_ts=RUN_TS,
    )
    return refresh.current_table(spark, f"{path}/state", "agg_product_metrics")


# --- views and analytical queries ------------------------------------------

_on_fact(views.v_order_metrics)
_on_fact(views.v_customer_history, "dim_customers")
_on_fact(views.v_product_performance, "dim_products")
_on_fact(views.v_monthly_trend, "dim_time")
_on_fact(revenue.top_customers, "dim_customers")
_on_fact(revenue.monthly_revenue_trend)
_on_fact(revenue.aov_analysis)
_on_fact(customers.repeat_purchase_rate)
_on_fact(customers.cohort_retention)
_on_fact(rfm.rfm_sql, "dim_customers")
_on_fact(products.top_products, "dim_products")
_on_fact(products.top_products, "dim_products", name="top_products_share_of_all", share_of="all")
_on_fact(products.category_performance, "dim_products")
_on_fact(sellers.seller_performance, "dim_sellers")
_on_fact(sellers.seller_performance, "dim_sellers", name="seller_performance_by_order",
         grain="order")
_on_fact(revenue.delayed_orders)
_on_fact(revenue.delayed_orders, name="delayed_orders_by_order", grain="order")


def _on_grain(fn: Callable[..., DataFrame], *dims: str) -> None:
    """Register a report that reads the stored order grain."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        h = house(spark, folder)
        key = (spark.sparkContext.applicationId, folder)
        if key not in _GRAINS:
            buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
            _GRAINS[key] = orders.kept(h.fact, h.tables["payments"],
                                       scratch_path(spark, "orders"), buckets)
        return flat(fn(_GRAINS[key], *[h.dims[d] for d in dims]))

    QUERIES[f"{fn.__name__}_stored"] = lambda spark, folder: run(configure(spark), folder)


_on_grain(orders.v_order_metrics)
_on_grain(orders.top_customers, "dim_customers")
_on_grain(orders.payment_method)
_on_fact(revenue.payment_method, "payments")
_on_fact(revenue.payment_method_fanout, "payments")
_on_fact(revenue.api_top_customers, "dim_customers", limit=25)
_on_fact(revenue.api_monthly_revenue)
_on_fact(products.api_top_products, "dim_products", limit=25)


# --- customer value --------------------------------------------------------


def _rfm_base(spark, folder):
    h = house(spark, folder)
    return rfm.rfm_base(h.fact, h.dims["dim_customers"])


def _segments(spark, folder):
    return rfm.rfm_segments(rfm.rfm_scores(_rfm_base(spark, folder)))


@query
def rfm_base(spark, folder):
    return _rfm_base(spark, folder)


@query
def rfm_distribution(spark, folder):
    return rfm.rfm_distribution(_rfm_base(spark, folder))


@query
def rfm_top(spark, folder):
    return rfm.rfm_top(_rfm_base(spark, folder))


@query
def rfm_scores(spark, folder):
    return rfm.rfm_scores(_rfm_base(spark, folder))


@query
def rfm_score_counts(spark, folder):
    return rfm.rfm_score_counts(rfm.rfm_scores(_rfm_base(spark, folder)))


@query
def rfm_segments(spark, folder):
    return _segments(spark, folder).select(
        "customer_id", "r_score", "f_score", "m_score", "rfm_score", "segment"
    )


@query
def rfm_quantile_rules(spark, folder):
    return rfm.rfm_quantile_rules(_rfm_base(spark, folder)).select("customer_id", "segment")


@query
def segment_summary(spark, folder):
    return rfm.segment_summary(_segments(spark, folder))


@query
def segment_insights(spark, folder):
    return rfm.segment_insights(_segments(spark, folder))


@query
def customers_by_segment(spark, folder):
    return rfm.customers_by_segment(_segments(spark, folder), "Champions")


# --- metrics ---------------------------------------------------------------


def _on_tables(fn: Callable[..., DataFrame], *names: str) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        h = house(spark, folder)
        return flat(fn(*[h.tables[n] for n in names]))

    QUERIES[fn.__name__] = lambda spark, folder: run(configure(spark), folder)


_on_tables(metrics.total_revenue, "orders", "order_items")
_on_tables(metrics.aov, "orders", "order_items")
_on_tables(metrics.repeat_rate, "orders")
_on_tables(metrics.clv_distribution, "orders", "order_items")
_on_tables(metrics.order_counts, "orders")
_on_tables(metrics.revenue_by_status, "orders", "order_items")
_on_tables(metrics.on_time_rate, "orders")
_on_tables(metrics.installment_usage, "payments")
_on_fact(metrics.revenue_concentration)
_on_fact(metrics.revenue_by_region, "dim_customers")
_on_fact(metrics.purchase_frequency_split)
_on_fact(customers.retention_60d)


@query
def quality_rates(spark, folder):
    return metrics.quality_rates(
        _raw(spark, folder, "order_items"), ["order_id", "product_id", "price"],
        ["order_id", "order_item_id"], ["shipping_limit_date"],
    )


@query
def seasonality(spark, folder):
    return metrics.seasonality(house(spark, folder).aggregates["agg_monthly_revenue"])


@query
def global_rank(spark, folder):
    """Every customer's place by orders, where most values are shared by many."""
    h = house(spark, folder)
    base = settle(revenue.customer_totals(h.fact).select("customer_id", "total_orders"))
    ranked = ordering.with_global_rank(
        base, "total_orders", "customer_id", "rank", descending=True
    )
    rows = base.count()
    tiles = ordering.tile_columns(
        base, {"quarter": ("total_orders", False)}, "customer_id", rows,
        ordering.tile_ends(rows, 4),
    )
    return ranked.withColumns(tiles)
