"""Recency, frequency and value of customers: scores, segments, summaries."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tradewind.functions.columns import floor_days, half_up, percent, ratio
from tradewind.operators.grain import by_order
from tradewind.operators.ordering import (
    column_quantiles, rank_bin_ends, tile_columns, tile_ends,
)
from tradewind.plans.revenue import delivered_orders
from tradewind.plans.views import as_of_date
from tradewind.session import settle, together

QUARTERS = (0.25, 0.5, 0.75)

# Segment names (fixed values), best first, each with a suggestion of our own.
SEGMENT_ADVICE = {
    "Champions": "Thank them personally and show new lines first",
    "Loyal Customers": "Give points for every order and suggest matching items",
    "Potential Loyalists": "Write soon after a purchase and offer a membership",
    "New Customers": "Explain the shop and give a reason for a second order",
    "At Risk": "Ask what went wrong and offer something for a return",
    "Need Attention": "Send reminders that fit what they bought before",
    "Lost": "Try one strong offer, then stop writing",
    "Other": "Keep watching until a pattern shows",
}

# Exact (r, f, m) quarter scores that name a segment.
EXACT_SEGMENTS = {
    (4, 4, 4): "Champions",
    (3, 4, 4): "Loyal Customers",
    (4, 3, 3): "Potential Loyalists",
    (4, 1, 1): "New Customers",
    (1, 4, 4): "At Risk",
    (1, 3, 3): "Need Attention",
    (1, 1, 1): "Lost",
}

# Lowest and highest (r, f, m) score of each segment, first match wins.
RANGE_SEGMENTS = (
    ("Champions", (4, 4, 4), (4, 4, 4)),
    ("Loyal Customers", (3, 4, 3), (4, 4, 4)),
    ("Potential Loyalists", (4, 3, 3), (4, 4, 4)),
    ("New Customers", (4, 1, 1), (4, 2, 2)),
    ("At Risk", (1, 4, 4), (2, 4, 4)),
    ("Need Attention", (1, 3, 2), (2, 4, 4)),
    ("Lost", (1, 1, 1), (2, 2, 2)),
)

# Share of customers a metric must beat (r, f, m), best segment first.
QUANTILE_SEGMENTS = (
    ("champions", (0.75, 0.75, 0.75)),
    ("loyal", (0.50, 0.50, 0.50)),
    ("at_risk", (0.25, 0.50, 0.50)),
    ("need_attention", (0.25, 0.25, 0.50)),
    ("lost", (0.0, 0.0, 0.0)),
)

REPEAT_TARGET_PCT = 30.0


def customer_rfm(fact: DataFrame, customer_key: str = "customer_id") -> DataFrame:
    """Last purchase, orders and value per customer over delivered orders."""
    return (
        by_order(
            delivered_orders(fact).dropna(subset=[customer_key]), customer_key,
            last_at=F.max("order_purchase_timestamp"), last_day=F.max("order_purchase_date"),
        )
        .groupBy(customer_key)
        .agg(
            F.max("last_at").alias("last_at"),
            F.max("last_day").alias("last_day"),
            F.count("order_id").alias("frequency"),
            F.sum("value").alias("monetary"),
        )
    )


# --- quartile tiles with exact-match segments ------------------------------


def rfm_sql(fact: DataFrame, customers: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Four equal tiles per metric, ties by customer, and exact-match segments."""
    base = settle(
        customer_rfm(fact)
        .join(customers.select("customer_id", "customer_city", "customer_state"), "customer_id")
        .select(
            "customer_id", "customer_city", "customer_state",
            F.datediff(as_of_date(fact, as_of), F.col("last_day")).alias("recency_days"),
            "frequency", "monetary",
        )
    )
    rows = base.count()
    scored = base.withColumns(tile_columns(base, {
        "r_score": ("recency_days", True),
        "f_score": ("frequency", False),
        "m_score": ("monetary", False),
    }, "customer_id", rows, tile_ends(rows, 4)))
    scores = F.struct("r_score", "f_score", "m_score")
    segment = None
    for exact, name in EXACT_SEGMENTS.items():
        hit = scores == F.struct(*[F.lit(s) for s in exact])
        segment = F.when(hit, name) if segment is None else segment.when(hit, name)
    return scored.withColumns({
        "monetary": F.round("monetary", 2),
        "rfm_segment": segment.otherwise("Other"),
    })


# --- quantile scores with range segments -----------------------------------


def rfm_base(
    fact: DataFrame, customers: DataFrame, reference: dt.datetime | None = None
) -> DataFrame:
    """Recency in whole days to one day after the last purchase of any status,
    frequency, value and place of every customer with a delivered order."""
    if reference is None:
        now = fact.agg(
            F.max("order_purchase_timestamp") + F.expr("INTERVAL 1 DAY")
        ).scalar()
    else:
        now = F.lit(reference).cast("timestamp_ntz")
    places = customers.select("customer_id", "customer_city", "customer_state")
    return (
        customer_rfm(fact)
        .withColumn("recency_days", floor_days(F.col("last_at"), now))
        .select("customer_id", "recency_days", "frequency", "monetary")
        .join(places, "customer_id", "left")
    )


def rfm_distribution(base: DataFrame) -> DataFrame:
    """Mean, median, extremes and spread of the three metrics, one row each."""
    metrics = ("recency_days", "frequency", "monetary")
    base = settle(base.select(*metrics))
    medians = column_quantiles(base, metrics, [0.5])
    stats = base.agg(*[
        F.struct(
            F.lit(m).alias("metric"),
            ratio(F.sum(m), F.count(m), 2).alias("mean"),
            half_up(F.lit(medians[m][0]), 2).alias("median"),
            half_up(F.min(m), 2).alias("min"),
            half_up(F.max(m), 2).alias("max"),
            half_up(F.stddev_samp(F.col(m).cast("double")), 2).alias("std"),
        ).alias(m)
        for m in metrics
    ])
    return stats.select(F.explode(F.array(*metrics)).alias("s")).select("s.*")


def rfm_top(base: DataFrame, limit: int = 10) -> DataFrame:
    return (
        base.orderBy(F.desc("monetary"), "customer_id")
        .limit(limit)
        .select("customer_id", "recency_days", "frequency", "monetary")
    )


def _bins(column: str, edges: list[float | None]) -> Column:
    """1 plus the number of edges the value lies above.

    Repeated edges leave bins empty, as merged bins do. Numbers are compared as
    doubles, the type the interpolated edges have.
    """
    value, place = F.col(column).cast("double"), F.lit(1)
    for edge in sorted({e for e in edges if e is not None}):
        place = place + F.when(value > F.lit(edge), 1).otherwise(0)
    return place


def rfm_scores(base: DataFrame) -> DataFrame:
    """Quarter scores 1..4: recency inverted, frequency by rank, value by quantile."""
    base = settle(base)
    rows = base.count()
    found = together({
        "by_rank": partial(
            tile_columns, base, {"f_score": ("frequency", False)}, "customer_id", rows,
            rank_bin_ends(rows, 4),
        ),
        "edges": partial(column_quantiles, base, ["recency_days", "monetary"], QUARTERS),
    })
    edges = found["edges"]
    scored = base.withColumns({
        "r_score": F.lit(5) - _bins("recency_days", edges["recency_days"]),
        **found["by_rank"],
        "m_score": _bins("monetary", edges["monetary"]),
    })
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return scored.withColumn("rfm_score", half_up(total / 3, 2))


def rfm_score_counts(scores: DataFrame) -> DataFrame:
    """Customers per score of each metric."""
    names = ("r_score", "f_score", "m_score")
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("score")) for n in names])
    return (
        scores.select(F.explode(pairs).alias("p"))
        .groupBy("p.metric", "p.score")
        .agg(F.count("*").alias("customers"))
    )


def rfm_segments(scores: DataFrame) -> DataFrame:
    """Segment of each customer by ordered score ranges."""
    segment = None
    for name, low, high in RANGE_SEGMENTS:
        inside = F.lit(True)
        for metric, lo, hi in zip(("r_score", "f_score", "m_score"), low, high):
            inside = inside & F.col(metric).between(lo, hi)
        segment = F.when(inside, name) if segment is None else segment.when(inside, name)
    return scores.withColumn("segment", segment.otherwise("Other"))


def rfm_quantile_rules(base: DataFrame) -> DataFrame:
    """Segments by quantile limits on each metric, best first.

    Recency is better when lower, so its limit is the mirrored quantile.
    """
    base = settle(base)
    shares = sorted({s for _, limits in QUANTILE_SEGMENTS for s in limits if s > 0})
    metrics = ("recency_days", "frequency", "monetary")
    cuts = {m: dict(zip(shares, v)) for m, v in column_quantiles(base, metrics, shares).items()}
    segment = None
    for name, (r, f, m) in QUANTILE_SEGMENTS:
        hit = F.lit(True)
        if r > 0:
            hit = hit & (F.col("recency_days").cast("double") <= F.lit(cuts["recency_days"][1 - r]))
        if f > 0:
            hit = hit & (F.col("frequency").cast("double") >= F.lit(cuts["frequency"][f]))
        if m > 0:
            hit = hit & (F.col("monetary").cast("double") >= F.lit(cuts["monetary"][m]))
        segment = F.when(hit, name) if segment is None else segment.when(hit, name)
    return base.withColumn("segment", segment)


# --- summaries -------------------------------------------------------------


def segment_summary(segments: DataFrame) -> DataFrame:
    """Size, means, shares and advice per segment, by revenue."""
    per_segment = segments.groupBy("segment").agg(
        F.count("*").alias("customer_count"),
        ratio(F.sum("recency_days"), F.count("*"), 2).alias("avg_recency_days"),
        ratio(F.sum("frequency"), F.count("*"), 2).alias("avg_frequency"),
        ratio(F.sum("monetary"), F.count("*"), 2).alias("avg_monetary"),
        F.sum("monetary").alias("total_monetary"),
        # Scores have two decimals; summing them as such keeps the mean exact.
        ratio(F.sum(F.col("rfm_score").cast("decimal(4,2)")), F.count("*"), 2)
        .alias("avg_rfm_score"),
    )
    everything = W.partitionBy()  # at most eight rows
    advice = F.element_at(
        F.create_map(*[F.lit(x) for pair in SEGMENT_ADVICE.items() for x in pair]), F.col("segment")
    )
    return per_segment.withColumns({
        "pct_customers": percent(
            F.col("customer_count"), F.sum("customer_count").over(everything), 1
        ),
        "pct_revenue": percent(
            F.col("total_monetary"), F.sum("total_monetary").over(everything), 1
        ),
        "strategy": advice,
    }).orderBy(F.desc("total_monetary"))


def segment_insights(segments: DataFrame) -> DataFrame:
    """Headline numbers of a segmentation, one metric per row."""
    per_segment = segments.groupBy("segment").agg(
        F.count("*").alias("n"), F.sum("monetary").alias("value"),
        F.count_if(F.col("frequency") > 1).alias("repeat"),
    )
    at_risk, new = F.col("segment") == "At Risk", F.col("segment") == "New Customers"
    customers, value = F.sum("n"), F.sum("value")
    # Eight rows at most from here on.
    facts = per_segment.agg(
        percent(F.max_by("n", "value"), customers, 1).alias("top_segment_customer_pct"),
        percent(F.max("value"), value, 1).alias("top_segment_revenue_pct"),
        F.coalesce(F.sum(F.when(at_risk, F.col("n"))), F.lit(0)).cast("double")
        .alias("at_risk_customers"),
        percent(F.coalesce(F.sum(F.when(at_risk, F.col("n"))), F.lit(0)), customers, 1)
        .alias("at_risk_customer_pct"),
        F.coalesce(F.sum(F.when(at_risk, F.col("value"))), F.lit(0)).cast("double")
        .alias("at_risk_revenue"),
        F.coalesce(F.sum(F.when(new, F.col("n"))), F.lit(0)).cast("double")
        .alias("new_customers"),
        percent(F.coalesce(F.sum(F.when(new, F.col("n"))), F.lit(0)), customers, 1)
        .alias("new_customer_pct"),
        ratio(F.sum(F.when(new, F.col("value"))), F.sum(F.when(new, F.col("n"))), 2)
        .alias("new_customer_avg_value"),
        percent(F.sum("repeat"), customers, 1).alias("repeat_purchase_pct"),
        ratio(value, customers, 2).alias("avg_customer_value"),
        (percent(F.sum("repeat"), customers, None) > REPEAT_TARGET_PCT).cast("double")
        .alias("repeat_target_met"),
    )
    entries = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in facts.columns]
    return facts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def customers_by_segment(segments: DataFrame, segment: str) -> DataFrame:
    """Customers of one named segment; other names are rejected."""
    known = [s for s in SEGMENT_ADVICE if s != "Other"]
    if segment not in known:
        raise ValueError(f"unknown segment {segment!r}, expected one of {known}")
    return segments.filter(F.col("segment") == segment).select(
        "customer_id", "segment", "recency_days", "frequency", "monetary", "rfm_score"
    )
