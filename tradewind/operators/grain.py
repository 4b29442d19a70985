"""Coarser grains of the fact, the first step of most reports.

Grouping items by order before anything else shrinks the rows inside the map
tasks, spreads a hot customer, product or month over all tasks, and leaves at
most one distinct count for the next step, which Spark computes without
multiplying the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.columns import ratio


def by_order(fact: DataFrame, *keys: str, **extra: Column) -> DataFrame:
    """One row per order and ``keys`` with item count and value; ``extra`` adds
    aggregates that can be merged again (sum, count, min, max)."""
    return fact.groupBy("order_id", *keys).agg(
        F.count("*").alias("items"),
        F.sum("total_value").alias("value"),
        *[c.alias(name) for name, c in extra.items()],
    )


def mean_item_value(digits: int | None = None) -> Column:
    return ratio(F.sum("value"), F.sum("items"), digits)
