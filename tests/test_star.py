import datetime as dt
from decimal import Decimal

import pytest

from tests.conftest import column
from tradewind.operators import star
from tradewind.functions.columns import floor_days, half_up, percent, ratio
from pyspark.sql import functions as F

ORDER_SCHEMA = """order_id string, customer_id string, order_status string,
  order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,
  order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,
  order_estimated_delivery_date timestamp_ntz, is_approved int, is_shipped int, is_delivered int"""
ITEM_SCHEMA = """order_id string, order_item_id int, product_id string, seller_id string,
  shipping_limit_date timestamp_ntz, price decimal(10,2), freight_value decimal(10,2)"""


def day(n, month=1):
    return dt.datetime(2023, month, n)


def order(oid, cid, bought, arrived, due, status="delivered"):
    return (oid, cid, status, bought, bought, bought, arrived, due, 1, 1, int(arrived is not None))


def item(oid, n, price, freight, product="P1", seller="S1"):
    return (oid, n, product, seller, None, Decimal(price), Decimal(freight))


@pytest.fixture
def fact(make):
    orders = make(ORDER_SCHEMA, order("O1", "C1", day(1), day(6), day(5)),
                  order("O2", "C2", day(2), day(3), day(4)))
    items = make(ITEM_SCHEMA, item("O1", 1, "100", "10"), item("O2", 1, "50", "5"),
                 item("O9", 1, "7", "1"))
    return star.fact_order_items(orders, items, day(9))


def test_fact_metrics(fact):
    assert column(fact, "total_value", "order_id") == [
        Decimal("110.00"), Decimal("55.00"), Decimal("8.00")
    ]
    assert column(fact, "is_delayed", "order_id") == [1, 0, 0]
    assert column(fact, "delivery_time_days", "order_id") == [5, 1, None]
    assert column(fact, "order_purchase_ym", "order_id") == ["2023-01", "2023-01", None]
    assert column(fact, "has_delivery_date", "order_id") == [1, 1, 0]
    assert set(column(fact, "etl_loaded_at")) == {day(9)}


def test_fact_keeps_every_item_and_unknown_orders(fact):
    assert fact.count() == 3
    assert column(fact, "customer_id", "order_id") == ["C1", "C2", None]


def test_floor_days_rounds_down(make):
    at = dt.datetime(2023, 1, 10, 12)
    df = make("h int, a timestamp_ntz", *[(h, at) for h in (-25, -24, -1, 0, 23, 24, 25)])
    out = df.select("h", floor_days(F.col("a"), F.expr("timestampadd(HOUR, h, a)")).alias("d"))
    assert column(out, "d", "h") == [-2, -1, -1, 0, 0, 1, 1]


def test_rounding_of_money_ties_and_zero_division(make):
    df = make("s decimal(10,2), n int", (Decimal("30.03"), 6), (Decimal("0.03"), 6),
              (Decimal("1.00"), 0))
    out = df.select(ratio(F.col("s"), F.col("n"), 2).alias("m"),
                    percent(F.col("s"), F.col("n")).alias("p"))
    assert column(out, "m") == [5.01, 0.01, None]
    assert column(out, "p")[2] is None
    assert df.select(half_up(F.lit(-0.005), 2).alias("x")).first().x == -0.01


def test_products_take_their_english_category(make):
    products = make("product_id string, product_category_name string",
                    ("P1", "livros"), ("P2", "unknown"))
    names = make("product_category_name string, product_category_name_english string",
                 ("livros", "books"))
    out = star.dim_products(products, names, day(1), "test")
    assert column(out, "category_english", "product_id") == ["books", None]
    assert set(column(out, "data_source")) == {"test"}


def test_time_dimension_has_whole_days_to_the_last(make):
    moments = make("order_purchase_timestamp timestamp_ntz",
                   (dt.datetime(2023, 12, 29, 18),), (dt.datetime(2024, 1, 1, 3),))
    rows = star.dim_time(moments).orderBy("date_id").collect()
    assert [r.date_key for r in rows] == [20231229, 20231230, 20231231, 20240101]
    assert [r.day_of_week for r in rows] == [4, 5, 6, 0]
    assert [r.is_weekend for r in rows] == [0, 1, 1, 0]
    assert [r.week_of_year for r in rows] == [52, 52, 52, 1]
    assert rows[0].day_name == "Friday" and rows[3].month_name == "January"


def test_time_dimension_of_no_orders_is_empty(make):
    assert star.dim_time(make("order_purchase_timestamp timestamp_ntz")).isEmpty()
