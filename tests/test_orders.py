"""Reports from the stored order grain: same rows, no exchange by order."""

import re

import pytest
from pyspark.sql import functions as F

from tradewind import registry
from tradewind.plans import orders, revenue, views

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def house(spark):
    return registry.house(spark, FOLDER)


@pytest.fixture(scope="module")
def place(tmp_path_factory):
    return str(tmp_path_factory.mktemp("grain's") / "kept")


@pytest.fixture(scope="module", params=["written", "opened"])
def grain(request, spark, house, place):
    if request.param == "written":
        return orders.kept(house.fact, house.tables["payments"], place, 4)
    return orders.opened(spark, place)


def reports(house, grain):
    customers, payments = house.dims["dim_customers"], house.tables["payments"]
    return [
        (orders.v_order_metrics(grain), views.v_order_metrics(house.fact)),
        (orders.top_customers(grain, customers), revenue.top_customers(house.fact, customers)),
        (orders.payment_method(grain), revenue.payment_method(house.fact, payments)),
        (orders.payment_method(grain, fanout=True),
         revenue.payment_method_fanout(house.fact, payments)),
    ]


def test_same_rows(house, grain):
    for stored, plain in reports(house, grain):
        assert stored.columns == plain.columns
        assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))


def test_no_exchange_by_order(house, grain, spark):
    # Neither side may be sent round whole.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stored, plain in reports(house, grain):
            assert not re.search(r"hashpartitioning\(order_id", plan(stored))
            assert re.search(r"hashpartitioning\(order_id", plan(plain))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_file_per_bucket(grain, place):
    files = [f for f in grain.orders.inputFiles() if f.endswith(".parquet")]
    assert 0 < len(files) <= 4


def test_empty_tables(house, tmp_path):
    empty = orders.kept(house.fact.limit(0), house.tables["payments"].filter(F.lit(False)),
                        str(tmp_path / "kept"), 2)
    assert orders.v_order_metrics(empty).count() == 0
    assert orders.payment_method(empty).count() == 0
