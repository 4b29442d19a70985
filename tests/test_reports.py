import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import column
from tests.test_star import ITEM_SCHEMA, ORDER_SCHEMA, item, order
from tradewind.operators import aggregates, star
from tradewind.plans import customers, metrics, products, revenue, rfm, sellers, views


def at(y, m, d, h=0):
    return dt.datetime(y, m, d, h)


@pytest.fixture(scope="module")
def data(spark):
    def make(schema, rows):
        return spark.createDataFrame(rows, schema)

    orders = [
        order("O1", "C1", at(2023, 1, 31, 23), at(2023, 2, 3), at(2023, 2, 2)),
        order("O2", "C1", at(2023, 2, 1, 1), at(2023, 2, 2), at(2023, 2, 9)),
        order("O3", "C2", at(2023, 1, 5), at(2023, 1, 6), at(2023, 1, 9)),
        order("O4", "C2", at(2023, 4, 20), at(2023, 4, 22), at(2023, 4, 21)),
        order("O5", "C3", at(2023, 4, 1), None, at(2023, 4, 9), "shipped"),
        order("O6", "C4", at(2024, 1, 2), at(2024, 1, 5), at(2024, 1, 9)),
    ]
    items = [
        item("O1", 1, "10", "1"), item("O1", 2, "20", "2", "P2"), item("O1", 3, "30", "3"),
        item("O2", 1, "5", "0"), item("O3", 1, "100", "0", "P2"), item("O4", 1, "50", "5"),
        item("O5", 1, "70", "7", "P3", "S2"), item("O6", 1, "0", "0", "P2"),
    ]
    orders, items = make(ORDER_SCHEMA, orders), make(ITEM_SCHEMA, items)
    return {
        "orders": orders, "items": items,
        "fact": star.fact_order_items(orders, items, at(2024, 1, 1)).cache(),
        "customers": make("customer_id string, customer_city string, customer_state string",
                          [(f"C{i}", "x", "SP") for i in range(1, 5)]),
        "products": make("product_id string, product_category_name string",
                         [("P1", "a"), ("P2", "b"), ("P3", "b")]),
        "sellers": make("seller_id string, seller_city string, seller_state string",
                        [("S1", "x", "SP"), ("S2", "y", "RJ")]),
        "payments": make("order_id string, payment_sequential int, payment_type string, "
                         "payment_installments int, payment_value decimal(10,2)",
                         [("O1", 1, "card", 3, Decimal(60)), ("O1", 2, "voucher", 1, Decimal(6)),
                          ("O3", 1, "card", 1, Decimal(100)), ("O5", 1, "card", 2, Decimal(77))]),
    }


def test_top_customers_breaks_ties_by_customer(data):
    rows = revenue.top_customers(data["fact"], data["customers"], 2).collect()
    assert [(r.customer_id, r.total_revenue, r.total_orders, r.total_items) for r in rows] == [
        ("C2", Decimal("155.00"), 2, 2), ("C1", Decimal("71.00"), 2, 4)
    ]
    assert [r.customer_lifetime_days for r in rows] == [105, 1]


@pytest.mark.parametrize("limit", [0, 101])
def test_read_limits_are_checked(data, limit):
    with pytest.raises(ValueError):
        revenue.api_top_customers(data["fact"], data["customers"], limit)
    with pytest.raises(ValueError):
        products.api_top_products(data["fact"], data["products"], limit)


def test_trend_guards_gaps_zero_months_and_runs_to_the_total(data):
    rows = {r.year_month: r for r in revenue.monthly_revenue_trend(data["fact"]).collect()}
    assert rows["2023-01"].prev_month_revenue is None and rows["2023-01"].mom_growth_pct is None
    assert rows["2023-02"].mom_growth_pct == -96.99  # 166 to 5
    assert rows["2024-01"].prev_year_same_month == Decimal("166.00")
    assert rows["2024-01"].yoy_growth_pct == -100.0
    assert rows["2024-01"].cumulative_revenue == Decimal("226.00")


def test_growth_after_a_month_without_revenue_is_unknown(make):
    fact = make("order_id int, customer_id int, order_purchase_ym string, order_status string, "
                "total_value int", (1, 1, "2023-01", "delivered", 0), (2, 1, "2023-02", "delivered", 5))
    rows = {r.year_month: r for r in revenue.monthly_revenue_trend(fact).collect()}
    assert rows["2023-02"].mom_growth_pct is None


def test_aov_counts_orders_not_items(data):
    rows = {(r.year, r.month): r for r in revenue.aov_analysis(data["fact"]).collect()}
    january = rows[(2023, 1)]
    assert (january.total_orders, january.aov, january.median_aov) == (2, 83.0, 83.0)
    assert january.aov_rank == 1 and rows[(2023, 2)].aov_stddev is None


def test_repeat_purchase_and_shares(data):
    r = customers.repeat_purchase_rate(data["fact"]).first()
    assert (r.total_customers, r.one_time_buyers, r.repeat_customers) == (3, 1, 2)
    assert r.repeat_purchase_rate_pct == 66.67 and r.avg_customer_lifetime_days == 35.33


def test_cohort_offset_counts_calendar_months(data):
    rows = {(r.cohort_month, r.months_since_first_purchase): r
            for r in customers.cohort_retention(data["fact"]).collect()}
    assert rows[("2023-01", 0)].customers_in_cohort == 2
    assert rows[("2023-01", 1)].cohort_retention_pct == 50.0  # one night, next month
    assert rows[("2023-01", 3)].customers_in_cohort == 1
    early = customers.cohort_retention(data["fact"], dt.date(2023, 2, 1)).collect()
    assert {r.months_since_first_purchase for r in early} == {0, 1}


def test_retention_within_60_days(data):
    rows = {r.cohort_month: r for r in customers.retention_60d(data["fact"]).collect()}
    assert (rows["2023-01"].new_customers, rows["2023-01"].returned_customers) == (2, 1)


def test_payments_count_once_or_once_per_item(data):
    once = {r.payment_type: r for r in
            revenue.payment_method(data["fact"], data["payments"]).collect()}
    assert once["card"].total_payment_value == 160 and once["card"].total_payment_records == 2
    fan = {r.payment_type: r for r in
           revenue.payment_method_fanout(data["fact"], data["payments"]).collect()}
    joined = (data["fact"].filter("order_status = 'delivered'").join(data["payments"], "order_id")
              .groupBy("payment_type").agg(
                  F.sum("payment_value").alias("v"), F.count("*").alias("n"),
                  F.avg("payment_installments").alias("i")).collect())
    for r in joined:
        assert (fan[r.payment_type].total_payment_value, fan[r.payment_type].total_payment_records
                ) == (r.v, r.n)
        assert fan[r.payment_type].avg_installments == round(r.i, 1)
    assert sum(r.revenue_contribution_pct for r in fan.values()) == pytest.approx(100)


def test_delays_by_item_and_by_order(data):
    by_item = {r.order_month: r for r in revenue.delayed_orders(data["fact"]).collect()}
    by_order = {r.order_month: r for r in revenue.delayed_orders(data["fact"], "order").collect()}
    assert (by_item["2023-01"].delayed_orders, by_order["2023-01"].delayed_orders) == (3, 1)
    assert by_item["2023-01"].delayed_rate_pct == 150.0
    assert by_item["2023-02"].prev_month_delayed_orders == 3
    assert by_item["2023-02"].revenue_from_delayed_orders == 0


def test_product_shares(data):
    rows = products.top_products(data["fact"], data["products"], 1).collect()
    assert rows[0].pct_of_total_revenue == 100.0 and rows[0].units_sold == 3
    whole = products.top_products(data["fact"], data["products"], 1, "all").first()
    assert whole.pct_of_total_revenue == pytest.approx(53.98)
    both = products.top_products(data["fact"], data["products"]).collect()
    assert both[-1].cumulative_pct_of_revenue == 100.0


def test_categories_include_shipped_items(data):
    rows = {r.product_category_name: r for r in
            products.category_performance(data["fact"], data["products"]).collect()}
    assert rows["b"].units_sold == 4 and rows["b"].unique_customers == 4
    assert rows["b"].delivery_rate_pct == 75.0


def test_sellers_need_enough_orders_and_get_a_tier(data):
    assert sellers.seller_performance(data["fact"], data["sellers"]).isEmpty()
    rows = {r.seller_id: r for r in
            sellers.seller_performance(data["fact"], data["sellers"], 1).collect()}
    assert (rows["S1"].revenue_rank, rows["S1"].delivered_orders, rows["S1"].delayed_orders) == (1, 7, 4)
    assert rows["S1"].performance_tier == "Poor" and rows["S2"].performance_tier == "Excellent"
    by_order = sellers.seller_performance(data["fact"], data["sellers"], 1, "order")
    assert by_order.filter("seller_id = 'S1'").first().delayed_orders == 2


def test_views(data):
    order_rows = {r.order_id: r for r in views.v_order_metrics(data["fact"]).collect()}
    assert (order_rows["O1"].item_count, order_rows["O1"].order_delayed) == (3, 1)
    history = {r.customer_id: r for r in views.v_customer_history(
        data["fact"], data["customers"], dt.date(2023, 5, 1)).collect()}
    assert history["C2"].days_since_last_purchase == 11 and "C3" not in history
    product = {r.product_id: r for r in
               views.v_product_performance(data["fact"], data["products"]).collect()}
    assert product["P3"].delivered_count == 0 and product["P3"].avg_delivery_days is None
    trend = views.v_monthly_trend(data["fact"], star.dim_time(data["orders"])).collect()
    assert [(r.year, r.month) for r in trend] == [(2024, 1), (2023, 4), (2023, 2), (2023, 1)]


def test_aggregates_drop_null_keys_and_keep_both_unit_counts(data):
    fact = data["fact"].withColumn(
        "customer_id", F.when(F.col("order_id") != "O3", F.col("customer_id"))
    )
    rows = {r.customer_id: r for r in aggregates.agg_customer_metrics(fact).collect()}
    assert None not in rows and rows["C1"].days_as_customer == 0
    assert (rows["C1"].avg_order_value, rows["C1"].aov) == (17.75, 35.5)
    product = {r.product_id: r for r in aggregates.agg_product_metrics(data["fact"]).collect()}
    assert (product["P1"].units_sold, product["P1"].order_item_id_sum) == (4, 6)


def test_metrics(data):
    assert metrics.total_revenue(data["orders"], data["items"]).first()[0] == Decimal("303.00")
    assert metrics.aov(data["orders"], data["items"]).first().aov == 50.5
    assert metrics.repeat_rate(data["orders"]).first().repeat_rate_pct == 50.0
    assert metrics.order_counts(data["orders"]).first().orders_per_customer == 1.5
    clv = metrics.clv_distribution(data["orders"], data["items"]).first()
    assert (clv.mean_clv, clv.median_clv, clv.min_clv) == (75.75, 74.0, 0)
    status = {r.order_status: r for r in
              metrics.revenue_by_status(data["orders"], data["items"]).collect()}
    assert status["shipped"].revenue_pct == 25.4
    assert metrics.on_time_rate(data["orders"]).first().on_time_orders == 3
    assert metrics.installment_usage(data["payments"]).first().installment_pct == 50.0
    split = metrics.purchase_frequency_split(data["fact"]).first()
    assert (split.one_time_pct, split.repeat_pct, split.loyal_pct) == (33.33, 66.67, 0.0)


def test_segment_rules_and_summary(data):
    base = rfm.rfm_base(data["fact"], data["customers"])
    assert {r.customer_id: r.recency_days for r in base.collect()} == {"C1": 335, "C2": 258, "C4": 1}
    segments = rfm.rfm_segments(rfm.rfm_scores(base))
    assert segments.count() == 3
    summary = rfm.segment_summary(segments).collect()
    assert sum(r.customer_count for r in summary) == 3
    assert sum(r.pct_revenue for r in summary) == pytest.approx(100, abs=0.2)
    with pytest.raises(ValueError):
        rfm.customers_by_segment(segments, "Other")


@pytest.mark.parametrize("scores, name", [
    ((4, 4, 4), "Champions"), ((3, 4, 3), "Loyal Customers"), ((4, 3, 3), "Potential Loyalists"),
    ((4, 1, 2), "New Customers"), ((2, 4, 4), "At Risk"), ((1, 3, 2), "Need Attention"),
    ((2, 2, 1), "Lost"), ((3, 3, 3), "Other"), ((2, 4, 3), "Need Attention"), ((4, 2, 3), "Other"),
])
def test_range_segments(make, scores, name):
    df = make("r_score int, f_score int, m_score int", scores)
    assert rfm.rfm_segments(df).first().segment == name


def test_all_customers_alike_share_one_score(make):
    base = make("customer_id int, recency_days int, frequency int, monetary double",
                *[(i, 5, 1, 9.0) for i in range(8)])
    scores = rfm.rfm_scores(base)
    assert set(column(scores, "r_score")) == {4} and set(column(scores, "m_score")) == {1}
    assert sorted(column(scores, "f_score")) == [1, 1, 2, 2, 3, 3, 4, 4]


def test_recency_can_use_another_reference_and_customer_key(data):
    base = rfm.rfm_base(data["fact"], data["customers"], at(2024, 1, 12))
    assert {r.customer_id: r.recency_days for r in base.collect()}["C4"] == 10
    fact = data["fact"].withColumn("person", F.lit("same"))
    assert customers.repeat_purchase_rate(fact, "person").first().total_customers == 1
    assert revenue.customer_totals(fact, "person").first().total_orders == 5
