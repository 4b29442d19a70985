import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import column
from tradewind.operators import profiling, quality
from tradewind.plans import metrics
from tradewind.schemas import GateRules

FACT = """order_id int, customer_id string, product_id string, seller_id string,
  price double, freight_value double, total_value double, order_status string,
  etl_loaded_at timestamp_ntz"""
AT = dt.datetime(2023, 1, 1)


def fact_row(i, c="C1", p="P1", s="S1", price=1.0, status="delivered"):
    return (i, c, p, s, price, 1.0, price + 1, status, AT)


def dims(make):
    return {"dim_customers": make("customer_id string", ("C1",)),
            "dim_products": make("product_id string", ("P1",)),
            "dim_sellers": make("seller_id string", ("S1",))}


def results(df, suite):
    return {(r.expectation, r.column_name): (r.failed_rows, r.success)
            for r in quality.validate_suite(df, suite).collect()}


def test_suite_counts_every_rule_in_one_pass(make):
    df = make("customer_id string, order_status string, payment_value double, product_weight_g int",
              ("a", "delivered", 5.0, 1), (None, "lost", 20000.0, None), ("b", None, None, 2))
    found = results(df, [
        quality.expect_column_exists(df, "customer_id"),
        quality.expect_column_exists(df, "nope"),
        quality.expect_not_null("customer_id"),
        quality.expect_in_set("order_status", quality.ORDER_STATUSES),
        quality.expect_between("payment_value", 0, 10000),
        quality.expect_type(df, "product_weight_g", T.IntegerType()),
        quality.check_constraint("positive", F.col("product_weight_g") > 1),
    ])
    assert found == {
        ("expect_column_exists", "customer_id"): (0, 1), ("expect_column_exists", "nope"): (0, 0),
        ("expect_not_null", "customer_id"): (1, 0), ("expect_in_set", "order_status"): (1, 0),
        ("expect_between", "payment_value"): (1, 0), ("expect_type", "product_weight_g"): (0, 1),
        ("check_constraint", "positive"): (1, 0),
    }
    strict = quality.expect_in_set("order_status", quality.ORDER_STATUSES, nulls_pass=False)
    assert results(df, [strict])[("expect_in_set", "order_status")] == (2, 0)


def test_suite_on_an_empty_table_passes(make):
    df = make("a int")
    assert quality.suite_passes(quality.validate_suite(df, [quality.expect_not_null("a")]))


def test_a_row_lost_to_two_dimensions_counts_once(make):
    fact = make(FACT, fact_row(1), fact_row(2, c="X", p="Y"), fact_row(3, s=None))
    assert quality.fk_integrity(fact, dims(make)).first().orphaned_records == 2


def test_checks_on_an_empty_fact_are_zero(make):
    empty = make(FACT)
    assert quality.null_checks(empty).first().null_price == 0
    assert quality.value_validation(empty).first().negative_price == 0
    assert quality.fk_integrity(empty, dims(make)).first().orphaned_records == 0


def test_freshness_against_a_given_time(make):
    row = quality.data_freshness(make(FACT, fact_row(1)), dt.datetime(2023, 1, 2, 12)).first()
    assert (row.last_load, row.hours_since_load) == (AT, 36.0)


def test_log_appends_with_verdicts(spark, make, tmp_path):
    fact = make(FACT, *[fact_row(i) for i in range(200)], fact_row(200, price=-3.0))
    rows = quality.log_rows(quality.fact_check_counts(fact, dims(make)), checked_at=AT)
    path = str(tmp_path / "log")
    quality.append_quality_log(rows, path)
    quality.append_quality_log(rows, path)
    log = quality.read_quality_log(spark, path)
    assert log.count() == 8
    verdicts = {r.check_name: r.check_result for r in log.collect()}
    assert verdicts["VALUE_VALIDATION"] == "WARNING" and verdicts["NULL_CHECKS"] == "PASS"


def test_gate_levels(make):
    rule = GateRules(("k",), 0.4, ("k",), {"customer_id": "dim_customers"})
    df = make("k int, customer_id string, note string",
              (1, "C1", None), (2, "C1", None), (None, "X", None))
    gate = {r.check_name: r.result for r in quality.threshold_gate(
        {"t": df, **dims(make)}, {"t": rule, "absent": rule}).collect()}
    assert gate == {"null:k": "WARNING", "null:customer_id": "PASS", "null:note": "WARNING",
                    "duplicates": "PASS", "reference:customer_id": "FAIL"}


def test_keys_required_columns_and_defaults(make):
    dim = make("customer_id string", ("a",), ("a",), ("b",))
    row = quality.pk_uniqueness({"dim_customers": dim}).first()
    assert (row.repeated_keys, row.repeated_rows, row.row_count) == (1, 2, 3)
    time = make("date_id date, year int, month int", (None, 2023, None))
    assert column(quality.not_null({"dim_time": time}), "null_count", "column_name") == [1, 1, 0]
    filled = quality.with_defaults(make("freight_value double", (None,)), "fact_order_items")
    assert column(filled, "freight_value") == [0.0]


def test_fact_metrics_on_a_small_fact(make):
    fact = make(FACT, fact_row(1), fact_row(2, price=-1.0, status=None), fact_row(3, c=None))
    found = {r.metric: r.value for r in quality.fact_metrics(fact).collect()}
    assert found["fact_table_rows"] == 3 and found["total_revenue"] == 4.0
    assert found["avg_order_value"] == 1.3333 and found["null_pct_customer_id"] == 33.3333
    assert found["negative_prices_count"] == 1 and found["invalid_order_statuses"] == 1


def test_null_correlation_equals_pandas(make):
    df = make("a int, b int, c int, d int", (None, None, 1, 1), (1, None, 1, 1), (None, None, None, 1),
              (2, 3, 1, 1), (None, 4, None, 1))
    expected = df.toPandas().isnull().corr()
    for r in profiling.null_correlation(df).collect():
        want = expected.loc[r.column_a, r.column_b]
        assert r.correlation is None if want != want else abs(r.correlation - want) < 1e-6


def test_relationship_with_orphans_and_unused_parents(make):
    children = make("k int", (1,), (1,), (2,), (9,), (None,))
    parents = make("id int", (1,), (2,), (3,), (None,))
    r = profiling.relationship("x", children, "k", parents, "id").first()
    assert (r.child_keys, r.parent_keys, r.child_rows, r.matched_rows) == (3, 3, 5, 3)
    assert (r.orphan_keys, r.max_children, r.parents_with_several) == (1, 2, 1)
    assert r.parents_without == 2  # key 3 and the parent without a key


def test_quality_rates(make):
    df = make("k int, t string", (1, "2023-01-01"), (1, "bad"), (None, None), (2, "2023-01-02"))
    r = metrics.quality_rates(df, ["k"], ["k"], ["t"]).first()
    assert (r.null_rate_pct, r.duplicate_rate_pct, r.type_compliance_pct) == (25.0, 25.0, 66.6667)


@pytest.mark.parametrize("rows", [0, 40])
def test_gate_reads_a_table_with_references_once(spark, make, rows):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    schema = "order_id int, order_item_id int, customer_id int, product_id int, seller_id int, price double"
    fact = make(schema, *[(k // 2, 1, k % 3 or None, 1, k % 4, k - 1.0) for k in range(rows)])
    dims = {f"dim_{n}s": make(f"{n}_id int", (1,), (2,)) for n in ("customer", "product", "seller")}
    found = {r.check_name: (r.checked, r.failed) for r in quality.threshold_gate(
        {"fact_order_items": fact.mapInArrow(seen, schema), **dims}).collect()
        if r.table_name == "fact_order_items"}
    assert read.value == rows
    nobody = sum(k % 3 == 0 for k in range(rows))
    assert found["null:customer_id"] == (rows, nobody) == found["reference:customer_id"]
    assert found["duplicates"] == (rows, rows // 2)
    assert found["reference:seller_id"] == (rows, rows // 2)
    assert found["negative amounts"] == (rows, min(rows, 1))
