import pytest

from tests.conftest import column
from tradewind.operators import cleaning
from tradewind.operators.cleaning import DataQualityError
from tradewind.schemas import CleaningRules

ORDERS = "order_id string, customer_id string, price double"


def test_critical_fields_pass_and_name_what_is_missing(make):
    df = make(ORDERS, ("1", "A", 10.0), ("2", "B", 20.0), ("3", "C", 30.0))
    assert cleaning.validate_critical(df, "t", ["order_id", "customer_id"])
    with pytest.raises(DataQualityError, match="missing_col"):
        cleaning.validate_critical(df, "t", ["order_id", "missing_col"])


def test_critical_null_share_above_limit_raises(make):
    df = make(ORDERS, *[(str(i), "A" if i == 0 else None, 1.0) for i in range(5)])
    with pytest.raises(DataQualityError, match="customer_id"):
        cleaning.validate_critical(df, "t", ["customer_id"])
    assert cleaning.validate_critical(df, "t", ["customer_id"], max_null=0.8)


def test_empty_table_passes_critical_check(make):
    assert cleaning.validate_critical(make(ORDERS), "t", ["order_id"])
    assert column(cleaning.critical_report(make(ORDERS), "t", ["order_id", "x"]), "passed") == [1, 0]


def test_presence_flags(make):
    df = make("n int, a double, b string", (1, 1.0, None), (2, None, "x"), (3, 3.0, None))
    out = cleaning.missing_flags(df, {"a": "a_present", "b": "b_present", "c": "c_present"})
    assert column(out, "a_present", "n") == [1, 0, 1]
    assert column(out, "b_present", "n") == [0, 1, 0]
    assert "c_present" not in out.columns


def test_mean_and_unknown_are_flagged_before_filling(make):
    df = make("n int, col1 double, col2 string", (1, 1.0, "A"), (2, None, "B"), (3, 3.0, None))
    out = cleaning.impute(df, "t", {"col1": "mean", "col2": "unknown"})
    assert column(out, "col1_is_missing", "n") == [0, 1, 0]
    assert column(out, "col2_is_missing", "n") == [0, 0, 1]
    assert column(out, "col1", "n") == [1.0, 2.0, 3.0]
    assert column(out, "col2", "n") == ["A", "B", "unknown"]


def test_actions_run_in_order_so_a_drop_changes_the_median(make):
    df = make(
        "n int, dropme double, zero double, median double, unknown string, keep double",
        (1, 1.0, None, None, "a", None), (2, None, 2.0, 4.0, None, 1.0),
        (3, 3.0, None, 6.0, "b", None), (4, 2.0, 4.0, None, None, 2.0),
    )
    out = cleaning.impute(df, "t", {
        "dropme": "drop", "zero": "zero", "median": "median", "unknown": "unknown",
        "keep": "keep_null",
    })
    assert out.count() == 3
    assert column(out, "dropme_is_missing", "n") == [0, 0, 0]
    assert column(out, "zero", "n") == [0.0, 0.0, 4.0]
    assert column(out, "median", "n") == [6.0, 6.0, 6.0]
    assert column(out, "unknown", "n") == ["a", "b", "unknown"]
    assert column(out, "keep", "n").count(None) == 2


def test_median_before_a_drop_sees_all_rows(make):
    df = make("n int, m double, d double", (1, 2.0, 1.0), (2, 4.0, None), (3, None, 1.0))
    out = cleaning.impute(df, "t", {"m": "median", "d": "drop"})
    assert column(out, "m", "n") == [2.0, 3.0]


def test_flags_are_made_even_without_nulls_and_unknown_actions_keep(make):
    df = make("a double, s string", (1.0, None))
    out = cleaning.impute(df, "t", {"a": "zero", "s": "mystery", "absent": "zero"})
    assert column(out, "a_is_missing") == [0]
    assert column(out, "s") == [None]
    assert column(cleaning.impute_mean(df, "s"), "s") == [None]


def test_all_null_column_has_no_fill(make):
    df = make("a double", (None,), (None,))
    assert column(cleaning.impute_mean(df, "a"), "a") == [None, None]
    assert column(cleaning.impute_median(df, "a"), "a") == [None, None]


def test_first_row_of_each_key_is_kept_and_null_keys_are_equal(make):
    df = make("k string, v int", ("a", 2), ("a", 1), (None, 5), (None, 4), ("b", 9))
    out = cleaning.dedupe_first(df, ["k"])
    assert sorted(column(out, "v")) == [1, 4, 9]
    latest = cleaning.dedupe_first(df.withColumnRenamed("v", "pos"), ["k"], ["pos"])
    assert latest.count() == 3
    assert cleaning.dedupe_first(make("k int", (1,), (1,)), ["k"]).count() == 1


def test_dedupe_is_right_when_one_key_holds_a_third_of_the_rows(spark):
    from pyspark.sql import functions as F

    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        (F.lit(30_000) - F.col("id")).alias("v"),
    )
    out = cleaning.dedupe_first(df, ["k"])
    assert out.count() == df.select("k").distinct().count()
    assert out.filter("k = 0").first().v == 3


def test_bad_dates_become_null_and_are_counted(make):
    df = make("n int, dt string", (1, "2023-01-01"), (2, "invalid-date"), (3, "2023-02-02"))
    out = cleaning.coerce_timestamps(df, ["dt", "absent"])
    assert [d and d.isoformat() for d in column(out, "dt", "n")] == [
        "2023-01-01T00:00:00", None, "2023-02-02T00:00:00"
    ]
    assert column(cleaning.coercion_failures(df, "t", ["dt"]), "invalid_count") == [1]


def test_ranges_raise_and_nulls_pass(make):
    df = make("price double", (1.0,), (None,), (-2.0,))
    with pytest.raises(DataQualityError, match="1 values outside"):
        cleaning.validate_ranges(df, "t", {"price": (0, 10)})
    assert cleaning.validate_ranges(df, "t", {"price": (-5, 10), "absent": (0, 1)}) is df


def test_missing_approval_time_is_the_purchase_time(make):
    df = make("n int, order_purchase_timestamp string, order_approved_at string",
              (1, "2023-01-01", None), (2, "2023-01-01", "2023-01-02"))
    assert column(cleaning.fill_approved_at(df), "order_approved_at", "n") == [
        "2023-01-01", "2023-01-02"
    ]


def test_orphans_are_dropped_with_null_keys(make):
    fact = make("customer_id string, product_id string, seller_id string",
                ("C1", "P1", "S1"), ("C2", "P2", "S2"), ("C3", "P3", "S3"), (None, "P1", "S1"))
    dims = {
        "dim_customers": make("customer_id string", ("C1",), ("C2",)),
        "dim_products": make("product_id string", ("P1",), ("P2",)),
        "dim_sellers": make("seller_id string", ("S1",), ("S2",)),
    }
    assert sorted(column(cleaning.referential_filter(fact, dims), "customer_id")) == ["C1", "C2"]
    report = {r.key_column: (r.orphan_keys, r.orphan_rows)
              for r in cleaning.orphan_report(fact, dims).collect()}
    assert report == {"customer_id": (1, 2), "product_id": (1, 1), "seller_id": (1, 1)}


def test_reference_filter_with_many_rows_on_one_orphan(spark):
    from pyspark.sql import functions as F

    fact = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("customer_id")
    )
    dims = {"dim_customers": spark.range(9_000).withColumnRenamed("id", "customer_id")}
    assert cleaning.referential_filter(fact, dims).count() == 6_000


def test_tables_without_rules_pass_through_and_bad_tables_raise(make):
    odd = make("x int", (1,))
    assert cleaning.clean_all({"geolocation": odd})["geolocation"] is odd
    with pytest.raises(DataQualityError, match="customer_id is missing"):
        cleaning.clean_all({"orders": make("order_id string", ("1",))})


def test_clean_table_keeps_rows_through_the_given_store(make):
    kept = []

    def keep(name, df):
        kept.append(name)
        return df

    rules = CleaningRules(critical=("k",), key=("k",), ranges={"v": (0, 5)})
    out = cleaning.clean_table(make("k int, v int", (1, 2), (1, 3)), "t", rules, keep=keep)
    assert kept == ["t"] and column(out, "v") == [2]


def test_null_audit_covers_every_column(make):
    tables = {"a": make("x int, y int", (1, None), (None, None)), "b": make("z int", (1,))}
    audit = {(r.table_name, r.column_name): r.null_count
             for r in cleaning.null_audit(tables).collect()}
    assert audit == {("a", "x"): 1, ("a", "y"): 2, ("b", "z"): 0}


def test_only_rows_of_repeated_keys_are_sorted_and_shuffled(make, monkeypatch):
    rows = [(k, str(k), 9) for k in range(500)] + [(3, "3", 1), (None, "x", 7), (None, "x", 5)]
    df = make("k int, part string, v int", *rows)
    out = cleaning.dedupe_first(df, ["k", "part"])
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "LeftAnti" in text
    kept = sorted(map(tuple, out.collect()), key=str)
    assert len(kept) == 501 and (3, "3", 1) in kept and (None, "x", 5) in kept
    # With many repeated keys there is one shuffle of all rows, and the same result.
    monkeypatch.setattr(cleaning, "FEW_KEYS", 1)
    whole = cleaning.dedupe_first(df, ["k", "part"])
    assert "LeftAnti" not in whole._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, whole.collect()), key=str) == kept
