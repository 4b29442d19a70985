import os
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import column
from tradewind.operators.cleaning import DataQualityError, dedupe_first
from tradewind.schemas import RAW_SCHEMAS
from tradewind.sources import files, keyed, tables


READ_ERRORS = (PySparkException, Py4JJavaError)


def write(folder, name, text):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.write(text)


@pytest.fixture
def folder(tmp_path):
    for name, schema in RAW_SCHEMAS.items():
        row = ",".join("1" for _ in schema.names)
        write(tmp_path, f"{name}.csv", f"{','.join(schema.names)}\n{row}\n")
    return str(tmp_path)


def test_all_nine_tables_are_read_with_declared_types(spark, folder):
    read = files.read_tables(spark, folder)
    assert len(read) == 9
    assert {r.table_name: r.n_rows for r in files.table_sizes(read).collect()} == dict.fromkeys(read, 1)
    assert read["order_items"].first().price == Decimal("1.00")


def test_leading_zeros_and_line_breaks_survive(spark, folder):
    write(folder, "customers.csv", "customer_id,customer_unique_id,customer_zip_code_prefix,"
          "customer_city,customer_state\n1,1,01234,a,SP\n")
    write(folder, "reviews.csv", ",".join(RAW_SCHEMAS["reviews"].names)
          + '\n1,1,5,t,"two\nlines, ""quoted""",2023-01-01,bad\n')
    read = files.read_tables(spark, folder)
    assert read["customers"].first().customer_zip_code_prefix == "01234"
    review = read["reviews"].first()
    assert review.review_comment_message == 'two\nlines, "quoted"'
    assert review.review_answer_timestamp == "bad"


def test_missing_file_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="orders.csv"):
        files.read_tables(spark, str(tmp_path))


def test_other_file_names_can_be_given(spark, folder):
    os.link(f"{folder}/sellers.csv", f"{folder}/shops.csv")
    assert files.read_tables(spark, folder, files={"sellers": "shops.csv"})["sellers"].count() == 1


def test_short_row_fails_fast_or_is_kept_as_corrupt(spark, folder):
    write(folder, "sellers.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\nx\n")
    with pytest.raises(READ_ERRORS, match="MALFORMED"):
        files.read_table(spark, f"{folder}/sellers.csv", "sellers").collect()
    row = files.read_table(spark, f"{folder}/sellers.csv", "sellers", "PERMISSIVE").first()
    assert row.seller_id == "x" and row.seller_city is None and row._corrupt_record == "x"


def test_unterminated_quote_is_an_error(spark, folder):
    write(folder, "sellers.csv", 'seller_id,seller_zip_code_prefix,seller_city,seller_state\n"a,b\n')
    with pytest.raises(READ_ERRORS, match="MALFORMED"):
        files.read_table(spark, f"{folder}/sellers.csv", "sellers").collect()


def test_first_row_in_file_order_can_be_kept(spark, folder):
    head = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    write(folder, "customers.csv", head + "1,z,0,z,z\n1,a,0,a,a\n2,b,0,b,b\n")
    df = files.with_file_order(files.read_table(spark, f"{folder}/customers.csv", "customers"))
    out = dedupe_first(df, ["customer_id"], ["_file_order"])
    assert column(out, "customer_city", "customer_id") == ["z", "b"]


def test_upsert_inserts_replaces_and_is_idempotent(spark, make, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, a string, b int"
    assert tables.load_existing(spark, path) is None
    keyed.upsert_table(spark, path, make(schema, (1, "x", 1), (2, "y", 2)), ["k"])
    updates = make(schema, (2, "Y", 20), (3, "z", 3))
    once = sorted(keyed.upsert_table(spark, path, updates, ["k"]).collect())
    twice = sorted(keyed.upsert_table(spark, path, updates, ["k"]).collect())
    assert once == twice == [(1, "x", 1), (2, "Y", 20), (3, "z", 3)]


def test_upsert_rejects_repeated_keys_and_replaces_without_keys(make):
    old, new = make("k int", (1,)), make("k int", (2,), (2,))
    with pytest.raises(DataQualityError):
        tables.upsert(old, new, ["k"])
    assert tables.upsert(old, new, []) is new


def test_unfinished_version_is_not_read(spark, make, tmp_path):
    path = str(tmp_path / "t")
    tables.write_version(make("k int", (1,)), path)
    os.makedirs(f"{path}/v=2")
    assert column(tables.read_current(spark, path), "k") == [1]
    assert column(tables.write_version(make("k int", (5,)), path), "k") == [5]


def test_append_with_keys_adds_only_new_rows(spark, make, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([(1,), (2,)], [(2,), (3,)]):
        tables.append_table(make("k int", *rows), path, ["k"])
    assert sorted(column(spark.read.parquet(path), "k")) == [1, 2, 3]
    tables.append_table(make("k int", (3,)), path)
    assert spark.read.parquet(path).count() == 4


def test_fact_is_partitioned_by_month_even_when_one_month_holds_a_third(spark, tmp_path):
    months = F.when(F.col("id") % 3 == 0, "2023-01").otherwise(
        F.format_string("2023-%02d", F.col("id") % 12 + 1)
    )
    df = spark.range(3_000).withColumn("order_purchase_ym", months)
    path = str(tmp_path / "fact")
    tables.replace_table(df, path, ["order_purchase_ym"])
    back = tables.read_back(spark, path, df)
    assert back.dtypes == df.dtypes and back.count() == 3_000
    assert back.exceptAll(df).isEmpty()
    assert sum(name.startswith("order_purchase_ym=") for name in os.listdir(path)) == 9


def test_layers_as_csv(spark, make, tmp_path):
    fact = make("order_id int, order_purchase_ym string", (1, "2023-01"))
    paths = tables.write_layers(
        str(tmp_path), {"orders": make("order_id int", (1,)), "geolocation": make("x int", (1,))},
        {"dim_time": make("date_key int", (20230101,))}, {}, fact, fmt="csv",
    )
    assert sorted(paths) == ["dim_time", "fact_order_items", "raw_orders"]
    assert tables.read_back(spark, paths["fact_order_items"], fact, "csv").first().order_id == 1


def test_csv_tables_come_back_with_their_types(spark, make, tmp_path):
    import datetime as dt

    df = make("k int, t timestamp_ntz, d date, m decimal(10,2), s string",
              (1, dt.datetime(2023, 1, 2, 3, 4, 5), dt.date(2023, 1, 2), Decimal("1.50"), 'a "b", c'),
              (2, None, None, None, None))
    tables.replace_table(df, str(tmp_path / "t"), fmt="csv")
    back = tables.read_back(spark, str(tmp_path / "t"), df, "csv")
    assert back.dtypes == df.dtypes and sorted(back.collect()) == sorted(df.collect())


def test_sample_is_the_first_rows_by_key(make):
    assert column(files.sample_rows(make("k int", (3,), (1,), (2,)), ["k"], 2), "k") == [1, 2]


def test_dataset_info(make):
    info = files.dataset_info({"t": make("a int, b int", (1, None), (None, None))}).first()
    assert (info.n_rows, info.n_columns, info.null_percentage) == (2, 2, 75.0)


def test_columns_go_by_name(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_state,extra,seller_id,seller_city,seller_zip_code_prefix\nRJ,x,s1,rio,01\n")
    row = files.read_table(spark, str(path), "sellers").first()
    assert (row.seller_id, row.seller_state, row.seller_zip_code_prefix) == ("s1", "RJ", "01")
    assert "extra" not in row.asDict()
    path.write_text("seller,seller_zip_code_prefix,seller_city,seller_state\ns1,01,rio,RJ\n")
    with pytest.raises(DataQualityError, match="seller_id"):
        files.read_table(spark, str(path), "sellers")


def test_malformed_rows_raise_in_counts_too(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01,rio,RJ\ns2,01\n")
    df = files.read_table(spark, str(path), "sellers")
    for action in (df.count, files.table_sizes({"sellers": df}).collect,
                   files.table_contents({"sellers": df}).collect):
        with pytest.raises(Exception, match="(?i)malformed"):
            action()


def test_appended_and_merged_keys_are_checked(spark, make, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([(1, "a"), (1, "b")], [(None, "c")]):
        df = make("k int, v string", *rows)
        with pytest.raises(DataQualityError):
            tables.append_table(df, path, ["k"])
        with pytest.raises(DataQualityError):
            tables.upsert(make("k int, v string", (1, "x")), df, ["k"])
    tables.append_table(make("k int, v string", (1, "a")), path, ["k"])
    tables.append_table(make("k int, v string", (1, "z"), (2, "b")), path, ["k"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b")]


def test_two_versions_stay(spark, make, tmp_path):
    for n in range(4):
        tables.write_version(make("k int", (n,)), str(tmp_path / "t"))
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["v=3", "v=4"]
    assert tables.previous_version(spark, str(tmp_path / "t")).first().k == 2
