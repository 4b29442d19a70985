import datetime as dt
from decimal import Decimal

import pytest

from tests.conftest import column
from tradewind.operators import quality
from tradewind.operators.cleaning import DataQualityError
from tradewind.plans import pipeline
from tradewind.schemas import RAW_SCHEMAS
from tradewind.sources import tables

ROWS = {
    "orders": [
        "O1,C1,delivered,2023-01-01 10:00:00,,2023-01-02 00:00:00,2023-01-06 09:00:00,2023-01-05 00:00:00",
        "O2,C2,delivered,2023-01-02 00:00:00,bad,,2023-01-03 00:00:00,2023-01-04 00:00:00",
        "O3,C9,shipped,2023-02-02 00:00:00,,,,2023-02-04 00:00:00",
    ],
    # The first of two rows with one key stays, though the second sorts before it.
    "order_items": ["O1,1,P1,S1,2023-01-03 00:00:00,100.00,10.00", "O1,1,P1,S1,,1.00,0.00",
                    "O2,1,P2,S1,,50.00,5.00", "O3,1,P1,S1,,7.00,0.00", "O2,2,P1,SX,,7.00,0.00"],
    "customers": ["C1,U1,01234,rio,RJ", "C2,U1,01235,rio,RJ"],
    "products": ["P1,livros,5,50,1,100,10,10,10", "P2,,,,,,,,"],
    "payments": ["O1,1,card,2,110.00"],
    "reviews": ['R1,O1,5,,"good, fast",2023-01-07 00:00:00,2023-01-08 00:00:00'],
    "sellers": ["S1,00001,rio,RJ"],
    "geolocation": ["01234,-1.0,-2.0,rio,RJ"],
    "category_translation": ["livros,books"],
}


@pytest.fixture
def folder(tmp_path):
    for name, rows in ROWS.items():
        head = ",".join(RAW_SCHEMAS[name].names)
        (tmp_path / f"{name}.csv").write_text("\n".join([head, *rows]) + "\n")
    return tmp_path


def test_files_to_warehouse(spark, folder, tmp_path):
    house = pipeline.run_files(spark, str(folder), str(tmp_path / "out"), max_broken=0.5)
    fact = house.fact
    assert not house.failures
    assert column(fact, "order_id", "order_id") == ["O1", "O2"]  # unknown customer and seller left
    assert column(fact, "total_value", "order_id") == [Decimal("110.00"), Decimal("55.00")]
    assert column(fact, "is_delayed", "order_id") == [1, 0]  # four whole days against three
    assert column(fact, "delivery_time_days", "order_id") == [4, 1]
    assert column(fact, "estimated_delivery_days", "order_id") == [3, 2]
    assert column(fact, "is_approved", "order_id") == [0, 0]
    assert column(fact, "order_approved_at", "order_id")[0] == dt.datetime(2023, 1, 1, 10)
    assert len(set(column(fact, "etl_loaded_at"))) == 1
    products = house.dims["dim_products"]
    assert column(products, "product_category_name", "product_id") == ["livros", "unknown"]
    assert column(products, "category_english", "product_id") == ["books", None]
    assert column(products, "product_weight_g", "product_id") == [100.0, 100.0]
    assert column(house.tables["customers"], "customer_zip_code_prefix", "customer_id")[0] == "01234"
    assert column(house.tables["reviews"], "review_comment_message_word_count") == [2]
    assert "_file_order" not in {c for df in house.tables.values() for c in df.columns}
    months = house.aggregates["agg_monthly_revenue"].collect()
    assert [(r.year, r.month, r.total_revenue, r.order_count) for r in months] == [
        (2023, 1, Decimal("165.00"), 2)
    ]


def test_broken_input_raises(spark, folder, tmp_path):
    (folder / "orders.csv").write_text(
        ",".join(RAW_SCHEMAS["orders"].names) + "\nO1,,delivered,2023-01-01 00:00:00,,,,\n"
    )
    with pytest.raises(DataQualityError, match="customer_id"):
        pipeline.run_files(spark, str(folder), str(tmp_path / "out"))


def test_values_out_of_range_raise(spark, folder, tmp_path):
    head = ",".join(RAW_SCHEMAS["order_items"].names)
    (folder / "order_items.csv").write_text(f"{head}\nO1,1,P1,S1,,-1.00,0.00\n")
    with pytest.raises(DataQualityError, match="price"):
        pipeline.run_files(spark, str(folder), str(tmp_path / "out"))


def test_a_failing_aggregate_is_reported(spark, folder, tmp_path, monkeypatch):
    real = pipeline.aggregate

    def sometimes(fact, table, run_ts=None):
        if table == "agg_product_metrics":
            raise RuntimeError("no luck")
        return real(fact, table, run_ts)

    monkeypatch.setattr(pipeline, "aggregate", sometimes)
    house = pipeline.run_files(spark, str(folder), str(tmp_path / "out"), max_broken=0.5)
    assert house.failures == {"agg_product_metrics": "no luck"}
    assert set(house.aggregates) == {"agg_customer_metrics", "agg_monthly_revenue"}


def test_a_bad_load_leaves_the_published_one(spark, folder, tmp_path):
    out, head = str(tmp_path / "out"), ",".join(RAW_SCHEMAS["order_items"].names)

    def load(*rows):
        (folder / "order_items.csv").write_text("\n".join([head, *rows]) + "\n")
        pipeline.run_files(spark, str(folder), out, max_broken=0.4)

    def prices():
        place = pipeline.published(spark, out)
        return sorted(column(spark.read.parquet(f"{place}/staging/raw_order_items"), "price"))

    load("O1,1,P1,S1,,5.00,1.00")
    assert prices() == [Decimal("5.00")]
    with pytest.raises(DataQualityError, match="price"):
        load("O1,1,P1,S1,,-1.00,1.00")
    with pytest.raises(DataQualityError, match="reference:seller_id: 1 of 2"):
        load("O1,1,P1,S1,,7.00,1.00", "O2,1,P1,SX,,7.00,1.00")
    assert prices() == [Decimal("5.00")]
    # A repeated key counts once; every gate left its rows in the log.
    load("O1,1,P1,S1,,6.00,1.00", "O1,1,P1,S1,,9.00,1.00")
    assert prices() == [Decimal("6.00")]
    log = spark.read.parquet(f"{out}/quality_log")
    assert log.where("result = 'FAIL'").count() == 1
    assert log.where("check_name = 'duplicates' and table_name = 'fact_order_items'").count() == 3


def test_repeated_dimension_keys_do_not_multiply_rows(spark, folder, tmp_path):
    for name in ("sellers", "category_translation"):
        (folder / f"{name}.csv").write_text(
            "\n".join([",".join(RAW_SCHEMAS[name].names), *ROWS[name] * 2]) + "\n")
    house = pipeline.run_files(spark, str(folder), str(tmp_path / "out"), max_broken=0.5)
    assert house.dims["dim_products"].count() == 2 and house.dims["dim_sellers"].count() == 1
    assert house.fact.count() == 2


def test_counts_come_with_the_write(spark, make, tmp_path):
    df = make("k int, price double", (1, -1.0), (2, None), (3, 5.0), (None, 2.0))
    many = df.crossJoin(spark.range(3_000)).select("k", "price")
    checks = quality.gate_counts(many)
    for rows, by in ((many, ()), (many, ("k",)), (many.limit(0), ()), (many.limit(0), ("k",))):
        found = tables.replace_table(rows, str(tmp_path / "t"), by, counts=checks)
        expected = rows.agg(*(n.alias(c) for c, n in checks.items())).first().asDict()
        assert found == expected
        assert found["rows"] == rows.count()
    assert tables.replace_table(many, str(tmp_path / "t")) == {}


def test_gate_from_counts_equals_gate_from_passes(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    house = pipeline.run_files(spark, str(folder), out, max_broken=0.5)
    passes = quality.load_gate({**house.dims, "fact_order_items": house.fact}, house.tables, 0.5)
    log = spark.read.parquet(f"{out}/quality_log").select(*passes.columns)
    assert sorted(map(tuple, log.collect())) == sorted(map(tuple, passes.collect()))
    assert log.where("failed > 0 and check_name like 'reference:%'").count() == 2
