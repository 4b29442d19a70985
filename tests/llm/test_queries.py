"""The numbered queries against SQL over the given tables, and the pipeline."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.test_oracles import TABLES, ordered
from tests.llm.test_packing import check
from tradewind.llm import minhash, pii, substrings
from tradewind.llm.queries import QUERIES
from tradewind.llm.sql import ORACLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    answer = duck.execute(ORACLES[name])
    names = [c[0] for c in answer.description]
    df = QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(names)
    assert ordered([tuple(r) for r in df.collect()], df.columns) == ordered(answer.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op10_packing"}))
def test_one_row_per_document(spark, name):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = QUERIES[name](spark, FOLDER).select("doc_id").collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in documents.select("doc_id").collect())


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = spark.createDataFrame(
        [(10**6, "12 34 --", "en", "s", 8), (10**6 + 1, None, None, "s", 0)], docs.schema)
    docs, columns = docs.unionByName(extra), docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, FOLDER)
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns and docs.dtypes == before.dtypes
    ids = {name: {r.doc_id for r in after.select("doc_id").collect()}
           for name, (_, after) in seen.items()}
    first = {r.doc_id for r in seen["language"][0].select("doc_id").collect()}
    assert first - ids["language"] == {10**6, 10**6 + 1}
    near = minhash.near_duplicates(seen["near_duplicates"][0],
                                   percent=corpus_pipeline.NEAR_PERCENT)
    assert ids["near_duplicates"] == {r.doc_id for r in near.where("kept").collect()}
    assert substrings.repeats(seen["passages"][1]).count() <= substrings.repeats(
        seen["passages"][0]).count() // 4
    left = pii.personal_data(seen["personal_data"][1])
    assert left.where(F.size("base") > 0).count() == 0
    assert ids["personal_data"] == ids["passages"] == ids["packing"]
    packed = seen["packing"][1].collect()
    check(packed, len(packed), 2048)


def test_the_whole_pipeline(spark):
    rows = QUERIES["op10_packing"](spark, FOLDER)
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == rows.columns and 0 < out.count() <= rows.count()
    assert corpus_pipeline.ORACLE_SQL is None
