"""Every operator against an independent SQL engine on the given tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from tradewind.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def ordered(rows, names):
    wanted = sorted(names)
    places = [names.index(n) for n in wanted]
    return sorted(
        (tuple(r[i] for i in places) for r in rows),
        key=lambda r: tuple((v is None, 0 if v is None else v) for v in r),
    )


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    answer = duck.execute(ORACLES[name])
    names = [c[0] for c in answer.description]
    expected = answer.fetchall()
    df = QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(names)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in plan for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython"))
    assert ordered([tuple(r) for r in df.collect()], df.columns) == ordered(expected, names)


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() == 10
