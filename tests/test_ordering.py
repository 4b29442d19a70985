import random

import pandas as pd
import pytest
from pyspark.sql import Window as W, functions as F

from tradewind.operators import ordering


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, others have heavy ties, some are unique."""
    rnd = random.Random(7)
    rows = [(i, 0.0 if i % 3 == 0 else float(rnd.choice([1, 2, 2, 3, i])), "ab"[i % 2])
            for i in range(12_000)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "id long, v double, g string").repartition(11)


def test_row_number_and_rank_equal_a_plain_window(skewed):
    for descending in (False, True):
        key = F.desc("v") if descending else F.asc("v")
        ranked = ordering.with_global_rank(skewed, "v", "id", "r", descending)
        plain = skewed.select("id", F.rank().over(W.orderBy(key)).alias("r0"))
        assert ranked.join(plain, "id").filter("r <> r0").isEmpty()
        assert ranked.count() == skewed.count()
    numbered = ordering.with_global_row_number(skewed, [F.asc("v"), F.asc("id")])
    plain = skewed.select("id", F.row_number().over(W.orderBy("v", "id")).alias("n0"))
    assert numbered.join(plain, "id").filter("row_number <> n0").isEmpty()


def test_rank_keeps_null_values(make):
    df = make("id int, v int", (1, None), (2, None), (3, 5))
    out = {r.id: r.r for r in ordering.with_global_rank(df, "v", "id", "r").collect()}
    assert out == {1: 1, 2: 1, 3: 3}


def test_tiles_equal_ntile(skewed):
    settled = skewed.cache()
    rows = settled.count()
    tiles = ordering.tile_columns(
        settled, {"up": ("v", False), "down": ("v", True)}, "id", rows,
        ordering.tile_ends(rows, 4),
    )
    plain = settled.select(
        "id",
        F.ntile(4).over(W.orderBy("v", "id")).alias("up0"),
        F.ntile(4).over(W.orderBy(F.desc("v"), "id")).alias("down0"),
    )
    wrong = settled.withColumns(tiles).join(plain, "id").filter("up <> up0 or down <> down0")
    assert wrong.isEmpty()


@pytest.mark.parametrize("rows", [0, 1, 2, 3, 4, 5, 6, 7, 9, 10, 11])
def test_tile_sizes_differ_by_at_most_one(spark, rows):
    df = spark.range(rows).withColumn("v", F.lit(1)).cache()
    tiles = ordering.tile_columns(df, {"t": ("v", False)}, "id", rows, ordering.tile_ends(rows, 4))
    plain = df.withColumn("t0", F.ntile(4).over(W.orderBy("v", "id"))).withColumns(tiles)
    assert plain.filter("t <> t0").isEmpty()


@pytest.mark.parametrize(
    "rows, sizes", [(5, "2111"), (6, "2112"), (7, "2212"), (10, "3223"), (11, "3323")]
)
def test_quantile_bins_of_ranks(rows, sizes):
    ends = ordering.rank_bin_ends(rows, 4)
    assert "".join(str(b - a) for a, b in zip([0, *ends], [*ends, rows])) == sizes


def test_quantiles_equal_pandas(skewed):
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    pdf = skewed.toPandas()
    assert ordering.column_quantiles(skewed, ["v", "id"], shares) == {
        "v": pytest.approx(list(pdf.v.quantile(shares))),
        "id": pytest.approx(list(pdf.id.quantile(shares))),
    }
    grouped = ordering.grouped_quantiles(skewed, ["g"], "v", [0.5, 0.9])
    for g, part in pdf.groupby("g"):
        assert grouped[(g,)] == pytest.approx(list(part.v.quantile([0.5, 0.9])))


def test_quantiles_of_decimals_nulls_and_nothing(make):
    df = make("g string, v decimal(10,2)", ("a", None), ("b", None))
    assert ordering.column_quantiles(df, ["v"], [0.5]) == {"v": [None]}
    assert ordering.grouped_quantiles(df, ["g"], "v", [0.5]) == {}


def test_rows_at_counts_weights(make):
    df = make("v int, w long", (10, 3), (20, 1), (30, 2))
    found = ordering.rows_at(df, [F.asc("v")], [1, 3, 4, 5, 6, 7], F.col("w"))
    assert {p: r.v for p, r in found.items()} == {1: 10, 3: 10, 4: 20, 5: 30, 6: 30}


def test_quantiles_against_brute_force_on_small_lists(spark):
    rnd = random.Random(3)
    for n in (1, 2, 3, 8, 13):
        values = [rnd.choice([1.5, 2.5, 2.5, 9.0]) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in values], "v double")
        expected = list(pd.Series(values).quantile([0.25, 0.5, 0.75]))
        assert ordering.column_quantiles(df, ["v"], [0.25, 0.5, 0.75])["v"] == pytest.approx(expected)


@pytest.mark.parametrize("few", [0, 100_000])
def test_selection_of_odd_values(spark, monkeypatch, few):
    monkeypatch.setattr(ordering, "FEW_ROWS", few)
    inf, tiny = float("inf"), 5e-324
    lists = {
        "one value": [3.5] * 40, "neighbours": [tiny, 0.0, 2 * tiny, tiny], "far": [-1e308, 1e308, 0.0],
        "unlimited": [-inf, 1.0, 2.0, inf, inf], "signs": [-0.0, 0.0, -1e-300, 1e-300, 7.0],
        "close": [1.0 + k * 2.0 ** -52 for k in range(50)],
        "spread": [10.0 ** k for k in range(-300, 300, 7)], None: [2.0, 1.0],
    }
    rows = [(g, v) for g, values in lists.items() for v in values]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([*rows, ("empty", None)], "g string, v double").repartition(5)
    shares = [0.0, 1.0, 0.5]
    got = ordering.grouped_quantiles(df, ["g"], "v", shares)
    assert set(got) == {(g,) for g in lists}
    for g, values in lists.items():
        at = sorted(values)
        assert got[(g,)][:2] == [at[0], at[-1]], g
        if len(at) % 2:
            assert got[(g,)][2] == at[len(at) // 2], g


def test_not_a_number_comes_last(make):
    df = make("v double", (float("nan"),), (float("inf"),), (2.0,), (float("nan"),), (1.0,))
    low, middle, high = ordering.column_quantiles(df, ["v"], [0.25, 0.5, 1.0])["v"]
    assert (low, middle) == (2.0, float("inf")) and high != high


def test_quantiles_sort_nothing(skewed, monkeypatch):
    monkeypatch.setattr(ordering, "FEW_ROWS", 50)
    monkeypatch.setattr(ordering, "_ranges", None)
    monkeypatch.setattr(ordering, "settle", None)
    pdf = skewed.toPandas()
    shares = [0.01, 0.25, 0.5, 0.9]
    for g, part in pdf.groupby("g"):
        got = ordering.grouped_quantiles(skewed, ["g"], "v", shares)[(g,)]
        assert got == pytest.approx(list(part.v.quantile(shares)))
