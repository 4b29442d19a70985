"""Ranks, tiles and exact quantiles over a whole table, without one-task windows.

Spark sends a window without partition keys to a single task. For ranks and tiles
the rows are range-partitioned on the order, settled, and only the row count of each
range (one number per partition) is looked at globally. Every order ends in a unique
tie-break column, so a value shared by a third of the rows still spreads over
many ranges. Quantiles need no order: they are selected by refining histograms.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F, types as T

from tradewind.session import settle

# monotonically_increasing_id keeps the partition above the low 33 bits.
ROW_BITS = 33

# Pieces a cell is cut into per round, and from how few rows on the values are counted.
PIECES = 1024
FEW_ROWS = 100_000
LARGEST = sys.float_info.max


def _ranges(df: DataFrame, order: Sequence[Column], weight: Column | None) -> DataFrame:
    """Rows in range partitions, each knowing its range number; settled."""
    weighted = df.withColumn("_weight", F.lit(1).cast("long") if weight is None else weight)
    return settle(
        weighted.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    )


def _range_starts(ranges: DataFrame) -> list[tuple[int, int, int]]:
    """(range, rows before it, rows up to its end); one entry per partition."""
    sizes = ranges.groupBy("_range").agg(F.sum("_weight").alias("n")).orderBy("_range").collect()
    ends = list(accumulate(row.n for row in sizes))
    return [(row["_range"], end - row.n, end) for row, end in zip(sizes, ends)]


def rows_at(
    df: DataFrame, order: Sequence[Column], positions: Iterable[int], weight: Column | None = None
) -> dict[int, Row]:
    """Rows standing at the given 1-based positions of the total order.

    Only the ranges that hold a wanted position are sorted, and only the wanted
    rows come back. With ``weight`` a row counts that many times.
    """
    return _rows_at(_ranges(df, order, weight), order, positions)


def _rows_at(
    ranges: DataFrame, order: Sequence[Column], positions: Iterable[int]
) -> dict[int, Row]:
    wanted = sorted(set(positions))
    hits = []
    for number, start, end in _range_starts(ranges):
        inside = [p for p in wanted if start < p <= end]
        if inside:
            hits.append((number, start, inside))
    if not hits:
        return {}
    # At most one row per wanted position.
    targets = ranges.sparkSession.createDataFrame(
        hits, "_range int, _before long, _wanted array<long>"
    )
    in_range = W.partitionBy("_range").orderBy(*order).rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    found = (
        ranges.join(F.broadcast(targets), "_range")
        .withColumn("_end", F.col("_before") + F.sum("_weight").over(in_range))
        .withColumn("_start", F.col("_end") - F.col("_weight"))
        .withColumn(
            "_positions",
            F.filter("_wanted", lambda p: (p > F.col("_start")) & (p <= F.col("_end"))),
        )
        .filter(F.size("_positions") > 0)
        .collect()
    )
    return {position: row for row in found for position in row["_positions"]}


def _quantile_slots(rows: int, shares: Sequence[float]) -> list[tuple[int, int, float]]:
    """Lower and upper 1-based position and the step between them, per share."""
    slots = []
    for share in shares:
        place = (rows - 1) * share
        low = int(place)
        slots.append((low + 1, min(low + 1, rows - 1) + 1, place - low))
    return slots


def column_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float]
) -> dict[str, list[float | None]]:
    """Interpolated quantiles of numeric columns, all in the same passes; nulls ignored.

    A column without any value gives None for each share. ``df`` is read a few times.
    """
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ])
    long = df.select(F.explode(cells).alias("cell")).select("cell.*")
    found = grouped_quantiles(long, ["column"], "value", shares)
    return {c: found.get((c,), [None] * len(shares)) for c in columns}


def grouped_quantiles(
    df: DataFrame, by: Sequence[str], value: str, shares: Sequence[float]
) -> dict[tuple, list[float]]:
    """Interpolated quantiles of a column per group, exact and without a sort.

    One pass takes the size and the extremes of each group; the wanted positions are then
    selected by ``_selected``. The result and the group sizes pass through the driver, so
    use it for a bounded set of groups such as calendar months; a group itself may be of
    any size. ``df`` is read a few times: settle it if its rows are dear.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("_value")).filter("_value is not null")
    sizes = rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.min("_value").alias("low"), F.max("_value").alias("high")
    ).collect()
    slots, cells = {}, []
    for row in sizes:
        if row["n"]:
            group = tuple(row[c] for c in by)
            slots[group] = _quantile_slots(row["n"], shares)
            wanted = sorted({p for low, high, _ in slots[group] for p in (low, high)})
            cells.append(Cell(group, row["low"], row["high"], 0, row["n"], tuple(wanted)))
    found = _selected(rows, by, cells)
    result = {}
    for group, places in slots.items():
        edges = []
        for low, high, step in places:
            start, end = found[group, low], found[group, high]
            edges.append(start if step == 0 or start == end else start + (end - start) * step)
        result[group] = edges
    return result


@dataclass(frozen=True)
class Cell:
    """A stretch of a group's values, both ends held by rows, and the positions wanted there."""

    group: tuple
    low: float
    high: float
    before: int
    rows: int
    wanted: tuple[int, ...]

    def settled(self) -> bool:
        return self.low == self.high or (math.isnan(self.low) and math.isnan(self.high))


def _selected(rows: DataFrame, by: Sequence[str], cells: list[Cell]) -> dict[tuple, float]:
    """The value at each wanted position of each group, by refining histograms.

    Each round cuts every open cell at equal steps between its extremes, counts the rows of
    the pieces inside the map tasks, and keeps the pieces that hold a wanted position. The
    extremes are pieces of their own, so each round leaves fewer different values. A piece
    with one value is the answer, however many rows share it. Once few rows are left, the
    pieces are the values themselves.
    """
    found, rest = {}, cells
    while True:
        for cell in rest:
            if cell.settled():
                found.update({(cell.group, p): cell.low for p in cell.wanted})
        rest = [c for c in rest if not c.settled()]
        if not rest:
            return found
        rest = [
            Cell(rest[r["_target"]].group, r["low"], r["high"], r["_end"] - r["n"], r["n"],
                 tuple(r["_hit"]))
            for r in _pieces(rows, by, rest).collect()
        ]


def _pieces(rows: DataFrame, by: Sequence[str], cells: list[Cell]) -> DataFrame:
    """Pieces of the cells that hold a wanted position; at most one per position."""
    keys = [T.StructField(f"_by{i}", rows.schema[c].dataType) for i, c in enumerate(by)]
    schema = T.StructType([*keys, *T.StructType.fromDDL(
        "_target int, _low double, _high double, _from double, _width double, _before long, "
        "_wanted array<long>").fields])
    known = []
    for number, c in enumerate(cells):
        # Halves keep the width of the widest range finite.
        low, high = max(c.low, -LARGEST), LARGEST if math.isnan(c.high) else min(c.high, LARGEST)
        width = high * 0.5 - low * 0.5
        known.append((*c.group, number, c.low, c.high, low * 0.5, width, c.before, list(c.wanted)))
    # One row per open cell: at most one per wanted position of a bounded set of groups.
    targets = F.broadcast(rows.sparkSession.createDataFrame(known, schema))
    value = F.col("_value")
    same = (value >= F.col("_low")) & (value <= F.col("_high"))
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    if sum(c.rows for c in cells) <= FEW_ROWS:
        piece = value
    else:
        step = F.floor(F.least((value * 0.5 - F.col("_from")) / F.col("_width"), F.lit(1.0)) * PIECES)
        # No value lies between two neighbours, whose width may round to nothing.
        piece = (F.when(value == F.col("_low"), -1.0).when(value == F.col("_high"), PIECES + 1.0)
                 .when(F.col("_width") > 0, step.cast("double")).otherwise(0.0))
    counted = rows.join(targets, same).groupBy("_target", piece.alias("_piece")).agg(
        F.count("*").alias("n"), F.min("_value").alias("low"), F.max("_value").alias("high"),
        F.first("_before").alias("_before"), F.first("_wanted").alias("_wanted"))
    # A bounded number of pieces per cell, whatever the rows.
    in_cell = W.partitionBy("_target").orderBy("_piece").rowsBetween(
        W.unboundedPreceding, W.currentRow)
    return counted.withColumn("_end", F.col("_before") + F.sum("n").over(in_cell)).withColumn(
        "_hit", F.filter("_wanted", lambda p: (p > F.col("_end") - F.col("n"))
                         & (p <= F.col("_end")))).filter(F.size("_hit") > 0)


def tile_ends(rows: int, tiles: int) -> list[int]:
    """Last position of each tile but the final one; sizes differ by at most 1."""
    size, extra = divmod(rows, tiles)
    return list(accumulate(size + (1 if t < extra else 0) for t in range(tiles)))[:-1]


def rank_bin_ends(rows: int, bins: int) -> list[int]:
    """Last position of each bin but the final one when ranks are cut at quantiles."""
    return [int(1 + (rows - 1) * b / bins) for b in range(1, bins)]


def tile_columns(
    df: DataFrame, metrics: Mapping[str, tuple[str, bool]], tie: str, rows: int,
    ends: Sequence[int],
) -> dict[str, Column]:
    """Tile number 1.. of each row per metric: name -> (column, descending).

    ``df`` has ``rows`` rows and is read more than once, so settle it first. All metrics are put in
    order by one sort of (metric, value, tie), and the order is only needed at
    the rows that end a tile: a row's tile is the number of those rows it lies
    behind, plus 1. Nothing is joined back.
    """
    names = sorted(metrics)
    # One sort direction and one type for all metrics.
    keys = {
        n: (-F.col(metrics[n][0]) if metrics[n][1] else F.col(metrics[n][0])).cast("decimal(38,6)")
        for n in names
    }
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), keys[n].alias("key")) for n in names])
    long = df.select(F.explode(cells).alias("cell"), F.col(tie)).select("cell.*", tie)
    found = rows_at(
        long, [F.col("metric"), F.col("key"), F.col(tie)],
        [i * rows + end for i in range(len(names)) for end in ends if 0 < end <= rows],
    )
    tie_type = df.schema[tie].dataType
    tiles = {}
    for i, n in enumerate(names):
        tile = F.lit(1)
        for end in ends:
            last = found.get(i * rows + end)
            if last is not None and 0 < end <= rows:
                # Rows without a value come first, as in the sort.
                edge = F.lit(last["key"]).cast("decimal(38,6)")
                edge_tie = F.lit(last[tie]).cast(tie_type)
                larger = F.coalesce(keys[n] > edge, keys[n].isNotNull() & edge.isNull())
                behind = larger | (keys[n].eqNullSafe(edge) & (F.col(tie) > edge_tie))
                tile = tile + F.when(behind, 1).otherwise(0)
        tiles[n] = tile
    return tiles


def with_global_row_number(
    df: DataFrame, order: Sequence[Column], name: str = "row_number"
) -> DataFrame:
    """1-based position of every row; ``order`` must be total."""
    placed = settle(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    ).withColumn("_range", F.shiftright("_id", ROW_BITS))
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    # One row per range, so this window and the broadcast stay tiny.
    starts = sizes.select(
        "_range",
        (F.sum("_n").over(W.orderBy("_range")) - F.col("_n")).alias("_before"),
    )
    local = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    return (
        placed.join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_before") + local)
        .drop("_id", "_before")
    )


def with_global_rank(
    df: DataFrame, value: str, tie: str, name: str, descending: bool = False
) -> DataFrame:
    """RANK over the whole table: equal values share the lowest position.

    The first position of a value is found per range and then overall, and
    joined back on (range, value), so a value held by many rows is spread out.
    """
    key = F.col(value)
    numbered = with_global_row_number(
        df, [key.desc() if descending else key.asc(), F.col(tie).asc()], "_position"
    )
    per_range = numbered.groupBy("_range", F.col(value).alias("_value")).agg(
        F.min("_position").alias("_first")
    )
    overall = per_range.groupBy("_value").agg(F.min("_first").alias(name))
    firsts = (
        per_range.alias("p")
        .join(overall.alias("o"), F.col("p._value").eqNullSafe(F.col("o._value")))
        .select("p._range", "p._value", name)
    )
    return (
        numbered.alias("n")
        .join(
            firsts.alias("f"),
            (F.col("n._range") == F.col("f._range"))
            & F.col(f"n.{value}").eqNullSafe(F.col("f._value")),
        )
        .select(*[F.col(f"n.{c}") for c in df.columns], F.col(name))
    )
