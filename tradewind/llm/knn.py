"""Exact top-k by inner product: a Voronoi join of queries with all rows.

Inner products become distances: with M the largest norm, a row x gets one more component
that lifts its norm to M, and a query is scaled to norm M. All then lie on one sphere,
where the nearest rows are those with the highest inner product.

1. Pivots are chosen far apart from a bounded sample. Every row belongs to the cell of its
   nearest pivot. Summaries over all rows: per cell the k smallest distances to the pivot
   among rows that are no queries, and per pivot a histogram of the distances of all rows.
2. Queries are grouped by cell and, within it, by rings of equal distance to the pivot. No
   query of a ring is farther from its k-th row than theta: the ring's radius, plus the
   k-th smallest of (distance between pivots + distance of a summarised row to its pivot).
3. A row can be among the k nearest of a ring only if its distance to the ring's pivot
   lies within theta of the ring; all other rows are left out. Rings whose rows are mostly
   the same, by the histograms, share one group, so that rows are not copied for each.
   A group's rows are dealt to chunks of bounded size, and its queries go to every chunk.
4. A chunk is solved by products of blocks; a query's best rows of all chunks are merged.

Bounds hold with room for rounding, so nothing is missed; scores are whole numbers and
exact. Where vectors are spread evenly in many dimensions no bound can leave rows out;
then every group meets every row, in chunks. Nothing that grows with the rows passes
through the driver.

Defined results: vectors that are null or hold null or non-finite components take no part.
Shorter vectors count as filled up with zeros to the longest one's length, so an empty one
is all zeros. Ties go to the smaller id; rows without an id come last and are no queries.
Rows that share the query's id are its own; repeated rows of another id count each time.
Of repeated queries the one with the smallest vector stands. Queries with fewer than k
candidates get all of them. An empty table, or one without queries, gives no rows. Other
columns are not passed on. Scores beyond 64 bits raise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tradewind.llm.frames import findable, kept, gathered, mapped
from tradewind.llm.vectors import listed, matrix, parts, plain

K, SCALE = 10, 1024
PIVOTS, SAMPLE_ROWS, SAMPLE_NUMBERS = 256, 1024, 1 << 22
BINS = RINGS = 32
# Queries of a group, and rows of a chunk: what a task holds at once.
MOST_QUERIES, MOST_ROWS, FEWEST_ROWS = 32_768, 131_072, 4_096
# Sending a row to a group costs as much as comparing it with this many queries.
COPY_COST = 256
_SLICE = 8192
_ROOM = 1e-6


@dataclass
class Sphere:
    """Pivots on the sphere of radius ``m``."""

    pivots: np.ndarray
    m: float
    width: int
    scale: int

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.m ** 2 - (x ** 2).sum(axis=1), 0)
        return np.concatenate([x, np.sqrt(rest)[:, None]], axis=1)

    def scaled(self, q: np.ndarray) -> np.ndarray:
        norm = np.sqrt((q ** 2).sum(axis=1, keepdims=True))
        q = q * (self.m / np.where(norm > 0, norm, 1))
        return np.concatenate([q, np.zeros((len(q), 1))], axis=1)

    def far(self, x: np.ndarray) -> np.ndarray:
        """Distances of points to all pivots."""
        square = ((x ** 2).sum(axis=1)[:, None] + (self.pivots ** 2).sum(axis=1)
                  - 2 * x @ self.pivots.T)
        return np.sqrt(np.maximum(square, 0))

    def bin_of(self, far: np.ndarray, bins: int) -> np.ndarray:
        step = 2 * self.m / bins or 1.0
        return np.minimum((far / step).astype(np.int64), bins - 1)


def sphere_of(rows: DataFrame, scale: int, pivots: int) -> Sphere | None:
    """Pivots from the rows with the smallest hashes, each the farthest from those before."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norm, width = 0.0, -1
        for batch in gathered(batches, 4096):
            values, row = parts(batch.column("vector"))
            sums = np.bincount(row, np.floor(scale * values) ** 2, batch.num_rows)
            norm = max(norm, float(sums.max(initial=0)))
            width = max(width, int(np.bincount(row, minlength=1).max()))
        yield pa.RecordBatch.from_pydict({"norm": [norm], "width": [width]}, pa.schema(
            [("norm", pa.float64()), ("width", pa.int32())]))

    whole = mapped(rows.select("vector"), work, "norm double, width int").agg(
        F.max("norm"), F.max("width")).head()
    if whole[1] is None or whole[1] < 0:
        return None
    width = max(whole[1], 1)
    m = math.sqrt(whole[0]) * (1 + 1e-12)
    if m >= 2.0 ** 31:
        raise ValueError("scores would not fit 64 bits")
    sample = min(SAMPLE_ROWS, max(1, SAMPLE_NUMBERS // width))
    chosen = rows.orderBy(F.xxhash64("id", "vector")).limit(sample).collect()
    sphere = Sphere(np.empty((0, width + 1)), m, width, scale)
    x = sphere.lifted(matrix(pa.array([r["vector"] for r in chosen], pa.list_(pa.float64())),
                             width, scale))
    picked, near = [0], np.full(len(x), np.inf)
    while len(picked) < min(pivots, len(x)):
        near = np.minimum(near, ((x - x[picked[-1]]) ** 2).sum(axis=1))
        farthest = int(near.argmax())
        if near[farthest] == 0:
            break
        picked.append(farthest)
    sphere.pivots = x[picked]
    return sphere


def summaries(rows: DataFrame, sphere: Sphere, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per cell the k smallest distances of rows that are no queries; histograms by pivot."""
    n = len(sphere.pivots)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, counts = np.full((n, k), np.inf), np.zeros(n * BINS, np.int64)
        for batch in gathered(batches, 4096):
            far = sphere.far(sphere.lifted(matrix(batch.column("vector"), sphere.width,
                                                  sphere.scale)))
            counts += np.bincount((np.arange(n) * BINS + sphere.bin_of(far, BINS)).reshape(-1),
                                  minlength=n * BINS)
            far = far[~batch.column("query").to_numpy(False).astype(bool)]
            cell, own = far.argmin(axis=1), far.min(axis=1, initial=np.inf)
            order = np.lexsort((own, cell))
            first = np.searchsorted(cell[order], np.arange(n + 1))
            for c in np.flatnonzero(np.diff(first)):
                more = own[order[first[c]:min(first[c + 1], first[c] + k)]]
                near[c] = np.sort(np.concatenate([near[c], more]))[:k]
        at, used = np.nonzero(np.isfinite(near)), np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([at[0], used // BINS]), pa.int32()),
             pa.array(np.concatenate([np.full(len(at[0]), -1), used % BINS]), pa.int32()),
             pa.array(np.concatenate([near[at], counts[used].astype(float)]), pa.float64())],
            names=["pivot", "bin", "value"])

    told = kept(mapped(rows.select("vector", "query"), work, "pivot int, bin int, value double"),
                "summaries")
    near, histogram = np.full((n, k), np.inf), np.zeros((n, BINS))
    # At most pivots x k and pivots x bins rows.
    best = W.partitionBy("pivot").orderBy("value")
    for r in told.where("bin < 0").select("pivot", "value", F.row_number().over(best).alias("r")
                                          ).where(F.col("r") <= k).collect():
        near[r["pivot"], r["r"] - 1] = r["value"]
    for r in told.where("bin >= 0").groupBy("pivot", "bin").agg(F.sum("value").alias("n")).collect():
        histogram[r["pivot"], r["bin"]] = r["n"]
    return near, histogram


def ringed(queries: DataFrame, sphere: Sphere) -> DataFrame:
    """Queries (id, vector of whole numbers) with cell, ring and distance to the pivot."""
    kind = queries.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, 4096):
            q = matrix(batch.column("vector"), sphere.width, sphere.scale)
            far = sphere.far(sphere.scaled(q))
            cell, own = far.argmin(axis=1), far.min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), listed(q, pa.float64()), pa.array(cell, pa.int32()),
                 pa.array(sphere.bin_of(own, RINGS), pa.int32()), pa.array(own)],
                names=["id", "vector", "cell", "ring", "far"])

    return mapped(queries, work,
                  f"id {kind}, vector array<double>, cell int, ring int, far double")


@dataclass
class Group:
    """Rings of queries that meet the same rows."""

    rings: list[tuple[int, int]]
    ranges: list[tuple[int, float, float]]  # pivot, least and largest distance of a row
    queries: int
    rows: float  # no fewer than the rows in its ranges


def groups_of(rings: list, sphere: Sphere, near: np.ndarray, histogram: np.ndarray,
              k: int) -> list[Group]:
    """Rings (cell, ring, least, largest, n) dealt to groups by what they need."""
    total, step, room = histogram[0].sum(), 2 * sphere.m / BINS or 1.0, _ROOM * sphere.m
    between = sphere.far(sphere.pivots)
    out = []
    for cell, ring, least, largest, n in rings:
        reach = (between[cell][:, None] + near).reshape(-1)
        theta = largest + (np.partition(reach, k - 1)[k - 1] if len(reach) >= k else np.inf)
        low, high = least - theta - room, largest + theta + room
        first = int(np.clip(low / step, 0, BINS - 1)) if np.isfinite(low) else 0
        last = int(np.clip(high / step, 0, BINS - 1)) if np.isfinite(high) else BINS - 1
        rows = histogram[cell, max(first - 1, 0):last + 2].sum()
        out.append(Group([(cell, ring)], [(cell, low, high)], n, rows))

    def cost(queries: int, rows: float) -> float:
        return rows * (COPY_COST + queries)

    merged: list[Group] = []
    for g in sorted(out, key=lambda g: -g.rows):
        for other in merged:
            rows, queries = min(total, other.rows + g.rows), other.queries + g.queries
            if queries <= MOST_QUERIES and cost(queries, rows) <= (
                    cost(other.queries, other.rows) + cost(g.queries, g.rows)):
                other.rings += g.rings
                other.ranges += g.ranges
                other.queries, other.rows = queries, rows
                break
        else:
            merged.append(g)
    return merged


def dealt(rows: DataFrame, sphere: Sphere, ranges: list[list[tuple[int, float, float]]],
          targets: list[list[int]], chunks: list[int]) -> DataFrame:
    """Rows (team, chunk, id, vector) for every group whose ranges hold them."""
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in gathered(batches, 4096):
            x = matrix(batch.column("vector"), sphere.width, sphere.scale)
            far = sphere.far(sphere.lifted(x))
            turn = np.arange(seen, seen + len(x))
            seen += len(x)
            for group, own in enumerate(ranges):
                wanted = np.zeros(len(x), bool)
                for pivot, low, high in own:
                    wanted |= (far[:, pivot] >= low) & (far[:, pivot] <= high)
                at = np.flatnonzero(wanted)
                if not len(at):
                    continue
                ids, vectors = batch.column("id").take(pa.array(at)), listed(x[at], pa.float64())
                for team in targets[group]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), team), pa.int32()),
                         pa.array((turn[at] + team) % chunks[group], pa.int32()), ids, vectors],
                        names=["team", "chunk", "id", "vector"])

    return mapped(rows.select("id", "vector"), work,
                  f"team int, chunk int, id {kind}, vector array<double>")


def best_of(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, known: int, x: np.ndarray,
            k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and places (queries x k) of the best rows; -inf where there is none.

    Rows stand in order of their ids, the ``known`` first ones; ties go to the earlier.
    """
    best = np.full((len(q), k), -np.inf)
    place = np.zeros((len(q), k), np.int64)
    own = [np.searchsorted(ids[:known], query_ids, side) for side in ("left", "right")]
    for start in range(0, len(x), _SLICE):
        block = x[start:start + _SLICE]
        score = q @ block.T
        for r in np.flatnonzero((own[0] < own[1]) & (own[1] > start)
                                & (own[0] < start + len(block))):
            score[r, max(own[0][r] - start, 0):max(own[1][r] - start, 0)] = -np.inf
        # One number for score and place: ties are never cut arbitrarily.
        ordered = score * _SLICE - np.arange(len(block))
        top = np.argsort(-ordered, axis=1) if len(block) <= k else np.argpartition(
            -ordered, k - 1, axis=1)[:, :k]
        top.sort(axis=1)
        both = np.concatenate([best, np.take_along_axis(score, top, 1)], axis=1)
        where = np.concatenate([place, top + start], axis=1)
        order = np.argsort(-both, axis=1, kind="stable")[:, :k]
        best, place = np.take_along_axis(both, order, 1), np.take_along_axis(where, order, 1)
    return best, place


def best_of_large(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, known: int,
                  x: np.ndarray, k: int) -> tuple[list[list[int]], np.ndarray]:
    """As ``best_of`` for scores that doubles cannot tell apart, in whole numbers."""
    exact = [[int(v) for v in row] for row in x]
    best, place = [], np.zeros((len(q), k), np.int64)
    for r, row in enumerate(q):
        row = [int(v) for v in row]
        scores = sorted((-sum(a * b for a, b in zip(row, other)), n)
                        for n, other in enumerate(exact)
                        if n >= known or ids[n] != query_ids[r])[:k]
        best.append([-s for s, _ in scores])
        place[r, :len(scores)] = [n for _, n in scores]
    return best, place


def solver(sphere: Sphere, k: int, id_type: pa.DataType):
    exact = sphere.m ** 2 * _SLICE < 2.0 ** 52

    def solve(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and rows.num_rows:
            rows = rows.take(pa.compute.sort_indices(rows.column("id")))  # nulls at the end
            column = rows.column("id").combine_chunks()
            known = len(column) - column.null_count
            ids = pa.compute.fill_null(column, 0).to_numpy(False)
            x = (rows.column("vector").combine_chunks().flatten().to_numpy(False)
                 .reshape(rows.num_rows, sphere.width))
            for part in queries.combine_chunks().to_batches(512):
                q = part.column("vector").flatten().to_numpy(False).reshape(-1, sphere.width)
                own = part.column("id").to_numpy(False)
                if exact:
                    best, place = best_of(own, q, ids, known, x, k)
                    r, c = np.nonzero(np.isfinite(best))
                    scores = pa.array(best[r, c].astype(np.int64))
                else:
                    best, place = best_of_large(own, q, ids, known, x, k)
                    at = [(r, c) for r, row in enumerate(best) for c in range(len(row))]
                    r, c = np.array(at, np.int64).reshape(-1, 2).T
                    scores = pa.array([best[a][b] for a, b in at], pa.int64())
                out.append(pa.table({"query_id": part.column("id").take(pa.array(r)),
                                     "vec_id": column.take(pa.array(place[r, c])),
                                     "score": scores}))
        return pa.concat_tables(out) if out else pa.table(
            {"query_id": pa.array([], id_type), "vec_id": pa.array([], id_type),
             "score": pa.array([], pa.int64())})

    return solve


def nearest(df: DataFrame, chosen: Column, id_col: str = "vec_id",
            vector_col: str = "embedding", k: int = K, scale: int = SCALE,
            pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank (from 1), id and score: the k best rows of each ``chosen`` row."""
    spark = df.sparkSession
    findable(spark)
    kind = df.schema[id_col].dataType.simpleString()
    rows = plain(df, id_col, vector_col, query=F.coalesce(chosen, F.lit(False)))
    sphere = sphere_of(rows, scale, pivots)
    own = rows.where("query and id is not null").groupBy("id").agg(F.min("vector").alias("vector"))
    none = spark.createDataFrame([], f"query_id {kind}, rank int, {id_col} {kind}, score long")
    if sphere is None:
        return none
    queries = kept(ringed(own, sphere), "queries")
    # At most cells x rings rows.
    rings = [(r["cell"], r["ring"], r["least"], r["largest"], r["n"]) for r in queries.groupBy(
        "cell", "ring").agg(F.min("far").alias("least"), F.max("far").alias("largest"),
                            F.count("*").alias("n")).orderBy("cell", "ring").collect()]
    if not rings:
        return none
    near, histogram = summaries(rows, sphere, k)
    groups = groups_of(rings, sphere, near, histogram, k)
    # A ring of very many queries is split over several teams that meet the same rows.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    targets, chunks, places = [], [], []
    for g in groups:
        first = sum(map(len, targets))
        targets.append(list(range(first, first + -(-g.queries // MOST_QUERIES))))
        chunks.append(max(1, math.ceil(g.rows / MOST_ROWS),
                          min(tasks, math.ceil(g.rows / FEWEST_ROWS))))
        places += [(cell, ring, first, len(targets[-1]), chunks[-1]) for cell, ring in g.rings]
    teams = spark.createDataFrame(places, "cell int, ring int, first int, teams int, chunks int")
    left = queries.join(F.broadcast(teams), ["cell", "ring"]).select(
        (F.col("first") + F.pmod(F.hash("id"), F.col("teams"))).alias("team"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "id", "vector")
    right = dealt(rows, sphere, [g.ranges for g in groups], targets, chunks)
    solve = solver(sphere, k, pa.int64() if kind == "bigint" else pa.int32())
    found = left.groupBy("team", "chunk").cogroup(right.groupBy("team", "chunk")).applyInArrow(
        solve, f"query_id {kind}, vec_id {kind}, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("vec_id").alias(id_col), "score")
