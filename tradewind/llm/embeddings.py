"""Near-duplicate vectors by cross-polytope hashing, every link confirmed by its cosine.

Each hash turns a vector by three rounds of random signs and the fast Hadamard
transform and names the corner of the cross-polytope that is nearest: the largest
coordinate and its sign. A table joins ``hashes`` of them to a bucket. Probing several
corners per hash on both sides finds pairs whose nearest corners differ.

The number of hashes per table grows with the logarithm of the number of vectors, so
that a bucket holds few strangers at any size; the number of tables follows from the
chance, measured on random pairs at the threshold, that a pair meets in one table, so
that it misses all of them once in ``1 / MISS``.

Equal vectors are one class. Links between classes come from ``buckets``. All linked
pairs lie within one component, so links are counted there: blocks of a component's
classes are multiplied, and only sums per class come out.

Defined results: a vector that is null, empty, zero, or holds null or non-finite
components has no links and is its own component, kept. Vectors of different length are
not linked. Rows that share an id and a vector count each other as links. An empty
table gives no rows; other columns are not passed on.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradewind.llm.buckets import EVERY, block_pairs, connected, members_of
from tradewind.llm.frames import kept, mapped, slices
from tradewind.llm.words import mixed

THRESHOLD = 0.95
PROBES = 2
MISS = 1e-6
BLOCK = 256
ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, whose length is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        pairs = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]],
                     axis=2).reshape(n, width)
        half *= 2
    return x / math.sqrt(width)


def corners(x: np.ndarray, number: int, probes: int) -> np.ndarray:
    """The nearest corners (rows x probes) under hash ``number``; ties to the lower one."""
    width = 1 << max(x.shape[1] - 1, 0).bit_length()
    turned = np.zeros((len(x), width))
    turned[:, :x.shape[1]] = x
    signs = np.random.default_rng([number, width]).choice([-1.0, 1.0], size=(ROUNDS, width))
    for row in signs:
        turned = hadamard(turned * row)
    order = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, :min(probes, width)]
    return order * 2 + (np.take_along_axis(turned, order, axis=1) > 0)


def bucket_keys(x: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """Keys (rows x tables * probed buckets) of unit vectors of one length."""
    out = []
    for t in range(tables):
        near = [corners(x, t * hashes + h, probes).astype(np.uint64) for h in range(hashes)]
        for choice in itertools.product(range(near[0].shape[1]), repeat=hashes):
            key = np.full(len(x), t * 4096 + x.shape[1], dtype=np.uint64)
            for h, c in enumerate(choice):
                key = mixed(key + near[h][:, c] * np.uint64(0x9E3779B97F4A7C15))
            out.append(key)
    return np.stack(out, axis=1)


def meeting_chance(width: int, threshold: float, probes: int, pairs: int = 4000) -> float:
    """Chance that two vectors at the threshold share a probed corner of one hash."""
    rng = np.random.default_rng(width)
    x = rng.normal(size=(pairs, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = rng.normal(size=(pairs, width))
    g -= (g * x).sum(axis=1, keepdims=True) * x
    g /= np.maximum(np.linalg.norm(g, axis=1, keepdims=True), 1e-12)
    y = threshold * x + math.sqrt(1 - threshold**2) * g
    a, b = corners(x, 0, probes), corners(y, 0, probes)
    return float((a[:, :, None] == b[:, None, :]).any(axis=(1, 2)).mean())


def plan(count: int, width: int, threshold: float, probes: int,
         miss: float) -> tuple[int, int]:
    """Hashes per table and tables for ``count`` vectors."""
    padded = 1 << max(width - 1, 0).bit_length()
    spread = max(2 * padded / probes, 1.5)
    hashes = max(1, math.ceil(math.log(max(4 * count, 2)) / math.log(spread)))
    together = min(max(meeting_chance(width, threshold, probes) - 0.01, 0.01), 0.999) ** hashes
    return hashes, max(1, math.ceil(math.log(miss) / math.log(1 - together)))


def hashed(df: DataFrame, id_col: str, vector_col: str, plans: dict[int, tuple[int, int]],
           probes: int) -> DataFrame:
    """id, digest, unit vector and keys; the last three are null for what links with nothing."""
    kind = df.schema[id_col].dataType.simpleString()
    plain = df.select(F.col(id_col).alias("id"),
                      F.col(vector_col).cast("array<double>").alias("vector"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            vectors = batch.column("vector").to_pylist()
            by_width: dict[int, list[int]] = {}
            for n, v in enumerate(vectors):
                if v and None not in v and all(map(math.isfinite, v)) and any(v):
                    by_width.setdefault(len(v), []).append(n)
            digests, units, keys = ([None] * len(vectors) for _ in range(3))
            for width, rows in by_width.items():
                x = np.array([vectors[n] for n in rows])
                # By the largest component first: squares neither overflow nor vanish.
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                hashes, tables = plans[width]
                own = bucket_keys(x, tables, hashes, probes).view(np.int64)
                for k, n in enumerate(rows):
                    digests[n] = hashlib.blake2b(x[k].tobytes(), digest_size=16).digest()
                    units[n], keys[n] = x[k], own[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(digests, pa.binary()),
                 pa.array(units, pa.list_(pa.float64())), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "digest", "vector", "keys"])

    return mapped(plain, work, f"id {kind}, digest binary, vector array<double>, keys array<long>")


def _cosine(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def confirmed(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    vectors = classes.select("node", "vector")
    both = (pairs.join(vectors.select(F.col("node").alias("a"), F.col("vector").alias("u")), "a")
            .join(vectors.select(F.col("node").alias("b"), F.col("vector").alias("v")), "b"))
    return both.where((F.size("u") == F.size("v")) & (_cosine("u", "v") >= threshold)
                      ).select("a", "b")


def _products(batches: Iterator[pa.RecordBatch], threshold: float):
    """Nodes of both blocks and which of them are linked; of one block with itself, half."""
    for batch in slices(batches, 1):
        a, b = batch.column("own_a")[0].as_py(), batch.column("own_b")[0].as_py()
        good = np.zeros((len(a), len(b)), dtype=bool)
        widths = [np.array([len(x["vector"]) for x in own]) for own in (a, b)]
        for width in set(widths[0]) & set(widths[1]):
            i, j = (np.flatnonzero(w == width) for w in widths)
            u, v = (np.array([own[k]["vector"] for k in at]) for own, at in ((a, i), (b, j)))
            good[np.ix_(i, j)] = u @ v.T >= threshold
        if batch.column("same")[0].as_py():
            place = {x["node"]: k for k, x in enumerate(b)}
            order = np.array([place[x["node"]] for x in a])
            good &= np.arange(len(b)) > order[:, None]
        yield a, b, good


def block_links(open_: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Links across components within large buckets."""
    held = open_.join(classes.select("node", "vector"), "node")
    both = block_pairs(held, "key", ["node", "component", "vector"], F.ceil(F.col("size") / BLOCK))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, good in _products(batches, threshold):
            links = [(a[i]["node"], b[j]["node"]) for i, j in np.argwhere(good)
                     if a[i]["component"] != b[j]["component"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in links], pa.binary()),
                 pa.array([y for _, y in links], pa.binary())], names=["a", "b"])

    return mapped(both, work, "a binary, b binary")


def link_counts(nodes: DataFrame, threshold: float) -> DataFrame:
    """For each node (node, component, vector, copies): vectors of other nodes linked to it."""
    sizes = nodes.groupBy("component").agg(F.count("*").alias("size"))
    both = block_pairs(nodes.join(sizes, "component"), "component",
                       ["node", "copies", "vector"], F.ceil(F.col("size") / BLOCK))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, good in _products(batches, threshold):
            copies_a, copies_b = (np.array([x["copies"] for x in own]) for own in (a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x["node"] for x in (*a, *b)], pa.binary()),
                 pa.array(np.concatenate([good @ copies_b, copies_a @ good]), pa.int64())],
                names=["node", "n"])

    return mapped(both, work, "node binary, n long").groupBy("node").agg(
        F.sum("n").alias("n_others"))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, probes: int = PROBES,
                    miss: float = MISS) -> DataFrame:
    """id, n_links, component_id (smallest id reachable by links) and kept, per vector."""
    widths = df.groupBy(F.size(vector_col).alias("width")).count().where("width > 0").collect()
    plans = {r["width"]: plan(r["count"], r["width"], threshold, probes, miss) for r in widths}
    rows = kept(hashed(df, id_col, vector_col, plans, probes), "hashed")
    classes = kept(rows.where("digest is not null").groupBy(F.col("digest").alias("node")).agg(
        F.min("id").alias("first_id"), F.count("*").alias("copies"),
        F.min("vector").alias("vector"), F.min("keys").alias("keys")), "classes")
    members = members_of(classes.select("node", F.lit(1).alias("n"),
                                        F.explode(F.array_distinct("keys")).alias("key")))
    parts = connected(members, lambda pairs: confirmed(pairs, classes, threshold),
                      lambda open_: block_links(open_, classes, threshold), lambda a, b: EVERY)
    parts = kept(parts.withColumnRenamed("id", "node"), "parts")
    named = kept(classes.select("node", "first_id", "copies").join(parts, "node", "left").select(
        "node", "first_id", "copies", F.coalesce("component", "node").alias("component")), "named")
    lowest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    counts = link_counts(parts.join(classes.select("node", "copies", "vector"), "node"), threshold)
    of_class = named.join(lowest, "component").join(counts, "node", "left").select(
        F.col("node").alias("digest"), "component_id",
        (F.col("copies") - 1 + F.coalesce("n_others", F.lit(0))).alias("n_links"))
    return rows.select("id", "digest").join(of_class, "digest", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
        .alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
