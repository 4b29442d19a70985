"""Links between the members of hash buckets, without all pairs of a bucket as rows.

1. Every member is compared with the bucket's first one; what these links connect is
   labelled, and buckets within one component are done.
2. What is left are pairs across components. Buckets of up to ``small`` members list
   them; larger ones are dealt into blocks, and pairs of blocks are compared inside
   tasks, from which only links come out.

Every pair of a bucket is compared or already connected, so components are exact for
the candidates the buckets give.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.llm.frames import components, kept

SMALL = 64
EVERY = "true"


def members_of(each: DataFrame) -> DataFrame:
    """Rows (node, n, key) of the buckets that hold two nodes or more, with size and hub."""
    buckets = each.groupBy("key").agg(F.count("*").alias("size"),
                                      F.min(F.struct("node", "n")).alias("hub")).where("size > 1")
    return kept(each.join(buckets, "key"), "buckets")


def connected(members: DataFrame, confirm: Callable[[DataFrame], DataFrame],
              compare: Callable[[DataFrame], DataFrame], fits: Callable[[str, str], str],
              small: int = SMALL) -> DataFrame:
    """Components (id, component) of the nodes that are linked within buckets.

    ``confirm`` keeps the linked ones of pairs (a, b). ``compare`` finds the links (a, b)
    across components in large buckets (key, node, component, size, and load: the sum of
    the bucket's ``n``). ``fits`` is a condition on two nodes' ``n`` without which they
    cannot be linked.
    """
    stars = (members.where("node <> hub.node and " + fits("n", "hub.n"))
             .select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct())
    links = kept(confirm(stars), "links")
    parts = components(links)
    labelled = members.join(parts.withColumnRenamed("id", "node"), "node", "left").select(
        "key", "node", "n", "size", "hub", F.coalesce("component", "node").alias("component"))
    torn = labelled.groupBy("key").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.sum("n").alias("load")
    ).where("x <> y").select("key", "load")
    open_ = kept(labelled.join(torn, "key"), "open")
    few = open_.where(F.col("size") <= small)
    other = few.select("key", F.col("node").alias("b"), F.col("n").alias("n_b"),
                       F.col("component").alias("component_b"))
    listed = (few.join(other, "key")
              .where("node < b and node <> hub.node and component <> component_b and "
                     + fits("n", "n_b"))
              .select(F.col("node").alias("a"), "b").distinct())
    more = kept(confirm(listed).unionByName(compare(open_.where(F.col("size") > small))), "links")
    return parts if more.isEmpty() else components(links.unionByName(more))


def block_pairs(rows: DataFrame, group: str, columns: list[str],
                blocks: Column) -> DataFrame:
    """Pairs (own_a, own_b) of each group's blocks, a block with itself included.

    ``blocks`` is the number of blocks of a row's group. A block is a list of structs of
    ``columns``, of which the first is the row's key; ``same`` tells whether both are the
    one block.
    """
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(columns[0]), blocks.cast("long")))
    dealt = kept(dealt.groupBy(group, "block").agg(
        F.collect_list(F.struct(*columns)).alias("own")), "blocks")
    left = dealt.select(group, F.col("block").alias("block_a"), F.col("own").alias("own_a"))
    right = dealt.select(group, F.col("block").alias("block_b"), F.col("own").alias("own_b"))
    return left.join(right, group).where("block_a <= block_b").select(
        "own_a", "own_b", (F.col("block_a") == F.col("block_b")).alias("same"))
