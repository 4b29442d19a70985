"""A Merkle manifest of a table: one tree per group, and one over the groups' tops.

Every row is a leaf: the hash of its columns. Within a group the leaves stand in order of
their key; ``FANOUT`` neighbours at a time have one parent, the hash of their digests.
A level is built by a slot pivot: conditional aggregates spread the children of a parent
into ``FANOUT`` columns, whose concatenation is hashed. The same columns without a
child's own one are its siblings, so proofs need no join with the children: they are read
off the pivoted parents from the top down, and only parents (a sixteenth of the rows)
meet the path above them.

Places within a group come from one range sort over (group, key, leaf) and a count per
range and group, so a group that holds most rows is spread like the rest. Pivots are
keyed by group and parent. Only the root and the depth pass through the driver.

Defined results: a null in any column is hashed as ``-``, so it differs from an empty
text. Rows without a key come first in their group; rows that share a key stand in order
of their leaves, and repeated rows take neighbouring places. Rows without a group are a
group, the first. An empty table gives no rows and has no root. Texts of any length are
hashed whole, inside the task that reads them. Columns that are neither hashed nor named
do not matter, whatever they are called.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tradewind.llm.frames import kept

FANOUT = 16
_ROW_BITS = 33  # monotonically_increasing_id counts rows below these bits
_SLOTS = [f"slot{k}" for k in range(FANOUT)]
_PATH = "array<struct<before: string, after: string>>"


def _joined(slots: list[str]) -> str:
    return f"concat_ws('', {', '.join(f'{name}.digest' for name in slots)})"


# A parent's children: place, child, and the siblings on both sides.
_CHILDREN = "filter(array({}), c -> c.child is not null)".format(", ".join(
    f"struct({k}L as slot, {name} as child, struct({_joined(_SLOTS[:k])} as before, "
    f"{_joined(_SLOTS[k + 1:])} as after) as step)" for k, name in enumerate(_SLOTS)
).replace("concat_ws('', )", "''"))


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, one after the other; nulls are left out."""
    return F.sha2(F.concat_ws("", *parts).cast("binary"), 256)


def told(column: Column) -> Column:
    """A value with its UTF-8 length in front, so that neighbours cannot be confused."""
    text = column.cast("string")
    return F.when(column.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*columns: Column) -> Column:
    return digest(*map(told, columns))


def lowered(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, from the leaf's run to the root's, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, p: digest(p["before"], node, p["after"]))


@dataclass
class Tree:
    """Pivoted levels from the leaves up, and the top of each group."""

    levels: list[DataFrame]  # part, n (children of the group), at, and a column per slot
    lone: DataFrame          # part, child: leaves that are alone in their group
    tops: DataFrame          # part, top


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows (part, ...) with their place ``at`` within the part and its size ``n``."""
    keys = ["part", *order]
    sorted_ = kept(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .withColumn("_row", F.monotonically_increasing_id()), "placed")
    sorted_ = sorted_.withColumn("_range", F.shiftright("_row", _ROW_BITS))
    # One row per range and part: few, whatever the size of a part.
    runs = sorted_.groupBy("part", "_range").agg(F.min("_row").alias("_first"),
                                                 F.count("*").alias("_n"))
    of_part = W.partitionBy("part")
    earlier = of_part.orderBy("_range").rowsBetween(W.unboundedPreceding, W.currentRow)
    runs = runs.select("part", "_range", F.sum("_n").over(of_part).alias("n"),
                       (F.sum("_n").over(earlier) - F.col("_n") - F.col("_first")).alias("_shift"))
    return (sorted_.join(runs, ["part", "_range"])
            .withColumn("at", F.col("_row") + F.col("_shift")).drop("_row", "_range", "_shift"))


def grown(nodes: DataFrame) -> Tree:
    """The trees over nodes (part, n, at, child), child a struct that has a ``digest``."""
    nodes = kept(nodes, "nodes")
    lone = nodes.where("n = 1").select("part", "child")
    largest = nodes.agg(F.max("n").alias("n")).head()["n"] or 0
    levels, tops = [], [lone.select("part", F.col("child.digest").alias("top"))]
    while largest > 1:
        level = kept(nodes.where("n > 1").groupBy(
            "part", "n", F.floor(F.col("at") / FANOUT).alias("at")).agg(*(
                F.expr(f"max(child) filter (where at % {FANOUT} = {k})").alias(name)
                for k, name in enumerate(_SLOTS))), "level")
        levels.append(level)
        whole = F.expr(f"sha2(cast({_joined(_SLOTS)} as binary), 256)")
        nodes = level.select("part", F.ceil(F.col("n") / FANOUT).alias("n"), "at",
                             F.struct(whole.alias("digest")).alias("child"))
        tops.append(nodes.where("n = 1").select("part", F.col("child.digest").alias("top")))
        largest = -(-largest // FANOUT)
    whole = tops[0]
    for more in tops[1:]:
        whole = whole.unionByName(more)
    return Tree(levels, lone, kept(whole, "tops"))


def proven(tree: Tree, above: DataFrame) -> DataFrame:
    """Every leaf's ``child`` with its path; ``above`` (part, path, ...) continues each part's."""
    extra = [c for c in above.columns if c not in ("part", "path")]
    below = None
    for level in reversed(tree.levels):
        parents = level.where(F.col("n") <= FANOUT).join(above, "part")
        if below is not None:
            more = level.where(F.col("n") > FANOUT).join(below, ["part", "at"])
            parents = parents.unionByName(more)
        below = parents.select("part", "at", "path", *extra, F.expr(f"explode({_CHILDREN})").alias("c")).select(
            "part", (F.col("at") * FANOUT + F.col("c.slot")).alias("at"),
            F.concat(F.array("c.step"), "path").cast(_PATH).alias("path"), *extra,
            F.col("c.child").alias("child"))
        if level is not tree.levels[0]:
            below = below.drop("child")
    alone = tree.lone.join(above, "part").select("part", "path", *extra, "child")
    return alone if below is None else below.drop("at").unionByName(alone)


def manifest(df: DataFrame, columns: Sequence[str], id_col: str, group_col: str) -> DataFrame:
    """id, leaf, subroot, root and path of every row, its leaf over ``columns`` in order.

    A column ``changed_leaf``, if ``df`` has one, comes along: a digest to be folded in
    the leaf's place.
    """
    part = F.when(F.col(group_col).isNull(), "").otherwise(
        F.concat(F.lit("="), F.col(group_col).cast("string")))
    other = F.col("changed_leaf") if "changed_leaf" in df.columns else F.lit(None).cast("string")
    rows = kept(df.select(part.alias("part"), F.col(id_col).alias("id"),
                          leaf(*map(F.col, columns)).alias("digest"), other.alias("other")),
                "leaves")
    nodes = placed(rows, ["id", "digest"]).select(
        "part", "n", "at", F.struct("digest", "id", "other").alias("child"))
    tree = grown(nodes)
    # The parts are the leaves of the last tree, in the order of their names.
    tops = tree.tops.select(F.lit("").alias("part"), F.col("part").alias("of"),
                            F.col("top").alias("digest"))
    last = grown(placed(tops, ["of"]).select(
        "part", "n", "at", F.struct("digest", "of").alias("child")))
    head = last.tops.head()
    root = head["top"] if head else None
    start = last.tops.select("part", F.array().cast(_PATH).alias("path"))
    above = kept(proven(last, start).select(
        F.col("child.of").alias("part"), "path", F.col("child.digest").alias("subroot")), "above")
    return proven(tree, above).select(
        F.col("child.id").alias(id_col), F.col("child.digest").alias("leaf"), "subroot",
        F.lit(root).cast("string").alias("root"), "path",
        F.col("child.other").alias("changed_leaf"))


def checked(rows: DataFrame) -> DataFrame:
    """The proof's digest, the root folded from each (changed) leaf, and whether it holds."""
    start = F.coalesce("changed_leaf", "leaf")
    told_ = rows.withColumn("proof_sha256", proof_digest(F.col("path"))).withColumn(
        "folded_root", folded(start, F.col("path")))
    return told_.withColumn("verified", F.col("folded_root") == F.col("root"))
