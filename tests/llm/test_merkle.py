"""Manifests against trees built in plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tradewind.llm import merkle

COLUMNS = ["doc_id", "source", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climbed(nodes):
    """The top of a run of digests and the siblings (before, after) of each."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, k in enumerate(at):
            lo = k // 16 * 16
            paths[leaf].append(("".join(nodes[lo:k]), "".join(nodes[k + 1:lo + 16])))
        nodes = [h(*nodes[k:k + 16]) for k in range(0, len(nodes), 16)]
        at = [k // 16 for k in at]
    return nodes[0], paths


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[name] = own, *climbed([plain_leaf(r) for r in own])
    root, upper = climbed([trees[name][1] for name in names])
    out = []
    for name, more in zip(names, upper):
        own, top, paths = trees[name]
        for row, path in zip(own, paths):
            siblings = "".join(a + b for a, b in path + more)
            out.append((row[0], plain_leaf(row), top, root, h(siblings)))
    return sorted(out, key=str)


def got(df):
    rows = merkle.checked(merkle.manifest(df, COLUMNS, "doc_id", "source")).collect()
    assert all(r.verified and r.folded_root == r.root for r in rows)
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in rows), key=str)


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 16}, {"a": 17, "b": 1}, {"big": 300, "a": 2, None: 33, "": 5, "é": 1},
    {f"s{k}": 1 + k % 3 for k in range(40)}])
def test_against_plain_trees(make, sizes):
    rows, n = [], 0
    for name, size in sizes.items():
        for _ in range(size):
            rows.append((n * 7919 % 1009, name, None if n % 11 == 0 else "tëxt " * (n % 4)))
            n += 1
    df = make("doc_id long, source string, text string", *rows)
    assert got(df) == plain(rows)


def test_odd_rows(make):
    rows = [(1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (None, "a", None), (None, None, ""),
            (2, None, None), (3, "=", "z" * 300_000), (4, "a", "-"), (5, "a", "")]
    df = make("doc_id long, source string, text string", *rows)
    # Columns named like the operator's own do not matter.
    odd = df.selectExpr("*", "1 as part", "2 as n", "3 as at", "'q' as digest", "0 as path")
    assert got(odd) == got(df) == plain(rows)
    assert got(df.limit(0)) == []


def test_lone_row(make):
    row = (7, "a", "x")
    out = merkle.checked(merkle.manifest(
        make("doc_id long, source string, text string", row), COLUMNS, "doc_id", "source")).head()
    assert out.leaf == out.subroot == out.root == plain_leaf(row) and out.proof_sha256 == h()


def test_changed_leaves_are_found(make):
    rows = [(n, "ab"[n % 2], f"Text {n}" if n % 3 else f"text {n}") for n in range(120)]
    df = make("doc_id long, source string, text string", *rows)
    lowered = df.withColumn("changed_leaf", merkle.leaf(
        F.col("doc_id"), F.col("source"), merkle.lowered(F.col("text"))))
    out = merkle.checked(merkle.manifest(lowered, COLUMNS, "doc_id", "source")).collect()
    assert len(out) == 120 and {r.doc_id for r in out if r.verified} == {
        n for n in range(120) if n % 3 == 0}
    assert {(r.doc_id, r.leaf) for r in out} == {(r[0], plain_leaf(r)) for r in rows}


def test_only_ascii_is_lowered(make):
    out = make("t string", ("ÀBÇ Zz",), (None,)).select(merkle.lowered(F.col("t")).alias("t"))
    assert [r.t for r in out.collect()] == ["ÀbÇ zz", None]
