"""Top-k by inner product against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import knn

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, every, k=10):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in good), default=0)
    good = [(i, v + [0] * (width - len(v))) for i, v in good]
    out = set()
    for i in {i for i, _ in good if i is not None and i % every == 0}:
        q = min(v for j, v in good if j == i)
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j is None, j or 0)
                        for j, v in good if j != i)[:k]
        out |= {(i, n + 1, None if no else j, -s) for n, (s, no, j) in enumerate(scored)}
    return sorted(out)


def got(df, every, **more):
    return sorted(map(tuple, knn.nearest(df, F.col("vec_id") % every == 0, **more).collect()))


def clustered(n, width, seed):
    """Tight clusters, one of a third of all rows, copies, and evenly spread vectors."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    rows = []
    for k in range(n):
        c = centres[0] if k % 3 == 0 else centres[k % 6]
        v = rng.normal(size=width) if k % 5 == 0 else c + rng.normal(size=width) * 0.01
        rows.append((v / np.linalg.norm(v) * (1 if k % 4 else 2)).tolist())
    rows[n // 2:n // 2 + 30] = [rows[9]] * 30
    return list(enumerate(rows))


@pytest.mark.parametrize("limits", [{}, {"MOST_QUERIES": 7, "FEWEST_ROWS": 50, "MOST_ROWS": 90,
                                         "_SLICE": 16, "COPY_COST": 1}])
def test_against_all_pairs(make, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(knn, name, value)
    rows = clustered(600, 12, 1)
    assert got(make(SCHEMA, *rows), 9, pivots=20) == plain(rows, 9)


def test_rows_are_left_out():
    """Queries in tight clusters meet their clusters only."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 16))
    x = np.concatenate([c + rng.normal(size=(200, 16)) * 0.01 for c in centres])
    x = np.floor(1024 * x / np.linalg.norm(x, axis=1, keepdims=True))
    m = np.linalg.norm(x, axis=1).max()
    sphere = knn.Sphere(np.empty((0, 17)), m, 16, 1024)
    sphere.pivots = sphere.lifted(x[::200])
    far = sphere.far(sphere.lifted(x))
    near = np.sort(far.reshape(8, 200, 8)[np.arange(8), :, np.arange(8)], axis=1)[:, :10]
    histogram = np.stack([np.bincount(b, minlength=knn.BINS)
                          for b in sphere.bin_of(far, knn.BINS).T])
    q = sphere.far(sphere.scaled(x[5::200]))
    rings = [(c, 0, q[c, c], q[c, c], 1) for c in range(8)]
    groups = knn.groups_of(rings, sphere, near, histogram, 10)
    assert len(groups) == 8 and all(g.rows < 800 for g in groups)


def test_odd_vectors(make):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.0, 0.0]), (2, [1.0, -1.0]), (2, [0.5, 1.0]), (4, None), (6, [nan, 1.0]),
            (8, [1.0, None]), (10, [inf, 0.0]), (12, []), (14, [3.0]), (16, [0.1, 0.2, 0.3]),
            (None, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (3, [-1.0, 0.0004]), (5, [])]
    df = make(SCHEMA, *rows)
    odd = df.selectExpr("*", "1 as query", "2 as id", "'x' as vector", "3 as team")
    assert got(odd, 2) == plain(rows, 2) and got(df, 2, k=3) == plain(rows, 2, 3)
    assert got(df.where("vec_id % 2 = 1"), 2) == got(df.limit(0), 2) == []
    zeros = [(k, [0.0] * 3) for k in range(20)]
    assert got(make(SCHEMA, *zeros), 5) == plain(zeros, 5)
    assert got(make(SCHEMA, (0, [1.0])), 1) == []


def test_large_components(make):
    rows = [(k, [float(2 ** 20 + k % 3), -float(k), 1.0]) for k in range(30)]
    assert got(make(SCHEMA, *rows), 7) == plain(rows, 7)
    with pytest.raises(Exception, match="64 bits"):
        knn.nearest(make(SCHEMA, (0, [1e20])), F.lit(True)).collect()
