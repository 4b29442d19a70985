"""Codes and codebooks against plain loops over all entries."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from tradewind.llm import codes, vectors


def plain_nearest(x, entries):
    far = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in entries]
    return far.index(min(far)), min(far)


def plain(rows, parts=16):
    """rows: (id, vector, label)."""
    good = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not good:
        return []
    size = -(-max(len(v) for _, v, _ in good) // parts)
    cut = []
    for i, v, label in good:
        v = v + [0] * (parts * size - len(v))
        cut.append((i, [v[p * size:(p + 1) * size] for p in range(parts)], label))
    first = sorted(zip(cut, good), key=lambda r: (r[0][0] is None, r[0][0] or 0, r[1][1]))[:64]
    books = [[list(c[1][p]) for c, _ in first] for p in range(parts)]
    for _ in range(2):
        for p in range(parts):
            held = {}
            for _, v, _ in cut:
                held.setdefault(plain_nearest(v[p], books[p])[0], []).append(v[p])
            for e, own in held.items():
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    out = []
    for i, v, label in cut:
        near = [plain_nearest(v[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for e, _ in near), sum(d for _, d in near), label))
    sums = {}
    for _, _, error, label in out:
        sums[label] = sums.get(label, 0) + error
    told = ",".join(str(x) for book in books for e in book for x in e)
    digest = hashlib.sha256(told.encode()).hexdigest()
    return sorted(((i, c, e, sums[label], digest) for i, c, e, label in out), key=str)


def got(df):
    return sorted(map(tuple, codes.compressed(df).collect()), key=str)


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("n, width", [(400, 32), (40, 16), (90, 20)])
def test_against_plain_loops(make, n, width):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(12, width))
    rows = [(k * 31 % n, (centres[k % 12] + rng.normal(size=width) * (k % 3) / 4).tolist(),
             None if k % 7 == 0 else k % 3) for k in range(n)]
    # Coarse values: many entries at equal distance.
    rows += [(n + k, rng.integers(-1, 2, width).astype(float).tolist(), 1) for k in range(40)]
    assert got(make(SCHEMA, *rows)) == plain(rows)


def test_odd_vectors(make):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None, 1), (1, [], 1), (2, [nan] * 4, 1), (3, [inf, 1.0], 2), (4, [1.0, None], 2),
            (5, [1.0, -2.5], 2), (6, [0.25] * 17, None), (6, [0.25] * 17, None), (6, [0.1], None),
            (None, [3.0], 2), (7, [-0.0, 0.001, -0.001], 5)]
    df = make(SCHEMA, *rows)
    assert got(df.selectExpr("*", "1 as id", "'c' as code", "2 as vector", "3 as error")) == plain(rows)
    assert got(make(SCHEMA, (1, [], 1), (2, None, 1))) == plain([(1, [], 1)])
    assert got(df.limit(0)) == [] == got(df.where("vec_id < 1"))


def test_large_components_raise(make):
    with pytest.raises(Exception, match="must stay below"):
        codes.compressed(make(SCHEMA, (1, [1e9], 1))).collect()


def test_masks_hold_the_nearest_entries_and_few_others():
    rng = np.random.default_rng(3)
    book = codes.Book(rng.integers(-300, 300, (64, 4)))
    x = rng.integers(-300, 300, (2000, 4))
    far = ((x[:, None, :] - book.entries[None]) ** 2).sum(axis=2)
    mask = book.candidates(x)
    inside = (mask[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1) == 1
    assert (inside | (far > far.min(axis=1, keepdims=True))).all()
    assert inside.sum(axis=1).mean() < 16
    found, best = book.nearest(x)
    assert (found == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()


def test_codes_give_vectors_back(make):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=32).tolist(), 0) for k in range(60)]
    plain_rows = vectors.plain(make(SCHEMA, *rows), "vec_id", "embedding")
    books = codes.trained(plain_rows, rounds=0)  # each of 60 vectors is an entry
    own = codes.coded(plain_rows, books)
    back = own.select("id", "error", codes.restored(own["code"], books).alias("v")).collect()
    whole = vectors.matrix(pa.array([v for _, v, _ in rows]), 32, 256)
    assert len(back) == 60 and all(r.error == 0 and (whole[r.id] == r.v).all() for r in back)
