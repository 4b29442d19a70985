"""Vector links against the product of all pairs."""

import numpy as np
import pytest

from tradewind.llm import embeddings


def plain(vectors, threshold=0.95):
    n = len(vectors)
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)
          and any(v) for v in vectors]
    label, links = list(range(n)), [0] * n
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(vectors[i]) == len(vectors[j]):
                a, b = (np.array(vectors[k], float) for k in (i, j))
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    x, y = label[i], label[j]
                    label = [min(x, y) if z in (x, y) else z for z in label]
    return sorted((k, links[k], label[k], label[k] == k) for k in range(n))


@pytest.mark.parametrize("block", [256, 8])
def test_against_all_pairs(make, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 32))
    rows = [(c + rng.normal(size=32) * rng.uniform(0, 0.33)).tolist() for c in centres
            for _ in range(12)]
    rows += [centres[0].tolist()] * 5 + [(centres[0] * 3).tolist()]
    rows += rng.normal(size=(40, 32)).tolist()
    df = make("vec_id long, embedding array<double>", *enumerate(rows))
    got = embeddings.near_duplicates(df)
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_odd_vectors(make):
    nan, inf = float("nan"), float("inf")
    rows = [[1.0, 2.0], [2.0, 4.0], None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [1.0, None],
            [1.0, 2.0, 0.0], [3.0], [5.0], [-5.0], [1e-300, 2e-300], [1e300, 2e300]]
    df = make("vec_id long, embedding array<double>, node int, keys string",
              *[(k, v, 1, "") for k, v in enumerate(rows)])
    got = sorted(map(tuple, embeddings.near_duplicates(df).collect()))
    expected = {0: (3, 0), 1: (3, 0), 12: (3, 0), 13: (3, 0), 9: (1, 9), 10: (1, 9)}
    assert got == [(k, *expected.get(k, (0, k)), expected.get(k, (0, k))[1] == k)
                   for k in range(len(rows))]
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_hadamard_keeps_lengths_and_angles():
    x = np.random.default_rng(0).normal(size=(5, 16))
    y = embeddings.hadamard(x)
    assert np.allclose(x @ x.T, y @ y.T)
    h = embeddings.hadamard(np.eye(4))
    assert np.allclose(np.abs(h), 0.5) and np.allclose(h @ h.T, np.eye(4))


def test_recall_at_the_limit():
    """Pairs just at the threshold meet in a bucket."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = rng.normal(size=x.shape)
    g -= (g * x).sum(axis=1, keepdims=True) * x
    g /= np.linalg.norm(g, axis=1, keepdims=True)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * g
    hashes, tables = embeddings.plan(50_000, 64, 0.95, 2, 1e-6)
    a, b = (embeddings.bucket_keys(v, tables, hashes, 2) for v in (x, y))
    met = np.array([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)])
    assert met.mean() >= 0.999
