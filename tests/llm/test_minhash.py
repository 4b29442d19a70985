"""Near-duplicates against all pairs, buckets against their definition."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradewind.llm import buckets, frames, minhash
from tradewind.llm.words import shingle_sets, words


def shingles(text):
    own = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\v\f\r":
        own = own.replace(c, " ")
    own = [w for w in own.split(" ") if w]
    if not own:
        return frozenset()
    return frozenset(tuple(own[i:i + 5]) for i in range(max(1, len(own) - 4)))


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    low = {}
    for (doc, _), x in zip(rows, label):
        low[x] = min(low.get(x, doc), doc)
    return sorted((doc, len(s), low[x], doc == low[x])
                  for (doc, _), s, x in zip(rows, sets, label))


def corpus(seed, n):
    rnd = random.Random(seed)
    base = [[f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(1, 120))] for _ in range(n)]
    rows = []
    for k in range(n * 3):
        own = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
            own[rnd.randrange(len(own))] = f"x{rnd.randint(0, 9)}"
        rows.append((k, rnd.choice([" ", "\n", "  "]).join(own).replace("w1", "W1")))
    return rows


def test_words_and_shingles():
    texts = ["A b\tC", None, "", "é  ÉÀ", "one two three four five six", "a b", "x" * 1000]
    w = words(pa.array(texts))
    assert np.diff(w.first).tolist() == [3, 0, 0, 2, 6, 1, 1]
    assert w.hashes[0] == words(pa.array(["a"])).hashes[0]
    values, ends = shingle_sets(w)
    assert np.diff(ends).tolist() == [len(shingles(t)) for t in texts]
    assert len(words(pa.array([None, ""], pa.string())).hashes) == 0
    # A sliced column reads its own texts.
    assert np.diff(words(pa.array(texts).slice(3, 2)).first).tolist() == [2, 6]


def test_against_all_pairs(make):
    rows = corpus(1, 40)
    got = minhash.near_duplicates(make("doc_id long, text string", *rows))
    assert sorted(map(tuple, got.collect())) == plain(rows)


@pytest.mark.parametrize("small", [2, 1000])
def test_large_buckets_lose_no_link(make, small):
    """Many look-alikes around the limit: listed pairs and blocks both find all links."""
    rnd, base = random.Random(7), [f"b{i}" for i in range(60)]
    rows = []
    for k in range(90):
        own = list(base)
        for _ in range(rnd.randint(1, 3)):
            own[rnd.randrange(60)] = f"y{rnd.randint(0, 40)}"
        rows.append((k, " ".join(own)))
    got = minhash.near_duplicates(make("doc_id long, text string", *rows), small=small)
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_odd_rows(make):
    df = make("doc_id long, text string, digest string, n int, key long, kept string",
              (5, "a b c", "", 1, 1, ""), (3, "A b  c", "", 1, 1, ""), (3, "A b  c", "", 1, 1, ""),
              (7, None, "", 1, 1, ""), (8, " \n", "", 1, 1, ""), (None, "q r s t u v", "", 1, 1, ""))
    got = minhash.near_duplicates(df)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        (5, 1, 3, False), (3, 1, 3, True), (3, 1, 3, True), (7, 0, 7, True), (8, 0, 8, True),
        (None, 2, None, False)]))
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_band_keys_hold_minima_and_maxima():
    values = np.arange(1, 50, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    one = minhash.band_keys(values, np.array([0]), 4, 2)
    assert (minhash.band_keys(values[::-1].copy(), np.array([0]), 4, 2) == one).all()
    less = minhash.band_keys(values[:-1], np.array([0]), 4, 2)
    assert one.shape == less.shape == (1, 4)
    assert len(minhash.multipliers(4, 2)) == 4  # half as many as signature values


def test_overlaps():
    rnd = np.random.default_rng(2)
    left, right = ([np.unique(rnd.integers(0, 60, n).astype(np.uint64)) for n in sizes]
                   for sizes in ((5, 30, 1), (40, 2)))
    assert minhash.overlaps(left, right).tolist() == [
        [len(np.intersect1d(a, b)) for b in right] for a in left]


def test_components(spark, monkeypatch):
    monkeypatch.setattr(frames, "LINKS_PER_TASK", 7)
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(300, i) for i in range(301, 340)] + [(5, 5)]
    links += [(rnd.randint(100, 200), rnd.randint(100, 200)) for _ in range(70)]
    low = {}

    def root(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((root(a), root(b)))
            low[b] = a
    got = frames.components(spark.createDataFrame(links, "a long, b long").repartition(5))
    assert dict(got.collect()) == {x: root(x) for x in list(low)}


def test_the_filter_passes_all_its_own(spark):
    rows = spark.range(1000).selectExpr("xxhash64(id) as h")
    own = np.array([r.h for r in rows.collect()], dtype=np.int64).view(np.uint64)
    may = frames.bloom(rows, 1000)
    assert may.may_hold(own).all()
    strangers = np.random.default_rng(1).integers(0, 2**63, 20000, dtype=np.uint64)
    assert may.may_hold(strangers).mean() < 0.02


def test_block_pairs_hold_every_pair_once(spark):
    rows = spark.range(300).selectExpr("1 as g", "id as node", "300 as size")
    pairs = set()
    for r in buckets.block_pairs(rows, "g", ["node"], F.ceil(F.col("size") / 64)).collect():
        for x in r.own_a:
            for y in r.own_b:
                if not r.same or x.node < y.node:
                    pair = (min(x.node, y.node), max(x.node, y.node))
                    assert pair not in pairs
                    pairs.add(pair)
    assert len(pairs) == 300 * 299 // 2
