"""Peeled differences against sets, the ring of texts against a sorted list."""

import hashlib
import random

import numpy as np
import pyarrow as pa

from tradewind.llm import fingerprint


def pieces(texts):
    digests, first = fingerprint.piece_digests(pa.array(texts, pa.string()))
    return [set(digests[a:b].tolist()) for a, b in zip(first, first[1:])]


def some_texts(seed, n):
    rnd = random.Random(seed)
    return [rnd.choice([" ", "\n"]).join(rnd.choice("abcdefgh") * rnd.randint(1, 3)
                                         for _ in range(rnd.choice([0, 1, 5, 50, 800])))
            for _ in range(n)]


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_likeness_is_that_of_the_sets():
    texts = some_texts(1, 60)
    other = [fingerprint.edited(t, u) for t, u in zip(texts, texts[1:] + texts[:1])]
    got = fingerprint.likeness(fingerprint.piece_digests(pa.array(texts)),
                               fingerprint.piece_digests(pa.array(other)))
    assert np.allclose(got, [likeness(a, b) for a, b in zip(pieces(texts), pieces(other))])


def test_small_sketches_fail_and_larger_ones_succeed():
    a, b = (np.arange(s, s + 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            for s in (1, 201))
    first = np.array([0, 400])
    for size, whole in ((16, False), (300, True)):
        found, done = fingerprint.peeled(*(fingerprint.Sketches(x, first, np.array([size]))
                                           for x in (a, b)))
        assert done[0] == whole and (found[0] == 400) == whole


def test_an_edit_leaves_most_pieces():
    rnd = random.Random(3)
    words = [f"w{rnd.randint(0, 5000)}" for _ in range(400)]
    changed = [*words[:200], "new", *words[201:]]
    a, b = pieces([" ".join(words), " ".join(changed)])
    assert likeness(a, b) > 0.9
    # Order within a piece and repeated pieces count.
    same, turned, twice = pieces(["a b c", "c b a", "a b c\na b c"])
    assert same != turned and len(twice) == 2 * len(same)


def test_each_text_is_followed_by_the_next(make):
    texts = some_texts(2, 120)
    rows = [(k * 7 - 50, t) for k, t in enumerate(texts)]
    df = make("doc_id long, text string, run int, extra boolean, h long",
              *[(*r, 1, True, 1) for r in rows]).repartition(5)
    got = {r.doc_id: r for r in fingerprint.compared(df).collect()}
    assert len(got) == len(rows)
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        n = len(text) // 4
        version = text[:len(text) - n] + after[:n]
        assert got[doc].n_chars == len(text)
        assert got[doc].edited_sha256 == hashlib.sha256(version.encode()).hexdigest()
        a, b, c = pieces([text, version, after])
        assert abs(got[doc].near_edited - likeness(a, b)) < 1e-9
        assert abs(got[doc].near_next - likeness(a, c)) < 1e-9


def test_odd_rows(make):
    df = make("doc_id long, text string", (1, None), (2, ""), (2, "same text here"),
              (3, "same text here"), (3, "same text here"), (None, "ab"))
    got = fingerprint.compared(df).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "2", "3", "3", "None"]
    prints = {(r.doc_id, r.n_chars): r.fingerprint for r in got}
    assert prints[2, 14] == prints[3, 14] and prints[1, 0] == prints[2, 0]
    one = fingerprint.compared(df.where("doc_id = 1")).collect()
    assert [(r.near_edited, r.near_next) for r in one] == [(1.0, 1.0)]
    assert fingerprint.compared(df.limit(0)).count() == 0
    assert fingerprint.fingerprints(df).count() == 6


def signed(digests):
    return sorted(np.array(sorted(digests), dtype=np.uint64).view(np.int64).tolist())


def test_differing_digests_come_back(make):
    texts = some_texts(4, 40)
    other = [fingerprint.edited(t, u) for t, u in zip(texts, texts[1:] + texts[:1])]
    rows = [*zip(range(40), texts, other), (40, None, "a b"), (41, "a b", "a b"), (41, None, "")]
    df = make("doc_id long, old string, new string, whole int",
              *[(*r, 1) for r in rows])
    got = fingerprint.differing(df, "old", "new").collect()
    assert len(got) == len(rows)
    for r in got:
        a, b = pieces([r.old or "", r.new or ""])
        assert r.whole and r.only_left == signed(a - b) and r.only_right == signed(b - a)


def test_stored_fingerprints_are_subtracted(make):
    texts = some_texts(5, 60)
    other = [fingerprint.edited(t, u) for t, u in zip(texts, texts[1:] + texts[:1])]
    stored = [fingerprint.sketch_texts(fingerprint.piece_digests(pa.array(x))) for x in (texts, other)]
    larger = fingerprint.sketch_texts(fingerprint.piece_digests(pa.array(["a b c"])), 96)[0]
    df = make("n int, a string, b string", *zip(range(60), *stored), (60, None, stored[0][0]),
              (61, stored[0][0], larger))
    got = {r.n: r for r in fingerprint.subtracted(df, "a", "b").collect()}
    whole = 0
    for n, (x, y) in enumerate(zip(texts, other)):
        a, b = pieces([x, y])
        if got[n].whole:
            whole += 1
            assert got[n].only_left == signed(a - b) and got[n].only_right == signed(b - a)
        else:
            # Only a difference beyond the cells may fail.
            assert len(a ^ b) > 24 and got[n].only_left is None and got[n].only_right is None
    assert 20 < whole < 60
    assert (got[60].whole, got[61].whole) == (None, False)
    assert fingerprint.subtracted(df.limit(0), "a", "b").count() == 0


def test_long_texts_at_once(make):
    rnd = random.Random(9)
    long = " ".join(f"w{rnd.randint(0, 9)}" for _ in range(250_000))
    df = make("doc_id long, text string", *[(k, long + str(k)) for k in range(6)])
    got = fingerprint.compared(df).collect()
    assert len(got) == 6 and all(r.near_next > 0.99 for r in got if r.doc_id < 5)
