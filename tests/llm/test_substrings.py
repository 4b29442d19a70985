"""Compact windows against their definition, planted passages, cuts."""

import random

import numpy as np

from tradewind.llm import substrings


def test_compact_windows():
    rng = np.random.default_rng(1)
    for trial in range(150):
        lengths = rng.integers(0, 60, rng.integers(1, 5))
        width = int(rng.integers(2, 12))
        values = rng.integers(1, 30 if trial % 2 else 2**60, lengths.sum()).astype(np.uint64)
        starts = np.r_[0, np.cumsum(lengths)]
        expected = set()
        for a, b in zip(starts[:-1], starts[1:]):
            for i in range(a, b):
                x = y = i
                while x - 1 >= a and values[x - 1] > values[i]:
                    x -= 1
                while y + 1 < b and values[y + 1] >= values[i]:
                    y += 1
                if y - x + 1 >= width:
                    expected.add((i, x, y))
        got = substrings.compact_windows(values, starts, width)
        assert set(zip(*(x.tolist() for x in got))) == expected


def corpus(seed):
    rnd = random.Random(seed)

    def fresh(n):
        return [f"w{rnd.randint(0, 3000)}" for _ in range(n)]

    docs = {k: fresh(rnd.randint(1, 400)) for k in range(60)}
    planted = []
    for p in range(20):
        passage = [f"p{p}x{i}" for i in range(rnd.randint(50, 90))]
        holders = sorted({3 * p, rnd.randrange(60), rnd.randrange(60)})
        for k in holders:
            at = rnd.choice([0, len(docs[k])])
            docs[k][at:at] = passage
        planted += [(k, passage) for k in holders[1:]]
    return docs, planted


def test_planted_passages_are_found_and_others_are_not(make):
    docs, planted = corpus(5)
    df = make("doc_id long, text string, id int, key long, spans string",
              *[(k, " ".join(w), 0, 0, "") for k, w in docs.items()])
    found = substrings.repeats(df)
    got = {r.doc_id: r.spans for r in found.collect()}
    for k, passage in planted:
        at = next(i for i in range(len(docs[k])) if docs[k][i:i + len(passage)] == passage)
        covered = set()
        for s in got.get(k, []):
            assert s.of < k
            covered |= set(range(s.start, s.end))
        assert set(range(at, at + len(passage))) <= covered
    assert set(got) == {k for k, _ in planted}
    cut = {r.doc_id: r for r in substrings.without_repeats(df, found).collect()}
    for k, words in docs.items():
        mine = {w for p, passage in planted if p == k for w in passage}
        assert cut[k].text.split() == [w for w in words if w not in mine]
        assert cut[k].n_words_cut == len(words) - len(cut[k].text.split())


def test_near_passages_and_copies(make):
    rnd = random.Random(9)
    passage = [f"q{i}" for i in range(100)]
    near = [*passage[:40], "other", *passage[41:70], "more", *passage[70:]]
    rows = [(1, " ".join([*(f"a{i}" for i in range(30)), *passage])),
            (2, " ".join([*near, *(f"b{i}" for i in range(30))])),
            (3, "\n".join(passage)), (3, "\n".join(passage)), (4, None), (5, ""), (6, "short text"),
            (None, " ".join(passage)), (8, " ".join(passage[:49])),
            (9, " ".join(f"line {rnd.randint(0, 3)}" for _ in range(300)))]
    df = make("doc_id long, text string", *rows)
    got = {r.doc_id: [(s.start, s.end, s.of) for s in r.spans] for r in substrings.repeats(df).collect()}
    assert got[2] == [(0, 101, 1)] and got[3] == [(0, 100, 1)] and set(got) == {2, 3}
    cut = substrings.without_repeats(df, substrings.repeats(df)).collect()
    assert len(cut) == len(rows)
    assert {(r.doc_id, r.text) for r in cut if r.n_words_cut == 0 and r.doc_id in (4, 5, 6)} == {
        (4, None), (5, ""), (6, "short text")}
    assert substrings.repeats(df.limit(0)).count() == 0


def test_a_passage_in_every_document(make):
    """One signature for all of them, told once per batch."""
    passage = " ".join(f"c{i}" for i in range(60))
    rows = [(k, f"{passage} " + " ".join(f"d{k}x{i}" for i in range(20))) for k in range(300)]
    df = make("doc_id long, text string", *rows).repartition(8)
    got = substrings.repeats(df).collect()
    assert len(got) == 299 and all((r.spans[0].start, r.spans[0].end) == (0, 60) for r in got)


def planted_in(make, groups):
    """Frame of texts that hold the given passages in order, groups apart; ids by trial."""
    rnd = random.Random(12)
    rows = []
    for trial, passages in enumerate(groups):
        for k, passage in enumerate(passages):
            before, after = ([f"f{rnd.random()}" for _ in range(rnd.randint(0, 30))] for _ in "ab")
            rows.append((10 * trial + k, before, passage, after))
    df = make("doc_id long, text string", *[(k, " ".join([*a, *p, *b])) for k, a, p, b in rows])
    places = {k: (len(a), len(a) + len(p)) for k, a, p, _ in rows}
    return df.repartition(8), places


def missed(found, places, wanted):
    """Pairs (later, earlier) of which no span covers the whole passage of the later one."""
    got = {r.doc_id: r.spans for r in found.collect()}
    return [(k, of) for k, of in wanted if not any(
        s.of == of and s.start <= places[k][0] and s.end >= places[k][1] for s in got.get(k, []))]


def test_repeats_of_later_documents_whose_first_holder_shares_less(make):
    groups = []
    for t in range(100):
        p = [f"s{t}x{i}" for i in range(60)]
        groups.append([p[:45], p[15:], p[8:53], p, p])
    df, places = planted_in(make, groups)
    found = substrings.repeats(df)
    assert missed(found, places, [(10 * t + 4, 10 * t + 3) for t in range(100)]) == []
    assert {r.doc_id for r in found.collect()} == {10 * t + 4 for t in range(100)}


def shares(a, b):
    a, b = ({tuple(x[i:i + 5]) for i in range(len(x) - 4)} for x in (a, b))
    return len(a & b) / len(a | b)


def edited(rnd, passage, t, edits):
    out = list(passage)
    for n in range(edits):
        at = (n + 1) * len(out) // (edits + 1) + rnd.randint(-3, 3)
        out[at:at + rnd.choice([0, 1, 1])] = rnd.choice([[], [f"e{t}x{n}"], [f"e{t}x{n}"]])
    return out


def test_edited_passages(make):
    rnd = random.Random(7)
    groups = []
    while len(groups) < 300:
        t = len(groups)
        long = t % 3 == 0
        p = [f"n{t}x{i}" for i in range(rnd.randint(92, 110) if long else rnd.randint(50, 70))]
        q = edited(rnd, p, t, 2 if long else 1)
        if q != p and len(q) >= 50 and shares(p, q) >= 0.8:
            groups.append([p, q])
    df, places = planted_in(make, groups)
    assert missed(substrings.repeats(df), places, [(10 * t + 1, 10 * t) for t in range(300)]) == []


def test_edited_passages_whose_first_holder_shares_less(make):
    groups = []
    for t in range(60):
        p = [f"r{t}x{i}" for i in range(60)]
        groups.append([p[:45], p, [*p[:30], "other", *p[30 + t % 2:]]])
    df, places = planted_in(make, groups)
    found = substrings.repeats(df)
    assert missed(found, places, [(10 * t + 2, 10 * t + 1) for t in range(60)]) == []


def test_edits_of_one_to_four_words_with_halves_quoted_before(make):
    """Every edit that leaves 0.8 of the shingles, alone and after quotes of both halves."""
    rnd, groups, wanted = random.Random(3), [], []
    while len(groups) < 300:
        t, n, size = len(groups), rnd.randint(90, 160), rnd.randint(1, 4)
        p = [f"e{t}x{i}" for i in range(n)]
        at, kind = rnd.randint(20, n - 20), rnd.choice(["insert", "delete", "replace"])
        new = [] if kind == "delete" else [f"new{t}x{i}" for i in range(size)]
        q = [*p[:at], *new, *p[at if kind == "insert" else at + size:]]
        if shares(p, q) < 0.8 or len(q) < 50:
            continue
        quotes = [p[:45], p[-45:]] if t % 2 else []
        groups.append([*quotes, p, q])
        wanted.append((10 * t + len(quotes) + 1, 10 * t + len(quotes)))
    df, places = planted_in(make, groups)
    assert len(missed(substrings.repeats(df), places, wanted)) <= 3


def all_passages(a, b, least=50, percent=80):
    """Words of ``b`` in passages that share enough with one of ``a``: every pair of stretches
    of ``least`` words, without hashes, windows or seeds."""
    covered = set()
    sets = [({tuple(x[i + k:i + k + 5]) for k in range(least - 4)}, i)
            for x in (a,) for i in range(len(a) - least + 1)]
    for j in range(len(b) - least + 1):
        own = {tuple(b[j + k:j + k + 5]) for k in range(least - 4)}
        if any(100 * len(own & s) >= percent * len(own | s) for s, _ in sets):
            covered |= set(range(j, j + least))
    return covered


def test_against_all_pairs_of_passages(make):
    """Documents of common lines, quotes and edited quotes, each against all earlier ones."""
    rnd = random.Random(21)
    line = [f"line{i}" for i in range(25)]
    shared = [[f"s{k}x{i}" for i in range(70)] for k in range(4)]
    docs = []
    for d in range(36):
        words = [f"u{d}x{i}" for i in range(rnd.randint(10, 40))] + line
        if d % 3 == 0:
            quote = list(shared[rnd.randrange(4)])
            if d % 2:
                quote[rnd.randint(25, 45)] = f"edit{d}"
            words += quote[:rnd.choice([40, 60, 70])]
        docs.append(words + [f"v{d}x{i}" for i in range(rnd.randint(5, 40))])
    df = make("doc_id long, text string", *enumerate(" ".join(d) for d in docs)).repartition(5)
    got = {r.doc_id: r.spans for r in substrings.repeats(df).collect()}
    for d, words in enumerate(docs):
        plain = set().union(*(all_passages(docs[e], words) for e in range(d)))
        spans = got.get(d, [])
        assert bool(plain) == bool(spans)
        # Passages end with equal words; stretches of a fixed length reach a little beyond.
        assert len(plain - {w for s in spans for w in range(s.start, s.end)}) <= 20
        for s in spans:
            own, other = words[s.start:s.end], docs[s.of]
            assert s.of < d and max(
                shares(own, other[at:at + n]) for n in range(len(own) - 8, len(own) + 9)
                for at in range(len(other) - 49) if other[at] == own[0]) >= 0.8


def test_a_passage_twice_in_one_document(make):
    words = [f"t{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "x", "y", *words]))]
    for parts in (1, 2):
        df = make("doc_id long, text string", *rows).repartition(parts, "doc_id")
        got = substrings.repeats(df).collect()
        assert [(r.doc_id, [(s.start, s.end, s.of) for s in r.spans]) for r in got] == [
            (2, [(0, 60, 1), (62, 122, 1)])]


def test_rows_that_share_an_id(make):
    words = [f"t{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, "other text"), (2, " ".join(["a", *words])),
            (2, " ".join(["b", "c", *words])), (3, " ".join(words)), (3, " ".join(words))]
    df = make("doc_id long, text string", *rows)
    got = substrings.repeats(df).collect()
    assert {r.doc_id for r in got} - {2} == {3} and len(got) <= 3
    assert substrings.without_repeats(df, substrings.repeats(df)).count() == len(rows)


def test_long_texts(make):
    rnd = random.Random(4)
    passage = " ".join(f"z{i}" for i in range(80))
    long = " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(200_000))
    same = " ".join(["same words again and again"] * 20_000)
    rows = [(1, f"{long} {passage}"), (2, f"x {passage} y"), (3, same), (4, same), (5, f"{passage} {long}")]
    got = {r.doc_id: r.spans for r in substrings.repeats(make("doc_id long, text string", *rows)).collect()}
    assert [(s.start, s.end, s.of) for s in got[2]] == [(1, 81, 1)] and set(got) >= {2, 4, 5}
    assert max(s.end - s.start for s in got[5]) >= 200_000
    assert max(s.end for s in got[4]) - min(s.start for s in got[4]) == 100_000


def test_common_windows():
    """Every subsequence is in one common window, whose key tells all its least hashes."""
    rng = np.random.default_rng(6)
    for trial in range(12):
        values = rng.integers(1, 8 if trial % 3 == 0 else 2**60, 60).astype(np.uint64)
        starts, width = np.array([0, 25, 60]), 6
        each = [substrings.Windows.of(values, starts, width, f) for f in range(3)]
        found = each[0].intersected(each[1], width).intersected(each[2], width)
        keys = {}
        for a, b in zip(starts[:-1], starts[1:]):
            for i in range(a, b - width + 1):
                for j in range(i + width - 1, b):
                    inside = np.flatnonzero((found.left <= i) & (i <= found.low)
                                            & (found.high <= j) & (j <= found.right))
                    assert len(inside) == 1
                    least = tuple(int(substrings.mixed(values[i:j + 1] * substrings._FACTORS[f]).min())
                                  for f in range(3))
                    assert keys.setdefault(int(found.key[inside[0]]), least) == least
        assert len(set(keys.values())) == len(keys)
