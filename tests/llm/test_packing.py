"""Token pieces against the public library, packings against bounds."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tradewind.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_tokens_are_the_librarys(library):
    rnd = random.Random(4)
    alphabet = [" ", "  ", "\n", "\t", "a", "é", "Ж", "中", "1", "²", "!", "'s", "the", " of"]
    texts = ["", "<|endoftext|> x", "a\x1cb", "x" * 200]
    texts += ["".join(rnd.choice(alphabet) for _ in range(40)) for _ in range(800)]
    for text, tokens in zip(texts, packing.encoder(PATH).encode(texts)):
        assert np.frombuffer(tokens, "<u4").tolist() == library(text), text


def test_pieces_and_places(make, library):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice(["the", "of", "zebra"]) for _ in range(n))
             for n in (0, 1, 6, 7, 8, 40, 100, 15, 16)] + [None]
    df = make("doc_id long, text string, ids string, piece int",
              *[(k, t, "", 0) for k, t in enumerate(texts)], (3, texts[3], "", 0))
    cut = packing.pieces(df, PATH, capacity=8).cache()
    rows = cut.collect()
    for k, text in enumerate(texts):
        own = sorted((r for r in rows if r.doc_id == k), key=lambda r: (r.start, r.piece))
        whole = [*library(text or ""), 0]
        own = own[::2] if k == 3 else own
        assert b"".join(bytes(r.ids) for r in own) == np.array(whole, "<u4").tobytes()
        assert [r.piece for r in own] == list(range(len(own)))
        assert all(r.length == 8 for r in own[1:]) and all(r.length == len(r.ids) // 4 for r in own)
        assert [r.start for r in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
    check(packing.packed(cut.drop("ids"), 8).collect(), len(rows), 8)
    assert packing.packed(packing.pieces(df.limit(0), PATH)).count() == 0
    assert zlib.crc32(b"") == 0


def check(rows, n, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    assert len(rows) == n
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("group_size, above", [(40, 1.03), (5000, 1.01)])
def test_nearly_as_few_as_the_bound(spark, group_size, above):
    rnd = np.random.default_rng(8)
    lengths = rnd.integers(1, 100, 3000)
    lengths[::9] = 100
    df = spark.createDataFrame([(int(x), k % 3) for k, x in enumerate(lengths)],
                               "length long, pack_group int")
    used = check(packing.packed(df, 100, group_size).collect(), 3000, 100)
    bound = packing.lower_bound(lengths, 100)
    assert bound <= used <= bound * above + 2


def test_equal_rows_are_spread(spark):
    df = spark.range(5000).selectExpr("7L as doc_id", "30L as length")
    assert check(packing.packed(df, 100, 200).collect(), 5000, 100) <= 5000 // 3 + 20


def test_lower_bounds():
    assert packing.lower_bound(np.array([51] * 7), 100) == 7
    assert packing.lower_bound(np.array([34] * 6), 100) == 3
    assert packing.lower_bound(np.array([100, 1]), 100) == 2
    assert packing.lower_bound(np.array([], int), 100) == 0
    rnd = np.random.default_rng(1)
    for _ in range(200):
        sizes = rnd.integers(1, 21, rnd.integers(1, 9))
        assert packing.lower_bound(sizes, 20) <= fewest(sorted(sizes.tolist(), reverse=True), 20)


def fewest(sizes, capacity, bins=()):
    if not sizes:
        return len(bins)
    size, rest = sizes[0], sizes[1:]
    choices = {b for b in bins if b + size <= capacity}
    found = [fewest(rest, capacity, tuple(sorted([*bins, size])))]
    for b in choices:
        left = list(bins)
        left.remove(b)
        found.append(fewest(rest, capacity, tuple(sorted([*left, b + size]))))
    return min(found)


def test_best_fit():
    bins, offsets, room = packing.best_fit(np.array([3, 7, 5, 5, 2]), 10)
    assert room.tolist() == [0, 0, 8] and bins.tolist() == [0, 0, 1, 1, 2]
    assert offsets.tolist() == [7, 0, 0, 5, 0]


def test_added_tokens_are_one_id_as_the_library_loads_them(make):
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "plain", None,
             "", "<|endoftext|", "the  <|endoftext|>  of"]
    rows = packing.pieces(make("doc_id long, text string", *enumerate(texts)), PATH).collect()
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == [*ids, 0], texts[r.doc_id]
    assert len(rows) == len(texts)
