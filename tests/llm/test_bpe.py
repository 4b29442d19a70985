"""Encoding against the public library, decoding as an exact round trip."""

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tradewind.llm import bpe, units

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(library, texts):
    for text, tokens in zip(texts, bpe.encoder(PATH, PATTERN).encode(texts)):
        assert np.frombuffer(tokens, "<u4").tolist() == library.encode_ordinary(text), text[:80]


def test_hard_texts(library):
    same(library, [
        "", " ", "\n", "a", " a ", "  a  b\n \n c\t\td  e", "x" * 300, "ab" * 3000,
        "日本語テキスト 한국어 ᲀ ՘ \U000323b0", "a\x1cb \x1c c  \x1d", " ", "\u0085 a",
        "don't I'll 123 ４５ ² ½ !!..  \r\n\r\nx", "<|endoftext|>", "\U0001f600 é"])


def test_random_texts(library):
    rnd = random.Random(3)
    alphabet = [" ", "  ", "\n", "\t", "\x1c", "\u0085", "a", "é", "Ж", "中", "1", "²", "!", "'s",
                "՘", " ", "\U0001f600", "́"]
    same(library, ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
                   for _ in range(3000)])


def test_both_segment_trees_agree():
    ranks, rnd = bpe.ranks_of(PATH), random.Random(5)
    for size in (2, 4, 16, 64):
        words = [bytes(rnd.choice(b"thereinao s") for _ in range(rnd.randint(size // 2 + 1, size)))
                 for _ in range(200)]
        for word, tokens in zip(words, bpe.merge_many(ranks, words, size)):
            assert np.frombuffer(tokens, "<u4").tolist() == bpe.merge_long(ranks, word)


def test_units_are_the_text():
    for text in ("a b\nc", " a", "a ", "\n a  b \n", "a\n\nb", "x"):
        assert "".join(map(units.unit, units.units(text))) == text


def test_kept_units_stay_bounded():
    own = units.Encoder(lambda new: [u.encode() for u in new], limit=50)
    for n in range(40):
        texts = [f"w{n}-{k} same " + "z" * 60 for k in range(20)]
        assert own.encode(texts) == [t.encode() for t in texts]
    assert len(own.young) <= 50 + 2 * 20 + 4


def test_frames(make):
    df = make("doc_id long, text string, ids string, id int, content string",
              (1, "hello wörld", "x", 7, "c"), (1, "hello wörld", "x", 7, "c"), (2, None, "", 1, ""),
              (None, "", "", 1, ""))
    back = bpe.decoded(bpe.encoded(df, PATH, PATTERN), PATH)
    assert back.columns == ["doc_id", "ids", "content"]
    rows = sorted((str(r.doc_id), bytes(r.content).decode(), len(r.ids) > 0) for r in back.collect())
    assert rows == [("1", "hello wörld", True)] * 2 + [("2", "", False), ("None", "", False)]
    assert bpe.encoded(df.limit(0), PATH, PATTERN).count() == 0
