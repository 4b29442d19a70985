"""Viterbi against the plain recursion, predictions on held-out rows."""

import numpy as np
from pyspark.sql import functions as F

from tradewind.llm import langid
from tradewind.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def plain(scores, text, penalty):
    out = np.zeros(scores.shape[1], int)
    for t in np.unique(text):
        words, value, came = np.flatnonzero(text == t), np.zeros(len(scores)), []
        for i in words:
            top, best = value.max() - penalty, value.argmax()
            came.append(np.where(value >= top, np.arange(len(value)), best))
            value = np.where(value >= top, value, top) + scores[:, i]
        state = value.argmax()
        for i, back in zip(words[::-1], came[::-1]):
            out[i] = state
            state = back[state]
    return out


def test_segments_give_the_plain_path():
    rng = np.random.default_rng(0)
    for _ in range(25):
        n = rng.integers(1, 300)
        scores, text = rng.normal(0, 3, (3, n)), np.sort(rng.integers(0, 6, n))
        for segment in (1, 7, 128):
            assert (langid.labels(scores, text, 4.0, segment) == plain(scores, text, 4.0)).all()


def test_words_and_scripts():
    g = langid.grams(["Ab é1c", None, "да 東京"], 1 << 10)
    assert g.text.tolist() == [0, 0, 0, 2, 2]
    assert list(zip(g.start.tolist(), g.end.tolist())) == [(0, 2), (3, 4), (5, 6), (0, 2), (3, 5)]
    assert [langid.NAMES[k] for k in g.script] == ["Latin"] * 3 + ["Cyrillic", "Han"]
    upper, lower = (langid.grams([t], 1 << 10).bucket.tolist() for t in ("ÀB", "àb"))
    assert upper == lower


def test_spans_of_mixed_text(make):
    train = make("text string, lang string",
                 *[("the quick brown fox jumps over the lazy dog and runs", "en")] * 3,
                 *[("der schnelle braune fuchs springt über den faulen hund", "de")] * 3,
                 *[("быстрая лиса прыгает", "ru")] * 2, (None, "en"), ("und", None))
    model = langid.trained(train)
    assert model.languages == ["de", "en", "ru"]
    text = "the quick dog runs over the fox. der faule hund springt über den braunen fuchs"
    df = make("doc_id long, text string, lang string, score double, id int",
              (1, text, "x", 0.0, 1), (2, "лиса", "x", 0.0, 1), (3, None, "x", 0.0, 1),
              (4, "12 --", "x", 0.0, 1), (4, "12 --", "x", 0.0, 1), (None, "the dog", "x", 0.0, 1))
    got = {}
    for r in langid.identified(df, model).collect():
        got.setdefault(r.doc_id, []).append(r)
    spans = [(s.lang, text[s.start:s.end]) for s in got[1][0].spans]
    assert spans == [("en", "the quick dog runs over the fox"),
                     ("de", "der faule hund springt über den braunen fuchs")]
    assert got[2][0].lang == "ru" and got[None][0].lang == "en"
    assert [(r.lang, r.score, r.spans) for r in got[3] + got[4]] == [("und", 0.0, [])] * 3
    kept = langid.with_language(df, model)
    assert kept.columns == [*df.columns, "found_lang", "found_score"] and kept.count() == 6


def test_nothing_to_learn_from(make):
    df = make("doc_id long, text string, lang string", (1, "abc", None))
    model = langid.trained(df)
    assert [(r.lang, r.score) for r in langid.identified(df, model).collect()] == [("und", 0.0)]
    assert langid.identified(df.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op7_language"](spark, FOLDER)
    row = found.join(truth, "doc_id").where("held_out").agg(
        F.count("*").alias("n"), F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))
        .alias("right"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert row.n > 250 and row.right >= 0.97 and 0 <= row.low <= row.high <= 1


def test_ways_in_small_blocks_give_the_plain_path(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(langid, "WAY_NUMBERS", 40)
    for _ in range(15):
        n = rng.integers(50, 400)
        scores, text = rng.normal(0, 3, (3, n)), np.sort(rng.integers(0, 5, n))
        assert (langid.labels(scores, text, 4.0, 6) == plain(scores, text, 4.0)).all()


def test_any_number_of_languages(make):
    rng = np.random.default_rng(2)
    scores, text = rng.normal(0, 3, (200, 300)), np.sort(rng.integers(0, 3, 300))
    assert (langid.labels(scores, text, 4.0, 16) == plain(scores, text, 4.0)).all()
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = {f"l{i:03}": " ".join(letters[i // 26 + j] + letters[i % 26] + letters[j]
                                 for j in range(6)) for i in range(150)}
    model = langid.trained(make("text string, lang string", *[(t, k) for k, t in word.items()]))
    assert model.languages == sorted(word)
    df = make("doc_id long, text string", *[(i, t) for i, t in enumerate(word.values())])
    got = langid.identified(df, model).orderBy("doc_id").collect()
    assert sum(r.lang == k for r, k in zip(got, word)) >= 148


def test_marks_begin_no_word(make):
    g = langid.grams(["\u0301 a\u0301b \u0301\u0302c", "\u0301"], 1 << 10)
    assert list(zip(g.text.tolist(), g.start.tolist(), g.end.tolist())) == [(0, 2, 5), (0, 8, 9)]
    model = langid.trained(make("text string, lang string", ("some words", "en")))
    df = make("doc_id long, text string", (1, "12 \u0301\u0301"), (2, "x\u0301"))
    assert {r.doc_id: (r.lang, r.score > 0) for r in langid.identified(df, model).collect()} == {
        1: ("und", False), 2: ("en", True)}


def test_a_very_long_text(make):
    model = langid.trained(make("text string, lang string", *[("the quick fox", "en")] * 2,
                                *[("der faule hund", "de")] * 2))
    df = make("doc_id long, text string", (1, "the fox " * 120_000 + "der hund " * 40_000))
    [row] = langid.identified(df, model).collect()
    assert row.lang == "en" and [s.lang for s in row.spans] == ["en", "de"]
    assert row.spans[0].end == 8 * 120_000 - 1
