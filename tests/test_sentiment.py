"""Learned sentiment on reviews it has not seen, and its odd rows."""

import random

import numpy as np
import pandas as pd

from tradewind.functions import sentiment

SCHEMA = "review_id long, review_comment_message string, review_score int, word string, weight int"


def written(n, seed):
    """Reviews whose words lean with the score; most words say nothing."""
    rnd, out = random.Random(seed), []
    for k in range(n):
        score = rnd.choice([1, 2, 3, 4, 5])
        words = [f"plain{'abcdefghij'[rnd.randint(0, 9)]}" for _ in range(12)]
        for _ in range(3):
            good = rnd.random() < (score - 0.5) / 5
            words.append(rnd.choice(["Ótimo", "lovely", "рад"] if good else ["ruim", "broken", "плохо"]))
        rnd.shuffle(words)
        out.append((k, rnd.choice([" ", ", ", "! "]).join(words), score, "w", 1))
    return out


def test_held_out_scores_are_ranked(make):
    weights = sentiment.word_weights(make(SCHEMA, *written(1500, 1)))
    by_word = {r.word: float(r.weight) for r in weights.collect()}
    assert min(by_word[w] for w in ("ótimo", "lovely", "рад")) > 0.5
    assert max(by_word[w] for w in ("ruim", "broken", "плохо")) < -0.5
    assert all(abs(v) < 0.4 for w, v in by_word.items() if w.startswith("plain"))
    seen = sentiment.learned_sentiment(make(SCHEMA, *written(800, 2)), weights).toPandas()
    ranks = seen[["review_score", "learned_polarity"]].rank()
    assert np.corrcoef(ranks.T)[0, 1] > 0.6
    assert seen.learned_polarity.between(-1, 1).all()


def test_weights_equal_the_plain_count(make):
    rows = written(300, 3)
    got = {r.word: (r.n_positive, r.n_negative, float(r.weight))
           for r in sentiment.word_weights(make(SCHEMA, *rows)).collect()}
    cells = pd.DataFrame([(w, s >= 4) for _, t, s, _, _ in rows if s != 3
                          for w in set(t.lower().replace(",", "").replace("!", "").split())],
                         columns=["word", "high"])
    p, n = cells.high.sum(), (~cells.high).sum()
    counts = cells.groupby("word").high.agg(["sum", "size"])
    assert set(got) == set(counts[counts["size"] >= 5].index)
    for word, (high, low, weight) in got.items():
        a, size = counts.loc[word]
        assert (high, low) == (a, size - a)
        prior = 10 / (p + n)
        assert abs(weight - np.log((a + prior * p) / p) + np.log((size - a + prior * n) / n)) < 2e-6


def test_odd_rows(make):
    rows = [(k, "fine words", 5, "", 0) for k in range(6)] + [(k, "sad words", 1, "", 0) for k in range(6)]
    weights = sentiment.word_weights(make(SCHEMA, *rows, (9, None, 5, "", 0), (9, "fine", None, "", 0)))
    assert {r.word: (r.n_positive, r.n_negative) for r in weights.collect()} == {
        "fine": (6, 0), "sad": (0, 6), "words": (6, 6)}
    df = make(SCHEMA, (1, "Fine, fine", 1, "", 0), (1, "sad", 1, "", 0), (1, "sad", 1, "", 0),
              (None, "sad words", 1, "", 0), (2, None, 1, "", 0), (2, "", 1, "", 0),
              (3, "unknown", 1, "", 0), (4, "fine " * 200_000, 1, "", 0))
    scored = sentiment.learned_sentiment(df, weights)
    assert scored.columns == [*df.columns, "learned_polarity"]
    got = sorted((r.review_id or 0, len(r.review_comment_message or ""), r.learned_polarity is None,
                  np.sign(r.learned_polarity or 0)) for r in scored.collect())
    assert got == [(0, 9, False, -1), (1, 3, False, -1), (1, 3, False, -1), (1, 10, False, 1),
                   (2, 0, True, 0), (2, 0, True, 0), (3, 7, False, 0), (4, 1_000_000, False, 1)]
    # Only one kind of score, and no rows, teach nothing.
    assert sentiment.word_weights(make(SCHEMA, *rows[:6])).count() == 0
    assert sentiment.word_weights(df.limit(0)).count() == 0
    none = sentiment.learned_sentiment(df.limit(1), weights.limit(0)).first()
    assert none.learned_polarity == 0.0
