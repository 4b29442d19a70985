"""Sentiment learned from review scores, without a word list.

A word's weight is the log of how much more often it stands in reviews with a high score
than in those with a low one. A prior of ``PRIOR`` occurrences, shared out as all words
are, draws the weights of rare words to 0. A review's polarity is the mean weight of its
different known words, drawn into -1..1. Words are counted in the map tasks and weights
are a table, so nothing depends on the size of the vocabulary. Sums are exact decimals.

Defined results: reviews without text or score, or with a middling score, teach nothing.
Without both high and low reviews there are no weights. A text without a known word has
polarity 0, a null or empty text none. Rows that repeat are counted and scored each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.columns import count_where, half_up
from tradewind.functions.text import WORD_BREAK, has_text

PRIOR = 10
HIGH, LOW = 4, 2
# Words in fewer scored reviews have no weight.
LEAST_REVIEWS = 5
WEIGHT = "decimal(18,6)"


def different_words(column: str) -> Column:
    """The lower-case words of a text, each once."""
    words = F.split(F.lower(F.col(column)), WORD_BREAK)
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def word_weights(reviews: DataFrame, column: str = "review_comment_message",
                 score: str = "review_score", prior: float = PRIOR,
                 least_reviews: int = LEAST_REVIEWS) -> DataFrame:
    """word, n_positive, n_negative (reviews that hold it) and weight."""
    scored = reviews.filter(has_text(column) & ((F.col(score) >= HIGH) | (F.col(score) <= LOW)))
    counts = scored.select(
        (F.col(score) >= HIGH).alias("_high"), F.explode(different_words(column)).alias("word")
    ).groupBy("word").agg(
        count_where(F.col("_high")).alias("n_positive"),
        count_where(~F.col("_high")).alias("n_negative"),
    )
    totals = counts.agg(F.sum("n_positive").cast("double").alias("_p"),
                        F.sum("n_negative").cast("double").alias("_n"))
    # One row of totals.
    both = counts.join(F.broadcast(totals), (F.col("_p") > 0) & (F.col("_n") > 0))

    def share(n: str, total: str) -> Column:
        expected = F.lit(float(prior)) * F.col(total) / (F.col("_p") + F.col("_n"))
        return F.log((F.col(n).cast("double") + expected) / F.col(total))

    weight = half_up(share("n_positive", "_p") - share("n_negative", "_n"), 6).cast(WEIGHT)
    return both.filter(F.col("n_positive") + F.col("n_negative") >= least_reviews).select(
        "word", "n_positive", "n_negative", weight.alias("weight"))


def learned_sentiment(reviews: DataFrame, weights: DataFrame, key: str = "review_id",
                      column: str = "review_comment_message") -> DataFrame:
    """``reviews`` with ``learned_polarity``.

    Words of a review go to their weights and back to the review's key; the text itself
    is represented by its hash. A frequent word is split by the skew join.
    """
    keyed = reviews.withColumn("_text", F.xxhash64(column))
    words = keyed.filter(has_text(column)).select(
        F.col(key).alias("_key"), F.col("_text").alias("_of"),
        F.explode(different_words(column)).alias("word"))
    # Rows that repeat add to both parts of their mean alike.
    sums = words.join(weights.select("word", "weight"), "word").groupBy("_key", "_of").agg(
        F.sum("weight").alias("_sum"), F.count("*").alias("_n"))
    mean = F.col("_sum").cast("double") / F.col("_n")
    polarity = half_up(F.coalesce(mean / (F.abs(mean) + 1), F.lit(0.0)), 6)
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_text") == F.col("_of"))
    return keyed.join(sums, same, "left").select(
        *[keyed[f"`{c}`"] for c in reviews.columns],
        F.when(has_text(column), polarity).alias("learned_polarity"))
