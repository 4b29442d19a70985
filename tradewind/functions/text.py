"""Numbers from review text. Whole texts, narrow plans, no Python workers.

Scores come from small fixed word lists held in the plan: a text is split once
and its words are looked up in place, so nothing is shuffled or joined back.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.columns import half_up

NO_TEXT = -999

# Polarity and subjectivity of common opinion words.
OPINION_WORDS: dict[tuple[float, float], tuple[str, ...]] = {
    (1.0, 1.0): ("excellent", "perfect", "wonderful", "excelente", "perfeito", "parfait"),
    (0.7, 0.6): ("good", "great", "nice", "bom", "boa", "bien", "gut", "bueno"),
    (0.5, 0.5): ("fast", "quick", "recommend", "love", "super", "rapide", "schnell"),
    (-0.5, 0.5): ("slow", "late", "problem", "damaged", "atrasado", "lent", "tarde"),
    (-0.7, 0.7): ("bad", "poor", "ruim", "mauvais", "schlecht", "malo"),
    (-1.0, 1.0): ("terrible", "awful", "horrible", "worst", "pessimo", "schrecklich"),
}

# Very frequent function words by language code.
STOP_WORDS: dict[str, tuple[str, ...]] = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "ein", "eine", "mit", "von", "zu"),
    "en": ("the", "and", "of", "to", "is", "in", "that", "it", "for", "was", "with"),
    "es": ("el", "los", "las", "y", "una", "por", "con", "para", "del", "como", "que"),
    "fr": ("le", "les", "et", "des", "une", "est", "pour", "dans", "pas", "vous", "du"),
    "pt": ("o", "os", "uma", "não", "com", "muito", "produto", "do", "da", "em", "foi"),
}

# The characters with the Emoji property in Unicode's public emoji data that
# are an emoji by themselves: no digits, no flag letters.
EMOJI_RANGES = (
    (0xA9, 0xA9), (0xAE, 0xAE), (0x203C, 0x203C), (0x2049, 0x2049), (0x2122, 0x2122),
    (0x2139, 0x2139), (0x2194, 0x2199), (0x21A9, 0x21AA), (0x231A, 0x231B), (0x2328, 0x2328),
    (0x23CF, 0x23CF), (0x23E9, 0x23F3), (0x23F8, 0x23FA), (0x24C2, 0x24C2), (0x25AA, 0x25AB),
    (0x25B6, 0x25B6), (0x25C0, 0x25C0), (0x25FB, 0x25FE), (0x2600, 0x2604), (0x260E, 0x260E),
    (0x2611, 0x2611), (0x2614, 0x2615), (0x2618, 0x2618), (0x261D, 0x261D), (0x2620, 0x2620),
    (0x2622, 0x2623), (0x2626, 0x2626), (0x262A, 0x262A), (0x262E, 0x262F), (0x2638, 0x263A),
    (0x2640, 0x2640), (0x2642, 0x2642), (0x2648, 0x2653), (0x265F, 0x2660), (0x2663, 0x2663),
    (0x2665, 0x2666), (0x2668, 0x2668), (0x267B, 0x267B), (0x267E, 0x267F), (0x2692, 0x2697),
    (0x2699, 0x2699), (0x269B, 0x269C), (0x26A0, 0x26A1), (0x26A7, 0x26A7), (0x26AA, 0x26AB),
    (0x26B0, 0x26B1), (0x26BD, 0x26BE), (0x26C4, 0x26C5), (0x26C8, 0x26C8), (0x26CE, 0x26CF),
    (0x26D1, 0x26D1), (0x26D3, 0x26D4), (0x26E9, 0x26EA), (0x26F0, 0x26F5), (0x26F7, 0x26FA),
    (0x26FD, 0x26FD), (0x2702, 0x2702), (0x2705, 0x2705), (0x2708, 0x270D), (0x270F, 0x270F),
    (0x2712, 0x2712), (0x2714, 0x2714), (0x2716, 0x2716), (0x271D, 0x271D), (0x2721, 0x2721),
    (0x2728, 0x2728), (0x2733, 0x2734), (0x2744, 0x2744), (0x2747, 0x2747), (0x274C, 0x274C),
    (0x274E, 0x274E), (0x2753, 0x2755), (0x2757, 0x2757), (0x2763, 0x2764), (0x2795, 0x2797),
    (0x27A1, 0x27A1), (0x27B0, 0x27B0), (0x27BF, 0x27BF), (0x2934, 0x2935), (0x2B05, 0x2B07),
    (0x2B1B, 0x2B1C), (0x2B50, 0x2B50), (0x2B55, 0x2B55), (0x3030, 0x3030), (0x303D, 0x303D),
    (0x3297, 0x3297), (0x3299, 0x3299), (0x1F004, 0x1F004), (0x1F0CF, 0x1F0CF),
    (0x1F170, 0x1F171), (0x1F17E, 0x1F17F), (0x1F18E, 0x1F18E), (0x1F191, 0x1F19A),
    (0x1F201, 0x1F202), (0x1F21A, 0x1F21A), (0x1F22F, 0x1F22F), (0x1F232, 0x1F23A),
    (0x1F250, 0x1F251), (0x1F300, 0x1F321), (0x1F324, 0x1F393), (0x1F396, 0x1F397),
    (0x1F399, 0x1F39B), (0x1F39E, 0x1F3F0), (0x1F3F3, 0x1F3F5), (0x1F3F7, 0x1F4FD),
    (0x1F4FF, 0x1F53D), (0x1F549, 0x1F54E), (0x1F550, 0x1F567), (0x1F56F, 0x1F570),
    (0x1F573, 0x1F57A), (0x1F587, 0x1F587), (0x1F58A, 0x1F58D), (0x1F590, 0x1F590),
    (0x1F595, 0x1F596), (0x1F5A4, 0x1F5A5), (0x1F5A8, 0x1F5A8), (0x1F5B1, 0x1F5B2),
    (0x1F5BC, 0x1F5BC), (0x1F5C2, 0x1F5C4), (0x1F5D1, 0x1F5D3), (0x1F5DC, 0x1F5DE),
    (0x1F5E1, 0x1F5E1), (0x1F5E3, 0x1F5E3), (0x1F5E8, 0x1F5E8), (0x1F5EF, 0x1F5EF),
    (0x1F5F3, 0x1F5F3), (0x1F5FA, 0x1F64F), (0x1F680, 0x1F6C5), (0x1F6CB, 0x1F6D2),
    (0x1F6D5, 0x1F6D7), (0x1F6DC, 0x1F6E5), (0x1F6E9, 0x1F6E9), (0x1F6EB, 0x1F6EC),
    (0x1F6F0, 0x1F6F0), (0x1F6F3, 0x1F6FC), (0x1F7E0, 0x1F7EB), (0x1F7F0, 0x1F7F0),
    (0x1F90C, 0x1F93A), (0x1F93C, 0x1F945), (0x1F947, 0x1F9FF), (0x1FA70, 0x1FA7C),
    (0x1FA80, 0x1FA89), (0x1FA8F, 0x1FAC6), (0x1FACE, 0x1FADC), (0x1FADF, 0x1FAE9),
    (0x1FAF0, 0x1FAF8),
)
EMOJI_CLASS = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in EMOJI_RANGES) + "]"
# Plain letters fail the first half at once and are not tried against every range.
EMOJI_PATTERN = f"[\\x{{A9}}-\\x{{1FAFF}}&&{EMOJI_CLASS}]"

# Everything that is not a letter parts two words.
WORD_BREAK = "[^\\p{L}]+"


def text_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Length in characters and number of words per text column; null counts 0."""
    added: dict[str, Column] = {}
    for c in columns:
        if c in df.columns:
            trimmed = F.regexp_replace(c, "^\\s+|\\s+$", "")
            words = F.when(F.length(trimmed) > 0, F.size(F.split(trimmed, "\\s+")))
            added[f"{c}_length"] = F.coalesce(F.length(c), F.lit(0))
            added[f"{c}_word_count"] = F.coalesce(words, F.lit(0))
    return df.withColumns(added)


def has_text(column: str) -> Column:
    return F.col(column).isNotNull() & (F.length(column) > 0)


def emoji_count(column: str) -> Column:
    return F.regexp_count(F.col(column), F.lit(EMOJI_PATTERN))


def known_words(column: str, vocabularies: Iterable[Sequence[str]]) -> Column:
    """Words of the text that occur in any of the vocabularies, in order."""
    known = sorted({w for words in vocabularies for w in words})
    return F.filter(F.split(F.lower(F.col(column)), WORD_BREAK), lambda w: w.isin(known))


def _hits(tokens: Column, vocabulary: Sequence[str]) -> Column:
    return F.size(F.filter(tokens, lambda w: w.isin(list(vocabulary))))


def review_sentiment(df: DataFrame, column: str) -> DataFrame:
    """Mean polarity and subjectivity of the opinion words of each text, 0 without any."""
    tokens = F.col("_tokens")
    hits = {f"_h{i}": _hits(tokens, v) for i, v in enumerate(OPINION_WORDS.values())}
    counts = [F.col(name) for name in hits]
    total = sum(counts[1:], counts[0])

    def mean(part: int) -> Column:
        weighted = [c * F.lit(score[part]) for c, score in zip(counts, OPINION_WORDS)]
        value = F.try_divide(sum(weighted[1:], weighted[0]), total.cast("double"))
        return F.when(has_text(column), half_up(F.coalesce(value, F.lit(0.0)), 6))

    return (
        df.withColumn("_tokens", known_words(column, OPINION_WORDS.values()))
        .withColumns(hits)
        .withColumns({"sentiment_polarity": mean(0), "sentiment_subjectivity": mean(1)})
        .drop("_tokens", *hits)
    )


def review_language(df: DataFrame, column: str) -> DataFrame:
    """Language whose function words occur most; ties go to the first code by
    name, and a text without any is "unknown"."""
    hits = {f"_l_{code}": _hits(F.col("_tokens"), v) for code, v in STOP_WORDS.items()}
    best = F.greatest(*[F.col(h) for h in hits])
    choice = F.when(best == 0, F.lit("unknown"))
    for code in sorted(STOP_WORDS):
        choice = choice.when(F.col(f"_l_{code}") == best, F.lit(code))
    return (
        df.withColumn("_tokens", known_words(column, STOP_WORDS.values()))
        .withColumns(hits)
        .withColumn("review_language", F.when(has_text(column), choice))
        .drop("_tokens", *hits)
    )


def text_features_nlp(df: DataFrame, column: str = "review_comment_message") -> DataFrame:
    """Sentiment, language and emoji count; -999 where there is no text, language null."""
    scored = review_language(review_sentiment(df, column), column).withColumn(
        "emoji_count", F.when(has_text(column), emoji_count(column))
    )
    return scored.withColumns({
        "sentiment_polarity": F.coalesce("sentiment_polarity", F.lit(float(NO_TEXT))),
        "sentiment_subjectivity": F.coalesce("sentiment_subjectivity", F.lit(float(NO_TEXT))),
        "emoji_count": F.coalesce("emoji_count", F.lit(NO_TEXT)),
    })
