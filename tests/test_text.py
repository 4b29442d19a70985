from tests.conftest import column
from tradewind.functions import text


def test_lengths_and_words(make):
    df = make("n int, m string", (1, "Hello world"), (2, "\U0001F600 emoji test"), (3, None),
              (4, ""), (5, "  two  words \n"))
    out = text.text_features(df, ["m", "absent"])
    assert column(out, "m_length", "n") == [11, 12, 0, 0, 14]
    assert column(out, "m_word_count", "n") == [2, 3, 0, 0, 2]


def test_emoji_are_counted_by_character(make):
    df = make("n int, m string", (1, "ok"), (2, "\U0001F600\U0001F600 ❤"), (3, "#1 ©"))
    out = df.select("n", text.emoji_count("m").alias("e"))
    assert column(out, "e", "n") == [0, 3, 1]


def test_symbols_and_flag_letters_are_no_emoji(make):
    df = make("n int, m string", (1, "\u2605" * 5), (2, "\u2713 \u2610"), (3, "\U0001F1E7\U0001F1F7"),
              (4, "\U0001F44D\U0001F3FD"), (5, "0 # *"), (6, "\u2714 \u2B50"))
    assert column(df.select("n", text.emoji_count("m").alias("e")), "e", "n") == [0, 0, 0, 2, 0, 2]


def test_sentiment_is_the_mean_of_opinion_words(make):
    df = make("n int, m string", (1, "Great product, EXCELLENT!"), (2, "bad and terrible"),
              (3, "a table"), (4, None))
    out = text.review_sentiment(df, "m")
    assert column(out, "sentiment_polarity", "n") == [0.85, -0.85, 0.0, None]
    assert column(out, "sentiment_subjectivity", "n") == [0.8, 0.85, 0.0, None]


def test_language_by_function_words(make):
    df = make("n int, m string", (1, "the book is on the table"), (2, "der Hund und die Katze"),
              (3, "les amis et le vin"), (4, "el perro y los gatos"), (5, "o produto não chegou"),
              (6, "12345"), (7, ""))
    assert column(text.review_language(df, "m"), "review_language", "n") == [
        "en", "de", "fr", "es", "pt", "unknown", None
    ]


def test_language_looks_at_the_whole_text(make):
    long = "xyz " * 20_000 + "the and of"
    assert column(text.review_language(make("m string", (long,)), "m"), "review_language") == ["en"]


def test_rows_without_text_carry_the_sentinel(make):
    df = make("review_id int, review_comment_message string", (1, "Great product"), (2, None),
              (3, ""))
    out = text.text_features_nlp(df)
    assert column(out, "sentiment_polarity", "review_id") == [0.7, -999.0, -999.0]
    assert column(out, "emoji_count", "review_id") == [0, -999, -999]
    assert column(out, "review_language", "review_id")[1:] == [None, None]


def test_language_against_labelled_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = text.review_language(documents, "text")
    right = found.where("lang = review_language").count()
    assert right >= 0.95 * documents.count()
