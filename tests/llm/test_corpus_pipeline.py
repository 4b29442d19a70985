"""Stages of the pipeline against plain versions."""

import random

import corpus_pipeline
from tradewind.session import stored


def shingles(words):
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def alike(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def documents(make, texts):
    return make("doc_id long, text string, lang string, source string, n_chars long",
                *[(k, t, "en", "s", len(t or "")) for k, t in texts.items()])


def test_near_duplicates_from_eighty_percent_on(spark, make):
    rnd = random.Random(3)
    docs = {}
    for p in range(30):
        own = [f"w{rnd.randint(0, 5000)}" for _ in range(100)]
        other = list(own)
        for at in rnd.sample(range(10, 90, 10), rnd.choice([2, 2, 3])):
            other[at] = f"edit{p}x{at}"
        docs[2 * p], docs[2 * p + 1] = own, other
    linked = {(a, b) for a in docs for b in docs if a < b and alike(docs[a], docs[b]) >= 0.8}
    assert sum(alike(docs[a], docs[b]) < 0.85 for a, b in linked) >= 10
    df = documents(make, {k: " ".join(w) for k, w in docs.items()})
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()}
    assert got == set(docs) - {b for _, b in linked}


def through(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stored(stage(spark, docs, ""), name)
        assert docs.columns == columns, name
    return docs, corpus_pipeline.STAGES[-1][1](spark, docs, "")


LANGUAGES = {"en": "the quick brown fox jumps over the lazy dog and runs away from it",
             "de": "der schnelle braune fuchs springt über den faulen hund und läuft weg"}


def test_odd_rows_through_all_stages(spark, make):
    rnd = random.Random(1)
    words = {k: t.split() for k, t in LANGUAGES.items()}
    text = [" ".join(rnd.choice(words[k]) + str(rnd.randint(0, 99)) for _ in range(40))
            for k in ("en", "de") * 6]
    rows = [(k, t, ("en", "de")[k % 2]) for k, t in enumerate(text)]
    long = " ".join(f"{rnd.choice(words['en'])} w{rnd.randint(0, 10 ** 6)}" for _ in range(100_000))
    rows += [(20, None, "en"), (21, "", "en"), (22, "12 34", None), (3, text[3], "de"),
             (23, text[0], None), (None, "the fox runs over it again", None), (24, long, None)]
    docs = make("doc_id long, text string, lang string, source string, n_chars long, id int, "
                "start long, found_score double",
                *[(k, t, g, "s", len(t or ""), 1, 2, 3.0) for k, t, g in rows])
    last, packed = through(spark, docs)
    kept = {r.doc_id: r for r in last.collect()}
    assert last.count() == len(kept) == 14
    assert set(kept) == {*range(12), None, 24} and kept[24].n_chars == len(kept[24].text)
    assert all(r.lang in LANGUAGES for r in kept.values())
    assert {r.doc_id for r in packed.collect()} == set(kept)


def test_no_rows_and_no_languages(spark, make):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    none = make(schema, (1, None, None, "s", 0), (2, "...", "en", "s", 3))
    assert through(spark, none.limit(0))[1].count() == 0
    assert through(spark, none)[1].count() == 0
    plain = make(schema, (1, "some words", None, "s", 10), (2, "12", None, "s", 2),
                 (3, None, None, "s", 0))
    last, packed = through(spark, plain)
    assert [(r.doc_id, r.lang) for r in last.collect()] == [(1, None)] and packed.count() == 1
