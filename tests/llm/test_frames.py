"""Tables of a step, and joins that leave most rows where they are."""

import os

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tradewind.llm import pii, substrings
from tradewind.llm.frames import kept, parted, passing
from tradewind.session import shared_root, stored


def scratch(spark):
    folder = f"{shared_root(spark).removeprefix('file://')}/tradewind"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def named(paths):
    return sorted(p.rsplit("-", 1)[0] for p in paths)


@pytest.fixture
def shuffled(spark):
    """Joins of small tables shuffle, too."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def branches(df):
    """The parts of a plan's union."""
    plan = df._jdf.queryExecution().sparkPlan()
    while not plan.nodeName().startswith("Union"):
        plan = plan.children().apply(0)
    return [plan.children().apply(k).toString() for k in range(plan.children().size())]


def test_what_is_kept_goes_with_its_block(spark):
    before = scratch(spark)
    with passing(spark) as around:
        outer = kept(spark.range(3), "outer")
        with passing(spark) as lasting:
            kept(spark.range(1), "inner")
            read = lasting(spark.range(5), "lasting")
        assert named(scratch(spark) - before) == ["lasting", "outer"]
        assert read.count() == 5 and outer.count() == 3
        rest = around(read, "rest")
    assert named(scratch(spark) - before) == ["rest"] and rest.count() == 5
    with pytest.raises(ValueError), passing(spark):
        kept(spark.range(1), "broken")
        raise ValueError
    kept(spark.range(1), "alone")
    assert named(scratch(spark) - before) == ["alone", "rest"]


def test_parted_by_keys(spark, make):
    rows = make("k long, t string", *[(n, "x") for n in range(2000)], (None, "y"), (7, "z"))
    few = make("id long", (7,), (None,), (7,), (5000,))
    may, others = parted(rows, F.col("k"), few, F.col("id"))
    some, rest = ([(r.k, r.t) for r in df.collect()] for df in (may, others))
    assert {(7, "x"), (7, "z"), (None, "y")} <= set(some) and len(some) < 100
    assert sorted(some + rest, key=str) == sorted([(r.k, r.t) for r in rows.collect()], key=str)
    none, every = parted(rows, F.col("k"), few.limit(0), F.col("id"))
    assert none.count() == 0 and every.count() == rows.count()
    # Types whose hashes differ.
    may, others = parted(rows, F.col("k"), make("id int", (7,)), F.col("id"))
    assert may.count() == rows.count() and others.count() == 0


def documents(make, texts):
    return make("doc_id long, text string, lang string, source string, n_chars long",
                *[(k, t, "en", "s", len(t)) for k, t in texts.items()])


def test_stages_shuffle_no_texts_that_stay_and_leave_no_tables(spark, make, shuffled):
    texts = {k: " ".join(f"w{k}x{i}" for i in range(80)) for k in range(40)}
    texts[41] = texts[3]
    texts[42] = "some words first " + " ".join(texts[5].split()[:55])
    texts[43] = "write to a.b@c.org now"
    docs = documents(make, texts)
    tables = {"near_duplicates": ["marked"], "passages": ["repeats", "repeats"],
              "personal_data": ["masked_spans", "spans"]}
    for name, stage in corpus_pipeline.STAGES[1:4]:
        before = scratch(spark)
        rows = stage(spark, docs, "")
        assert named(scratch(spark) - before) == tables[name]
        assert any("Join" not in part for part in branches(rows)), name
        docs = stored(rows, name)
    got = {r.doc_id: r.text for r in docs.collect()}
    expected = {k: t for k, t in texts.items() if k != 41}
    expected[42], expected[43] = "some words first", "write to [EMAIL] now"
    assert got == expected


def test_cuts_and_masks_of_some_rows(spark, make, shuffled):
    df = make("doc_id long, text string, other int", (1, "a b c d", 1), (2, "e f", 2),
              (None, "a b c d", 3), (1, "not that text", 4), (3, None, 5))
    found = df.where("doc_id = 1 and other = 1").select("doc_id", F.xxhash64("text").alias(
        "text_hash"), F.expr("array(named_struct('start', 1, 'end', 3, 'of', 0L))").alias("spans"))
    cut = {r.other: (r.text, r.n_words_cut) for r in substrings.without_repeats(df, found).collect()}
    assert cut == {1: ("a d", 2), 2: ("e f", 0), 3: ("a b c d", 0), 4: ("not that text", 0),
                   5: (None, 0)}
    kind = "array<struct<start:int,end:int,kind:string>>"
    spans = df.where("other in (1, 3)").select("doc_id", F.xxhash64("text").alias("text_hash"), F.expr(
        "array(named_struct('start', 0, 'end', 1, 'kind', 'ip'))").cast(kind).alias("base"),
        F.expr("array()").cast(kind).alias("found"))
    masked = {r.other: r.text for r in pii.masked(df, spans).collect()}
    assert masked == {1: "[IP] b c d", 2: "e f", 3: "[IP] b c d", 4: "not that text", 5: None}
