"""From raw documents to packed training sequences.

Five stages, each over all its predecessor kept: documents without a language go, one
document of each group of near-duplicates stays, passages that an earlier document holds
are cut, personal data is masked, and what is left is packed. Every stage's rows are
written as Parquet to the shared folder and read again by the next.

Null and empty texts, and texts without a letter, have no language and go in the first
stage; so an empty table, or one of such texts only, packs into nothing. Rows that repeat
an id and its text stay once; a null id is kept. Columns beyond those of documents are
carried along up to packing. Very long texts are handled whole by every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.llm import langid, minhash, packing, pii, substrings
from tradewind.llm.frames import kept, parted, passing, table
from tradewind.session import configure, stored

# A document is rejected if no language holds this share of its letters.
LEAST_LANGUAGE = 0.25
# Documents are near-duplicates from this similarity of their shingle sets on.
NEAR_PERCENT = 80

# Most stages have no form in SQL; they are tested against plain versions.
ORACLE_SQL = None


def _tidy(spark: SparkSession) -> None:
    """Settings of the stages: shuffle files go with the job that read them, not with the
    driver's next garbage collection."""
    configure(spark).conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def _sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", length).select(*columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; a missing ``lang`` becomes the one found.

    Where no document has a ``lang`` there is nothing to learn from: those with a letter stay.
    """
    _tidy(spark)
    model = langid.trained(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    known = langid.with_language(docs, model).where(
        (F.col("found_lang") != langid.UNKNOWN) & (F.col("found_score") >= LEAST_LANGUAGE))
    return known.withColumn("lang", F.coalesce("lang", "found_lang")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, rows repeated once."""
    _tidy(spark)
    with passing(spark):
        judged = kept(minhash.near_duplicates(docs, percent=NEAR_PERCENT), "judged")
        ids = judged.groupBy(F.col("doc_id").alias("_id")).agg(
            F.max(F.expr("kept or component_id is null")).alias("_stays"),
            F.count("*").alias("_rows"))
        # The texts of ids that stay and do not repeat are not shuffled.
        marked = stored(ids.where("not _stays or _rows > 1"), "marked")
    may, others = parted(docs, F.col("doc_id"), marked, F.col("_id"))
    gone = marked.where("not _stays")
    left = may.join(gone, may["doc_id"].eqNullSafe(gone["_id"]), "left_anti")
    if not marked.where("_stays and _rows > 1").isEmpty():
        left = left.dropDuplicates(["doc_id", "text"])
    return left.unionByName(others)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of earlier ones; those with nothing else go."""
    _tidy(spark)
    with passing(spark):
        found = stored(substrings.repeats(docs), "repeats")
    cut = substrings.without_repeats(docs, found)
    left = cut.where((F.col("n_words_cut") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return _sized(left, docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    _tidy(spark)
    with passing(spark):
        spans = stored(pii.personal_data(docs).where("size(base) + size(found) > 0"), "spans")
    return _sized(pii.masked(docs, spans), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    _tidy(spark)
    pieces = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.packed(pieces.select("doc_id", "piece", "start", "length",
                                        F.crc32("ids").alias("ids_crc32")))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("passages", passages),
          ("personal_data", personal_data), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
