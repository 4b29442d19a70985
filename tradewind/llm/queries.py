"""The numbered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.llm import (bpe, codes, embeddings, fingerprint, knn, langid, merkle, minhash, packing,
                           pii, substrings, urls, warc)
from tradewind.llm.frames import table
from tradewind.session import configure, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

URL_RULES = (urls.Rule("allow", "com"), urls.Rule("block", "example.com", "/en/"),
             urls.Rule("allow", "www.example.com", "/en/"), urls.Rule("block", "net", "/es/"),
             urls.Rule("block", "net", "/fr/"))


def query(name: str) -> Callable[[Query], Query]:
    def add(work: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return work(configure(spark), folder)

        QUERIES[name] = run
        return run

    return add


@query("op1_pii")
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digest of the base spans; ``spans`` has the found ones, too."""
    found = pii.personal_data(table(spark, folder, "documents"))
    kinds = F.col("base.kind")
    counts = [F.size(F.array_remove(kinds, kind)).cast("long") for kind in pii.KINDS]
    counts = [(F.size("base") - n).cast("long").alias(f"n_{kind}")
              for n, kind in zip(counts, pii.KINDS)]
    return found.select("doc_id", *counts,
                        F.sha2(pii.in_order(F.col("base")), 256).alias("base_sha256"),
                        pii.in_order(F.concat("base", "found")).alias("spans"))


@query("op2_fingerprints")
def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.compared(table(spark, folder, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        "near_next")


@query("op3_bpe")
def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encoded(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    back = bpe.decoded(ids, path)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("content", 256).alias("decoded_sha256"))


@query("op4_minhash")
def op4_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query("op5_embeddings")
def op5_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


@query("op6_warc")
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    pages = table(spark, folder, "pages")
    warc.write(warc.as_records(pages), path)
    kind = pages.schema["page_id"].dataType
    # Revisits are read by their headers alone; payloads of responses are read and hashed.
    responses = warc.read(spark, path).where(F.col("record_type") == "response")
    revisits = warc.read(spark, path, payload="none").where(F.col("record_type") == "revisit")
    seen = responses.select(
        "record_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2(F.encode("payload", "UTF-8"), 256).alias("payload_digest"),
        "record_type", "refers_to",
    ).unionByName(revisits.select(
        "record_id", "payload_bytes",
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        "record_type", "refers_to"))
    return seen.select(F.col("record_id").cast(kind).alias("page_id"), "payload_bytes",
                       "payload_digest", "record_type", F.col("refers_to").cast(kind)
                       .alias("refers_to"))


@query("op7_language")
def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = langid.trained(documents.where(third != 1))
    found = langid.identified(documents, model)
    return found.select("doc_id", F.coalesce(third == 1, F.lit(False)).alias("held_out"),
                        F.col("lang").alias("lang_pred"), "score", "spans")


@query("op8_url_filter")
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(table(spark, folder, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


@query("op9_substrings")
def op9_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: its passages that an earlier document holds, and whose they are."""
    documents = table(spark, folder, "documents")
    found = substrings.repeats(documents)
    own = documents.select("doc_id", F.xxhash64("text").alias("text_hash"))
    return own.join(found, ["doc_id", "text_hash"], "left").select(
        "doc_id", F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_passages"),
        F.coalesce(F.array_distinct("spans.of"), F.array().cast("array<long>"))
        .alias("repeats_of"),
        F.coalesce(F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(
            ":", s["start"], s["end"], s["of"]))), F.lit("")).alias("passages"))


@query("op10_packing")
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    cut = packing.pieces(table(spark, folder, "documents"),
                         public_tokenizers.path("byte_bpe_50k.json"))
    cut = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.packed(cut)


@query("op11_codes")
def op11_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.compressed(table(spark, folder, "embeddings"))


@query("op12_topk")
def op12_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten rows with the highest inner product, for every hundredth vector."""
    return knn.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op13_manifest")
def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents; a fifth of them is folded from a tampered text."""
    documents = table(spark, folder, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = merkle.leaf(*map(F.col, columns[:-1]), merkle.lowered(F.col("text")))
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    judged = merkle.checked(merkle.manifest(
        documents.withColumn("changed_leaf", F.when(chosen, tampered)), columns, "doc_id", "source"))
    return judged.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                         "verified")
