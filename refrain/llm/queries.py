"""The contract queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.base import fold, table
from refrain.llm.bpe import encode_decode
from refrain.llm.decontaminate import contamination
from refrain.llm.exact_dedup import exact_dedup, halves
from refrain.llm.language_id import identify_language, learn_profiles
from refrain.llm.license_scan import license_scan
from refrain.llm.quality import fit_quality, score_quality
from refrain.llm.simhash import simhash_classes
from refrain.llm.substring_dedup import substring_dedup
from refrain.llm.suffix_dedup import suffix_dedup
from refrain.llm.toxicity import fit_toxicity, score_toxicity


def _predicted() -> F.Column:
    return (F.col("score") >= 0.5).cast("int").alias("predicted")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 3) != 1).select("doc_id", F.col("quality").alias("label"))
    return score_quality(docs, fit_quality(docs, labels)).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", _predicted())


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document that shares a passage with the benchmark."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.count(F.lit(1)).alias("n_overlaps"),
        F.max("n_words").alias("longest"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(table(spark, sf_dir, "documents"), window=100, digests=True)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = learn_profiles(docs, fold("doc_id", 5) != 0)
    return identify_language(docs, profiles).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_classes(table(spark, sf_dir, "documents"), k=4, t=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup(docs, halves(docs))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"), window=50, digests=True)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    base = F.transform("places", lambda p: p["label"])
    words = F.transform("places", lambda p: p["word"])
    edited = F.transform("spans", lambda s: s["label"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.array_distinct(base))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(base, edited))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("spans", lambda s: s["similarity"])), F.lit(0.0))).alias("score"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0).select("doc_id", F.col("toxic").alias("label"))
    return score_toxicity(docs, fit_toxicity(docs, labels)).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", _predicted())


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)


QUERIES = {f.__name__: f for f in (op1_quality, op2_decontaminate, op3_suffix_dedup, op4_language, op5_simhash, op6_exact_dedup, op7_substring_dedup, op8_license, op9_toxicity, op10_bpe)}

ORACLE_SQL = {
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
}
