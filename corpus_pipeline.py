"""The corpus pipeline: five stages over ``documents``, each one an operator's decision.

Every stage but the last returns the columns it was given, for the rows it
keeps. It drops rows by an anti-join with the ids it rejects, broadcast if they
are few and shuffled otherwise, so texts seldom move. Rows are told apart by
doc_id or, where ids repeat, by a hash of id and text; then "smallest id" among near
duplicates means the smallest hash. Rows with a null id can't be rejected and stay. All stages take null and
empty texts, and an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.base import cut, drop_ids, fold, table
from refrain.llm.bpe import encode_decode
from refrain.llm.decontaminate import contamination
from refrain.llm.exact_dedup import exact_dedup, halves
from refrain.llm.simhash import near_duplicates, simhash_classes
from refrain.llm.toxicity import fit_toxicity, score_toxicity


KEY = "__row"


def rejecting(docs: DataFrame, find: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``docs`` without the rows that ``find(docs, id column)`` gives the ids of."""
    if not docs.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        return drop_ids(docs, find(docs, "doc_id"))
    keyed = docs.withColumn(KEY, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256))))
    return drop_ids(keyed, find(keyed, KEY).select(F.col("doc_id").alias(KEY)), KEY).drop(KEY)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score 0.5 or more; the index learns from the labels, without each fifth."""
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0).select("doc_id", F.col("toxic").alias("label"))
    index = fit_toxicity(docs, labels)
    return rejecting(docs, lambda rows, key: score_toxicity(rows, index, id_col=key).filter("score >= 0.5"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts the row with the largest id. A row repeated with its id stays once."""

    def repeats(rows: DataFrame, key: str) -> DataFrame:
        found = exact_dedup(rows, halves(rows)).filter("NOT kept")
        return found if key == "doc_id" else found.select(F.xxhash64("doc_id", "text_sha256").alias("doc_id"))

    if docs.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        docs = docs.dropDuplicates(["doc_id", "text"])
    return rejecting(docs, repeats)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates the smallest id: of the classes that SimHash
    links, joined where an exact check finds pairs that fingerprints miss (five-word
    shingles, similarity 0.8)."""

    def repeats(rows: DataFrame, key: str) -> DataFrame:
        rows = rows.filter(F.col(key).isNotNull())
        classes = cut(simhash_classes(rows, k=4, t=4, id_col=key).select("doc_id", "component_id"))
        return near_duplicates(rows, k=5, similarity=0.8, linked=classes, id_col=key).filter("doc_id <> component_id")

    return rejecting(docs, repeats)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that share a passage with the benchmark."""
    items = table(spark, sf_dir, "benchmark")
    return rejecting(docs, lambda rows, key: contamination(rows, items, id_col=key))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digest of the decoded text. The tables are smaller
    than the encoder's own bounds: JVMs that ran four stages have less memory to spare."""
    made = encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, max_states=40_000, max_pieces=80_000)
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("simhash_near_dedup", near), ("decontamination", decontamination), ("byte_bpe", tokens)]

#: SQL can't express the toxicity index, fingerprints or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
