"""Queries of the operators that SQL cannot express; tests hold them against plain Python."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.order_minhash import order_minhash
from siltbed.llm.packing import pack_documents
from siltbed.llm.records import round_trip
from siltbed.llm.registry import query, table
from siltbed.llm.simhash import simhash_groups
from siltbed.llm.substring_dedup import remove_repeats
from siltbed.llm.toxicity import toxicity


@query()
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 20-word passages that were there before."""
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query()
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate components of all documents."""
    return simhash_groups(table(spark, sf_dir, "documents"))


@query()
def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash fingerprints of all documents and of their edited texts."""
    return order_minhash(table(spark, sf_dir, "documents"))


@query()
def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token records, written and read back."""
    return round_trip(table(spark, sf_dir, "documents"))


@query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))
