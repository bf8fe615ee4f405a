"""From raw documents to packed training sequences.

``STAGES`` in order: quality rules, near-duplicates, personal data, source mixing,
packing. Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltbed.llm import stages
from siltbed.sources.session import staged

STAGES = [
    ("quality_rules", lambda spark, docs, sf_dir: stages.keep_quality(docs)),
    ("near_dedup", lambda spark, docs, sf_dir: stages.keep_one_of_each_near_group(docs)),
    ("mask_pii", lambda spark, docs, sf_dir: stages.mask(docs)),
    ("mix_sources", lambda spark, docs, sf_dir: stages.mix(docs)),
    ("pack", lambda spark, docs, sf_dir: stages.pack(docs)),
]

#: SQL has neither XXH64 nor a tokenizer; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
