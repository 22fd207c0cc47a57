"""The corpus pipeline: documents through five stages of :mod:`chronofeat.llm`.

Each stage works on all rows its predecessor kept and returns the columns of
``documents`` (the last one: the pieces of the packed sequences).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chronofeat.llm.common import materialise
from chronofeat.llm.exact_dedup import drop_exact_duplicates
from chronofeat.llm.ngram_join import drop_near_duplicates
from chronofeat.llm.packing import pack_documents
from chronofeat.llm.quality_rules import drop_low_quality
from chronofeat.llm.secrets import redact_secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail their own rules or whose host is rejected go."""
    return drop_low_quality(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents (five-word shingles, similarity 0.8 or more) the smallest id stays."""
    return drop_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their ids."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup),
          ("secret scan", secret_scan), ("packing", packing)]

#: No SQL: near duplicates are groups reached over links, packing depends on the partitions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{n}")
    return docs
