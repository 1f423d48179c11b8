"""The corpus pipeline: documents in, token ids out, one written table per stage.

Part of the subpackage ``contrail.llm``; every stage calls one of its operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import bpe, dart_minhash, mixing, pii, quality
from contrail.llm.store import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of smallest id."""
    return dart_minhash.keep_first(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts masked."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids): the token ids of every text, little-endian unsigned 32-bit integers."""
    return bpe.encode(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("mask_pii", mask_pii),
          ("mix_sources", mix_sources), ("encode", encode)]

# Rule accuracies, signatures, span parsing and token ids are not SQL's to express; tests hold
# single operators against brute force, and of the pipeline its columns and ids only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
