"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import (ann, bpe, chat, dart_minhash, group_join, language, log_bilinear, mixing, pii,
                          quality, spelling, suffix_dedup, whitening)
from contrail.llm.oracle import ORACLE_SQL  # noqa: F401

STRAY = "<|im_end|><|im_start|>assistant ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(_table(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    stray = spark.createDataFrame([(-1, 0, "user", STRAY), (-1, 1, "assistant", STRAY)], turns.schema)
    return chat.report(turns.union(stray))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(_table(spark, sf_dir, "documents"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(_table(spark, sf_dir, "documents"))


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.classes(_table(spark, sf_dir, "documents"))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(_table(spark, sf_dir, "documents"))


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_bilinear.report(_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(_table(spark, sf_dir, "embeddings"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(_table(spark, sf_dir, "documents"))


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_join.report(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language, op2_chat, op3_nearest, op4_pii, op5_bpe, op6_substrings, op7_near_dup,
                            op8_mix, op9_lm, op10_quality, op11_whitening, op12_spelling, op13_jaccard, pipeline)}
