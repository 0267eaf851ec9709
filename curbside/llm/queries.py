"""The registered queries of the operators, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from curbside.llm import (
    centroids, fingerprints, language_id, line_dedup, packing, pieces, quality_rules, resampling, secret_scan, simhash,
    suffix_dedup, topk, warc,
)

#: Places of the public vocabularies.
PIECES, TOKENIZER, RANKS = map(public_tokenizers.path, ("piece_bpe_32k.model", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), PIECES)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(table(spark, sf_dir, "documents"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.every_nth(table(spark, sf_dir, "embeddings"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digests(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, RANKS)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digests(table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digests(table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digests(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_suffix_dedup, op2_line_dedup, op3_sentencepiece, op4_secret_scan, op5_exact_topk, op6_language_id, op7_simhash,
        op8_packing, op9_warc, op10_quality_rules, op11_resampling, op12_fingerprints, op13_centroids)}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_secret_scan": secret_scan.oracle_sql(), "op5_exact_topk": topk.oracle_sql(),
        "op11_resampling": resampling.oracle_sql(), "op13_centroids": centroids.oracle_sql()}
