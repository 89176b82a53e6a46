"""Registered queries of the text operators, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loyaltylens.llm import (
    bpe_codec, collocations, exact_dedup, licenses, lm_score, ngram_join, packing, pii, quality, secrets, sharding,
    token_counts, whitening,
)
from loyaltylens.llm.common import documents


VOCABULARY = "word_bpe_49k.json"


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))
    return token_counts.over_limit(counts)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY)))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ngram_join.similar_groups(documents(spark, sf_dir), ngram_join.Similarity(4, 85, 100))
    return groups.select("doc_id", "n_shingles", "component_id")


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.codec_digests(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(documents(spark, sf_dir))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_report(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op10_pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(documents(spark, sf_dir))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(documents(spark, sf_dir), 16)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 16)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_score, op2_token_counts, op3_license_scan, op4_secret_scan, op5_packing, op6_ngram_join, op7_bpe_codec,
        op8_quality_rules, op9_exact_dedup, op10_pii_scan, op11_sharding, op12_collocations, op13_whitening,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op6_ngram_join": ngram_join.ORACLE,
    "op9_exact_dedup": exact_dedup.ORACLE,
    "op12_collocations": collocations.ORACLE,
}
