"""From raw documents to packed sequences: the stages, each written and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loyaltylens.llm import exact_dedup, ngram_join, packing, pii, quality
from loyaltylens.llm.common import documents, keep

VOCABULARY = "word_bpe_49k.json"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.passing(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 0.8 of the five-word shingles or more, the document with the smallest id."""
    return ngram_join.without_near_copies(docs, ngram_join.Similarity(5, 80, 100))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens, with the checksum of their ids."""
    return packing.digests(packing.pack(docs, public_tokenizers.path(VOCABULARY)))


STAGES = [
    ("quality_rules", keep_good),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

# The sequences need the ids of a tokenizer, which SQL does not have; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
