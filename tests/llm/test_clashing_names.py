"""Stages of the pipeline on documents whose further columns have the names that the stages use themselves."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loyaltylens.llm import exact_dedup, ngram_join, pii, quality

NAMES = [
    "key", "hash", "_key", "span_id", "span_hash", "spans", "redacted", "found", "node", "band", "stays", "text_key",
    "doc", "kept", "base_failed", "llm_id", "llm_text", "llm_found", "llm_own_hash", "llm_own_key", "rows", "chosen",
]
TEXT = " ".join(f"word{i}" for i in range(60))


@pytest.mark.parametrize(
    "stage", [quality.passing, exact_dedup.without_copies, ngram_join.without_near_copies, pii.redact], ids=lambda f: f.__name__
)
def test_columns_are_carried_along(spark, stage):
    rows = [(1, f"{TEXT} mail a@b.cd", 11), (2, f"{TEXT} mail a@b.cd", 22), (3, None, 33), (None, "", 44)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    docs = docs.withColumns({n: F.concat(F.lit(f"{n}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for n in NAMES})
    out = stage(docs)
    assert out.columns == docs.columns
    kept = out.collect()
    assert kept or stage is quality.passing
    for row in kept:
        assert [row[n] for n in NAMES] == [f"{n}-{'none' if row['doc_id'] is None else row['doc_id']}" for n in NAMES]
    texts = {r["doc_id"]: r["text"] for r in kept}
    if stage is pii.redact:
        assert texts[1] == f"{TEXT} mail <EMAIL>" and texts[3] is None


@pytest.mark.parametrize("stage", [exact_dedup.without_copies, ngram_join.without_near_copies], ids=lambda f: f.__name__)
@pytest.mark.parametrize("tags", ["lang", "map(lang, 1)"])
def test_of_repeated_rows_the_smallest_stays(spark, stage, tags):
    rows = [(7, TEXT, lang) for lang in ("fr", "de", None, "en", "de")] + [(8, "other words", "it"), (None, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    docs = docs.filter("lang is not null").withColumn("row", F.expr(tags)).repartition(5)
    found = {(r["doc_id"], r["lang"]) for r in stage(docs).collect()}
    assert found == {(7, "de"), (8, "it"), (None, "en")} and stage(docs).columns == docs.columns
