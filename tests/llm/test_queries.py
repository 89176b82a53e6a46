"""The registered queries: all documents, contract columns, and their DuckDB statements."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as contract
from loyaltylens.llm.queries import ORACLE_SQL, QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
COLUMNS = {
    1: ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    2: ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    3: ["doc_id", "license", "matched_words", "coverage", "start", "end"],
    4: ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    5: ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    6: ["doc_id", "n_shingles", "component_id"],
    7: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    8: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    9: ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    10: ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    11: ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    12: ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    13: ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
}


@pytest.mark.parametrize("name", QUERIES)
def test_columns_and_rows(spark, name):
    result = QUERIES[name](spark, SMALL)
    number = int(name[2:].split("_")[0])
    assert result.columns == COLUMNS[number]
    if number not in (3, 5, 12, 13):
        ids = [r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()]
        assert sorted(r.doc_id for r in result.select("doc_id").collect()) == sorted(ids)


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_statements(spark, name):
    assert compare.difference(QUERIES[name](spark, MEDIUM), compare.connect(MEDIUM), ORACLE_SQL[name]) is None


def test_all_are_registered():
    assert sorted(COLUMNS) == sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())
