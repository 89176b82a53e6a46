from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string"


@pytest.fixture
def docs(spark):
    """documents rows from texts or (id, text) pairs, with further columns of clashing names."""

    def build(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        extra = [(i, t, "en", "s", len(t or ""), "x", 7) for i, t in rows]
        return spark.createDataFrame(extra, f"{SCHEMA}, lang string, source string, n_chars bigint, kept string, n_tokens int")

    return build


def by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}
