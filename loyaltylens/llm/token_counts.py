"""Token counts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyaltylens.llm.bpe import piece_counts
from loyaltylens.llm.common import pieces, texts

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint"


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every document, without begin, end or added special tokens.

    ``vocabulary`` is the path of a tokenizers file whose splitter drops white space.  The pieces of some texts
    are looked up together; those not met before are merged together.  A missing or empty text has no tokens;
    rows that repeat an id come back as often as they are there.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = piece_counts(vocabulary)
        for ids, found in pieces(batches):
            cut = [known.vocabulary.pieces(t.decode()) for t in found]
            long = known.known(cut)
            totals = [sum(map(known.__getitem__, c)) for c in cut]
            known.forget(long)
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(list(map(len, found)), pa.int64()), pa.array(totals, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    rows = texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return rows.mapInArrow(count, SCHEMA)


def over_limit(counts: DataFrame, limit: int = 2048) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
