"""Encoding and decoding by a contiguous array of ranks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyaltylens.llm.bpe import PieceIds, WordVocabulary
from loyaltylens.llm.common import pieces, texts


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``ids``, the token ids of the whole text without added special tokens.

    A missing or empty text has no ids; rows that repeat an id come back as often as they are there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = PieceIds(vocabulary)
        for ids, found in pieces(batches):
            coded = [[i for p in known.vocabulary.pieces(t.decode()) for i in known[p]] for t in found]
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(coded, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(coded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and ``decoded``: the strings of the ids, special ones included, joined by a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = WordVocabulary(vocabulary).names
        for batch in batches:
            rows = [" ".join(map(names.__getitem__, ids or ())) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.string())], ["doc_id", "decoded"])

    rows = coded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id bigint, decoded string")


def codec_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the decimal ids and of the decoded text of every document.

    Same as hashing what :func:`encode` and :func:`decode` return, but no id leaves the task: each piece is held
    with its ids and its strings already written out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Written(vocabulary)
        for ids, found in pieces(batches):
            counts, sums, decoded = [], [], []
            for text in found:
                cut = [known[p] for p in known.vocabulary.pieces(text.decode())]
                numbers = " ".join([i for i, _ in cut])
                counts.append(numbers.count(" ") + 1 if numbers else 0)
                sums.append(hashlib.sha256(numbers.encode()).hexdigest())
                decoded.append(hashlib.sha256(" ".join([d for _, d in cut]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(sums), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _rows(docs, id_col, text_col).mapInArrow(run, schema)


class _Written(PieceIds):
    """Ids and their strings by piece, each joined by a space."""

    def written(self, ids: list[int]) -> tuple[str, str]:
        return " ".join(map(str, ids)), " ".join(map(self.vocabulary.names.__getitem__, ids))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
