"""Packing of documents into sequences along a space-filling curve."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltylens.llm.bpe import piece_table
from loyaltylens.llm.common import keep, pieces, texts

FEATURES, DIMENSIONS, BITS = 256, 3, 16  # hashed features, dimensions they are projected to, bits of each
TIE_BITS = 63 - DIMENSIONS * BITS  # spread documents at the same point over many keys
SLICE = 1 << 19  # bytes of texts that are encoded together
BUCKET_TOKENS = 1 << 20  # a bucket of the curve is written by one task, in a stream
GRID = 4096  # quantiles that are found at a time


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of points with integer coordinates below 2**bits (rows are points).

    Skilling's method: undo the rotations of each level from the top, Gray-decode, then interleave the bits.
    """
    x = points.T.astype(np.uint64).copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        top, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(n):
            inverted = (x[i] & top) != 0
            swap = np.where(inverted, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(inverted, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> np.uint64(level)) & np.uint64(1), np.uint64((1 << level) - 1), np.uint64(0))
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << np.uint64(1) | (x[i] >> np.uint64(level)) & np.uint64(1)
    return key


def directions() -> np.ndarray:
    return np.random.default_rng(20).standard_normal((FEATURES, DIMENSIONS))


@cache
def features(count: int) -> np.ndarray:
    """The hashed feature of every token id."""
    return (np.arange(count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.int64)


def curve_keys(ids: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Key of each document from its token ids: hashed counts, damped, scaled to length one and projected."""
    known = features(1 << max(16, int(ids.max(initial=0)).bit_length()))
    counts = np.bincount(owner * FEATURES + known[ids], minlength=rows * FEATURES)
    vectors = np.log1p(counts.reshape(rows, FEATURES))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    # A projected unit vector has about standard normal coordinates; the ends of the scale are far out.
    points = np.clip((vectors @ directions() + 6) / 12, 0, 1) * ((1 << BITS) - 1)
    return hilbert_key(points.astype(np.int64))


def tokenised(docs: DataFrame, vocabulary: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, place on the curve, n and packed ids of each document, the end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(vocabulary, end_id)
        for doc_ids, found in pieces(batches, SLICE):
            ids, lengths = table.encoded(t.decode() for t in found)
            keys = curve_keys(ids, np.repeat(np.arange(len(found)), lengths), len(found))
            data, ends = ids.tobytes(), (np.cumsum(lengths) * ids.itemsize).tolist()
            packed = [data[a:b] for a, b in zip([0, *ends], ends)]
            yield pa.RecordBatch.from_arrays(
                [doc_ids.cast(pa.int64()), pa.array(keys.astype(np.int64)), pa.array(lengths), pa.array(packed, pa.binary())],
                ["doc_id", "key", "n", "packed"],
            )

    rows = texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    coded = rows.mapInArrow(run, "doc_id bigint, key bigint, n bigint, packed binary")
    tie = F.pmod(F.xxhash64("doc_id"), F.lit(1 << TIE_BITS))
    return coded.withColumn("place", F.shiftleft("key", TIE_BITS).bitwiseOR(tie)).drop("key")


def interval_of(bounds: np.ndarray) -> Callable[[str], Column]:
    """Which of the intervals between the bounds a place lies in."""

    @F.pandas_udf("int")
    def interval(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, place.to_numpy(), side="right"), dtype="int32")

    return interval


def bucket_bounds(rows: DataFrame) -> np.ndarray:
    """Where to cut the curve for buckets of about BUCKET_TOKENS tokens, however many that makes.

    One pass gives the total and a grid of quantiles of the places, of which as many are taken as there are
    buckets.  If the grid has too few, each of its parts is cut at quantiles of its own in a second pass.
    """
    grid = [i / GRID for i in range(1, GRID)]
    total, bounds = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.percentile_approx("place", grid, 5 * GRID)).first()
    buckets = max(1, math.ceil(total / BUCKET_TOKENS))
    if buckets <= GRID:
        chosen = [bounds[i * GRID // buckets - 1] for i in range(1, buckets)]
        return np.unique(np.array(chosen, dtype=np.int64))
    coarse = np.unique(np.array(bounds, dtype=np.int64))
    finer = math.ceil(buckets / GRID)
    cuts = [i / finer for i in range(1, finer)]
    parts = rows.groupBy(interval_of(coarse)("place").alias("part"))
    within = parts.agg(F.percentile_approx("place", cuts, 20 * finer).alias("bounds"))
    inner = within.select(F.explode("bounds").alias("bound")).distinct().toPandas()["bound"].to_numpy(np.int64)
    return np.union1d(coarse, inner)


def pack(
    docs: DataFrame, vocabulary: str, length: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Sequences of ``length`` tokens, cut from the documents in the order of the curve.

    One row per piece: doc_id, start (ids of the document before it), length, doc_tokens, sequence_id, offset
    (place in the sequence) and ``ids`` as little-endian unsigned 32-bit numbers.  Every document ends with
    ``end_id``; a missing or empty text is that id alone; repeated rows are packed as often as they are there.
    All sequences are full but the last one.

    The curve is cut into buckets at quantiles of the places; documents at one point are spread by their id, so
    that no bucket holds much more than its share.  A very long document is one row of its bucket.  The driver
    holds two numbers per bucket of ``BUCKET_TOKENS`` tokens.
    """
    rows = keep(tokenised(docs, vocabulary, end_id, id_col, text_col))
    dealt = rows.withColumn("bucket", interval_of(bucket_bounds(rows))("place"))
    sums = dealt.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas().sort_values("bucket")
    first = np.zeros(int(sums["bucket"].max()) + 1 if len(sums) else 0, np.int64)
    first[sums["bucket"].to_numpy(np.int64)] = (sums["n"].cumsum() - sums["n"]).to_numpy(np.int64)
    kind = piece_table(vocabulary, end_id).kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = at = None
        for batch in batches:
            out = []
            for doc_id, n, packed, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "packed", "bucket"))):
                if own != bucket:
                    bucket, at = own, int(first[own])
                ids = np.frombuffer(packed, kind).astype("<u4").tobytes()
                start = 0
                while start < n:
                    offset = at % length
                    size = min(n - start, length - offset)
                    out.append((doc_id, start, size, n, at // length, offset, ids[4 * start : 4 * (start + size)]))
                    start += size
                    at += size
                if len(out) >= 4096:
                    yield _rows(out)
                    out = []
            if out:
                yield _rows(out)

    ordered = dealt.repartition("bucket").sortWithinPartitions("bucket", "place", "doc_id", "n", "packed")
    return ordered.select("doc_id", "n", "packed", "bucket").mapInArrow(run, SCHEMA)


SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def _rows(out: list[tuple]) -> pa.RecordBatch:
    *numbers, ids = zip(*out)
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in numbers), pa.array(ids, pa.binary())], names)


def digests(packed: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
