"""Uniform shuffle of documents into shards of exact size by a hypergeometric communication matrix."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyaltylens.llm.common import keep

# Rows of a source (a run of rows of one scan task) and of a block (a run of slots of one shard), as powers of two.
SOURCE_BITS, BLOCK_BITS = 18, 18
# monotonically_increasing_id holds the task above these bits; tasks are gathered in groups of 256 for the draw.
TASK_BITS, GROUP_BITS = 33, 41
SMALL = 10**9  # populations below it are drawn by numpy

NODE = "node bigint, blocks array<bigint>, counts array<bigint>"


def hypergeometric(good: int, bad: int, sample: int, rng: np.random.Generator) -> int:
    """How many of ``sample`` rows drawn from ``good`` and ``bad`` ones are good, for any number of rows.

    Beyond what numpy draws, the distribution is added up outwards from its mode, by the exact ratio of neighbours;
    what lies beyond 14 standard deviations is below the resolution of the random number.
    """
    total = good + bad
    if total < SMALL:
        return int(rng.hypergeometric(good, bad, sample)) if total and sample else 0
    low, high = max(0, sample - bad), min(good, sample)
    mode = min(high, max(low, (sample + 1) * (good + 1) // (total + 2)))
    spread = math.sqrt(sample * (good / total) * (bad / total) * ((total - sample) / max(1, total - 1)))
    reach = int(14 * spread) + 20
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    ratio = (np.log(good - k) + np.log(sample - k)) - (np.log(k + 1) + np.log(k + (bad - sample + 1)))
    weight = np.concatenate([[0.0], np.cumsum(ratio)])
    shares = np.cumsum(np.exp(weight - weight.max()))
    return first + int(np.searchsorted(shares, rng.random() * shares[-1], side="right"))


def draw(counts: np.ndarray, sample: int, rng: np.random.Generator) -> np.ndarray:
    """``sample`` rows drawn without replacement from blocks with ``counts`` rows left: how many of each."""
    total = int(counts.sum())
    if total < SMALL:
        return rng.multivariate_hypergeometric(counts, sample, method="marginals") if total else np.zeros_like(counts)
    if len(counts) == 1:
        return np.array([sample], dtype=np.int64)
    half = len(counts) // 2
    left = int(counts[:half].sum())
    there = hypergeometric(left, total - left, sample, rng)
    return np.concatenate([draw(counts[:half], there, rng), draw(counts[half:], sample - there, rng)])


def dealt(children: DataFrame, parents: DataFrame, bits: int, seed: int) -> DataFrame:
    """Deal the rows of each parent's blocks to its children (``node``, ``n``): one row of the matrix per child.

    Every parent is dealt in one task, which holds its blocks and the sizes of its children; the random numbers
    depend on the seed and the parent only, so a task that is run again draws the same.
    """

    def run(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("node")
        blocks = np.array(above["blocks"].iloc[0], dtype=np.int64)
        left = np.array(above["counts"].iloc[0], dtype=np.int64)
        rng = np.random.default_rng([seed, bits, int(above["node"].iloc[0])])
        rows = []
        for node, n in zip(own["node"], own["n"]):
            found = draw(left, int(n), rng)
            left -= found
            some = np.flatnonzero(found)
            rows.append((node, blocks[some], found[some]))
        return pd.DataFrame(rows, columns=["node", "blocks", "counts"])

    return children.groupBy("parent").cogroup(parents.groupBy("node")).applyInPandas(run, NODE)


def communication_matrix(rows: DataFrame, sizes: list[int], seed: int) -> DataFrame:
    """(node, blocks, counts): how many rows every source sends to every block, zeros left out.

    Uniform over all ways to put the rows into blocks of ``sizes``.  Dealt from the root to groups of scan tasks, from
    those to tasks and from those to sources, so that no task and not the driver sees the whole matrix.
    """
    spark = rows.sparkSession
    sources = keep(rows.groupBy(F.col("source").alias("node")).agg(F.count(F.lit(1)).alias("n")))
    root = [(0, [b for b, size in enumerate(sizes) if size], [size for size in sizes if size])]
    known = spark.createDataFrame(root, NODE)
    levels = [GROUP_BITS - SOURCE_BITS, TASK_BITS - SOURCE_BITS, 0]
    for above, bits in zip([63, *levels], levels):
        children = sources.groupBy(F.shiftright("node", bits).alias("node")).agg(F.sum("n").alias("n"))
        known = dealt(children.withColumn("parent", F.shiftright("node", above - bits)), known, bits, seed)
    return known


def labelled(rows: DataFrame, matrix: DataFrame, seed: int) -> DataFrame:
    """row, place and block of each row: each source hands its rows out in a random order, as the matrix says.

    The source's row of the matrix comes first in its partition, then its rows stream by: a task holds the labels of
    one source, never its rows.
    """
    row_type = rows.schema["row"].dataType
    none = F.lit(None).cast("array<bigint>")
    deals = matrix.select(
        F.lit(None).cast(row_type).alias("row"), F.lit(-1).cast("bigint").alias("place"), F.col("node").alias("source"),
        "blocks", "counts",
    )
    both = rows.select("row", "place", "source", none.alias("blocks"), none.alias("counts")).unionByName(deals)
    schema = both.select("row", "place").withColumn("block", F.lit(0).cast("bigint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, at = np.zeros(0, np.int64), 0
        for batch in batches:
            deal = np.flatnonzero(pc.is_valid(batch.column("counts")).to_numpy(zero_copy_only=False))
            out = np.zeros(batch.num_rows, np.int64)
            starts = np.concatenate([[0], deal + 1])
            ends = np.concatenate([deal, [batch.num_rows]])
            for start, end in zip(starts, ends):
                if start:
                    row = start - 1
                    blocks, counts = (np.array(batch.column(c)[row].as_py(), np.int64) for c in ("blocks", "counts"))
                    source = batch.column("source")[row].as_py()
                    labels, at = np.repeat(blocks, counts), 0
                    np.random.default_rng([seed, SOURCE_BITS, source]).shuffle(labels)
                out[start:end] = labels[at : at + end - start]
                at += end - start
            plain = np.ones(batch.num_rows, bool)
            plain[deal] = False
            columns = [batch.column("row"), batch.column("place"), pa.array(out)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "place", "block"]).filter(pa.array(plain))

    # The place of a source's deal is -1, before all its rows.
    return both.repartition("source").sortWithinPartitions("source", "place").mapInArrow(run, schema)


def shard_sizes(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def uniform_shuffle(rows: DataFrame, shards: int, seed: int = 11) -> DataFrame:
    """All ``rows`` with ``shard`` and ``slot``, as if one random permutation had been cut into ``shards`` runs.

    Shard sizes differ by at most one row; slots are gapless from 0.  Every shard is a run of blocks of at most
    2**BLOCK_BITS rows.  The exact number of rows that each source sends to each block is drawn first; the sources
    deal their rows out in random order, the rows are exchanged by block, and each block is put into random order.
    No task holds more than a block, whatever the rows have in common: their values play no part.

    The order depends on the seed and on the layout of the table in files.  Columns of any name are carried along; those
    named ``shard`` or ``slot`` are replaced.  Repeated rows, missing ids and values, and texts of any length are rows
    like others; an empty table gives an empty result.  The rows are written once to the shared folder, so pass only
    the columns that are needed.
    """
    rows = rows.drop("shard", "slot")
    place = F.monotonically_increasing_id()
    placed = rows.select(F.struct(*rows.columns).alias("row"), place.alias("place"))
    placed = keep(placed.withColumn("source", F.shiftright("place", SOURCE_BITS)))
    total = placed.count()
    per_shard = max(1, math.ceil(math.ceil(total / shards) / (1 << BLOCK_BITS)))
    sizes = [size for shard in shard_sizes(total, shards) for size in shard_sizes(shard, per_shard)]
    found = labelled(placed, communication_matrix(placed, sizes, seed), seed)
    shard = F.floor(F.col("block") / per_shard).cast("bigint")
    number = F.pmod("block", F.lit(per_shard))
    own = F.lit(total // shards) + (shard < total % shards).cast("bigint")  # rows of the shard
    start = number * F.floor(own / per_shard) + F.least(number, F.pmod(own, F.lit(per_shard)))
    order = Window.partitionBy("block").orderBy(F.xxhash64("place", F.lit(seed)), "place")
    slot = (start + F.row_number().over(order) - 1).cast("bigint")
    return found.select("row.*", shard.cast("int").alias("shard"), slot.alias("slot"))


def sizes_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes and one) and CRC-32 of every text; a missing text is empty."""
    text: Column = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(
        docs[id_col].alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def shard_report(docs: DataFrame, shards: int = 16, seed: int = 11) -> DataFrame:
    """Where :func:`uniform_shuffle` puts every document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``rows``: shard counts differ by at most one.  Documents with equal texts are spread like all others.
    """
    return uniform_shuffle(sizes_of(docs), shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, folder: str, shards: int, seed: int = 11) -> None:
    """The documents as Parquet folders ``shard=N``, each file sorted by slot, all columns kept."""
    placed = uniform_shuffle(docs, shards, seed)
    pieces = F.shiftright("slot", BLOCK_BITS)
    dealt_out = placed.repartition("shard", pieces).sortWithinPartitions("shard", "slot")
    dealt_out.write.partitionBy("shard").parquet(folder)
