"""Distinct counts that can be merged: exact bitmaps over dense numbers.

The bitmaps of a city and a month answer for any group of cities and any run of months: OR them, then count bits.
They are a few KB each however many rows they stand for, so they can be kept and merged without the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyaltylens.operators.joins import spread_missing

NUMBER_PARTS = 256  # tasks that may number the ids of one place


def numbered(ids: DataFrame, key: str, near: str | None = None, known: DataFrame | None = None) -> DataFrame:
    """``key`` and ``number``: dense numbers from 1 of the distinct ids; a missing id gets none.

    Ids of one ``near`` value, the smallest that an id occurs with, get neighbouring numbers, so that the bitmaps of a place are
    few and full.  Ids in ``known`` (``key``, ``number``) keep their numbers, new ones follow behind them.

    Ids are added up per task first.  Each task numbers a part of a place by itself; the parts are then moved one behind
    the other, by one row per part.
    """
    place = F.min(F.col(near).cast("string")) if near else F.lit(None).cast("string")
    people = ids.filter(F.col(key).isNotNull()).groupBy(key).agg(place.alias("_near"))
    first = F.lit(0).cast("bigint")
    if known is not None:
        people = people.join(known.select(key), key, "left_anti")
        first = F.coalesce(known.agg(F.max("number")).scalar(), first)
    people = people.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(NUMBER_PARTS)))
    sizes = people.groupBy("_near", "_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy(F.col("_near"), F.col("_part")).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_near").alias("_place"), F.col("_part").alias("_piece"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
    )
    within = F.row_number().over(Window.partitionBy("_near", "_part").orderBy(key))
    ranked = people.withColumn("_rank", within)
    same = ranked["_near"].eqNullSafe(starts["_place"]) & (ranked["_part"] == starts["_piece"])
    fresh = ranked.join(starts, same).select(key, (first + F.col("_start") + F.col("_rank")).cast("bigint").alias("number"))
    return fresh if known is None else known.select(key, "number").unionByName(fresh)


def with_number(rows: DataFrame, numbers: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with the number of ``key`` as ``name``; rows without a key stay and are spread over all tasks."""
    found = numbers.select(F.col(key).cast("string").alias("_number_key"), F.col("number").alias(name))
    spread = rows.withColumn("_row_key", spread_missing(F.col(key), *rows.columns))
    return spread.join(found, F.col("_row_key") == F.col("_number_key"), "left").drop("_row_key", "_number_key")


def distinct_bitmaps(rows: DataFrame, keys: Sequence[str], sets: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """``keys``, ``bucket`` and one bitmap per set, over the numbers of the rows that meet its condition.

    ``sets`` maps a name to a number column and a condition.  Sets over different numbers get rows of their own; a bitmap
    without any bit is NULL.  Bits are set per task before the shuffle.
    """
    each = []
    for number in dict.fromkeys(column for column, _ in sets.values()):
        own = {name: condition for name, (column, condition) in sets.items() if column == number}
        each.append(F.struct(F.lit(number).alias("_ids"), F.col(number).alias("number"), *(
            F.coalesce(own[name], F.lit(False)).alias(name) if name in own else F.lit(False).alias(name) for name in sets
        )))
    marked = rows.select(*keys, F.inline(F.array(*each))).filter(F.col("number").isNotNull())
    place = F.bitmap_bit_position(F.col("number"))
    found = marked.groupBy(*keys, "_ids", F.bitmap_bucket_number(F.col("number")).alias("bucket")).agg(
        *(F.bitmap_construct_agg(F.when(F.col(name), place)).alias(name) for name in sets)
    )
    return found.withColumns({name: F.when(F.bitmap_count(F.col(name)) > 0, F.col(name)) for name in sets})


def merged(bitmaps: DataFrame, keys: Sequence[str], sets: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser ``keys``: those of all rows with equal keys, OR-ed."""
    united = bitmaps.groupBy(*keys, "_ids", "bucket").agg(*(F.bitmap_or_agg(name).alias(name) for name in sets))
    return united.withColumns({name: F.when(F.bitmap_count(F.col(name)) > 0, F.col(name)) for name in sets})


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], sets: Sequence[str]) -> DataFrame:
    """``keys`` and, for each set, the distinct ids of all rows with equal keys."""
    counted = [F.coalesce(F.sum(F.bitmap_count(F.col(name))), F.lit(0)).alias(name) for name in sets]
    return merged(bitmaps, keys, sets).groupBy(*keys).agg(*counted)
