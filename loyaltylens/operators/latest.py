"""Newest rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltylens.operators.joins import lookup_join


def latest_batch(df: DataFrame, part: str, order: str, groups: DataFrame) -> DataFrame:
    """All rows of the newest ``order`` value of each ``part``, ties kept.

    ``groups`` lists the values of ``part`` to look at.
    A few groups may hold almost all rows, so the newest value is found by a partial aggregation and
    joined back instead of ranking each group in one task.
    """
    known = df.filter(F.col(order).isNotNull())
    wanted = groups.select(part).distinct()
    newest = lookup_join(known, wanted, {part: part}, how="left_semi").groupBy(part).agg(F.max(order).alias(order))
    return lookup_join(known, newest, {part: part, order: order}, how="left_semi")


def newest_values(log: DataFrame, preferred: Column) -> DataFrame:
    """prop_key, gio_id, update_time and prop_value of the newest row per property and user.

    Of rows of the same time, one that is ``preferred`` wins, then the smallest value.  Rows without a time are left
    out.  One row per property, user and task is shuffled.
    """
    age = F.expr("timestamp_ntz'1970-01-01'") - F.col("update_time")
    first = F.min(F.struct(age, ~F.coalesce(preferred, F.lit(False)), "prop_value"))
    newest = log.filter(F.col("update_time").isNotNull()).groupBy("prop_key", "gio_id")
    return newest.agg(F.max("update_time").alias("update_time"), first["prop_value"].alias("prop_value"))
