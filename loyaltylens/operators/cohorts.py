"""Members that are new in a period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyaltylens.functions import fixed
from loyaltylens.functions.exprs import whole_number_id
from loyaltylens.functions.periods import YtdWindow, in_window, period_of


def new_members(members: DataFrame, window: YtdWindow, channel_like: str | None = None) -> DataFrame:
    """Distinct (member_id, period) of members who joined within the windows, optionally by channel."""
    joined = members.filter(in_window(F.col("join_time"), window))
    if channel_like is not None:
        joined = joined.filter(F.col("eff_reg_channel").contains(channel_like))
    return joined.select(
        whole_number_id(F.col("member_detail_id")).alias("member_id"),
        period_of(F.col("join_time"), window).alias("period"),
    ).distinct()


def new_members_by_channel(members: DataFrame, window: YtdWindow, channel_like: str) -> DataFrame:
    """Distinct (member_id, period, through_store) of all members who joined within the windows.

    ``through_store`` is true where one of the member's channels holds ``channel_like``.
    """
    joined = members.filter(in_window(F.col("join_time"), window)).select(
        whole_number_id(F.col("member_detail_id")).alias("member_id"),
        period_of(F.col("join_time"), window).alias("period"),
        F.coalesce(F.col("eff_reg_channel").contains(channel_like), F.lit(False)).alias("through_store"),
    )
    return joined.groupBy("member_id", "period").agg(F.max("through_store").alias("through_store"))


def new_accounts(bindings: DataFrame, window: YtdWindow) -> DataFrame:
    """Distinct (kyid, period) of marketplace accounts first bound within the windows."""
    bound = bindings.filter(
        in_window(F.col("first_bind_time"), window)
        & (F.col("platform_id_type") == fixed.BIND_ID_TYPE)
        & (F.col("platformid") == fixed.BIND_PLATFORM)
    )
    return bound.select(
        F.col("platform_id_value").alias("kyid"), period_of(F.col("first_bind_time"), window).alias("period")
    ).distinct()
