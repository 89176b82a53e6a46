"""State that daily runs carry on, so that a day reads its own rows and not the whole history.

Each state is a folder of :func:`loyaltylens.sources.tables.refresh`: its current version is labelled with the last day it
holds, and a run merges the days after it.  A run that stops anywhere leaves the state of the day before; run again,
it comes to the same.  Filters on the day column prune the partitions of a source that is partitioned by it.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyaltylens.functions import fixed
from loyaltylens.operators import penetration as ops
from loyaltylens.operators.identity import eligible_orders
from loyaltylens.plans import location
from loyaltylens.sources.tables import current, current_label, refresh


def days_after(rows: DataFrame, day: str, through: str | None, until: date) -> DataFrame:
    """Rows of the days after ``through``, up to and with ``until``."""
    kept = rows.filter(F.col(day) <= F.lit(until))
    return kept if through is None else kept.filter(F.col(day) > F.lit(date.fromisoformat(through)))


def advance_newest(
    log: DataFrame,
    segment_map: DataFrame,
    target: str,
    until: date,
    *,
    day: str = "day",
    id_prop: str = fixed.CRM_ID_PROPERTY,
) -> None:
    """Bring the newest values per property and user up to ``until``.

    The state is in the form of the log: which of two rows is newer, and which one wins a tie, does not depend on when they were
    merged, so late rows and rows that come twice change nothing.  It holds the properties that
    ``segment_map`` names; after a property is added to the map, start a new state.
    """
    spark = log.sparkSession
    through = current_label(spark, target)
    if through is not None and date.fromisoformat(through) >= until:
        return
    rows = days_after(log, day, through, until).select("gio_id", "prop_key", "prop_value", "update_time")
    if through is not None:
        rows = rows.unionByName(current(spark, target))
    newest = location.newest_log(rows, segment_map, id_prop)
    refresh(newest.select("gio_id", "prop_key", "prop_value", "update_time"), target, label=until.isoformat())


def located_members(state: DataFrame, segment_map: DataFrame, id_prop: str = fixed.CRM_ID_PROPERTY) -> DataFrame:
    """Located members (:func:`loyaltylens.plans.location.segment_members`) from the state of :func:`advance_newest`."""
    return location.members_of_newest(state, state, segment_map, id_prop)


def advance_purchases(
    omni: DataFrame, lists: Mapping[str, ops.AdultList], target: str, until: date, *, day: str = "order_paid_date"
) -> None:
    """Bring the purchase history up to ``until``: per order city and customer reference, the first day and what was
    bought.

    A reference is what an order says of its buyer; it is joined to the members when the state is read, so a member who
    is linked later is found with all earlier purchases.  A product counts as what the lists said on the
    day it was merged; start a new state when a list is corrected.
    """
    spark = omni.sparkSession
    through = current_label(spark, target)
    if through is not None and date.fromisoformat(through) >= until:
        return
    orders = eligible_orders(days_after(omni, day, through, until), until + timedelta(days=1))
    references = ops.purchase_references(orders, lists)
    if through is not None:
        references = ops.merged_references(references.unionByName(current(spark, target)))
    refresh(references, target, label=until.isoformat())


def buyers(state: DataFrame, crm: DataFrame) -> DataFrame:
    """One row per order city and member id: first purchase and what was bought, from the state of
    :func:`advance_purchases`."""
    return ops.people_of(state, crm)
