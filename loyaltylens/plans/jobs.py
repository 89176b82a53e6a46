"""All reports of a reporting day, written as full-refresh tables."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame

from loyaltylens.plans import location, penetration, scorecards
from loyaltylens.sources.tables import current, refresh, saved

CHANNELS = ("online", "offline")
GRAINS = ("city", "maturity", "tier")


def refresh_reports(
    tables: Mapping[str, DataFrame], target: str, as_of: date, *, as_tables: bool = False, as_published: bool = False
) -> list[str]:
    """Write every report and return their names.

    ``target`` is a folder or, with ``as_tables``, a schema of the catalog.  The located members come first, as the
    penetration reports read them.  The two penetration reports share one pass over the order history, the three
    scorecards of a channel one aggregation of its order lines; what they share is removed at the end.
    """
    written = []

    def place(name: str) -> str:
        return f"{target}.{name}" if as_tables else f"{target}/{name}"

    def write(name: str, report: DataFrame, *, audited: bool = False) -> None:
        refresh(report, place(name), as_table=as_tables, as_of=as_of if audited else None)
        written.append(name)

    located = location.segment_members(tables["prop_log"], tables["segment_map"])
    write("located_members", located)
    spark = located.sparkSession
    read = spark.table(place("located_members")) if as_tables else current(spark, place("located_members"))
    tables = ChainMap({"located": read}, tables)
    with saved(penetration.both_profiles(tables, as_of)) as both:
        write("penetration_city", penetration.penetration_city(tables, as_of, penetration.profile_by_age(both)))
        by_portfolio = penetration.profile_by_portfolio(both)
        write("penetration_maturity", penetration.penetration_maturity(tables, as_of, by_portfolio), audited=True)
    for channel in CHANNELS:
        with saved(scorecards.channel_measures(tables, channel, as_of)) as measures:
            for grain in GRAINS:
                report = scorecards.scorecard(tables, channel, grain, as_of, measures=measures, as_published=as_published)
                write(f"performance_{channel}_{grain}", report)
    return written
