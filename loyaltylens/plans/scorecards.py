"""Sales and member scorecards: two channels, three grains, one plan."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyaltylens.functions import fixed
from loyaltylens.functions.periods import ytd_window
from loyaltylens.operators import kpis
from loyaltylens.operators.cities import (
    city_bands,
    city_maturity,
    city_tiers,
    grain_labelled,
    maturity_labelled,
    tier_labelled,
)
from loyaltylens.operators.cohorts import new_accounts, new_members, new_members_by_channel

Tables = Mapping[str, DataFrame]

SEGMENT_COLUMN = {"city": "city", "maturity": "city_maturity_type", "tier": "city_tier"}

# The change that the older online reports print as TY / (LY - 1), by grain.
SHIFTED_CHANGE = {"city": "atv_vs_LY", "tier": "sales_vs_LY"}


def labeller(tables: Tables, grain: str, channel: str, *, total: bool = True) -> kpis.Labeller:
    """How facts with a ``city`` get the segment of ``grain``; bands and tiers also get a total row."""
    if grain == "city":
        return lambda facts: facts
    if grain == "tier":
        tiers = city_tiers(tables["city_tier"])
        return lambda facts: tier_labelled(facts, tiers, city="city", total=total)
    if grain == "maturity":
        bands = city_bands(tables["store"], tables["city_type"])
        missing_city = fixed.NO_ORDER_CITY if channel == "online" else None
        return lambda facts: maturity_labelled(facts, bands, city="city", missing_city=missing_city, total=total)
    raise ValueError(f"unknown grain: {grain}")


def orders_of(tables: Tables, channel: str, as_of: date) -> DataFrame:
    """Both windows of a channel, one row per order and member; the same for every grain."""
    if channel == "online":
        return kpis.per_order(kpis.online_lines(tables["omni"], as_of, kpis.online_window(as_of)))
    return kpis.per_order(kpis.offline_lines(tables["member_orders"], kpis.offline_window(as_of)))


def flagged_orders(tables: Tables, channel: str, grain: str, as_of: date, orders: DataFrame | None = None) -> DataFrame:
    """Orders with the flag ``is_new``.

    Online, an account is new when it was first bound in the period, at any time of the year.  Offline, new
    members are those of any channel by city, and those of the store channel by band or tier.
    """
    orders = orders if orders is not None else orders_of(tables, channel, as_of)
    window = ytd_window(as_of)
    if channel == "online":
        return kpis.flag_new_accounts(orders, new_accounts(tables["ec_bind"], window))
    through = None if grain == "city" else fixed.STORE_MARK
    return kpis.flag_new_members(orders, new_members(tables["member"], window, through))


def order_measures(
    tables: Tables, channel: str, grain: str, as_of: date, orders: DataFrame | None = None
) -> DataFrame:
    """Sums and distinct counts of a channel per segment and period."""
    flagged = flagged_orders(tables, channel, grain, as_of, orders)
    return kpis.order_measures(flagged, labeller(tables, grain, channel), SEGMENT_COLUMN[grain])


def channel_measures(tables: Tables, channel: str, as_of: date) -> DataFrame:
    """Sums and distinct counts of a channel per grain, segment and period: all grains and the total from one read,
    one join to the new members and one aggregation of the orders."""
    orders = orders_of(tables, channel, as_of)
    window = ytd_window(as_of)
    if channel == "online":
        flagged = kpis.flag_new_accounts(orders, new_accounts(tables["ec_bind"], window))
        is_new, missing_city = F.col("is_new"), fixed.NO_ORDER_CITY
    else:
        cohort = new_members_by_channel(tables["member"], window, fixed.STORE_MARK)
        flagged = kpis.mark_new_members(orders, cohort)
        is_new = F.when(F.col("segment.grain") == "city", F.col("is_new")).otherwise(F.col("is_new_in_store"))
        missing_city = None
    bands, tiers = city_bands(tables["store"], tables["city_type"]), city_tiers(tables["city_tier"])

    def label(facts: DataFrame) -> DataFrame:
        return grain_labelled(facts, bands, tiers, city="city", missing_city=missing_city)

    measures = kpis.order_measures(flagged, label, "segment", is_new)
    return measures.select("segment.grain", F.col("segment.name").alias("name"), "period", *kpis.MEASURES)


def grain_measures(measures: DataFrame, grain: str) -> DataFrame:
    """The rows of :func:`channel_measures` that a scorecard of ``grain`` shows."""
    kept = measures.filter(F.col("grain") == grain if grain == "city" else F.col("grain").isin(grain, "total"))
    return kept.withColumnRenamed("name", SEGMENT_COLUMN[grain]).drop("grain")


def sales(tables: Tables, channel: str, grain: str, as_of: date) -> DataFrame:
    """Net sales and transactions (and visitors offline) per segment and period."""
    segment = SEGMENT_COLUMN[grain]
    if channel == "offline":
        return kpis.offline_sales(
            tables["offline_mart"], kpis.offline_window(as_of), labeller(tables, grain, channel), segment
        )
    lines = kpis.online_lines(tables["omni"], as_of, kpis.online_window(as_of))
    return (
        labeller(tables, grain, channel)(lines)
        .groupBy(segment, "period")
        .agg(
            F.sum("amount").alias("sales_rrp"),
            F.expr("count(distinct order_id) filter (where effective)").alias("transactions"),
        )
    )


def _add_band(cities: DataFrame, tables: Tables, channel: str) -> DataFrame:
    """Maturity band as the first column of a by-city scorecard."""
    if channel == "online":
        missing, no_city = fixed.UNSPECIFIED_CITY_BAND, fixed.NO_ORDER_CITY
    else:
        missing, no_city = fixed.UNSPECIFIED_BAND, fixed.UNSPECIFIED_BAND
    maturity = city_maturity(tables["store"], tables["city_type"]).withColumnRenamed("city_cn", "_city")
    joined = cities.join(maturity, cities.city == maturity["_city"], "left").drop("_city")
    band = F.when(F.col("city").isNull(), F.lit(no_city)).otherwise(
        F.coalesce("city_maturity_type", F.lit(missing))
    )
    return joined.withColumn("city_maturity_type", band)


def scorecard(
    tables: Tables,
    channel: str,
    grain: str,
    as_of: date,
    *,
    measures: DataFrame | None = None,
    as_published: bool = False,
) -> DataFrame:
    """Sales of this year against last year, with member KPIs, one row per segment.

    ``channel`` is ``online`` or ``offline``; ``grain`` is ``city``, ``maturity`` or ``tier``.
    ``measures`` are the channel's :func:`channel_measures` where they are at hand already.  ``as_published`` keeps the
    divergent change formula of the older online reports.
    """
    segment = SEGMENT_COLUMN[grain]
    if measures is None:
        measures = order_measures(tables, channel, grain, as_of)
    else:
        measures = grain_measures(measures, grain)
    kpi_columns = kpis.kpi_growth_columns()
    if channel == "online":
        # Sales and KPIs come from the same orders, so they share the one aggregation.
        both = kpis.compare_periods(measures, segment, kpis.MEASURES)
        shifted = SHIFTED_CHANGE.get(grain) if as_published else None
        growth = kpis.sales_growth_columns("net", "orders", shifted=shifted)
        known = F.col(segment).isNotNull()
        kpi_columns = {name: F.when(known, column) for name, column in kpi_columns.items()}
    else:
        sold = kpis.compare_periods(sales(tables, channel, grain, as_of), segment, kpis.OFFLINE_SALES)
        members = kpis.compare_periods(measures, segment, kpis.MEASURES).withColumnRenamed(segment, "_segment")
        both = sold.join(members, sold[segment] == members["_segment"], "left")
        growth = kpis.sales_growth_columns("sales_rrp", "transactions", "traffic")
    report = both.select(segment, *(c.alias(n) for n, c in {**growth, **kpi_columns}.items()))
    if grain != "city":
        return report
    city_name = "order_city" if channel == "online" else "city_cn"
    report = _add_band(report, tables, channel).withColumnRenamed("city", city_name)
    rest = [c for c in report.columns if c not in ("city_maturity_type", city_name)]
    return report.select("city_maturity_type", city_name, *rest)
