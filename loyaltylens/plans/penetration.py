"""Member penetration reports by city and by maturity band."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltylens.functions import fixed
from loyaltylens.functions.exprs import band_of_level, change_ratio, safe_div
from loyaltylens.operators import penetration as ops
from loyaltylens.operators.cities import CityBands, city_bands, maturity_labelled, with_labels
from loyaltylens.operators.identity import eligible_orders
from loyaltylens.operators.joins import lookup_join

Tables = Mapping[str, DataFrame]

REPORT_COLUMNS = (
    "target_kids_population", "adult_shopper_population", "ttl_member_base",
    "member_base_penetration_target_kids_shopper", "member_base_penetration_Y18_45_without_0_14_kids",
    "ttl_kids_member_shopper", "ttl_adult_member_shopper", "Kids_member_shopper_penetration",
    "adult_member_shopper_penetration",
)


SHOPPERS = {"bought_kids": "ttl_kids_member_shopper", "bought_adult": "ttl_adult_member_shopper"}
NEW_SHOPPERS = {"shopped_ty": "_shoppers_ty", "new_ty": "_new_shoppers_ty"}


def buyers(tables: Tables, as_of: date, adult: ops.AdultList, *, with_years: bool = False) -> DataFrame:
    """What every member bought in every order city."""
    orders = eligible_orders(tables["omni"], as_of)
    calendar = tables["calendar"] if with_years else None
    return ops.buyer_profile(orders, tables["crm"], adult, calendar=calendar, as_of=as_of)


def both_profiles(tables: Tables, as_of: date) -> DataFrame:
    """What every member bought in every order city, by either list of adult products, from one pass."""
    orders = eligible_orders(tables["omni"], as_of)
    lists = {"age": ops.adult_skus(tables["product"]), "portfolio": ops.adult_portfolio(tables["portfolio"])}
    return ops.buyer_profiles(orders, tables["crm"], lists)


def profile_by_age(both: DataFrame) -> DataFrame:
    return both.select("city", "omni_member_id", *(F.col(f"age_{f}").alias(f) for f in SHOPPERS))


def profile_by_portfolio(both: DataFrame) -> DataFrame:
    return both.select("city", "omni_member_id", *(F.col(f"portfolio_{f}").alias(f) for f in SHOPPERS))


def city_member_sources(tables: Tables, profile: DataFrame, bands: CityBands) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Registered members, buyers and located members by city.

    Registrations and purchases count in cities with a band; located members count in any city.
    """
    marked = bands.typed_cities.withColumn("counted", F.lit(True))
    known = lookup_join(profile, marked, {"city": "city_cn"}).withColumn("counted", F.coalesce("counted", F.lit(False)))
    located = ops.located_registrants(tables["located"], tables["member"])
    return ops.registered_by_city(tables["member"], bands), known, located


def city_members(tables: Tables, profile: DataFrame, bands: CityBands, *, with_years: bool = False) -> DataFrame:
    """Member base and shopper counts per city, of the sources of :func:`city_member_sources`."""
    counts = {**SHOPPERS, **(NEW_SHOPPERS if with_years else {})}
    members = ops.member_segments(*city_member_sources(tables, profile, bands), "city", tuple(counts))
    return members.withColumnsRenamed(counts)


def maturity_members(tables: Tables, profile: DataFrame, bands: CityBands) -> DataFrame:
    """Member base and shopper counts per maturity band, also of cities without one."""
    registered = with_labels(
        ops.registered_in_stores(tables["member"]).select(
            F.col("member_detail_id").cast("string").alias("omni_member_id"), "eff_reg_store"
        ),
        bands.by_store,
        fact_key="eff_reg_store",
        lookup_key="store_code",
        lookup_label="city_maturity_type",
        label="city_maturity_type",
        missing_label=fixed.UNSPECIFIED_BAND,
    )
    located = ops.located_registrants(tables["located"], tables["member"])
    members = ops.member_segments(
        registered,
        maturity_labelled(profile, bands, city="city", total=False).withColumn("counted", F.lit(True)),
        maturity_labelled(located, bands, city="city", total=False),
        "city_maturity_type",
        tuple(SHOPPERS),
    )
    return members.withColumnsRenamed(SHOPPERS)


def member_kpis_city(tables: Tables, as_of: date, agg_type: str) -> DataFrame:
    """Member base, shoppers, stores, footfall growth, registration rate and new-shopper share per city."""
    bands = city_bands(tables["store"], tables["city_type"])
    profile = buyers(tables, as_of, ops.adult_skus(tables["product"]), with_years=True)
    counts = {**SHOPPERS, **NEW_SHOPPERS}
    report = ops.city_measures(
        ops.member_rows(*city_member_sources(tables, profile, bands), "city", tuple(counts)),
        ops.open_store_rows(tables["store"]),
        ops.new_registration_rows(tables["member"], tables["store"], as_of),
        ops.footfall_rows(tables["traffic"], as_of, agg_type),
        tuple(counts),
    ).withColumnsRenamed(counts)
    return report.select(
        F.col("city").alias("city_cn"),
        "ttl_member_base",
        *SHOPPERS.values(),
        "current_LCS_store_count",
        change_ratio(F.col("traffic_TY_YTD"), F.col("traffic_LY_YTD")).alias("LCS_YTD_traffic_growth"),
        safe_div(F.col("LCS_new_reg"), F.col("traffic_TY_YTD")).alias("LCS_YTD_regisration_rate"),
        safe_div(F.col("_new_shoppers_ty"), F.col("_shoppers_ty")).alias("new_member_shopper_share_YTD"),
    )


def penetration_city(tables: Tables, as_of: date, profile: DataFrame | None = None) -> DataFrame:
    """Penetration of every city with a population; ``profile`` is :func:`profile_by_age` where it is at hand."""
    if profile is None:
        profile = buyers(tables, as_of, ops.adult_skus(tables["product"]))
    members = city_members(tables, profile, city_bands(tables["store"], tables["city_type"]))
    cities = tables["population"]
    joined = cities.join(members, cities.city_cn == members.city, "left")
    band = band_of_level(F.col("city_maturity_level"), fixed.OTHERS).alias("city_maturity_level")
    return joined.withColumns(ops.penetration_columns()).select(band, "city_cn", *REPORT_COLUMNS)


def penetration_maturity(tables: Tables, as_of: date, profile: DataFrame | None = None) -> DataFrame:
    """Penetration of every maturity band, and two total rows.  ``profile`` is :func:`profile_by_portfolio`.

    The first total adds the bands up, so a member of two bands counts twice; the second counts all
    members and all linked accounts without a member.
    """
    if profile is None:
        profile = buyers(tables, as_of, ops.adult_portfolio(tables["portfolio"]))
    members = maturity_members(tables, profile, city_bands(tables["store"], tables["city_type"]))
    return with_total_rows(members, tables)


COUNTS = ("ttl_member_base", *SHOPPERS.values())


def with_total_rows(members: DataFrame, tables: Tables) -> DataFrame:
    population = ops.population_by_maturity(tables["population"])
    everyone = ops.all_members(tables["member"], tables["belong"]).select(
        F.lit(fixed.ALL_MEMBERS).alias("city_maturity_type"), "ttl_member_base", *_unknown(COUNTS[1:])
    )
    rows = with_band_total(members).unionByName(everyone)
    # The labels of the total rows have no population, so their ratios are NULL.
    joined = rows.join(population, rows.city_maturity_type == population.city_maturity_level, "left")
    return joined.withColumns(ops.penetration_columns()).select("city_maturity_type", *REPORT_COLUMNS)


def with_band_total(members: DataFrame) -> DataFrame:
    """The bands, and the sum of their counts as one more row; that row is there even without any band."""
    label = "city_maturity_type"
    total = members.sparkSession.range(1).select(F.lit(fixed.ALL_WITH_CITY).alias(label), *_unknown(COUNTS))
    repeated = members.select(F.explode(F.array(label, F.lit(fixed.ALL_WITH_CITY))).alias(label), *COUNTS)
    return repeated.unionByName(total).groupBy(label).agg(*(F.sum(c).alias(c) for c in COUNTS))


def _unknown(names: tuple[str, ...]) -> list[Column]:
    return [F.lit(None).cast("bigint").alias(name) for name in names]
