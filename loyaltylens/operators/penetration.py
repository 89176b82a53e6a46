"""Member base, kids and adult shoppers, stores, footfall and registrations."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyaltylens.functions import fixed
from loyaltylens.functions.exprs import age_years, as_double, band_of_level, canonical_id, change_ratio, safe_div
from loyaltylens.functions.periods import in_last_year, in_this_year, in_window, ytd_window
from loyaltylens.operators.cities import CityBands
from loyaltylens.operators.identity import (
    calendar_days,
    member_references,
    registered_through,
    resolve_identity,
    with_calendar,
)
from loyaltylens.operators.joins import lookup_join


# -- adult products -------------------------------------------------------------------------------


@dataclass(frozen=True)
class AdultList:
    """Product ids for adults: as found, and as a lookup of the distinct ids."""

    found: DataFrame  # sku_id, may repeat and may be missing
    listed: DataFrame  # sku

    def state(self) -> Column:
        """``empty``, ``has missing`` or ``complete``, as a scalar subquery."""
        missing = F.max(F.col("sku_id").isNull())
        label = F.when(missing.isNull(), F.lit("empty")).when(missing, F.lit("has missing")).otherwise(F.lit("complete"))
        return self.found.agg(label).scalar()


def _adult_list(products: DataFrame, is_adult: Column) -> AdultList:
    found = products.filter(is_adult).select("sku_id")
    ids = found.filter(F.col("sku_id").isNotNull()).select(F.col("sku_id").cast("string").alias("sku")).distinct()
    return AdultList(found, ids)


def adult_skus(products: DataFrame, min_age: int = fixed.ADULT_MIN_AGE) -> AdultList:
    """Products whose age mark says ``min_age`` or older; marks that cannot be read do not count."""
    return _adult_list(products, age_years(F.col("age_mark")) >= min_age)


def adult_portfolio(portfolio: DataFrame) -> AdultList:
    """Products labelled for adults."""
    return _adult_list(portfolio, F.col("kids_vs_adult") == fixed.ADULT_PRODUCT)


def with_buyer_flags(lines: DataFrame, adult: AdultList) -> DataFrame:
    """Add ``is_adult`` (product is in the list) and ``is_kids`` (it is not).

    The second follows SQL's NOT IN: a list with a missing id, or a line without a product, makes "not in
    the list" unknown, and unknown does not count; an empty list holds nothing for certain.
    """
    listed = adult.listed.withColumn("_listed", F.lit(True))
    flagged = lookup_join(lines.withColumn("_line_sku", F.col("sku_id").cast("string")), listed, {"_line_sku": "sku"})
    is_adult = F.coalesce(F.col("_listed"), F.lit(False))
    absent = F.col("_line_sku").isNotNull() & ~is_adult
    return (
        flagged.withColumn("_state", adult.state())
        .withColumn("is_adult", is_adult)
        .withColumn("is_kids", (F.col("_state") == "empty") | ((F.col("_state") == "complete") & absent))
        .drop("_listed", "_line_sku", "_state")
    )


def buyer_profile(
    orders: DataFrame, crm: DataFrame, adult: AdultList, *, calendar: DataFrame | None = None, as_of: date | None = None
) -> DataFrame:
    """One row per order city and member id, with flags for what the member did there.

    Flags: ``bought_kids``, ``bought_adult`` and, with a calendar, ``shopped_ty`` (in the fiscal year numbered
    like the calendar year of ``as_of``) and ``new_ty`` (and registered in that fiscal year).  Order lines are
    reduced to distinct references before they are joined to the members.
    """
    lines = with_buyer_flags(orders, adult)
    years: tuple[str, ...] = ()
    if calendar is not None:
        days = calendar_days(calendar, as_of)
        paid_day = F.col("order_paid_time").cast("date")
        lines = with_calendar(lines.withColumn("paid_day", paid_day), days, "paid_day", "trans")
        years = ("first_bind_time", "trans_fiscal_year")
    keys = ("order_city", "type_name", "type_value", "crm_member_detail_id", *years)
    references = (
        member_references(lines, *years, "is_kids", "is_adult")
        .groupBy(*keys)
        .agg(F.max("is_kids").alias("bought_kids"), F.max("is_adult").alias("bought_adult"))
    )
    people = resolve_identity(references, crm)
    flags = {"bought_kids": F.col("bought_kids"), "bought_adult": F.col("bought_adult")}
    if calendar is not None:
        people = people.withColumn("registered_on", F.coalesce("join_time", "first_bind_time"))
        people = with_calendar(people, days, "registered_on", "reg")
        this_year = F.col("trans_fiscal_year") == as_of.year
        flags["shopped_ty"] = this_year
        flags["new_ty"] = this_year & (F.col("trans_fiscal_year") == F.col("reg_fiscal_year"))
    return people.groupBy(F.col("order_city").alias("city"), "omni_member_id").agg(
        *(F.max(F.coalesce(flag, F.lit(False))).alias(name) for name, flag in flags.items())
    )


REFERENCE = ("order_city", "type_name", "type_value", "crm_member_detail_id")


def purchase_references(orders: DataFrame, lists: Mapping[str, AdultList]) -> DataFrame:
    """One row per order city and customer reference: the first day, and ``<name>_bought_kids`` and
    ``<name>_bought_adult`` for each list."""
    lines, flags = orders, []
    for name, adult in lists.items():
        named = {"is_kids": f"{name}_bought_kids", "is_adult": f"{name}_bought_adult"}
        lines = with_buyer_flags(lines, adult).withColumnsRenamed(named)
        flags += named.values()
    return merged_references(member_references(lines, F.col("order_paid_date").alias("first_paid"), *flags))


def merged_references(references: DataFrame) -> DataFrame:
    """References that may repeat, added up: the first day and everything that was bought."""
    flags = [c for c in references.columns if c not in (*REFERENCE, "first_paid")]
    return references.groupBy(*REFERENCE).agg(F.min("first_paid").alias("first_paid"), *(F.max(f).alias(f) for f in flags))


def people_of(references: DataFrame, crm: DataFrame) -> DataFrame:
    """One row per order city and member id, from the rows of :func:`purchase_references`."""
    flags = [c for c in references.columns if c not in (*REFERENCE, "first_paid")]
    people = resolve_identity(references, crm)
    return people.groupBy(F.col("order_city").alias("city"), "omni_member_id").agg(
        F.min("first_paid").alias("first_paid"), *(F.max(F.coalesce(f, F.lit(False))).alias(f) for f in flags)
    )


def buyer_profiles(orders: DataFrame, crm: DataFrame, lists: Mapping[str, AdultList]) -> DataFrame:
    """One row per order city and member id, with ``<name>_bought_kids`` and ``<name>_bought_adult`` for each list."""
    return people_of(purchase_references(orders, lists), crm).drop("first_paid")


def _distinct_members(condition: str) -> Column:
    return F.expr(f"count(distinct omni_member_id) filter (where {condition})")


def kids_adult_shoppers(profile: DataFrame, segment: str) -> DataFrame:
    """Distinct members who bought a kids product, and who bought an adult product; one may be in both."""
    return profile.groupBy(segment).agg(
        _distinct_members("bought_kids").alias("ttl_kids_member_shopper"),
        _distinct_members("bought_adult").alias("ttl_adult_member_shopper"),
    )


def new_shopper_share(profile: DataFrame, segment: str) -> DataFrame:
    """Share of this year's shoppers who registered this year."""
    share = safe_div(_distinct_members("new_ty"), _distinct_members("shopped_ty"))
    return profile.groupBy(segment).agg(share.alias("new_member_shopper_share_YTD"))


# -- member base ----------------------------------------------------------------------------------


def registered_in_stores(members: DataFrame) -> DataFrame:
    return members.filter(F.col("eff_reg_channel").contains(fixed.STORE_MARK))


def registered_by_city(members: DataFrame, bands: CityBands) -> DataFrame:
    """(city of the member, member id) of those who registered in a store of a city with a band."""
    kept = lookup_join(
        registered_in_stores(members), bands.typed_stores, {"eff_reg_store": "store_code"}, how="left_semi"
    )
    return kept.select(F.col("city_cn").alias("city"), F.col("member_detail_id").cast("string").alias("omni_member_id"))


def located_registrants(located: DataFrame, members: DataFrame) -> DataFrame:
    """Distinct (city, member id) of located members who registered in the mini program."""
    places = located.select(
        F.col("city_cn").alias("city"), canonical_id(F.col("crm_member_id")).alias("omni_member_id")
    ).distinct()
    registrants = registered_through(members, fixed.MINI_PROGRAM_MARK)
    return places.join(registrants, places.omni_member_id == registrants.member_id, "left_semi")


MARKS = ("counted", "buyer", "bought", "located")


def member_rows(
    registered: DataFrame, buyers: DataFrame, located: DataFrame, segment: str, flags: tuple[str, ...]
) -> DataFrame:
    """The rows of the three member sources, marked with what each says about its member in the segment.

    Each source has ``segment`` and ``omni_member_id``.  ``buyers`` also has the ``flags`` to count and
    ``counted``: buyers outside the counted cities only matter because a located member who bought anywhere
    is no member of the third source.
    """
    no, yes = F.lit(False), F.lit(True)
    sources = (
        buyers.withColumns({"bought": yes, "located": no, "buyer": F.col("counted")}),
        registered.withColumns({"bought": no, "located": no, "buyer": no, "counted": yes, **dict.fromkeys(flags, no)}),
        located.withColumns({"bought": no, "located": yes, "buyer": no, "counted": no, **dict.fromkeys(flags, no)}),
    )
    marks = (*MARKS, *flags)
    rows = sources[0].select(segment, "omni_member_id", *marks)
    for source in sources[1:]:
        rows = rows.unionByName(source.select(segment, "omni_member_id", *marks))
    return rows


def _counted_once(rows: DataFrame, flags: tuple[str, ...], *keys: str, segment: str) -> DataFrame:
    """One row per segment and id that counts there.

    The rows are reduced to one per segment and id, so the window that spreads "ever bought" over the rows of
    an id never holds more rows than there are segments.
    """
    people = rows.groupBy(segment, *keys).agg(*(F.max(m).alias(m) for m in (*MARKS, *flags)))
    ever_bought = F.max("bought").over(Window.partitionBy(*keys))
    return people.withColumn("_ever_bought", ever_bought).filter(
        F.col("counted") | (F.col("located") & ~F.col("_ever_bought"))
    )


def _member_counts(flags: tuple[str, ...]) -> list[Column]:
    """Member base, and one count per flag, NULL without counted buyers."""
    id_ = F.col("omni_member_id")
    buyers = (F.count(F.when(F.col("buyer") & F.col(f), id_)).alias(f) for f in flags)
    return [F.count(id_).alias("ttl_member_base"), *(F.when(F.max("buyer"), n).alias(f) for f, n in zip(flags, buyers))]


def member_segments(
    registered: DataFrame, buyers: DataFrame, located: DataFrame, segment: str, flags: tuple[str, ...]
) -> DataFrame:
    """Member base and shopper counts per segment from one pass over the sources of :func:`member_rows`.

    Result: ``ttl_member_base`` and one count per flag, NULL for a segment without counted buyers.
    """
    rows = member_rows(registered, buyers, located, segment, flags)
    members = _counted_once(rows, flags, "omni_member_id", segment=segment)
    return members.groupBy(segment).agg(*_member_counts(flags))


def city_measures(
    members: DataFrame, stores: DataFrame, registrations: DataFrame, visitors: DataFrame, flags: tuple[str, ...]
) -> DataFrame:
    """Members, shoppers, open stores, new registrations and visitors of every city with members.

    ``members`` are :func:`member_rows` by ``city``; ``stores`` and ``registrations`` are (city_cn, id) that may
    repeat; ``visitors`` are daily rows.  All that is counted is brought to one row per city, kind and id by one
    aggregation, and all measures come from one more, in which the visitors are added up; nothing is joined.  A city
    without rows of a source has NULL there.  Stores, registrations and visitors without a city count nowhere.
    """
    kinds = {"store_id": stores, "registered_id": registrations}
    ids = ("omni_member_id", *kinds)
    rows = members
    for name, found in kinds.items():
        city, key = found.columns
        marks = [F.lit(m in ("counted", name)).alias(m) for m in (*MARKS, *flags)]
        kind = found.filter(F.col(city).isNotNull()).select(
            F.col(city).alias("city"), F.lit(name).alias("_kind"), F.col(key).cast("string").alias(name), *marks
        )
        rows = rows.unionByName(kind, allowMissingColumns=True)
    counted = _counted_once(rows, flags, "_kind", *ids, segment="city")
    daily = visitors.filter(F.col("city_cn").isNotNull()).withColumnRenamed("city_cn", "city")

    def entities(name: str) -> Column:
        return F.when(F.max(F.col("_kind") == name), F.count(name))

    # Rows of members have no kind, but marks.
    is_member = F.col("_kind").isNull() & F.col("counted").isNotNull()
    found = counted.unionByName(daily, allowMissingColumns=True).groupBy("city").agg(
        F.max(is_member).alias("_listed"),
        *_member_counts(flags),
        entities("store_id").alias("current_LCS_store_count"),
        entities("registered_id").alias("LCS_new_reg"),
        F.sum("traffic_TY_YTD").alias("traffic_TY_YTD"),
        F.sum("traffic_LY_YTD").alias("traffic_LY_YTD"),
    )
    return found.filter("_listed").drop("_listed")


# -- stores, footfall, registrations --------------------------------------------------------------


def open_store_rows(stores: DataFrame) -> DataFrame:
    return stores.filter(
        (F.col("store_status") == fixed.OPEN_STATUS) & F.col("distributor").contains(fixed.STORE_MARK)
    ).select("city_cn", "store_code")


def open_stores(stores: DataFrame) -> DataFrame:
    """Distinct open stores per city."""
    return open_store_rows(stores).groupBy("city_cn").agg(F.count_distinct("store_code").alias("current_LCS_store_count"))


def _counted(daily: DataFrame, agg_type: str) -> DataFrame:
    return daily.filter((F.col("agg_type") == agg_type) & F.col("distributor").contains(fixed.STORE_MARK))


def footfall_rows(daily: DataFrame, as_of: date, agg_type: str) -> DataFrame:
    """Visitors of each counted row of this year or of last year to 365 days ago, by year.

    Only the two windows are read.
    """
    window = ytd_window(as_of, ly_days=365)
    day = F.col("date_id")

    def visitors(within: Column) -> Column:
        return F.when(within, F.col("traffic_amt")).otherwise(F.lit(0))

    return _counted(daily, agg_type).filter(in_window(day, window)).select(
        "city_cn",
        visitors(in_this_year(day, window)).alias("traffic_TY_YTD"),
        visitors(in_last_year(day, window)).alias("traffic_LY_YTD"),
    )


def footfall(daily: DataFrame, as_of: date, agg_type: str) -> DataFrame:
    """Visitors of both windows, of cities with a counted row in either."""
    years = ("traffic_TY_YTD", "traffic_LY_YTD")
    return footfall_rows(daily, as_of, agg_type).groupBy("city_cn").agg(*(F.sum(y).alias(y) for y in years))


def traffic_growth(daily: DataFrame, as_of: date, agg_type: str) -> DataFrame:
    """Footfall of both windows and its change; cities that were only counted in other years are listed with 0."""
    visitors = footfall(daily, as_of, agg_type).withColumnRenamed("city_cn", "_city")
    cities = _counted(daily, agg_type).select("city_cn").distinct()
    counted = cities.join(visitors, cities.city_cn.eqNullSafe(visitors["_city"]), "left").fillna(
        0, ["traffic_TY_YTD", "traffic_LY_YTD"]
    )
    return counted.select(
        "city_cn",
        as_double(F.col("traffic_TY_YTD")).alias("traffic_TY_YTD"),
        as_double(F.col("traffic_LY_YTD")).alias("traffic_LY_YTD"),
        change_ratio(F.col("traffic_TY_YTD"), F.col("traffic_LY_YTD")).alias("LCS_YTD_traffic_growth"),
    )


def new_registration_rows(members: DataFrame, stores: DataFrame, as_of: date) -> DataFrame:
    """Members who registered in a store this year, with the city of that store; unknown stores have no city."""
    joined_ty = registered_in_stores(members).filter(in_this_year(F.col("join_time"), ytd_window(as_of)))
    places = stores.select("store_code", F.col("city_cn").alias("store_city")).distinct()
    located = lookup_join(
        joined_ty.select("member_detail_id", "eff_reg_store"), places, {"eff_reg_store": "store_code"}
    )
    return located.select(F.col("store_city").alias("city_cn"), "member_detail_id")


def new_registrations(members: DataFrame, stores: DataFrame, as_of: date) -> DataFrame:
    """Distinct members who registered in a store this year, per city of that store.

    Members whose store is unknown form a group without a city.
    """
    rows = new_registration_rows(members, stores, as_of)
    return rows.groupBy("city_cn").agg(F.count_distinct("member_detail_id").alias("LCS_new_reg"))


def registration_rate(members: DataFrame, stores: DataFrame, daily: DataFrame, as_of: date, agg_type: str) -> DataFrame:
    """New registrations per visitor of this year."""
    registered = new_registrations(members, stores, as_of)
    visitors = footfall(daily, as_of, agg_type).select(F.col("city_cn").alias("_city"), "traffic_TY_YTD")
    return registered.join(visitors, registered.city_cn == visitors["_city"], "left").select(
        "city_cn",
        "LCS_new_reg",
        safe_div(F.col("LCS_new_reg"), F.col("traffic_TY_YTD")).alias("LCS_YTD_regisration_rate"),
    )


# -- population -----------------------------------------------------------------------------------


def population_by_maturity(population: DataFrame) -> DataFrame:
    return population.groupBy(
        band_of_level(F.col("city_maturity_level"), fixed.UNSPECIFIED_BAND).alias("city_maturity_level")
    ).agg(
        F.sum("target_kids_population").alias("target_kids_population"),
        F.sum("adult_shopper_population").alias("adult_shopper_population"),
    )


def penetration_columns() -> dict[str, Column]:
    """Member counts relative to the two populations."""
    kids, adult = F.col("target_kids_population"), F.col("adult_shopper_population")
    base = F.col("ttl_member_base")
    return {
        "member_base_penetration_target_kids_shopper": safe_div(base, kids),
        "member_base_penetration_Y18_45_without_0_14_kids": safe_div(base, adult),
        "Kids_member_shopper_penetration": safe_div(F.col("ttl_kids_member_shopper"), kids),
        "adult_member_shopper_penetration": safe_div(F.col("ttl_adult_member_shopper"), adult),
    }


def all_members(members: DataFrame, belong: DataFrame) -> DataFrame:
    """One row: members, plus linked accounts without a member, counted per marketplace."""
    registered = members.agg(F.count("member_detail_id").alias("member_count"))
    unlinked = belong.filter(
        (F.col("belong_type") == fixed.LINK_BELONG_TYPE)
        & F.col("member_detail_id").isNull()
        & F.col("eff_belong_channel").isin(*fixed.LINK_CHANNELS)
    )
    linked = unlinked.select("eff_belong_channel", "platform_id_value").distinct()
    counts = registered.unionByName(linked.agg(F.count("platform_id_value").alias("member_count")))
    return counts.agg(F.sum("member_count").alias("ttl_member_base"))
