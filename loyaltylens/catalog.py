"""The registered queries: every operator and report over the generated tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loyaltylens.functions import exprs, fixed, periods
from loyaltylens.operators import bitmaps, cities, identity, kpis
from loyaltylens.operators import penetration as ops
from loyaltylens.operators.joins import lookup_join
from loyaltylens.plans import location, penetration, scorecards, state
from loyaltylens.sources import rejects
from loyaltylens.sources.retail_binding import AS_OF, FOOTFALL_ROWS, RetailBinding
from loyaltylens.sources.tables import current, refresh, with_audit_columns

# Where the queries over saved state split the days into two runs.
FIRST_ORDER_DAYS = date(2000, 3, 31)
FIRST_LOG_DAYS, LAST_LOG_DAY = date(2024, 1, 15), date(2999, 12, 31)

Query = Callable[[RetailBinding], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(RetailBinding(spark, sf_dir))

    return {name: runner(build) for name, build in _QUERIES.items()}


def _lines(name: str = "line_count") -> Column:
    return F.count(F.lit(1)).alias(name)


def _day(column: str) -> Column:
    return F.col(column).cast("date").alias(column)


# -- scans, projections, filters -------------------------------------------------------------------


@query
def scan_project(t: RetailBinding) -> DataFrame:
    return t.raw("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("member_id"),
        F.col("o_orderdate").cast("date").alias("paid_on"), F.col("o_orderstatus").alias("status"),
    )


@query
def star_join(t: RetailBinding) -> DataFrame:
    mapping = t["segment_map"].select(F.col("prop_key").alias("_segment"), "city_cn")
    joined = lookup_join(t["prop_log"].alias("base"), mapping, {"prop_key": "_segment"}, how="inner")
    return joined.select("base.*", "city_cn").withColumn("update_time", _day("update_time"))


@query
def filter_basic(t: RetailBinding) -> DataFrame:
    kept = t["member_orders"].filter(
        (F.col("is_rrp_sales_type") == fixed.RRP_SALES_TYPE) & (F.col("distributor_name") != fixed.EXCLUDED_DISTRIBUTOR)
    )
    return kept.groupBy("city_cn", "distributor_name").agg(_lines())


@query
def filter_like(t: RetailBinding) -> DataFrame:
    channel = F.col("eff_reg_channel")
    kept = t["member"].filter(channel.like("%LCS%") | channel.like("%WMP%"))
    return kept.select("member_detail_id", "city_cn", "eff_reg_channel")


@query
def filter_in_list(t: RetailBinding) -> DataFrame:
    kept = t["omni"].filter(
        F.col("source_channel").isin(*fixed.ALL_CHANNELS) & F.col("type_name").isin(*fixed.MEMBER_ID_KINDS)
    )
    return kept.groupBy("source_channel", "type_name").agg(_lines())


@query
def filter_null(t: RetailBinding) -> DataFrame:
    with_member = t["member_orders"].filter(F.col("crm_member_id").isNotNull()).groupBy("city_cn").agg(_lines())
    no_city = t["omni"].filter(F.col("order_city").isNull()).groupBy("source_channel").agg(_lines())
    return with_member.select(F.col("city_cn").alias("name"), "line_count").unionByName(
        no_city.select(F.col("source_channel").alias("name"), "line_count")
    )


@query
def filter_bool(t: RetailBinding) -> DataFrame:
    return t["omni"].filter(exprs.effective_member_order()).groupBy("order_city").agg(_lines())


@query
def filter_asof(t: RetailBinding) -> DataFrame:
    return t["omni"].filter(F.col("order_paid_date") < F.lit(AS_OF)).groupBy("source_channel").agg(
        _lines(), F.max("order_paid_date").alias("last_day")
    )


@query
def eligible_orders(t: RetailBinding) -> DataFrame:
    counted = identity.eligible_orders(t["omni"], AS_OF, members_only=False)
    return counted.groupBy("source_channel", "order_city").agg(
        _lines(), F.sum(exprs.effective_member_order().cast("bigint")).alias("member_line_count")
    )


@query
def ytd_window(t: RetailBinding) -> DataFrame:
    parts = []
    for rule, window in {
        "open": periods.ytd_window(AS_OF),
        "closed": periods.ytd_window(AS_OF, ty_open=False),
        "365 days": periods.ytd_window(AS_OF, ly_days=365),
    }.items():
        sold = F.col("order_paid_date")
        rows = t["omni"].filter(periods.in_window(sold, window))
        parts.append(
            rows.groupBy(F.lit(rule).alias("rule"), periods.period_of(sold, window).alias("period")).agg(
                _lines(), F.min(sold).alias("first_day"), F.max(sold).alias("last_day")
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def distinct_dim(t: RetailBinding) -> DataFrame:
    return t["store"].select("city_cn", "store_status", "distributor").distinct()


# -- scalar functions ------------------------------------------------------------------------------


@query
def safe_ratio(t: RetailBinding) -> DataFrame:
    return t["offline_mart"].select(
        "city_cn", "date_id", exprs.safe_div(F.col("gmv_rsp"), F.col("return_gmv_rsp")).alias("gross_per_return")
    )


@query
def cast_suite(t: RetailBinding) -> DataFrame:
    padded = F.concat(F.lit("00"), F.col("id").cast("string"))
    return t["crm"].select(
        F.col("id").cast("string").alias("id_text"),
        padded.alias("padded"),
        exprs.canonical_id(padded).alias("canonical"),
        exprs.whole_number_id(F.concat(F.lit("x"), padded)).alias("not_a_number"),
        F.col("id").cast("double").alias("id_double"),
        F.col("join_time").cast("string").alias("joined_text"),
    )


@query
def date_suite(t: RetailBinding) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t.raw("orders").select(day.alias("day")).distinct().select(
        "day",
        F.year("day").cast("bigint").alias("year"),
        F.add_months("day", -12).alias("year_before"),
        F.date_sub("day", 365).alias("days_before"),
        F.when(F.col("day") < F.lit(AS_OF), 1).otherwise(0).cast("bigint").alias("before_as_of"),
        F.date_format("day", "yyyyMMdd").alias("batch_day"),
    )


@query
def age_mark_parse(t: RetailBinding) -> DataFrame:
    return t["product"].select("sku_id", "age_mark", exprs.age_years(F.col("age_mark")).alias("years"))


@query
def audit_columns(t: RetailBinding) -> DataFrame:
    return with_audit_columns(ops.open_stores(t["store"]), AS_OF).drop("dl_load_time")


@query
def net_sales(t: RetailBinding) -> DataFrame:
    online = t["omni"].groupBy(F.coalesce("order_city", F.lit("none")).alias("city")).agg(
        exprs.as_double(F.sum(exprs.net_amount(F.col("sales_qty"), F.col("order_rrp_amt")))).alias("net")
    )
    offline = t["offline_mart"].groupBy(F.col("city_cn").alias("city")).agg(
        exprs.as_double(F.sum("gmv_rsp") - F.sum("return_gmv_rsp")).alias("net")
    )
    return online.withColumn("channel", F.lit("orders")).unionByName(offline.withColumn("channel", F.lit("stores")))


# -- lookups and labels ----------------------------------------------------------------------------


@query
def city_maturity_lookup(t: RetailBinding) -> DataFrame:
    return cities.city_maturity(t["store"], t["city_type"])


@query
def city_tier_lookup(t: RetailBinding) -> DataFrame:
    stores = t["store"].groupBy("city_cn").agg(F.count(F.lit(1)).alias("stores"))
    return cities.tier_labelled(stores, cities.city_tiers(t["city_tier"]), city="city_cn", total=False)


@query
def segment_labels(t: RetailBinding) -> DataFrame:
    lines = t["omni"].groupBy("order_city").agg(_lines())
    bands = cities.city_bands(t["store"], t["city_type"])
    tiers = cities.city_tiers(t["city_tier"])
    labelled = cities.maturity_labelled(
        lines, bands, city="order_city", missing_city=fixed.NO_ORDER_CITY, total=False
    ).withColumnRenamed("city_maturity_type", "online_band")
    labelled = cities.maturity_labelled(labelled, bands, city="order_city", total=False).withColumnRenamed(
        "city_maturity_type", "offline_band"
    )
    labelled = cities.tier_labelled(labelled, tiers, city="order_city", total=False)
    return labelled.select("order_city", "online_band", "offline_band", "city_tier", "line_count")


@query
def calendar_enrich(t: RetailBinding) -> DataFrame:
    orders = t["omni"].select("parent_order_id", "order_paid_date", "first_bind_time").distinct()
    days = identity.calendar_days(t["calendar"], AS_OF)
    dated = identity.with_calendar(orders, days, "order_paid_date", "trans")
    return identity.with_calendar(dated, days, "first_bind_time", "reg")


@query
def sales_by_tier(t: RetailBinding) -> DataFrame:
    lines = t["omni"].filter(exprs.eligible((fixed.ONLINE_CHANNEL,), AS_OF))
    labelled = cities.tier_labelled(lines, cities.city_tiers(t["city_tier"]), city="order_city", total=False)
    return labelled.groupBy("city_tier").agg(
        exprs.as_double(F.sum(exprs.net_amount(F.col("sales_qty"), F.col("order_rrp_amt")))).alias("sales_rrp"),
        F.count_distinct(F.when(F.col("if_eff_order_tag"), F.col("parent_order_id"))).alias("transactions"),
    )


def _tier_orders(t: RetailBinding) -> DataFrame:
    lines = kpis.online_lines(t["omni"], AS_OF, kpis.online_window(AS_OF)).filter(F.col("period") == periods.TY)
    return cities.tier_labelled(lines, cities.city_tiers(t["city_tier"]), city="city", total=False)


def _sales_columns() -> list[Column]:
    return [
        exprs.as_double(F.sum("amount")).alias("sales_rrp"),
        F.expr("count(distinct order_id) filter (where effective)").alias("transactions"),
    ]


@query
def total_row_union(t: RetailBinding) -> DataFrame:
    lines = _tier_orders(t)
    total = lines.groupBy(F.lit(fixed.TOTAL).alias("city_tier")).agg(*_sales_columns())
    return lines.groupBy("city_tier").agg(*_sales_columns()).unionByName(total)


@query
def total_row_rollup(t: RetailBinding) -> DataFrame:
    tier = F.col("city_tier")
    sets = _tier_orders(t).groupingSets([[tier], []], tier).agg(
        F.grouping_id().alias("is_total"), _lines(), *_sales_columns()
    )
    # Without orders there is no total row, as with a literal group key.
    label = F.when(F.col("is_total") == 1, F.lit(fixed.TOTAL)).otherwise(tier)
    return sets.filter("line_count > 0").select(label.alias("city_tier"), "sales_rrp", "transactions")


# -- latest rows -----------------------------------------------------------------------------------


@query
def latest_batch_rank(t: RetailBinding) -> DataFrame:
    rows = location.newest_segment_rows(t["prop_log"], t["segment_map"])
    return rows.select("prop_key", "city_cn", "gio_id", _day("update_time"))


@query
def latest_per_pair(t: RetailBinding) -> DataFrame:
    return location.segment_users(t["prop_log"], t["segment_map"])


@query
def latest_attribute(t: RetailBinding) -> DataFrame:
    return location.latest_attribute(t["prop_log"], fixed.CRM_ID_PROPERTY)


@query
def lbs_city_member(t: RetailBinding) -> DataFrame:
    return t["located"]


# -- members ---------------------------------------------------------------------------------------


@query
def identity_resolve(t: RetailBinding) -> DataFrame:
    return identity.member_cities(t["omni"], t["crm"])


@query
def omni_fact(t: RetailBinding) -> DataFrame:
    fact = identity.omni_fact(t["omni"], t["crm"], t["calendar"], AS_OF, (fixed.ONLINE_CHANNEL,))
    return fact.withColumns(
        {
            "order_rrp_amt": exprs.as_double(F.col("order_rrp_amt")),
            "if_eff_order_tag": F.col("if_eff_order_tag").cast("bigint"),
            "is_member_order": F.col("is_member_order").cast("bigint"),
        }
    )


@query
def member_transactions(t: RetailBinding) -> DataFrame:
    bands = cities.city_bands(t["store"], t["city_type"])
    return identity.member_transactions(t["omni"], t["crm"], t["calendar"], bands, AS_OF)


def _bands(t: RetailBinding) -> cities.CityBands:
    return cities.city_bands(t["store"], t["city_type"])


def _buyers(t: RetailBinding, *, with_years: bool = False) -> DataFrame:
    return penetration.buyers(t, AS_OF, ops.adult_skus(t["product"]), with_years=with_years)


def _typed_buyers(t: RetailBinding, *, with_years: bool = False) -> DataFrame:
    typed = _bands(t).typed_cities
    return lookup_join(_buyers(t, with_years=with_years), typed, {"city": "city_cn"}, how="left_semi")


@query
def registered_not_purchased(t: RetailBinding) -> DataFrame:
    purchasers = identity.member_cities(identity.eligible_orders(t["omni"], AS_OF), t["crm"])
    return identity.registered_not_purchased(t["member"], purchasers)


@query
def lbs_only_members(t: RetailBinding) -> DataFrame:
    purchasers = identity.member_cities(identity.eligible_orders(t["omni"], AS_OF), t["crm"])
    return identity.located_never_bought(
        t["located"], identity.registered_not_purchased(t["member"], purchasers)
    )


@query
def member_base_city(t: RetailBinding) -> DataFrame:
    return penetration.city_members(t, _buyers(t), _bands(t)).select(F.col("city").alias("city_cn"), "ttl_member_base")


@query
def member_base_maturity(t: RetailBinding) -> DataFrame:
    return penetration.maturity_members(t, _buyers(t), _bands(t)).select("city_maturity_type", "ttl_member_base")


@query
def adult_sku_from_age(t: RetailBinding) -> DataFrame:
    return ops.adult_skus(t["product"]).found.distinct()


@query
def kids_adult_split(t: RetailBinding) -> DataFrame:
    return ops.kids_adult_shoppers(_typed_buyers(t), "city").withColumnRenamed("city", "city_cn")


@query
def kids_adult_split_portfolio(t: RetailBinding) -> DataFrame:
    profile = penetration.buyers(t, AS_OF, ops.adult_portfolio(t["portfolio"]))
    labelled = cities.maturity_labelled(profile, _bands(t), city="city", total=False)
    return ops.kids_adult_shoppers(labelled, "city_maturity_type")


@query
def new_shopper_share(t: RetailBinding) -> DataFrame:
    return ops.new_shopper_share(_typed_buyers(t, with_years=True), "city").withColumnRenamed("city", "city_cn")


# -- stores, footfall, registrations, penetration --------------------------------------------------


@query
def open_store_count(t: RetailBinding) -> DataFrame:
    return ops.open_stores(t["store"])


@query
def traffic_growth(t: RetailBinding) -> DataFrame:
    return ops.traffic_growth(t["traffic"], AS_OF, FOOTFALL_ROWS)


@query
def registration_rate(t: RetailBinding) -> DataFrame:
    return ops.registration_rate(t["member"], t["store"], t["traffic"], AS_OF, FOOTFALL_ROWS)


@query
def member_kpis_city(t: RetailBinding) -> DataFrame:
    return penetration.member_kpis_city(t, AS_OF, FOOTFALL_ROWS)


@query
def penetration_city(t: RetailBinding) -> DataFrame:
    return penetration.penetration_city(t, AS_OF)


@query
def population_maturity(t: RetailBinding) -> DataFrame:
    return ops.population_by_maturity(t["population"])


@query
def penetration_maturity(t: RetailBinding) -> DataFrame:
    return penetration.penetration_maturity(t, AS_OF)


@query
def totals_rows(t: RetailBinding) -> DataFrame:
    profile = penetration.buyers(t, AS_OF, ops.adult_portfolio(t["portfolio"]))
    report = penetration.with_total_rows(penetration.maturity_members(t, profile, _bands(t)), t)
    return report.filter(F.col("city_maturity_type").isin(fixed.ALL_WITH_CITY, fixed.ALL_MEMBERS))


# -- sales and member KPIs -------------------------------------------------------------------------


def _flag_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("city", "period").agg(
        F.count(F.lit(1)).alias("order_rows"),
        F.sum(F.col("is_new").cast("bigint")).alias("new_rows"),
        F.expr("count(distinct member_id) filter (where is_new)").alias("new_members"),
    )


@query
def new_member_flag_offline(t: RetailBinding) -> DataFrame:
    return _flag_counts(scorecards.flagged_orders(t, "offline", "tier", AS_OF))


@query
def new_member_flag_online(t: RetailBinding) -> DataFrame:
    return _flag_counts(scorecards.flagged_orders(t, "online", "tier", AS_OF))


@query
def conditional_distinct(t: RetailBinding) -> DataFrame:
    return scorecards.order_measures(t, "online", "city", AS_OF).select(
        "city", "period", "orders", "member_orders", "member_shoppers", "new_orders", "new_shoppers",
        "existing_orders", "existing_shoppers",
    )


@query
def atv_frequency(t: RetailBinding) -> DataFrame:
    kpi = kpis.member_kpis(scorecards.order_measures(t, "online", "tier", AS_OF), "city_tier")
    return kpi.select("city_tier", "period", "member_atv", "member_frequency")


def _sales(t: RetailBinding, channel: str, grain: str) -> DataFrame:
    totals = scorecards.sales(t, channel, grain, AS_OF).withColumn("sales_rrp", exprs.as_double(F.col("sales_rrp")))
    if "traffic" in totals.columns:
        totals = totals.withColumn("traffic", exprs.as_double(F.col("traffic")))
    return totals


def _channel_measures(t: RetailBinding, channel: str) -> DataFrame:
    measures = scorecards.channel_measures(t, channel, AS_OF)
    return measures.withColumns({c: exprs.as_double(F.col(c)) for c in kpis.MEASURES if c.endswith("net")})


@query
def channel_measures_online(t: RetailBinding) -> DataFrame:
    return _channel_measures(t, "online")


@query
def channel_measures_offline(t: RetailBinding) -> DataFrame:
    return _channel_measures(t, "offline")


DISTINCT_SETS = ("orders", "member_orders", "member_shoppers")


def _monthly_bitmaps(t: RetailBinding) -> DataFrame:
    """City, month and bitmaps of the online orders and member shoppers of all years."""
    kept = t["omni"].filter(exprs.eligible((fixed.ONLINE_CHANNEL,), AS_OF) & F.col("if_eff_order_tag"))
    lines = kept.select(
        F.col("order_city").alias("city"), F.date_format("order_paid_date", "yyyy-MM").alias("month"),
        "parent_order_id", "kyid", F.coalesce("is_member_order", F.lit(False)).alias("is_member"),
    ).distinct()
    for key, name in (("parent_order_id", "order_number"), ("kyid", "member_number")):
        lines = bitmaps.with_number(lines, bitmaps.numbered(lines, key, "city"), key, name)
    member = F.col("is_member")
    sets = {
        "orders": ("order_number", F.lit(True)),
        "member_orders": ("order_number", member),
        "member_shoppers": ("member_number", member),
    }
    return bitmaps.distinct_bitmaps(lines, ["city", "month"], sets)


@query
def distinct_by_city_month(t: RetailBinding) -> DataFrame:
    """Distinct counts per city and month."""
    return bitmaps.distinct_counts(_monthly_bitmaps(t), ["city", "month"], DISTINCT_SETS)


@query
def distinct_merged_by_tier_year(t: RetailBinding) -> DataFrame:
    """The same bitmaps merged to tiers, a total and years: nothing is counted twice and no order is read for it."""
    yearly = bitmaps.merged(_monthly_bitmaps(t).withColumn("year", F.left("month", F.lit(4))), ["city", "year"], DISTINCT_SETS)
    labelled = cities.tier_labelled(yearly, cities.city_tiers(t["city_tier"]), city="city")
    return bitmaps.distinct_counts(labelled, ["city_tier", "year"], DISTINCT_SETS)


@query
def sales_ty_online(t: RetailBinding) -> DataFrame:
    return _sales(t, "online", "tier")


@query
def sales_online_maturity(t: RetailBinding) -> DataFrame:
    return _sales(t, "online", "maturity")


@query
def sales_online_city(t: RetailBinding) -> DataFrame:
    return _sales(t, "online", "city")


@query
def sales_ty_offline(t: RetailBinding) -> DataFrame:
    return _sales(t, "offline", "tier")


@query
def sales_offline_maturity(t: RetailBinding) -> DataFrame:
    return _sales(t, "offline", "maturity")


@query
def sales_offline_city(t: RetailBinding) -> DataFrame:
    return _sales(t, "offline", "city")


@query
def yoy_join(t: RetailBinding) -> DataFrame:
    both = kpis.compare_periods(scorecards.sales(t, "online", "city", AS_OF), "city", ("sales_rrp", "transactions"))
    growth = kpis.sales_growth_columns("sales_rrp", "transactions")
    return both.select("city", *(c.alias(n) for n, c in growth.items()))


@query
def member_kpi_offline(t: RetailBinding) -> DataFrame:
    measures = scorecards.order_measures(t, "offline", "maturity", AS_OF)
    return kpis.member_kpis(measures, "city_maturity_type")


@query
def member_kpi_online(t: RetailBinding) -> DataFrame:
    measures = scorecards.order_measures(t, "online", "maturity", AS_OF)
    return kpis.member_kpis(measures, "city_maturity_type", existing_shares=True)


@query
def kpi_vs_ly(t: RetailBinding) -> DataFrame:
    return kpis.kpi_vs_ly(scorecards.order_measures(t, "offline", "tier", AS_OF), "city_tier")


@query
def scorecard_offline_city(t: RetailBinding) -> DataFrame:
    return scorecards.scorecard(t, "offline", "city", AS_OF)


@query
def scorecard_offline_maturity(t: RetailBinding) -> DataFrame:
    return scorecards.scorecard(t, "offline", "maturity", AS_OF)


@query
def scorecard_offline_tier(t: RetailBinding) -> DataFrame:
    return scorecards.scorecard(t, "offline", "tier", AS_OF)


@query
def scorecard_online_city(t: RetailBinding) -> DataFrame:
    return scorecards.scorecard(t, "online", "city", AS_OF)


@query
def scorecard_online_maturity(t: RetailBinding) -> DataFrame:
    return scorecards.scorecard(t, "online", "maturity", AS_OF)


@query
def scorecard_online_tier(t: RetailBinding) -> DataFrame:
    return scorecards.scorecard(t, "online", "tier", AS_OF)


@query
def scorecard_online_city_as_published(t: RetailBinding) -> DataFrame:
    return scorecards.scorecard(t, "online", "city", AS_OF, as_published=True)


@query
def scorecard_online_tier_as_published(t: RetailBinding) -> DataFrame:
    return scorecards.scorecard(t, "online", "tier", AS_OF, as_published=True)


# -- writing ---------------------------------------------------------------------------------------


def _shared(t: RetailBinding) -> str:
    """A new folder in the one that ``spark.checkpoint.dir`` names; a temporary one only where that is unset, as in tests."""
    shared = t["store"].sparkSession.sparkContext.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="refresh-")
    return f"{shared}/refresh_{uuid.uuid4().hex}"


def _loaded(written: DataFrame) -> DataFrame:
    return written.withColumn("loaded", F.col("dl_load_time").isNotNull().cast("bigint")).drop("dl_load_time")


# These write while they are built, in the folder that ``spark.checkpoint.dir`` names or the session's catalog.
WRITERS = {
    "refresh_round_trip", "refresh_table_round_trip", "located_from_state", "registered_not_purchased_from_state",
    "member_base_from_state",
}


@query
def refresh_round_trip(t: RetailBinding) -> DataFrame:
    """Member purchases written twice and read back: the second content replaces the first one whole."""
    report, target = member_transactions(t), _shared(t)
    refresh(report.filter("trans_fiscal_year < 1995"), target, as_of=AS_OF)
    refresh(report, target, as_of=AS_OF)
    return _loaded(current(report.sparkSession, target))


@query
def refresh_table_round_trip(t: RetailBinding) -> DataFrame:
    """The same into a catalog table whose columns stand in another order."""
    report, name = member_transactions(t), f"purchases_{uuid.uuid4().hex}"
    backwards = report.filter("trans_fiscal_year < 1995").select(*reversed(report.columns))
    refresh(backwards, name, as_table=True, as_of=AS_OF)
    refresh(report, name, as_table=True, as_of=AS_OF, keep=1)
    return _loaded(report.sparkSession.table(name))


# -- state that grows by the day ---------------------------------------------------------------------


@query
def located_from_state(t: RetailBinding) -> DataFrame:
    """Located members from the newest values of two runs; the second one reads the days after the first only."""
    target = _shared(t)
    log = t["prop_log"].withColumn("day", F.col("update_time").cast("date"))
    for until in FIRST_LOG_DAYS, LAST_LOG_DAY:
        state.advance_newest(log, t["segment_map"], target, until)
    return state.located_members(current(log.sparkSession, target), t["segment_map"])


def _purchases_from_state(t: RetailBinding) -> DataFrame:
    target = _shared(t)
    lists = {"age": ops.adult_skus(t["product"])}
    for until in FIRST_ORDER_DAYS, AS_OF - timedelta(days=1):
        state.advance_purchases(t["omni"], lists, target, until)
    return state.buyers(current(t["omni"].sparkSession, target), t["crm"])


@query
def registered_not_purchased_from_state(t: RetailBinding) -> DataFrame:
    """The anti-join reads who ever bought from the state of two runs, no orders."""
    return identity.registered_not_purchased(t["member"], _purchases_from_state(t))


@query
def member_base_from_state(t: RetailBinding) -> DataFrame:
    """Member base and shoppers per city from the state of two runs."""
    profile = penetration.profile_by_age(_purchases_from_state(t))
    return penetration.city_members(t, profile, _bands(t)).withColumnRenamed("city", "city_cn")


# -- rows that do not fit ------------------------------------------------------------------------------


def _raw_lines(t: RetailBinding) -> DataFrame:
    """Order lines as a source may deliver them: all text, with ids of letters, amounts too large and days that are none."""
    return t.raw("orders").selectExpr(
        "case when o_orderstatus = 'P' then concat('C', cast(o_custkey as string)) else cast(o_custkey as string) end member_detail_id",
        "case when o_orderpriority = '1-URGENT' then concat(cast(o_orderkey as string), '0000000000000')"
        " else cast(o_totalprice as string) end order_rrp_amt",
        "case when o_orderkey % 50 = 0 then '2001-02-30' when o_orderkey % 51 = 0 then null"
        " else cast(cast(o_orderdate as date) as string) end order_paid_date",
    )


RAW_SCHEMA = "member_detail_id bigint, order_rrp_amt decimal(18,6), order_paid_date date"


@query
def reject_reasons(t: RetailBinding) -> DataFrame:
    """How many rows do not fit, by column and type, and how many fit."""
    checked = rejects.checked(_raw_lines(t), RAW_SCHEMA)
    counts = rejects.reasons(rejects.rejected(checked)).select("column_name", "expected", "row_count")
    good = rejects.accepted(checked).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.unionByName(good.select(F.lit("all").alias("column_name"), F.lit("fits").alias("expected"), "row_count"))


@query
def accepted_rows(t: RetailBinding) -> DataFrame:
    """The rows that fit, cast."""
    good = rejects.accepted(rejects.checked(_raw_lines(t), RAW_SCHEMA))
    return good.groupBy("order_paid_date").agg(
        _lines(), exprs.as_double(F.sum("order_rrp_amt")).alias("amount"), F.max("member_detail_id").alias("last_member")
    )
