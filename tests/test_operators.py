"""Operators on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from conftest import rows_of

from loyaltylens.operators import cities, identity, joins
from loyaltylens.operators import penetration as ops
from loyaltylens.operators.latest import latest_batch, newest_values
from loyaltylens.plans import location, penetration

NOON, LATER = datetime(2024, 1, 1, 12), datetime(2024, 1, 2, 12)


def log_rows(*rows):
    return [dict(zip(("gio_id", "prop_key", "prop_value", "update_time"), r, strict=True)) for r in rows]


# -- joins -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_lookup_join_is_the_same_shuffled_and_broadcast(spark, how):
    facts = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 50 = 0 then null else concat('k', id % 40) end key")
    lookup = spark.createDataFrame([("hot", "H"), *((f"k{i}", f"v{i}") for i in range(20))], "name string, label string")
    small = joins.lookup_join(facts, lookup.hint("broadcast"), {"key": "name"}, how=how)
    large = joins.lookup_join(facts, lookup.hint("merge"), {"key": "name"}, how=how)
    assert small.columns == large.columns
    assert rows_of(small) == rows_of(large)


def test_flag_join_keeps_every_fact_once(spark):
    facts = spark.createDataFrame([(1, "a", "TY"), (2, None, "TY"), (3, "a", "LY"), (4, "b", "TY")], "order_id int, m string, period string")
    members = spark.createDataFrame([("a", "TY"), ("a", "TY"), (None, "TY"), ("b", "LY")], "member string, period string")
    flagged = joins.flag_join(facts, members, {"m": "member", "period": "period"}, "m", "is_new", ["order_id"])
    assert {(r.order_id, r.is_new) for r in flagged.collect()} == {(1, True), (2, False), (3, False), (4, False)}


# -- latest ----------------------------------------------------------------------------------------


def test_latest_batch_keeps_ties_and_looks_at_the_flag_afterwards(table):
    log = table("prop_log", log_rows((1, "s", "1", NOON), (2, "s", "0", LATER), (3, "s", "1", LATER), (4, "s", "1", None), (5, "other", "1", NOON)))
    segments = table("segment_map", [{"prop_key": "s", "city_cn": "X"}, {"prop_key": "empty", "city_cn": "Y"}])
    newest = latest_batch(log, "prop_key", "update_time", segments)
    assert {r.gio_id for r in newest.collect()} == {"2", "3"}
    assert {r.gio_id for r in location.newest_segment_rows(log, segments).collect()} == {"3"}


def test_newest_values_break_ties_the_same_way(table):
    rows = log_rows((1, "p", "b", LATER), (1, "p", "a", LATER), (1, "p", "c", NOON), (2, "p", "z", None))
    for order in (rows, rows[::-1]):
        newest = newest_values(table("prop_log", order), F.lit(False))
        assert [(r.gio_id, r.prop_value) for r in newest.collect()] == [("1", "a")]


def test_segment_members_takes_one_city_per_segment_and_user(table):
    log = table(
        "prop_log",
        log_rows((1, "s", "1", LATER), (2, "s", "1", LATER), (1, "usr_crm_member_id", "007", NOON), (1, "usr_crm_member_id", "008", LATER), (3, "usr_crm_member_id", "9", NOON)),
    )
    segments = table("segment_map", [{"prop_key": "s", "city_cn": "B"}, {"prop_key": "s", "city_cn": "A"}])
    assert rows_of(location.segment_members(log, segments)) == {("s", "A", "008")}


# -- cities ----------------------------------------------------------------------------------------


def bands_of(table, stores, types):
    return cities.city_bands(
        table("store", [{"store_code": c, "city_cn": n} for c, n in stores]),
        table("city_type", [{"city_chn": c, "city_type": t} for c, t in types]),
    )


def test_labels(spark, table):
    bands = bands_of(table, [(1, "A"), (2, "A"), (3, "B"), (4, None)], [("A", "1_mature"), ("C", "2_core")])
    facts = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "city string")
    online = cities.maturity_labelled(facts, bands, city="city", missing_city="no order city", total=True)
    assert sorted(map(tuple, online.collect()), key=str) == sorted(
        [("A", "1_mature"), ("A", "TTL"), ("B", "4_unspecified"), ("B", "TTL"), ("C", "4_unspecified"), ("C", "TTL"), (None, "no order city"), (None, "TTL")],
        key=str,
    )
    offline = cities.maturity_labelled(facts, bands, city="city", total=False)
    assert rows_of(offline) == {("A", "1_mature"), ("B", "4_unspecified"), ("C", "4_unspecified"), (None, "4_unspecified")}


def test_city_of_two_bands_counts_in_both_but_once_in_the_total(spark, table):
    bands = bands_of(table, [(1, "A")], [("A", "1_mature"), ("A", "2_core")])
    facts = spark.createDataFrame([("A",)], "city string")
    labelled = cities.maturity_labelled(facts, bands, city="city", total=True)
    assert sorted(r.city_maturity_type for r in labelled.collect()) == ["1_mature", "2_core", "TTL"]


def test_no_rows_give_no_total(spark, table):
    bands = bands_of(table, [(1, "A")], [("A", "1_mature")])
    assert cities.maturity_labelled(spark.createDataFrame([], "city string"), bands, city="city").count() == 0


# -- identity --------------------------------------------------------------------------------------


def test_resolve_identity(table):
    omni = table(
        "omni",
        [
            {"parent_order_id": 1, "type_name": "CRM_memberid", "type_value": "v1", "crm_member_detail_id": 10},
            {"parent_order_id": 2, "type_name": "DY_openid", "type_value": "v2", "crm_member_detail_id": 99},
            {"parent_order_id": 3, "type_name": "TMALL_kyid", "type_value": "v3"},
            {"parent_order_id": 4, "type_name": "phone", "type_value": "v4", "crm_member_detail_id": 10},
            {"parent_order_id": 5, "type_name": None, "type_value": "v5"},
        ],
    )
    crm = table("crm", [{"id": 100, "member_id": 10, "join_time": date(2000, 1, 1)}, {"id": 101, "member_id": None}])
    found = {r.parent_order_id: r.omni_member_id for r in identity.resolve_identity(omni, crm).collect()}
    assert found == {"1": "100", "2": "v2", "3": "v3", "4": None, "5": None}


def test_ids_are_compared_as_text(table):
    omni = table("omni", [{"parent_order_id": n, "type_name": "CRM_memberid", "type_value": "v", "crm_member_detail_id": i} for n, i in enumerate(("007", "7", "M001"))])
    crm = table("crm", [{"id": "a", "member_id": "7"}, {"id": "b", "member_id": "M001"}])
    found = {r.parent_order_id: r.omni_member_id for r in identity.resolve_identity(omni, crm).collect()}
    assert found == {"0": "v", "1": "a", "2": "b"}


def test_transactions_are_dated_by_the_paid_time(table):
    order = {"order_city": "A", "type_name": "CRM_memberid", "type_value": "m", "sku_id": 1, "source_channel": "LCS", "sales_type": 1, "is_member_order": True, "if_eff_order_tag": True}
    orders = table("omni", [{**order, "order_paid_date": date(2000, 12, 31), "order_paid_time": datetime(2001, 1, 1, 0, 5)}])
    days = table("calendar", [{"date_id": d, "date_type": "day", "fiscal_year": d.year} for d in (date(2000, 12, 31), date(2001, 1, 1))])
    bands = bands_of(table, [(1, "A")], [("A", "1_mature")])
    found = identity.member_transactions(orders, table("crm", []), days, bands, date(2001, 6, 15)).collect()
    assert [r.trans_fiscal_year for r in found] == [2001]


def test_registered_not_purchased(spark, table):
    members = table("member", [{"member_detail_id": i, "eff_reg_channel": c} for i, c in ((1, "WMP"), (2, "LCS,WMP"), (3, "LCS"), (4, None))])
    buyers = spark.createDataFrame([("2",), ("2",), (None,)], "omni_member_id string")
    assert rows_of(identity.registered_not_purchased(members, buyers)) == {("1",)}


def test_located_ids_match_after_cleaning(spark, table):
    located = table("located", [{"prop_key": "s", "city_cn": "A", "crm_member_id": "007"}, {"prop_key": "t", "city_cn": "A", "crm_member_id": "7"}, {"prop_key": "s", "city_cn": "A", "crm_member_id": "x"}])
    never = spark.createDataFrame([("7",)], "member_id string")
    assert rows_of(identity.located_never_bought(located, never)) == {("A", "7")}


def test_calendar_roles(table, spark):
    calendar = table("calendar", [{"date_id": date(2000, 1, 1), "date_type": "day", "fiscal_year": 1999}, {"date_id": date(2000, 1, 2), "date_type": "week", "fiscal_year": 2000}, {"date_id": date(2000, 1, 3), "date_type": "day", "fiscal_year": 2000}])
    days = identity.calendar_days(calendar, date(2000, 1, 3))
    facts = spark.createDataFrame([(1, date(2000, 1, 1)), (2, date(2000, 1, 2)), (3, date(2000, 1, 3)), (4, None)], "id int, d date")
    found = {r.id: r.x_fiscal_year for r in identity.with_calendar(facts, days, "d", "x").collect()}
    assert found == {1: 1999, 2: None, 3: None, 4: None}


# -- adult lists -----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("adult", "expected"),
    [
        ([1], {(1, True, False), (2, False, True), (None, False, False)}),
        ([1, None], {(1, True, False), (2, False, False), (None, False, False)}),
        ([], {(1, False, True), (2, False, True), (None, False, True)}),
    ],
)
def test_buyer_flags_follow_not_in(spark, table, adult, expected):
    portfolio = table("portfolio", [{"sku_id": s, "kids_vs_adult": "adult product"} for s in adult] + [{"sku_id": 5, "kids_vs_adult": "kids product"}])
    lines = spark.createDataFrame([(1,), (2,), (None,)], "sku_id bigint")
    flagged = ops.with_buyer_flags(lines, ops.adult_portfolio(portfolio))
    assert rows_of(flagged.select("sku_id", "is_adult", "is_kids")) == expected


def test_adult_skus(table):
    marks = ["13+", "12", "1 1/2", "N/A", None, "18"]
    products = table("product", [{"sku_id": i, "age_mark": m} for i, m in enumerate(marks)])
    assert rows_of(ops.adult_skus(products).found) == {("0",), ("5",)}


# -- member base -----------------------------------------------------------------------------------


def test_member_segments(spark):
    schema = "city string, omni_member_id string"
    buyers = spark.createDataFrame(
        [("A", "1", True, False, True), ("A", None, False, True, True), ("Z", "2", True, True, False)],
        schema + ", kids boolean, adult boolean, counted boolean",
    )
    registered = spark.createDataFrame([("A", "1"), ("B", "3")], schema)
    located = spark.createDataFrame([("A", "1"), ("B", "2"), ("B", "4"), ("C", "2"), ("C", "1")], schema)
    found = ops.member_segments(registered, buyers, located, "city", ("kids", "adult"))
    # 2 bought in an uncounted city: not located anywhere.  4 never bought.  C has no member left.
    assert rows_of(found) == {("A", 1, 1, 0), ("B", 2, None, None)}


def test_city_measures(spark):
    members = spark.createDataFrame(
        [("A", "1", True, True, True, False, True), ("A", "1", True, False, False, False, False), ("A", "2", True, False, False, False, False),
         ("B", "1", False, False, False, True, False), ("B", "9", False, False, False, True, False), (None, "8", True, False, False, False, False),
         ("D", "1", False, False, False, True, False)],
        "city string, omni_member_id string, counted boolean, buyer boolean, bought boolean, located boolean, kids boolean",
    )
    stores = spark.createDataFrame([("A", 5), ("A", 5), ("A", 6), ("B", None), ("Z", 7), (None, 8)], "city_cn string, store_code int")
    # Store 5 and registered member 5 are different ids; member 1 registering bought nothing by it.
    registered = spark.createDataFrame([("A", "5"), ("A", "5"), (None, "1"), ("Z", "1")], "city_cn string, member_detail_id string")
    visitors = spark.createDataFrame(
        [("A", 3, 0), ("A", 0, 4), ("Z", 1, 1), (None, 9, 9), ("B", None, 2)], "city_cn string, traffic_TY_YTD int, traffic_LY_YTD int"
    )
    found = ops.city_measures(members, stores, registered, visitors, ("kids",))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3 and "Join" not in plan
    assert found.columns[1:] == ["ttl_member_base", "kids", "current_LCS_store_count", "LCS_new_reg", "traffic_TY_YTD", "traffic_LY_YTD"]
    assert rows_of(found) == {("A", 2, 1, 2, 1, 3, 4), ("B", 1, None, 0, None, None, 2), (None, 1, None, None, None, None, None)}
    assert ops.city_measures(*(f.limit(0) for f in (members, stores, registered, visitors)), ("kids",)).count() == 0


def test_open_stores_and_registrations(table):
    stores = table("store", [{"store_code": 1, "city_cn": "A", "store_status": "营业中", "distributor": "LCS-A"}, {"store_code": 1, "city_cn": "A", "store_status": "营业中", "distributor": "LCS-A"}, {"store_code": 2, "city_cn": "A", "store_status": "closed", "distributor": "LCS-A"}, {"store_code": 3, "city_cn": "B", "store_status": "营业中", "distributor": "LBR"}])
    assert rows_of(ops.open_stores(stores)) == {("A", 1)}
    joined = [(1, 1, date(2001, 3, 1)), (2, 2, date(2001, 3, 1)), (3, 9, date(2001, 3, 1)), (4, 1, date(2000, 3, 1))]
    members = table("member", [{"member_detail_id": m, "eff_reg_store": s, "eff_reg_channel": "LCS", "join_time": d} for m, s, d in joined])
    assert rows_of(ops.new_registrations(members, stores, date(2001, 6, 15))) == {("A", 2), (None, 1)}


def test_footfall_lists_cities_without_visitors(table):
    rows = [("A", date(2001, 2, 1), 5), ("A", date(2000, 2, 1), 4), ("B", date(1999, 1, 1), 3)]
    daily = table("traffic", [{"city_cn": c, "date_id": d, "traffic_amt": v, "agg_type": "brand", "distributor": "LCS"} for c, d, v in ((c, d, __import__("decimal").Decimal(v)) for c, d, v in rows)])
    growth = ops.traffic_growth(daily, date(2001, 6, 15), "brand")
    assert rows_of(growth) == {("A", 5.0, 4.0, 0.25), ("B", 0.0, 0.0, None)}


def test_all_members(table):
    members = table("member", [{"member_detail_id": 1}, {"member_detail_id": 1}, {"member_detail_id": None}])
    rows = [(None, "p1", "registerOrBind", "TMall"), (None, "p1", "registerOrBind", "TMall"), (None, "p1", "registerOrBind", "Douyin"), (5, "p2", "registerOrBind", "TMall"), (None, "p3", "other", "TMall")]
    belong = table("belong", [dict(zip(("member_detail_id", "platform_id_value", "belong_type", "eff_belong_channel"), r, strict=True)) for r in rows])
    assert [tuple(r) for r in ops.all_members(members, belong).collect()] == [(4,)]


def test_population_by_maturity(table):
    rows = [("A", "Mature", 1, 2), ("B", "Mature", 3, 4), ("C", None, 5, 6), ("D", "Odd", 7, 8)]
    population = table("population", [dict(zip(("city_cn", "city_maturity_level", "target_kids_population", "adult_shopper_population"), r, strict=True)) for r in rows])
    assert rows_of(ops.population_by_maturity(population)) == {("1_mature", 4, 6), ("4_unspecified", 12, 14)}


def test_band_total_is_there_without_bands(spark):
    schema = "city_maturity_type string, ttl_member_base bigint, ttl_kids_member_shopper bigint, ttl_adult_member_shopper bigint"
    empty = penetration.with_band_total(spark.createDataFrame([], schema))
    assert rows_of(empty) == {("all_have_city_information", None, None, None)}
    bands = spark.createDataFrame([("1_mature", 2, 1, None), ("2_core", 3, None, None)], schema)
    assert rows_of(penetration.with_band_total(bands)) == {
        ("1_mature", 2, 1, None), ("2_core", 3, None, None), ("all_have_city_information", 5, 1, None)
    }
