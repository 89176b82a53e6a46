"""Reports on random rows with missing values, hot keys and cities of several bands, against plain Python."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import brute
import pytest
from pyspark.sql import functions as F

from loyaltylens.operators import penetration as ops
from loyaltylens.operators.cities import city_bands
from loyaltylens.plans import penetration, scorecards

AS_OF = date(2001, 6, 15)
CITIES = ["A", "B", "C", "D", "E", None]


def random_tables(seed: int, orders: int = 600) -> dict[str, list[dict]]:
    r = random.Random(seed)

    def day(last=date(2001, 7, 30)):
        return last - timedelta(days=r.randrange(900))

    def city():
        return "A" if r.random() < 0.35 else r.choice(CITIES)

    def member():
        return 7 if r.random() < 0.35 else r.randrange(1, 60)

    def money():
        return Decimal(r.randrange(-2000, 9000)) / 100

    omni, member_orders = [], []
    for _ in range(orders):
        who = member()
        omni.append({
            "order_city": city(), "source_channel": r.choice(["LCS", "TMALL", "TMALL", "TMALL", "DOUYIN", "X"]),
            "type_name": r.choice(["CRM_memberid", "DY_openid", "TMALL_kyid", "phone", None]), "type_value": f"x{who}",
            "crm_member_detail_id": r.choice([who, who, None]), "order_paid_date": day(),
            "sales_type": r.choice([1, 2, 3, None]), "order_type": r.choice(["normal", "normal", "presale", None]),
            "is_member_order": r.choice([True, True, False, None]), "if_eff_order_tag": r.choice([True, True, False, None]),
            "sku_id": r.choice([1, 2, 3, 4, None]), "first_bind_time": day(), "kyid": r.choice([f"k{who}", f"k{who}", None]),
            "parent_order_id": r.choice([r.randrange(orders // 3), r.randrange(orders // 3), None]),
            "sales_qty": r.choice([1.0, 2.0, -1.0, 0.0, None]), "order_rrp_amt": r.choice([money(), money(), money(), None]),
        })
        member_orders.append({
            "city_cn": city(), "crm_member_id": r.choice([str(who), f"00{who}", None]), "sales_qty": r.choice([1.0, -2.0, 0.0, None]),
            "order_rrp_amt": money(), "if_eff_order_tag": r.choice([True, False, None]),
            "original_order_id": r.randrange(orders // 3), "is_rrp_sales_type": r.choice([1, 1, 0, None]),
            "distributor_name": r.choice(["LCS-A", "LBR", None]), "date_id": day(),
        })
    members = [
        {"member_detail_id": m, "city_cn": r.choice(CITIES), "eff_reg_channel": r.choice(["LCS", "LCS,WMP", "WMP", "X", None]),
         "eff_reg_store": r.randrange(1, 9), "join_time": day()} for m in range(1, 80)
    ]
    return {
        "omni": omni,
        "member_orders": member_orders,
        "member": members,
        "crm": [{"id": 1000 + m if m % 3 else m, "member_id": m, "join_time": day()} for m in range(1, 50)],
        "ec_bind": [
            {"platform_id_value": f"k{m}", "platform_id_type": r.choice(["kyid", "kyid", "openid"]),
             "platformid": r.choice(["taobao", "taobao", "douyin"]), "first_bind_time": day()}
            for m in (*range(1, 60), *range(1, 20))
        ],
        "offline_mart": [
            {"city_cn": city(), "date_id": day(), "transactions": r.randrange(5), "traffic_amt": Decimal(r.randrange(50)),
             "gmv_rsp": money(), "return_gmv_rsp": abs(money())} for _ in range(200)
        ],
        # Two cities of band 2, one city of two bands, one without a band, one without a store.
        "store": [{"store_code": i, "city_cn": c} for i, c in enumerate(["A", "A", "B", "C", "D", None], 1)],
        "city_type": [{"city_chn": c, "city_type": t} for c, t in (("A", "1_mature"), ("B", "2_core"), ("C", "2_core"), ("C", "3_uprising"), ("E", "3_uprising"))],
        "city_tier": [{"city_chn": c, "city_tier": t} for c, t in (("A", "T1"), ("B", "T1"), ("C", "T2"))],
        "located": [{"prop_key": r.choice("st"), "city_cn": r.choice("ABE"), "crm_member_id": r.choice([str(m), f"0{m}"])} for m in range(1, 80)],
        "calendar": [{"date_id": date(1999, 1, 1) + timedelta(days=d), "date_type": "day" if d % 9 else "week", "fiscal_year": (date(1999, 1, 15) + timedelta(days=d)).year} for d in range(950)],
        "portfolio": [{"sku_id": s, "kids_vs_adult": "adult product" if s % 2 else "kids product"} for s in (1, 2, 3)],
    }


@pytest.fixture(scope="module", params=[1, 2])
def case(request, table):
    rows = random_tables(request.param)
    return rows, {name: table(name, content) for name, content in rows.items()}


def same(found, expected) -> bool:
    if found is None or expected is None:
        return found is None and expected is None
    return float(found) == pytest.approx(float(expected), rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("grain", ["city", "maturity", "tier"])
@pytest.mark.parametrize("channel", ["online", "offline"])
def test_scorecard(case, channel, grain):
    rows, tables = case
    expected = brute.scorecard(rows, channel, grain, AS_OF)
    segment = {"maturity": "city_maturity_type", "tier": "city_tier"}.get(grain, "order_city" if channel == "online" else "city_cn")
    found = scorecards.scorecard(tables, channel, grain, AS_OF).collect()
    assert {r[segment] for r in found} == set(expected)
    for row in found:
        for name, value in expected[row[segment]].items():
            assert same(row[name], value), (row[segment], name, row[name], value)


def test_total_is_the_sum_of_bands_for_sales(case):
    _, tables = case
    totals = {(r.city_tier, r.period): r.sales_rrp for r in scorecards.sales(tables, "online", "tier", AS_OF).collect()}
    for period in ("TY", "LY"):
        assert totals["TTL", period] == sum(v for (tier, p), v in totals.items() if p == period and tier != "TTL")


def test_new_and_existing_add_up(case):
    _, tables = case
    for row in scorecards.order_measures(tables, "online", "tier", AS_OF).collect():
        assert row.new_net + row.existing_net == row.member_net
        assert row.new_shoppers + row.existing_shoppers == row.member_shoppers
        assert row.new_orders + row.existing_orders >= row.member_orders


def test_row_order_does_not_matter(case):
    _, tables = case
    shuffled = {name: df.orderBy(F.rand(3)).repartition(5) for name, df in tables.items()}
    a = scorecards.scorecard(tables, "online", "maturity", AS_OF).collect()
    b = scorecards.scorecard(shuffled, "online", "maturity", AS_OF).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_city_members(case):
    rows, tables = case
    bands = city_bands(tables["store"], tables["city_type"])
    profile = penetration.buyers(tables, AS_OF, ops.adult_portfolio(tables["portfolio"]), with_years=True)
    found = penetration.city_members(tables, profile, bands, with_years=True).withColumn(
        "share", ops.safe_div(F.col("_new_shoppers_ty"), F.col("_shoppers_ty"))
    )
    expected = brute.city_members(rows, {1, 3}, AS_OF)
    got = {r.city: (r.ttl_member_base, r.ttl_kids_member_shopper, r.ttl_adult_member_shopper, r.share) for r in found.collect()}
    assert got.keys() == expected.keys()
    for city in got:
        assert all(same(a, b) for a, b in zip(got[city], expected[city], strict=True)), (city, got[city], expected[city])


def test_penetration_total_adds_bands_up(case):
    _, tables = case
    population = [("A", "Mature", 100, 200), ("B", "Core", 50, 0)]
    extra = {
        "population": tables["omni"].sparkSession.createDataFrame(population, "city_cn string, city_maturity_level string, target_kids_population bigint, adult_shopper_population bigint"),
        "belong": tables["omni"].sparkSession.createDataFrame([], "member_detail_id bigint, platform_id_value string, belong_type string, eff_belong_channel string"),
    }
    report = {r.city_maturity_type: r for r in penetration.penetration_maturity({**tables, **extra}, AS_OF).collect()}
    bands = [r for name, r in report.items() if name not in ("all_have_city_information", "TTL_member_base")]
    assert report["all_have_city_information"].ttl_member_base == sum(r.ttl_member_base for r in bands)
    assert report["TTL_member_base"].ttl_member_base == 79
    assert report["2_core"].adult_member_shopper_penetration is None
    assert report["1_mature"].member_base_penetration_target_kids_shopper == report["1_mature"].ttl_member_base / 100


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_large_lookups_give_the_same_scorecard(case, limit, spark):
    rows, tables = case
    expected = brute.scorecard(rows, "online", "maturity", AS_OF)
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, limit)
    try:
        _same_scorecard(scorecards.scorecard(tables, "online", "maturity", AS_OF), expected)
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)


def _same_scorecard(found, expected):
    for row in found.collect():
        assert all(same(row[n], v) for n, v in expected[row.city_maturity_type].items())
