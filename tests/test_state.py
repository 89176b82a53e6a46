"""State carried from day to day equals a full run, and a day reads its own files only."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loyaltylens.functions import fixed
from loyaltylens.operators import penetration as ops
from loyaltylens.operators.identity import eligible_orders, member_cities, registered_not_purchased
from loyaltylens.plans import location, state
from loyaltylens.sources.tables import current, current_label

DAYS = [date(2001, 6, n) for n in range(1, 6)]


def log_rows(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(900):
        day = rng.choice(DAYS)
        late = timedelta(days=rng.choice([0, 0, 0, 1]))  # some rows arrive a day after their time
        key = rng.choice(["a", "b", "c", "other", fixed.CRM_ID_PROPERTY])
        value = f"m{rng.randint(1, 9)}" if key == fixed.CRM_ID_PROPERTY else rng.choice(["0", "1"])
        stamp = rng.choice([None, *[datetime(day.year, day.month, day.day)] * 9])
        rows.append((rng.choice([None, *[f"u{i}" for i in range(25)]]), key, value, stamp, min(day + late, DAYS[-1])))
    return rows + rows[:100]



@pytest.mark.parametrize("seed", [1, 2, 3])
def test_newest_values_day_by_day(spark, tmp_path, seed):
    schema = "gio_id string, prop_key string, prop_value string, update_time timestamp_ntz, day date"
    spark.createDataFrame(log_rows(seed), schema).write.partitionBy("day").parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    segments = spark.createDataFrame([("a", "X"), ("b", "Y"), ("b", "Z"), ("c", "X")], "prop_key string, city_cn string")
    target = str(tmp_path / "state")
    for day in DAYS:
        state.advance_newest(log, segments, target, day)
        state.advance_newest(log, segments, target, day)  # a day that is run twice changes nothing
        assert current_label(spark, target) == day.isoformat()
        full = location.segment_members(log.filter(F.col("day") <= F.lit(day)), segments)
        found = state.located_members(current(spark, target), segments)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, full.collect()))


def test_a_day_reads_its_own_files(spark, tmp_path):
    schema = "gio_id string, prop_key string, prop_value string, update_time timestamp_ntz, day date"
    spark.createDataFrame(log_rows(4), schema).write.partitionBy("day").parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    rows = state.days_after(log, "day", DAYS[2].isoformat(), DAYS[3])
    read = [line for line in rows._jdf.queryExecution().toString().splitlines() if "PartitionFilters" in line]
    assert read and all("2001-06-03" in line and "2001-06-04" in line for line in read)
    assert {r.day for r in rows.select("day").distinct().collect()} == {DAYS[3]}
    # Files of the days before may even be gone.
    segments = spark.createDataFrame([("a", "X")], "prop_key string, city_cn string")
    target = str(tmp_path / "state")
    state.advance_newest(log, segments, target, DAYS[2])
    expected = location.segment_members(log.filter(F.col("day") <= F.lit(DAYS[3])), segments).collect()
    for day in DAYS[:3]:
        for file in (tmp_path / "log" / f"day={day}").glob("*.parquet"):
            file.write_bytes(b"unreadable")
    spark.catalog.clearCache()
    state.advance_newest(spark.read.schema(schema).parquet(str(tmp_path / "log")), segments, target, DAYS[3])
    found = state.located_members(current(spark, target), segments).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, expected))


def order_rows(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        member = rng.randint(1, 40)
        rows.append({
            "order_city": rng.choice(["A", "B", None]), "source_channel": rng.choice(["LCS", "TMALL", "OTHER"]),
            "type_name": rng.choice(["CRM_memberid", "TMALL_kyid", "x"]), "type_value": f"t{member}",
            "crm_member_detail_id": rng.choice([None, f"K{member}"]), "order_paid_date": rng.choice(DAYS),
            "sales_type": rng.choice([1, 3]), "order_type": "normal", "is_member_order": rng.choice([True, True, False]),
            "if_eff_order_tag": True, "sku_id": rng.choice([None, "s1", "s2"]), "parent_order_id": i,
        })
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_purchase_history_day_by_day(spark, table, tmp_path, seed):
    omni = table("omni", order_rows(seed))
    crm = table("crm", [{"id": str(m), "member_id": f"K{m}", "join_time": DAYS[0]} for m in range(1, 30)])
    members = table("member", [{"member_detail_id": m, "eff_reg_channel": "LCS,WMP"} for m in range(1, 60)])
    lists = {"age": ops.adult_skus(table("product", [{"sku_id": "s1", "age_mark": "18+"}, {"sku_id": "s2", "age_mark": "3+"}]))}
    target = str(tmp_path / "state")
    for day in (DAYS[0], DAYS[2], DAYS[3], DAYS[3], DAYS[4]):
        state.advance_purchases(omni, lists, target, day)
        orders = eligible_orders(omni, day + timedelta(days=1))
        people = state.buyers(current(spark, target), crm)
        full = ops.buyer_profiles(orders, crm, lists)
        assert sorted(map(str, people.drop("first_paid").collect())) == sorted(map(str, full.collect()))
        never = registered_not_purchased(members, people)
        expected = registered_not_purchased(members, member_cities(orders, crm))
        assert sorted(r.member_id for r in never.collect()) == sorted(r.member_id for r in expected.collect())
    first = ops.people_of(ops.purchase_references(eligible_orders(omni, date(2001, 7, 1)), lists), crm)
    assert sorted(map(str, people.collect())) == sorted(map(str, first.collect()))
    assert {r.first_paid for r in people.collect()} <= set(DAYS)


def test_lost_run_is_repeated(spark, table, tmp_path, monkeypatch):
    omni = table("omni", order_rows(5))
    lists = {"age": ops.adult_skus(table("product", []))}
    target, other = str(tmp_path / "state"), str(tmp_path / "whole")
    state.advance_purchases(omni, lists, target, DAYS[1])
    with monkeypatch.context() as patched:
        patched.setattr("loyaltylens.sources.tables._FolderVersions.switch", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            state.advance_purchases(omni, lists, target, DAYS[4])
    assert current_label(spark, target) == DAYS[1].isoformat()
    state.advance_purchases(omni, lists, target, DAYS[4])
    state.advance_purchases(omni, lists, other, DAYS[4])
    assert sorted(map(str, current(spark, target).collect())) == sorted(map(str, current(spark, other).collect()))
