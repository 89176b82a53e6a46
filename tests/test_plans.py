"""Physical plans: what must and must not be in them."""

from __future__ import annotations

import pytest

from loyaltylens.catalog import WRITERS, registered

SF_DIR = "/root/testdata/sf0.01"
QUERIES = registered()
REPORTS = [n for n in QUERIES if n.startswith(("scorecard_", "penetration_", "member_kpi", "lbs_"))]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def initial_plan(spark, name) -> str:
    return plan_of(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_and_no_nested_loops(spark, name):
    plan = initial_plan(spark, name)
    for forbidden in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "Scan ExistingRDD"):
        assert forbidden not in plan


def scans(plan: str, table: str) -> list[str]:
    return [line for line in plan.splitlines() if "FileScan" in line and f"{table}.parquet" in line]


@pytest.mark.parametrize("grain", ["city", "maturity", "tier"])
def test_online_scorecard_reads_the_orders_once(spark, grain):
    plan = initial_plan(spark, f"scorecard_online_{grain}")
    lines = scans(plan, "lineitem")
    assert len(lines) == 1
    assert len(scans(plan, "orders")) == 1
    assert "l_discount" not in lines[0] and "l_shipdate" not in lines[0]


@pytest.mark.parametrize("name", ["penetration_city", "penetration_maturity", "totals_rows", "member_kpis_city"])
def test_penetration_reads_the_orders_once(spark, name):
    plan = initial_plan(spark, name)
    per_fact = [line for line in scans(plan, "lineitem") if "l_partkey" in line]
    assert len(per_fact) == 1


def test_both_windows_reach_the_scan(spark):
    plan = initial_plan(spark, "scorecard_online_tier")
    pushed = scans(plan, "orders")[0]
    for bound in ("2000-01-01", "2000-06-15", "2001-01-01", "2001-06-15"):
        assert bound in pushed


def test_location_log_is_read_for_rows_once_and_for_batch_times_once(spark):
    plan = initial_plan(spark, "lbs_city_member")
    read = scans(plan, "events")
    assert len(read) == 2 and sum("user_id" in line.split("ReadSchema")[1] for line in read) == 1
    assert len(scans(initial_plan(spark, "latest_attribute"), "events")) == 1


def test_footfall_windows_reach_the_scan(spark):
    for name in ("member_kpis_city", "registration_rate"):
        pushed = [line for line in scans(initial_plan(spark, name), "lineitem") if "l_shipdate" in line]
        for bound in ("2000-01-01", "2000-06-15", "2001-01-01", "2002-01-01"):
            assert all(bound in line for line in pushed) and pushed


def test_no_job_runs_while_a_query_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    for name in set(QUERIES) - WRITERS:
        QUERIES[name](spark, SF_DIR)
    assert not list(tracker.getJobIdsForGroup("building"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("channel", ["online", "offline"])
def test_distinct_counts_need_no_copies_per_count(spark, channel):
    for name in (f"scorecard_{channel}_tier", f"member_kpi_{channel}", f"channel_measures_{channel}"):
        assert "Expand" not in initial_plan(spark, name)


@pytest.mark.parametrize("channel", ["online", "offline"])
def test_all_grains_come_from_one_read_of_the_orders(spark, channel):
    plan = initial_plan(spark, f"channel_measures_{channel}")
    assert len(scans(plan, "lineitem")) == 1
    # Lines per order, keys per segment, segments; the rest are the joins of the generated tables and the lookups.
    assert plan.count("bit_or(seen") == 2 and plan.count("partial_bit_or(seen") == 1
