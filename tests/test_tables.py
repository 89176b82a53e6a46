"""Reading canonical tables and refreshing report tables."""

from __future__ import annotations

from datetime import date

import pytest
from conftest import rows_of

from loyaltylens.sources import tables as tables_module
from loyaltylens.sources.schemas import SCHEMAS
from loyaltylens.sources.contract import ContractError
from loyaltylens.sources.tables import Tables, conform, current, current_label, refresh, saved


def test_tables_from_folder_with_other_names(spark, tmp_path):
    raw = spark.createDataFrame([("A", "T1", 1)], "city string, city_tier string, extra int")
    raw.write.parquet(str(tmp_path / "tiers"))
    tables = Tables(
        spark, root=str(tmp_path), location={"city_tier": "tiers"}, columns={"city_tier": {"city": "city_chn"}}
    )
    assert rows_of(tables["city_tier"]) == {("A", "T1")}
    assert set(SCHEMAS) < set(tables)
    with pytest.raises(KeyError):
        tables["unknown"]


def test_tables_from_catalog_are_cast(spark):
    spark.sql("create table tier_source using parquet as select 'A' city_chn, 5 city_tier")
    tables = Tables(spark, location={"city_tier": "tier_source"})
    assert rows_of(tables["city_tier"]) == {("A", "5")}
    spark.sql("drop table tier_source")


def test_refresh_replaces_a_folder(spark, tmp_path):
    target = str(tmp_path / "report")
    refresh(spark.createDataFrame([("A", 1), ("B", 2)], "city string, n int"), target, as_of=date(2001, 6, 15))
    refresh(spark.createDataFrame([("C", 3)], "city string, n int"), target, as_of=date(2001, 6, 16))
    written = current(spark, target)
    assert written.columns == ["city", "n", "dl_batch_date", "dl_load_time"]
    assert rows_of(written.select("city", "n", "dl_batch_date")) == {("C", 3, "20010616")}
    assert written.filter("dl_load_time is null").count() == 0


def test_refresh_matches_columns_by_name(spark, tmp_path):
    first = spark.createDataFrame([("A", 1)], "city string, n bigint")
    second = spark.createDataFrame([(2, "B")], "n int, city string")
    for as_table, target in ((True, "report_table"), (False, str(tmp_path / "report"))):
        refresh(first, target, as_table=as_table)
        refresh(second, target, as_table=as_table, keep=1)
        read = spark.table(target) if as_table else current(spark, target)
        assert read.dtypes == [("city", "string"), ("n", "bigint")] and rows_of(read) == {("B", 2)}
        with pytest.raises(ContractError, match="missing columns: n.*columns too many: m"):
            refresh(second.withColumnRenamed("n", "m"), target, as_table=as_table)
        refresh(second.withColumnRenamed("n", "m"), target, as_table=as_table, new_columns=True, keep=1)
        read = spark.table(target) if as_table else current(spark, target)
        assert read.columns == ["m", "city"]
    spark.sql("drop view report_table")
    left = [t.name for t in spark.catalog.listTables() if t.name.startswith("report_table")]
    assert len(left) == 1  # the one version that is kept
    spark.sql(f"drop table `{left[0]}`")


def test_plain_content_becomes_the_first_version(spark, tmp_path):
    target = str(tmp_path / "old")
    spark.range(3).write.parquet(target)
    assert current(spark, target).count() == 3
    refresh(spark.range(5), target)
    assert current(spark, target).count() == 5
    refresh(spark.range(6), target)
    refresh(spark.range(7), target)
    assert current(spark, target).count() == 7 and not [n for n in left_in(tmp_path / "old") if n.startswith("part-")]
    spark.sql("create table plain_report using parquet as select 1 id")
    refresh(spark.range(4).selectExpr("cast(id as int) id"), "plain_report", as_table=True, keep=1)
    assert spark.table("plain_report").count() == 4
    spark.sql("drop view plain_report")
    for table in [t.name for t in spark.catalog.listTables() if t.name.startswith("plain_report")]:
        spark.sql(f"drop table `{table}`")


def test_refresh_may_read_its_target(spark, tmp_path):
    target = str(tmp_path / "data")
    refresh(spark.range(3), target)
    refresh(current(spark, target).selectExpr("id + 10 as id"), target)
    assert rows_of(current(spark, target)) == {(10,), (11,), (12,)}


def test_failed_refresh_keeps_the_old_content(spark, tmp_path):
    target = str(tmp_path / "data")
    refresh(spark.range(3), target)
    with pytest.raises(Exception, match="stop here"):
        refresh(spark.range(3).selectExpr("if(id = 2, cast(raise_error('stop here') as bigint), id) as id"), target)
    assert rows_of(current(spark, target)) == {(0,), (1,), (2,)}


def left_in(folder) -> set[str]:
    return {p.name for p in folder.iterdir() if not p.name.startswith(".")}


def test_old_versions_and_remains_are_dropped(spark, tmp_path):
    target = tmp_path / "data"
    readers = []
    for n in range(1, 6):
        refresh(spark.range(n), str(target), label=f"run{n}")
        readers.append(current(spark, str(target)))
        assert [r.count() for r in readers[-2:]] == [n - 1, n][2 - len(readers[-2:]) :]  # the version before is still there
    (target / "00000003..stopped").mkdir()
    refresh(spark.range(6), str(target), label="run6")
    assert sorted(n[:8] for n in left_in(target) if n != "_versions") == ["00000005", "00000006"]
    assert len(left_in(target / "_versions")) == 2 and current_label(spark, str(target)) == "run6"
    assert current_label(spark, str(tmp_path / "none")) is None
    with pytest.raises(ValueError, match="dot"):
        refresh(spark.range(1), str(target), label="a.b")


class Stop(Exception):
    """The job is lost."""


@pytest.mark.parametrize("as_table", [False, True])
@pytest.mark.parametrize("step", ["write", "switch", "drop_before"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_lost_job_leaves_a_whole_report(spark, tmp_path, monkeypatch, as_table, step, when):
    """Stopped before or after any step, readers find the old or the new content, and the next run goes through."""
    target = f"lost_{step}_{when}" if as_table else str(tmp_path / "data")
    kind = tables_module._TableVersions if as_table else tables_module._FolderVersions

    def read():
        return rows_of(spark.table(target) if as_table else current(spark, target))

    refresh(spark.range(3), target, as_table=as_table)
    real = getattr(kind, step)

    def lost(self, *args):
        if when == "after":
            real(self, *args)
        raise Stop

    with monkeypatch.context() as patched:
        patched.setattr(kind, step, lost)
        with pytest.raises(Stop):
            refresh(spark.range(9), target, as_table=as_table)
    switched = step == "drop_before" or (step, when) == ("switch", "after")
    assert read() == {(i,) for i in range(9 if switched else 3)}
    refresh(spark.range(5), target, as_table=as_table, keep=1)
    assert read() == {(i,) for i in range(5)}
    if as_table:
        spark.sql(f"drop view {target}")
        tables = [t.name for t in spark.catalog.listTables() if t.name.startswith(target)]
        assert len(tables) == 1
        spark.sql(f"drop table `{tables[0]}`")
    else:
        assert len(left_in(tmp_path / "data")) == 2


def test_saved_tables_go_away(spark, tmp_path):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))
    with saved(spark.range(5)) as kept:
        path = kept.inputFiles()[0]
        assert kept.count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()


def test_ids_stay_text_and_amounts_unrounded(spark):
    spark.sql("create table crm_source using parquet as select 'M001' id, '007' member_id union all select '7', '7'")
    spark.sql("create table line_source using parquet as select cast(1.0049 as decimal(10,4)) order_rrp_amt, 5 original_order_id")
    tables = Tables(spark, location={"crm": "crm_source", "member_orders": "line_source"})
    ids = conform(spark.table("crm_source"), "id string, member_id string")
    assert rows_of(ids) == {("M001", "007"), ("7", "7")}
    assert SCHEMAS["crm"].startswith("id string, member_id string")
    line = conform(spark.table("line_source"), "original_order_id string, order_rrp_amt decimal(18,6)").first()
    assert (line.original_order_id, float(line.order_rrp_amt)) == ("5", 1.0049)
    spark.sql("drop table crm_source")
    spark.sql("drop table line_source")
