"""The whole reporting day."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from loyaltylens.plans.jobs import refresh_reports
from loyaltylens.sources.retail_binding import AS_OF, RetailBinding
from loyaltylens.sources.tables import current

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def checkpoint_folder(spark, tmp_path):
    """Only where the session names none, as on this machine."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))


def test_refresh_reports(spark, tmp_path, checkpoint_folder):
    folder = str(tmp_path / "reports")
    written = refresh_reports(RetailBinding(spark, SF_DIR), folder, AS_OF)
    assert len(written) == 9
    same_as = {"located_members": "lbs_city_member", "penetration_city": "penetration_city"}
    same_as |= {name: name.replace("performance", "scorecard") for name in written if name.startswith("performance")}
    for name, query in same_as.items():
        saved = current(spark, f"{folder}/{name}")
        expected = contract.queries()[query](spark, SF_DIR)
        assert saved.columns == expected.columns
        assert sorted(map(str, saved.collect())) == sorted(map(str, expected.collect()))
    audited = current(spark, f"{folder}/penetration_maturity")
    assert audited.columns[-2:] == ["dl_batch_date", "dl_load_time"]
    assert {r.dl_batch_date for r in audited.collect()} == {"20010615"}


def test_refresh_reports_into_the_catalog(spark, checkpoint_folder):
    spark.sql("create database reports_db")
    written = refresh_reports(RetailBinding(spark, SF_DIR), "reports_db", AS_OF, as_tables=True)
    shown = {t.name for t in spark.catalog.listTables("reports_db") if t.tableType == "VIEW"}
    assert shown == set(written) and len(written) == 9
    expected = contract.queries()["penetration_city"](spark, SF_DIR)
    assert sorted(map(str, spark.table("reports_db.penetration_city").collect())) == sorted(map(str, expected.collect()))
    spark.sql("drop database reports_db cascade")
