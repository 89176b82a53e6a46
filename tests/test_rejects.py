"""Rows that do not fit are told apart with their reasons."""

from __future__ import annotations

import json

import pytest
from conftest import rows_of

from loyaltylens.sources import rejects
from loyaltylens.sources.tables import Tables

SCHEMA = "member_detail_id bigint, order_rrp_amt decimal(18,6), paid date"
RAW = [
    ("1", "10.5", "2001-01-01"),
    ("x1", "10.5", "2001-01-01"),
    (None, None, None),
    ("2", "1000000000000", "2001-02-30"),
    ("99999999999999999999", "1", "2001-01-02"),
    ("", "1", "2001-01-02"),
]


@pytest.fixture(scope="module")
def checked(spark):
    return rejects.checked(spark.createDataFrame(RAW, "member_detail_id string, order_rrp_amt string, paid string"), SCHEMA)


def test_accepted_and_rejected_are_all_rows(checked):
    good = rejects.accepted(checked)
    assert good.dtypes == [("member_detail_id", "bigint"), ("order_rrp_amt", "decimal(18,6)"), ("paid", "date")]
    assert [r.member_detail_id for r in good.collect()] == [1, None]
    bad = rejects.rejected(checked).collect()
    assert len(bad) == 4
    assert json.loads(bad[0]["raw"]) == {"member_detail_id": "x1", "order_rrp_amt": "10.5", "paid": "2001-01-01"}
    assert [(p["column_name"], p["value"]) for p in bad[1]["problems"]] == [
        ("order_rrp_amt", "1000000000000"),
        ("paid", "2001-02-30"),
    ]


def test_reasons(checked):
    assert rows_of(rejects.reasons(rejects.rejected(checked))) == {
        ("member_detail_id", "bigint", 3, ""),
        ("order_rrp_amt", "decimal(18,6)", 1, "1000000000000"),
        ("paid", "date", 1, "2001-02-30"),
    }


def test_tables_skip_misfits(spark, tmp_path):
    rows = [("7", "Kyoto", "A", "S1", "2001-01-01"), ("M7", "Kyoto", "A", "S1", "2001-01-01")]
    raw = spark.createDataFrame(rows, "member_detail_id string, city_cn string, eff_reg_channel string, eff_reg_store string, join_time string")
    raw.write.parquet(str(tmp_path / "member"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        Tables(spark, root=str(tmp_path))["member"].collect()
    tables = Tables(spark, root=str(tmp_path), skip_misfits=True)
    assert [r.member_detail_id for r in tables["member"].collect()] == [7]
    assert rejects.reasons(tables.rejects("member")).first()["example"] == "M7"


def test_one_pass_without_a_shuffle(checked):
    for df in (rejects.accepted(checked), rejects.rejected(checked)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
