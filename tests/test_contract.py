"""What may be written into an existing table."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from conftest import rows_of
from pyspark.sql.types import StructType

from loyaltylens.sources.contract import ContractError, insert_by_name, keeps_values, problems

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def kind(ddl):
    return StructType.fromDDL(f"x {ddl}")["x"].dataType


@pytest.mark.parametrize(
    "given, kept, fits",
    [
        ("int", "int", True),
        ("int", "bigint", True),
        ("bigint", "int", False),
        ("bigint", "double", False),
        ("int", "double", True),
        ("smallint", "float", True),
        ("int", "float", False),
        ("float", "double", True),
        ("double", "float", False),
        ("decimal(10,2)", "decimal(12,4)", True),
        ("decimal(10,2)", "decimal(11,4)", False),
        ("decimal(10,4)", "decimal(12,2)", False),
        ("bigint", "decimal(19,0)", True),
        ("bigint", "decimal(18,0)", False),
        ("date", "timestamp_ntz", True),
        ("timestamp_ntz", "date", False),
        ("string", "int", False),
        ("int", "string", False),
        ("void", "date", True),
    ],
)
def test_types(given, kept, fits):
    assert keeps_values(kind(given), kind(kept)) is fits


def test_problems_are_named():
    kept = StructType.fromDDL("city string, n int, paid date")
    given = StructType.fromDDL("City string, n bigint, extra int, EXTRA int")
    assert problems(given, kept) == [
        "columns named twice: extra",
        "missing columns: paid",
        "columns too many: EXTRA",
        "n: bigint does not fit int",
    ]
    assert problems(StructType.fromDDL("paid date, N smallint, CITY string"), kept) == []


def test_insert_by_name(spark):
    spark.sql("create table by_name using parquet as select 'A' city, 1L n")
    insert_by_name(spark.createDataFrame([(2, "B")], "n int, city string"), "by_name")
    assert rows_of(spark.table("by_name")) == {("A", 1), ("B", 2)}
    for bad in ("n string, city string", "n int", "n int, city string, more int"):
        with pytest.raises(ContractError):
            insert_by_name(spark.createDataFrame([], bad), "by_name")
    assert spark.table("by_name").count() == 2
    insert_by_name(spark.createDataFrame([("C", 3)], "city string, n int"), "by_name", overwrite=True)
    assert rows_of(spark.table("by_name")) == {("C", 3)}
    spark.sql("drop table by_name")


@pytest.mark.parametrize("hidden", ["public_tokenizers", "corpus_pipeline", "loyaltylens.llm"])
def test_queries_without_the_text_operators(hidden):
    """A package that they need and that is missing takes away the text queries only."""
    code = (
        f"import sys; sys.modules[{hidden!r}] = None\n"
        "import __spark_entry__ as e\n"
        "q = e.queries(); assert 'scorecard_online_city' in q and 'pipeline' not in q and set(e.oracle_sql()) == set(q)"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)
