from __future__ import annotations

import os
import sys
from collections.abc import Iterable
from datetime import datetime, time

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loyaltylens.session import build_session  # noqa: E402
from loyaltylens.sources.schemas import LOCATED_SCHEMA, SCHEMAS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__driver__memory="8g",
        spark__sql__maxMetadataStringLength="10000",
        spark__sql__debug__maxToStringFields="500",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Build a canonical table from rows given as dicts; missing columns are NULL, ids may be given as numbers.

    The paid time is noon of the paid day where it is not given.
    """

    def build(name: str, rows: Iterable[dict]):
        schema = LOCATED_SCHEMA if name == "located" else SCHEMAS[name]
        kinds = dict(part.split() for part in schema.split(", "))

        def value(row: dict, column: str):
            found = row.get(column)
            if column == "order_paid_time" and column not in row and row.get("order_paid_date"):
                found = datetime.combine(row["order_paid_date"], time(12))
            return str(found) if kinds[column] == "string" and isinstance(found, int) else found

        return spark.createDataFrame([tuple(value(row, n) for n in kinds) for row in rows], schema)

    return build


def rows_of(df) -> set[tuple]:
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows)), "unexpected duplicate rows"
    return set(rows)
