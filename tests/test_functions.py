"""Column rules on hand-made values."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loyaltylens.functions import exprs, fixed, periods


def evaluate(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(
    ("as_of", "expected"),
    [
        (date(2001, 6, 15), date(2000, 6, 15)),
        (date(2004, 2, 29), date(2003, 2, 28)),
        (date(2001, 2, 28), date(2000, 2, 28)),
    ],
)
def test_same_day_last_year(spark, as_of, expected):
    assert periods.same_day_last_year(as_of) == expected
    assert evaluate(spark, F.add_months("d", -12), [(as_of,)], "d date") == [expected]


def test_ytd_window_bounds():
    mid_year = periods.ytd_window(date(2001, 6, 15))
    assert (mid_year.ty_start, mid_year.ty_end) == (date(2001, 1, 1), date(2002, 1, 1))
    assert (mid_year.ly_start, mid_year.ly_end) == (date(2000, 1, 1), date(2000, 6, 15))
    assert periods.ytd_window(date(2001, 6, 15), ty_open=False).ty_end == date(2001, 6, 15)
    new_year = periods.ytd_window(date(2001, 1, 1))
    assert new_year.ly_start == new_year.ly_end
    # 2000 has 366 days: going back 365 days leaves one day of last year.
    assert periods.ytd_window(date(2001, 1, 1), ly_days=365).ly_end == date(2000, 1, 2)
    after_leap_day = date(2004, 3, 10)
    assert periods.ytd_window(after_leap_day).ly_end == date(2003, 3, 10)
    assert periods.ytd_window(after_leap_day, ly_days=365).ly_end == date(2003, 3, 11)


def test_period_of(spark):
    window = periods.ytd_window(date(2001, 6, 15))
    days = [date(1999, 12, 31), date(2000, 1, 1), date(2000, 6, 14), date(2000, 6, 15), date(2001, 1, 1), date(2001, 12, 31)]
    found = evaluate(spark, periods.period_of(F.col("d"), window), [(d,) for d in [*days, None]], "d date")
    assert found == [None, "LY", "LY", None, "TY", "TY", None]


def test_safe_div(spark):
    rows = [(Decimal("3.00"), 2), (Decimal("3.00"), 0), (None, 2), (Decimal("3.00"), None)]
    assert evaluate(spark, exprs.safe_div(F.col("a"), F.col("b")), rows, "a decimal(18,2), b bigint") == [1.5, None, None, None]


def test_net_amount(spark):
    rows = [(2.0, "10"), (-1.0, "-4"), (-1.0, "4"), (0.0, "9"), (None, "9"), (1.0, None)]
    rows = [(q, None if a is None else Decimal(a)) for q, a in rows]
    found = evaluate(spark, exprs.net_amount(F.col("q"), F.col("a")), rows, "q double, a decimal(18,2)")
    assert found == [Decimal(v) for v in (10, -4, -4, 0, 0, 0)]


@pytest.mark.parametrize(
    ("mark", "years"),
    [
        ("18+", 18.0), ("6-12", 6.0), ("1 1/2", 1.5), (" 4+ ", 4.0), ("1/2", 1.0), ("1 1/2+", 0.0), ("N/A", None),
        (None, None), ("13", 13.0), ("1 1/0", 0.0), ("", None), ("99999999999999999999", 0.0),
    ],
)
def test_age_years(spark, mark, years):
    assert evaluate(spark, exprs.age_years(F.col("m")), [(mark,)], "m string") == [years]


def test_canonical_id(spark):
    rows = [("007",), ("7",), ("x7",), (None,)]
    assert evaluate(spark, exprs.canonical_id(F.col("v")), rows, "v string") == ["7", "7", None, None]


def test_band_of_level(spark):
    rows = [("Mature",), ("Core",), ("Uprising",), ("Rural",), (None,)]
    found = evaluate(spark, exprs.band_of_level(F.col("l"), fixed.OTHERS), rows, "l string")
    assert found == ["1_mature", "2_core", "3_uprising", "Others", "Others"]


def test_eligible(table):
    day = date(2001, 6, 14)
    base = {"order_paid_date": day, "sales_type": 1, "order_type": "normal"}
    orders = table(
        "omni",
        [
            {**base, "parent_order_id": 1, "source_channel": "LCS"},
            {**base, "parent_order_id": 2, "source_channel": "LCS", "sales_type": 3},
            {**base, "parent_order_id": 3, "source_channel": "LCS", "sales_type": None},
            {**base, "parent_order_id": 4, "source_channel": "TMALL"},
            {**base, "parent_order_id": 5, "source_channel": "TMALL", "order_type": "presale"},
            {**base, "parent_order_id": 6, "source_channel": "DOUYIN_B2B", "sales_type": 3},
            {**base, "parent_order_id": 7, "source_channel": "OTHER"},
            {**base, "parent_order_id": 8, "source_channel": "TMALL", "order_paid_date": date(2001, 6, 15)},
            {**base, "parent_order_id": 9, "source_channel": None},
        ],
    )
    kept = orders.filter(exprs.eligible(fixed.ALL_CHANNELS, date(2001, 6, 15)))
    assert sorted(r.parent_order_id for r in kept.collect()) == ["1", "4", "6"]
    online = orders.filter(exprs.eligible(("TMALL",), date(2001, 6, 15)))
    assert [r.parent_order_id for r in online.collect()] == ["4"]
