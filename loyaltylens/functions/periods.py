"""Year-to-date windows.

A window pair is two half-open date ranges.  Comparing the date column with literals (instead of
extracting its year) lets the ranges reach the Parquet scan, so only the two windows are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

TY = "TY"
LY = "LY"


def same_day_last_year(as_of: date) -> date:
    """One calendar year earlier; 29 February becomes 28 February."""
    try:
        return as_of.replace(year=as_of.year - 1)
    except ValueError:
        return as_of.replace(year=as_of.year - 1, day=28)


@dataclass(frozen=True)
class YtdWindow:
    """This year [ty_start, ty_end) and last year [ly_start, ly_end)."""

    ty_start: date
    ty_end: date
    ly_start: date
    ly_end: date


def ytd_window(as_of: date, *, ty_open: bool = True, ly_days: int | None = None) -> YtdWindow:
    """This calendar year against last year up to, and without, the same day.

    ``ty_open`` keeps the rest of this year as well; otherwise this year ends before ``as_of``.
    ``ly_days`` moves last year's end back by that many days instead of one calendar year.
    """
    ty_start = date(as_of.year, 1, 1)
    ly_start = date(as_of.year - 1, 1, 1)
    cutoff = as_of - timedelta(days=ly_days) if ly_days is not None else same_day_last_year(as_of)
    return YtdWindow(
        ty_start=ty_start,
        ty_end=date(as_of.year + 1, 1, 1) if ty_open else as_of,
        ly_start=ly_start,
        ly_end=min(max(cutoff, ly_start), ty_start),
    )


def _between(day: Column, start: date, end: date) -> Column:
    return (day >= F.lit(start)) & (day < F.lit(end))


def in_this_year(day: Column, window: YtdWindow) -> Column:
    return _between(day, window.ty_start, window.ty_end)


def in_last_year(day: Column, window: YtdWindow) -> Column:
    return _between(day, window.ly_start, window.ly_end)


def in_window(day: Column, window: YtdWindow) -> Column:
    """Row filter that keeps both windows."""
    return in_this_year(day, window) | in_last_year(day, window)


def period_of(day: Column, window: YtdWindow) -> Column:
    """``'TY'``, ``'LY'`` or NULL."""
    return F.when(in_this_year(day, window), F.lit(TY)).when(in_last_year(day, window), F.lit(LY))
