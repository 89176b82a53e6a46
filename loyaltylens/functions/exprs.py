"""Scalar rules shared by the reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from loyaltylens.functions import fixed

MONEY = "decimal(18,6)"


def as_double(value: Column) -> Column:
    return value.cast("double")


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Double division; a zero denominator gives NULL."""
    return as_double(numerator) / F.nullif(as_double(denominator), F.lit(0.0))


def change_ratio(current: Column, previous: Column) -> Column:
    """``current / previous - 1``; NULL when there is nothing to compare with."""
    return safe_div(current, previous) - F.lit(1.0)


def net_amount(quantity: Column, amount: Column) -> Column:
    """Signed amount of an order line.

    Sold lines add their amount and returned lines subtract its absolute value.  Lines with
    quantity 0 or NULL count nowhere, and a missing amount counts as zero.
    """
    known = F.coalesce(amount, F.lit(0).cast(MONEY))
    return F.when(quantity > 0, known).when(quantity < 0, -F.abs(known)).otherwise(F.lit(0).cast(MONEY))


def eligible(channels: Sequence[str], as_of: date) -> Column:
    """Order lines of the given channels paid before ``as_of`` that pass the rule of their channel."""
    channel = F.col("source_channel")
    store_rule = (channel == fixed.STORE_CHANNEL) & (F.col("sales_type") != fixed.EXCLUDED_STORE_SALES_TYPE)
    ecom_rule = channel.isin(*fixed.ECOM_CHANNELS) & (F.col("order_type") == fixed.NORMAL_ORDER)
    return channel.isin(*channels) & (F.col("order_paid_date") < F.lit(as_of)) & (store_rule | ecom_rule)


def effective_member_order() -> Column:
    return F.col("is_member_order") & F.col("if_eff_order_tag")


def whole_number_id(value: Column) -> Column:
    """Member id as a number: ``'007'`` and ``7`` are the same id, text that is no number gives NULL."""
    return value.try_cast("bigint")


def canonical_id(value: Column) -> Column:
    """Member id as text without leading zeros."""
    return whole_number_id(value).cast("string")


def known_kind(kind: Column) -> Column:
    return F.coalesce(kind.isin(*fixed.MEMBER_ID_KINDS), F.lit(False))


def band_of_level(level: Column, missing: str) -> Column:
    """Sortable band label of a maturity level."""
    label = F.lit(missing)
    for name, band in fixed.MATURITY_LABELS.items():
        label = F.when(level == name, F.lit(band)).otherwise(label)
    return label


def has_age(age_mark: Column) -> Column:
    return F.trim(age_mark).rlike(fixed.AGE_MARK_PATTERN)


def age_years(age_mark: Column) -> Column:
    """Minimum age in years: the leading integer, or a mixed fraction such as ``1 1/2`` as 1.5.

    Marks without a leading digit give NULL; a mark that starts with a digit but cannot be read gives 0.
    """
    whole, top, bottom = (
        F.regexp_extract(F.trim(age_mark), fixed.AGE_MARK_PATTERN, n).try_cast("decimal(18,4)") for n in (1, 2, 3)
    )
    fraction = F.when(F.regexp_extract(F.trim(age_mark), fixed.AGE_MARK_PATTERN, 2) == "", 0.0)
    years = as_double(whole) + fraction.otherwise(safe_div(top, bottom))
    return F.when(has_age(age_mark), F.coalesce(years, F.lit(0.0)))


def batch_day(as_of: date) -> Column:
    """Batch day as ``yyyyMMdd`` text."""
    return F.date_format(F.lit(as_of), "yyyyMMdd")
