"""One member id across channels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltylens.functions import fixed
from loyaltylens.functions.exprs import canonical_id, effective_member_order, eligible, known_kind
from loyaltylens.operators.cities import CityBands
from loyaltylens.operators.joins import left_join_on_optional_key, lookup_join


def eligible_orders(omni: DataFrame, as_of: date, *, members_only: bool = True) -> DataFrame:
    """Order lines of all channels that count, by default only effective member orders."""
    rows = omni.filter(eligible(fixed.ALL_CHANNELS, as_of))
    return rows.filter(effective_member_order()) if members_only else rows


def resolve_identity(orders: DataFrame, crm: DataFrame, spread: tuple[str, ...] = ("type_value",)) -> DataFrame:
    """Add ``omni_member_id`` (CRM id, else channel id, else NULL) and the CRM ``join_time``.

    Orders without a CRM reference match nothing; they are spread over all tasks of the join by the
    ``spread`` columns.  Callers that only need distinct members deduplicate the orders first.
    """
    people = crm.select(F.col("member_id").alias("_crm_key"), F.col("id").alias("_crm_id"), "join_time")
    matched = left_join_on_optional_key(orders, "crm_member_detail_id", people, "_crm_key", spread=list(spread))
    resolved = F.when(known_kind(F.col("type_name")), F.coalesce("_crm_id", "type_value"))
    return matched.withColumn("omni_member_id", resolved).drop("_crm_key", "_crm_id")


def member_references(orders: DataFrame, *also: str | Column) -> DataFrame:
    """Order columns that decide the member id, with ``also``; all NULL where the id kind names no member."""
    known = known_kind(F.col("type_name"))
    return orders.select(
        "order_city",
        *(F.when(known, F.col(c)).alias(c) for c in ("type_name", "type_value", "crm_member_detail_id")),
        *also,
    )


def member_cities(orders: DataFrame, crm: DataFrame) -> DataFrame:
    """Distinct (order city, member id); orders are reduced to distinct references before the join."""
    references = member_references(orders).distinct()
    return resolve_identity(references, crm).select("order_city", "omni_member_id").distinct()


def calendar_days(calendar: DataFrame, as_of: date) -> DataFrame:
    """Fiscal periods of the days before ``as_of``."""
    days = calendar.filter((F.col("date_type") == fixed.DAY_ROW) & (F.col("date_id") < F.lit(as_of)))
    return days.select("date_id", "fiscal_year", "fiscal_quarter", "fiscal_month").distinct()


def with_calendar(df: DataFrame, days: DataFrame, date_col: str, prefix: str) -> DataFrame:
    """Fiscal year, quarter and month of ``date_col``, NULL for a day outside ``days``.

    Call it once per role of the calendar, with a prefix each.
    """
    periods = {f"fiscal_{part}": f"{prefix}_fiscal_{part}" for part in ("year", "quarter", "month")}
    return lookup_join(df, days.withColumnsRenamed(periods), {date_col: "date_id"})


def omni_fact(omni: DataFrame, crm: DataFrame, calendar: DataFrame, as_of: date, channels: tuple[str, ...]) -> DataFrame:
    """Eligible order lines with member id and the fiscal periods of the order and of the registration."""
    lines = resolve_identity(omni.filter(eligible(channels, as_of)), crm, ("type_value", "parent_order_id"))
    lines = lines.withColumn("registered_on", F.coalesce("join_time", "first_bind_time"))
    days = calendar_days(calendar, as_of)
    lines = with_calendar(lines, days, "order_paid_date", "trans")
    lines = with_calendar(lines, days, "registered_on", "reg")
    return lines.select(
        "order_city", "order_paid_date", "kyid", "omni_member_id", "parent_order_id", "sales_qty", "if_eff_order_tag",
        "is_member_order", "order_rrp_amt", "trans_fiscal_year", "trans_fiscal_quarter", "trans_fiscal_month",
        "reg_fiscal_year", "reg_fiscal_quarter", "reg_fiscal_month",
    )


def member_transactions(omni: DataFrame, crm: DataFrame, calendar: DataFrame, bands: CityBands, as_of: date) -> DataFrame:
    """Distinct member purchases (city, member, product, fiscal years) in cities with a band."""
    lines = lookup_join(eligible_orders(omni, as_of), bands.typed_cities, {"order_city": "city_cn"}, how="left_semi")
    days = calendar_days(calendar, as_of)
    dated = with_calendar(lines.withColumn("paid_day", F.col("order_paid_time").cast("date")), days, "paid_day", "trans")
    purchases = dated.select(
        "order_city", "type_name", "type_value", "crm_member_detail_id", "sku_id", "trans_fiscal_year",
        "first_bind_time",
    ).distinct()
    resolved = resolve_identity(purchases, crm, ("type_value", "sku_id"))
    resolved = resolved.withColumn("registered_on", F.coalesce("join_time", "first_bind_time"))
    return (
        with_calendar(resolved, days, "registered_on", "reg")
        .select(
            F.col("order_city").alias("city_cn"), "omni_member_id", "sku_id", "trans_fiscal_year", "reg_fiscal_year"
        )
        .distinct()
    )


def registered_through(members: DataFrame, channel: str) -> DataFrame:
    """Distinct ids of members whose registration channels include ``channel``."""
    registered = members.filter(F.col("eff_reg_channel").contains(channel))
    return registered.select(F.col("member_detail_id").cast("string").alias("member_id")).distinct()


def registered_not_purchased(
    members: DataFrame, purchasers: DataFrame, channel: str = fixed.MINI_PROGRAM_MARK
) -> DataFrame:
    """Ids of members registered through ``channel`` that are no ``purchasers.omni_member_id``."""
    registered = registered_through(members, channel)
    return registered.join(purchasers, registered.member_id == purchasers.omni_member_id, "left_anti")


def located_never_bought(located: DataFrame, never_bought: DataFrame) -> DataFrame:
    """Distinct (city, member id) of located members among ``never_bought.member_id``."""
    places = located.select("city_cn", canonical_id(F.col("crm_member_id")).alias("omni_member_id")).distinct()
    return places.join(never_bought, places.omni_member_id == never_bought.member_id, "left_semi")
