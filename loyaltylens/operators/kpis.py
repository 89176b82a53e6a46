"""Sales and member measures per segment and year-to-date period.

All measures come from one pass over the order lines: lines are first added up per order and member, the
new-member flag is joined to that smaller set, and one aggregation then yields every sum and every
distinct count of both periods.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltylens.functions import fixed
from loyaltylens.functions.exprs import as_double, change_ratio, eligible, net_amount, safe_div, whole_number_id
from loyaltylens.functions.periods import LY, TY, YtdWindow, in_window, period_of, ytd_window
from loyaltylens.operators.joins import flag_join, left_join_on_optional_key

Labeller = Callable[[DataFrame], DataFrame]

MEASURES = (
    "net", "orders", "member_net", "member_orders", "member_shoppers", "new_net", "new_orders", "new_shoppers",
    "existing_net", "existing_orders", "existing_shoppers",
)
RATIO_KPIS = (
    "member_atv", "member_frequency", "new_member_atv", "new_member_frequency", "existing_member_atv",
    "existing_member_frequency",
)
SHARE_KPIS = ("new_mbr_sales_share", "new_member_shopper_share")
EXISTING_SHARES = ("existing_member_sales_share", "existing_member_shopper_share")


# -- one row per order and member -----------------------------------------------------------------


def per_order(lines: DataFrame) -> DataFrame:
    """Add up lines per city, period, order and member; lines of one order are combined map-side."""
    return lines.groupBy("city", "period", "order_id", "member_id", "is_member").agg(
        F.sum("amount").alias("net"), F.max("effective").alias("effective")
    )


def online_lines(omni: DataFrame, as_of: date, window: YtdWindow) -> DataFrame:
    paid = F.col("order_paid_date")
    kept = omni.filter(in_window(paid, window) & eligible((fixed.ONLINE_CHANNEL,), as_of))
    return kept.select(
        F.col("order_city").alias("city"),
        period_of(paid, window).alias("period"),
        F.col("parent_order_id").alias("order_id"),
        F.col("kyid").alias("member_id"),
        F.coalesce(F.col("is_member_order"), F.lit(False)).alias("is_member"),
        F.coalesce(F.col("if_eff_order_tag"), F.lit(False)).alias("effective"),
        net_amount(F.col("sales_qty"), F.col("order_rrp_amt")).alias("amount"),
    )


def offline_lines(member_orders: DataFrame, window: YtdWindow) -> DataFrame:
    sold = F.col("date_id")
    kept = member_orders.filter(
        in_window(sold, window)
        & (F.col("is_rrp_sales_type") == fixed.RRP_SALES_TYPE)
        & (F.col("distributor_name") != fixed.EXCLUDED_DISTRIBUTOR)
        & F.col("crm_member_id").isNotNull()
    )
    return kept.select(
        F.col("city_cn").alias("city"),
        period_of(sold, window).alias("period"),
        F.col("original_order_id").alias("order_id"),
        F.col("crm_member_id").alias("member_id"),
        F.lit(True).alias("is_member"),
        F.coalesce(F.col("if_eff_order_tag"), F.lit(False)).alias("effective"),
        net_amount(F.col("sales_qty"), F.col("order_rrp_amt")).alias("amount"),
    )


def flag_new_accounts(orders: DataFrame, accounts: DataFrame) -> DataFrame:
    """Online orders with the flag ``is_new``; ``accounts`` are (kyid, period)."""
    on = {"member_id": "kyid", "period": "period"}
    return flag_join(orders, accounts, on, "member_id", "is_new", ["order_id", "city"])


def flag_new_members(orders: DataFrame, cohort: DataFrame) -> DataFrame:
    """Offline orders with the flag ``is_new``; ``cohort`` is (member_id, period).

    Members are matched as numbers but counted as they are written.
    """
    numbered = orders.withColumn("_member_number", whole_number_id(F.col("member_id")))
    on = {"_member_number": "member_id", "period": "period"}
    return flag_join(numbered, cohort, on, "_member_number", "is_new", ["order_id", "city"]).drop("_member_number")


def mark_new_members(orders: DataFrame, cohort: DataFrame) -> DataFrame:
    """Offline orders with ``is_new`` and ``is_new_in_store``, from one join; ``cohort`` is (member_id, period, through_store)."""
    numbered = orders.withColumn("_member_number", whole_number_id(F.col("member_id")))
    others = cohort.withColumnsRenamed({"member_id": "_new_member", "period": "_new_period", "through_store": "_through_store"})
    joined = left_join_on_optional_key(
        numbered, "_member_number", others, "_new_member", spread=["order_id", "city"], also={"period": "_new_period"}
    )
    flags = {
        "is_new": F.col("_through_store").isNotNull(),
        "is_new_in_store": F.coalesce(F.col("_through_store"), F.lit(False)),
    }
    return joined.withColumns(flags).drop("_member_number", "_new_member", "_new_period", "_through_store")


# -- measures -------------------------------------------------------------------------------------


# Classes of an order row as bits, so that a set of rows is described by OR-ing them.
OTHER_BUYER, NEW_MEMBER, EXISTING_MEMBER = 1, 2, 4


def order_measures(orders: DataFrame, label: Labeller, segment: str, is_new: Column | None = None) -> DataFrame:
    """All sums and distinct counts per ``segment`` and period.

    Every order row stands once for its order, with its amount, and once for its member.  These are first added up
    per segment, period and key, where the classes of buyers become one number; a distinct count is then the number
    of keys with a class.  However often an order or a member occurs, each task sends one row for it, whatever the
    number of counts.
    """
    is_new = F.col("is_new") if is_new is None else is_new
    buyer = (
        F.when(~F.col("is_member"), OTHER_BUYER)
        .when(is_new, NEW_MEMBER)
        .otherwise(EXISTING_MEMBER)
    )
    seen = F.when(F.col("effective"), F.col("buyer")).otherwise(0)
    nothing = F.lit(None).cast("int")

    def key_row(is_order: bool) -> Column:
        key = F.col("order_id" if is_order else "member_id").cast("string")
        amount = F.col("net") if is_order else F.lit(None).cast(dict(orders.dtypes)["net"])
        return F.struct(
            F.lit(is_order).alias("is_order"), key.alias("key"), amount.alias("net"),
            (F.col("buyer") if is_order else nothing).alias("buyer"), seen.alias("seen"),
        )

    def net(kind: int) -> Column:
        return F.sum(F.when(F.col("buyer") == kind, F.col("net"))).alias(f"net_{kind}")

    kinds = (OTHER_BUYER, NEW_MEMBER, EXISTING_MEMBER)
    each = label(orders).withColumn("buyer", buyer).select(segment, "period", F.inline(F.array(key_row(True), key_row(False))))
    by_key = each.groupBy(segment, "period", "is_order", "key").agg(*map(net, kinds), F.bit_or("seen").alias("seen"))

    def total(*of: int) -> Column:
        return sum((F.coalesce(F.sum(f"net_{k}"), F.lit(0)) for k in of[1:]), F.coalesce(F.sum(f"net_{of[0]}"), F.lit(0)))

    def distinct(is_order: bool, of: int) -> Column:
        of_kind = F.col("is_order") if is_order else ~F.col("is_order")
        return F.count_if(of_kind & F.col("key").isNotNull() & (F.col("seen").bitwiseAND(of) != 0))

    member = NEW_MEMBER | EXISTING_MEMBER
    return by_key.groupBy(segment, "period").agg(
        total(*kinds).alias("net"),
        distinct(True, OTHER_BUYER | member).alias("orders"),
        total(NEW_MEMBER, EXISTING_MEMBER).alias("member_net"),
        distinct(True, member).alias("member_orders"),
        distinct(False, member).alias("member_shoppers"),
        total(NEW_MEMBER).alias("new_net"),
        distinct(True, NEW_MEMBER).alias("new_orders"),
        distinct(False, NEW_MEMBER).alias("new_shoppers"),
        total(EXISTING_MEMBER).alias("existing_net"),
        distinct(True, EXISTING_MEMBER).alias("existing_orders"),
        distinct(False, EXISTING_MEMBER).alias("existing_shoppers"),
    )


def compare_periods(measures: DataFrame, segment: str, columns: tuple[str, ...]) -> DataFrame:
    """One row per segment of this year, with columns ``<name>_ty`` and ``<name>_ly``.

    Segments that only occur last year are left out.  The row without a segment is compared with nothing.
    """

    def value(column: str, period: str) -> Column:
        return F.max(F.when(F.col("period") == period, F.col(column)))

    both = measures.groupBy(segment).agg(
        F.max(F.col("period") == TY).alias("_has_ty"),
        *(value(c, TY).alias(f"{c}_ty") for c in columns),
        *(value(c, LY).alias(f"_{c}_ly") for c in columns),
    )
    return both.filter("_has_ty").select(
        segment,
        *(f"{c}_ty" for c in columns),
        *(F.when(F.col(segment).isNotNull(), F.col(f"_{c}_ly")).alias(f"{c}_ly") for c in columns),
    )


# -- ratios ---------------------------------------------------------------------------------------


def member_kpi_columns(suffix: str = "", *, existing_shares: bool = False) -> dict[str, Column]:
    """KPI expressions over measures named ``<measure><suffix>``."""

    def ratio(a: str, b: str) -> Column:
        return safe_div(F.col(f"{a}{suffix}"), F.col(f"{b}{suffix}"))

    columns = {
        "member_atv": ratio("member_net", "member_orders"),
        "member_frequency": ratio("member_orders", "member_shoppers"),
        "new_mbr_sales_share": ratio("new_net", "member_net"),
        "new_member_shopper_share": ratio("new_shoppers", "member_shoppers"),
        "new_member_atv": ratio("new_net", "new_orders"),
        "new_member_frequency": ratio("new_orders", "new_shoppers"),
        "existing_member_atv": ratio("existing_net", "existing_orders"),
        "existing_member_frequency": ratio("existing_orders", "existing_shoppers"),
    }
    if existing_shares:
        columns["existing_member_sales_share"] = ratio("existing_net", "member_net")
        columns["existing_member_shopper_share"] = ratio("existing_shoppers", "member_shoppers")
    return columns


def member_kpis(measures: DataFrame, segment: str, *, existing_shares: bool = False) -> DataFrame:
    """KPI pack per segment and period."""
    columns = member_kpi_columns(existing_shares=existing_shares)
    return measures.select(segment, "period", *(c.alias(name) for name, c in columns.items()))


def kpi_growth_columns() -> dict[str, Column]:
    """This year's KPIs and their change: ratio for averages, difference for shares."""
    ty, ly = member_kpi_columns("_ty"), member_kpi_columns("_ly")
    columns: dict[str, Column] = {}
    for name in ty:
        columns[name] = ty[name]
        columns[f"{name}_vs_LY"] = ty[name] - ly[name] if name in SHARE_KPIS else change_ratio(ty[name], ly[name])
    return columns


def kpi_vs_ly(measures: DataFrame, segment: str) -> DataFrame:
    both = compare_periods(measures, segment, MEASURES)
    return both.select(segment, *(c.alias(name) for name, c in kpi_growth_columns().items()))


def sales_growth_columns(
    net: str, orders: str, traffic: str | None = None, *, shifted: str | None = None
) -> dict[str, Column]:
    """Sales figures of this year and their change against last year.

    ``shifted`` names one change (``sales_vs_LY`` or ``atv_vs_LY``) to compute as ``TY / (LY - 1)``, a
    form that two of the older reports print in place of ``TY / LY - 1``.
    """

    def change(name: str, current: Column, previous: Column) -> Column:
        if name == shifted:
            return safe_div(current, as_double(previous) - F.lit(1.0))
        return change_ratio(current, previous)

    def col(name: str, period: str) -> Column:
        return F.col(f"{name}_{period}")

    atv_ty = safe_div(col(net, "ty"), col(orders, "ty"))
    atv_ly = safe_div(col(net, "ly"), col(orders, "ly"))
    columns: dict[str, Column] = {}
    if traffic:
        columns["traffic"] = as_double(col(traffic, "ty"))
    columns["sales_rrp"] = as_double(col(net, "ty"))
    columns["transactions"] = col(orders, "ty").cast("bigint")
    columns["atv"] = atv_ty
    if traffic:
        columns["traffic_vs_LY"] = change_ratio(col(traffic, "ty"), col(traffic, "ly"))
    columns["sales_vs_LY"] = change("sales_vs_LY", col(net, "ty"), col(net, "ly"))
    columns["transactions_vs_LY"] = change_ratio(col(orders, "ty"), col(orders, "ly"))
    columns["atv_vs_LY"] = change("atv_vs_LY", atv_ty, atv_ly)
    return columns


# -- offline sales --------------------------------------------------------------------------------


def offline_sales(mart: DataFrame, window: YtdWindow, label: Labeller, segment: str) -> DataFrame:
    """Visitors, transactions and net sales per segment and period.

    Everything here is a sum, so the store figures are added up per city first and only the few city rows
    are labelled.
    """
    day = F.col("date_id")
    by_city = (
        mart.filter(in_window(day, window))
        .groupBy(F.col("city_cn").alias("city"), period_of(day, window).alias("period"))
        .agg(
            F.sum("transactions").alias("transactions"),
            F.sum("traffic_amt").alias("traffic"),
            F.sum("gmv_rsp").alias("gross"),
            F.sum("return_gmv_rsp").alias("returned"),
        )
    )
    totals = (
        label(by_city)
        .groupBy(segment, "period")
        .agg(*(F.sum(c).alias(c) for c in ("transactions", "traffic", "gross", "returned")))
    )
    return totals.select(
        segment, "period", "traffic", (F.col("gross") - F.col("returned")).alias("sales_rrp"), "transactions"
    )


OFFLINE_SALES = ("traffic", "sales_rrp", "transactions")


def online_window(as_of: date) -> YtdWindow:
    return ytd_window(as_of, ty_open=False)


def offline_window(as_of: date) -> YtdWindow:
    return ytd_window(as_of, ty_open=True)
