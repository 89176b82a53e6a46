"""Plain Python versions of the reports, written row by row from their definitions."""

from __future__ import annotations

from collections import defaultdict
from datetime import date

KPI_NAMES = (
    "member_atv", "member_frequency", "new_mbr_sales_share", "new_member_shopper_share", "new_member_atv",
    "new_member_frequency", "existing_member_atv", "existing_member_frequency",
)
SHARES = ("new_mbr_sales_share", "new_member_shopper_share")


def div(a, b):
    return None if a is None or b is None or b == 0 else float(a) / float(b)


def change(a, b):
    ratio = div(a, b)
    return None if ratio is None else ratio - 1.0


def minus(a, b):
    return None if a is None or b is None else a - b


def is_eligible(row: dict, as_of: date, channels) -> bool:
    if row["source_channel"] not in channels or not row["order_paid_date"] < as_of:
        return False
    if row["source_channel"] == "LCS":
        return row["sales_type"] is not None and row["sales_type"] != 3
    return row["order_type"] == "normal"


def period(day: date, as_of: date) -> str | None:
    if day.year == as_of.year:
        return "TY"
    return "LY" if day.year == as_of.year - 1 and day < as_of.replace(year=as_of.year - 1) else None


def segments(city, grain: str, channel: str, tables: dict) -> list:
    """Segments a row of this city counts under, with the total."""
    if grain == "city":
        return [city]
    if grain == "tier":
        found = {r["city_tier"] for r in tables["city_tier"] if city is not None and r["city_chn"] == city}
        return [*(found or {"Others"}), "TTL"]
    if city is None and channel == "online":
        return ["no order city", "TTL"]
    has_store = any(r["city_cn"] == city for r in tables["store"]) and city is not None
    found = {r["city_type"] for r in tables["city_type"] if has_store and r["city_chn"] == city}
    return [*(found or {"4_unspecified"}), "TTL"]


def measures(rows: list[dict]) -> dict:
    def net(kept):
        return sum((r["amount"] or 0) if r["qty"] > 0 else -abs(r["amount"] or 0) for r in kept if r["qty"])

    def count(kept, key):
        return len({r[key] for r in kept if r["effective"] and r[key] is not None})

    groups = {
        "member": [r for r in rows if r["is_member"]],
        "new": [r for r in rows if r["is_member"] and r["is_new"]],
        "existing": [r for r in rows if r["is_member"] and not r["is_new"]],
    }
    net_of = {name: net(kept) for name, kept in groups.items()}
    orders = {name: count(kept, "order") for name, kept in groups.items()}
    shoppers = {name: count(kept, "member") for name, kept in groups.items()}
    result = {"sales_rrp": net(rows), "transactions": count(rows, "order")}
    for name, prefix in (("member", "member"), ("new", "new_member"), ("existing", "existing_member")):
        result[f"{prefix}_atv"] = div(net_of[name], orders[name])
        result[f"{prefix}_frequency"] = div(orders[name], shoppers[name])
    result["new_mbr_sales_share"] = div(net_of["new"], net_of["member"])
    result["new_member_shopper_share"] = div(shoppers["new"], shoppers["member"])
    return result


def order_rows(tables: dict, channel: str, grain: str, as_of: date) -> list[dict]:
    """Order lines in one shape, with period and new-member flag."""
    rows = []
    if channel == "online":
        new = {
            (r["platform_id_value"], period(r["first_bind_time"], as_of))
            for r in tables["ec_bind"]
            if r["platform_id_type"] == "kyid" and r["platformid"] == "taobao"
        }
        for r in tables["omni"]:
            if is_eligible(r, as_of, ("TMALL",)):
                when = period(r["order_paid_date"], as_of)
                rows.append({
                    "city": r["order_city"], "period": when, "order": r["parent_order_id"], "member": r["kyid"],
                    "qty": r["sales_qty"], "amount": r["order_rrp_amt"], "effective": r["if_eff_order_tag"] is True,
                    "is_member": r["is_member_order"] is True, "is_new": (r["kyid"], when) in new and when is not None,
                })
        return rows
    new = {
        (r["member_detail_id"], period(r["join_time"], as_of))
        for r in tables["member"]
        if grain == "city" or "LCS" in (r["eff_reg_channel"] or "")
    }
    for r in tables["member_orders"]:
        if r["is_rrp_sales_type"] == 1 and r["distributor_name"] not in (None, "LBR") and r["crm_member_id"] is not None:
            when = period(r["date_id"], as_of)
            rows.append({
                "city": r["city_cn"], "period": when, "order": r["original_order_id"], "member": r["crm_member_id"],
                "qty": r["sales_qty"], "amount": r["order_rrp_amt"], "effective": r["if_eff_order_tag"] is True,
                "is_member": True, "is_new": (int(r["crm_member_id"]), when) in new,
            })
    return rows


def scorecard(tables: dict, channel: str, grain: str, as_of: date) -> dict:
    """Segment -> figures.  The row without a segment has no comparison and no KPIs."""
    grouped: dict = defaultdict(list)
    for row in order_rows(tables, channel, grain, as_of):
        if row["period"]:
            for segment in segments(row["city"], grain, channel, tables):
                grouped[segment, row["period"]].append(row)
    facts = {key: measures(rows) for key, rows in grouped.items()}
    if channel == "online":
        sales = facts
        names = ("sales_rrp", "transactions")
    else:
        names = ("traffic", "sales_rrp", "transactions")
        sales = defaultdict(lambda: dict.fromkeys(names, 0))
        for r in tables["offline_mart"]:
            when = period(r["date_id"], as_of)
            for segment in segments(r["city_cn"], grain, channel, tables) if when else ():
                total = sales[segment, when]
                total["traffic"] += r["traffic_amt"]
                total["sales_rrp"] += r["gmv_rsp"] - r["return_gmv_rsp"]
                total["transactions"] += r["transactions"]
    report = {}
    for segment, when in list(sales):
        if when != "TY":
            continue
        ty = sales[segment, "TY"]
        ly = sales[segment, "LY"] if segment is not None and (segment, "LY") in sales else dict.fromkeys(names)
        row = {name: ty[name] for name in names}
        row["atv"] = div(ty["sales_rrp"], ty["transactions"])
        row["atv_vs_LY"] = change(row["atv"], div(ly["sales_rrp"], ly["transactions"]))
        for name in names:
            row[f"{name.removesuffix('_rrp')}_vs_LY"] = change(ty[name], ly[name])
        kpi_ty = facts.get((segment, "TY")) if segment is not None else None
        kpi_ly = facts.get((segment, "LY")) if segment is not None else None
        for name in KPI_NAMES:
            a, b = (kpi_ty or {}).get(name), (kpi_ly or {}).get(name)
            row[name] = a
            row[f"{name}_vs_LY"] = minus(a, b) if name in SHARES else change(a, b)
        report[segment] = row
    return report


def city_members(tables: dict, adult: set, as_of: date) -> dict:
    """City -> (member base, kids shoppers, adult shoppers, share of new shoppers this year)."""
    typed = {t["city_chn"] for t in tables["city_type"] if t["city_type"]} & {s["city_cn"] for s in tables["store"]}
    typed_stores = {s["store_code"] for s in tables["store"] if s["city_cn"] in typed}
    years = {r["date_id"]: r["fiscal_year"] for r in tables["calendar"] if r["date_type"] == "day" and r["date_id"] < as_of}
    crm = {r["member_id"]: r for r in tables["crm"]}
    base, kids, adults, ty, new = (defaultdict(set) for _ in range(5))
    bought = set()
    buyer_cities = set()
    for r in tables["omni"]:
        member_order = r["is_member_order"] and r["if_eff_order_tag"]
        if not (is_eligible(r, as_of, ("LCS", "TMALL", "DOUYIN", "DOUYIN_B2B")) and member_order):
            continue
        person = crm.get(r["crm_member_detail_id"])
        who = None
        if r["type_name"] in ("CRM_memberid", "DY_openid", "TMALL_kyid"):
            who = str(person["id"]) if person else r["type_value"]
        bought.add(who)
        city = r["order_city"]
        if city not in typed:
            continue
        buyer_cities.add(city)
        base[city].add(who)
        if r["sku_id"] is not None:
            (adults if r["sku_id"] in adult else kids)[city].add(who)
        if years.get(r["order_paid_date"]) == as_of.year:
            ty[city].add(who)
            if years.get(person["join_time"] if person else r["first_bind_time"]) == as_of.year:
                new[city].add(who)
    wmp = set()
    for m in tables["member"]:
        channel = m["eff_reg_channel"] or ""
        if "LCS" in channel and m["eff_reg_store"] in typed_stores:
            base[m["city_cn"]].add(str(m["member_detail_id"]))
        if "WMP" in channel:
            wmp.add(str(m["member_detail_id"]))
    for r in tables["located"]:
        who = str(int(r["crm_member_id"]))
        if who in wmp and who not in bought:
            base[r["city_cn"]].add(who)

    def size(group, city):
        return len(group[city] - {None}) if city in buyer_cities else None

    return {
        city: (len(people - {None}), size(kids, city), size(adults, city), div(size(new, city), size(ty, city)))
        for city, people in base.items()
    }
