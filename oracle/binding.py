"""The canonical tables as common table expressions over the generated tables."""

from __future__ import annotations

import re

AS_OF = "DATE '2001-06-15'"
TY_START = "DATE '2001-01-01'"
NEXT_YEAR = "DATE '2002-01-01'"
LY_START = "DATE '2000-01-01'"
LY_END = "DATE '2000-06-15'"

_SIGN = "CASE WHEN l_returnflag = 'R' THEN -{0} ELSE {0} END"
_QUANTITY = f"CASE l_linenumber WHEN 6 THEN 0 WHEN 7 THEN NULL ELSE {_SIGN.format('l_quantity')} END"
_EFFECTIVE = "CASE WHEN o_orderkey % 19 <> 0 THEN o_orderstatus <> 'P' END"
_DISTRIBUTOR = "CASE {0} % 3 WHEN 0 THEN 'LCS-A' WHEN 1 THEN 'LCS-B' ELSE 'LBR' END"
_JOINED = "DATE '1995-01-01' + CAST(c_custkey * 37 % 2400 AS INT)"
_SOLD = """lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
_SHOPS = "lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"

TABLES: dict[str, str] = {
    "city_type": """SELECT n_name AS city_chn,
        CASE n_regionkey WHEN 0 THEN '1_mature' WHEN 1 THEN '2_core' ELSE '3_uprising' END AS city_type
        FROM nation WHERE n_regionkey < 3""",
    "city_tier": """SELECT n_name AS city_chn, 'T' || (n_nationkey % 4 + 1) AS city_tier
        FROM nation WHERE n_nationkey < 20""",
    "store": f"""SELECT CAST(s_suppkey AS VARCHAR) AS store_code, n_name AS city_cn,
        CASE WHEN s_acctbal > 0 THEN '营业中' ELSE 'closed' END AS store_status,
        {_DISTRIBUTOR.format("s_suppkey")} AS distributor
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "population": """SELECT n_name AS city_cn,
        CASE n_regionkey WHEN 0 THEN 'Mature' WHEN 1 THEN 'Core' WHEN 2 THEN 'Uprising' END AS city_maturity_level,
        CAST(1000 + 37 * count(*) AS BIGINT) AS target_kids_population,
        CAST(5000 + 91 * count(*) AS BIGINT) AS adult_shopper_population
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey < 22 GROUP BY n_name, n_regionkey""",
    "member": f"""SELECT c_custkey AS member_detail_id, n_name AS city_cn,
        CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'LCS' WHEN 'BUILDING' THEN 'LCS,WMP' WHEN 'MACHINERY' THEN 'WMP'
            WHEN 'FURNITURE' THEN 'TMALL' ELSE 'DOUYIN' END AS eff_reg_channel,
        CAST(c_custkey // 15 AS VARCHAR) AS eff_reg_store, {_JOINED} AS join_time
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "crm": f"""SELECT CAST(c_custkey AS VARCHAR) AS id, 'K' || c_custkey AS member_id, {_JOINED} + 200 AS join_time
        FROM customer WHERE c_custkey % 13 <> 0""",
    "belong": """SELECT CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey END AS member_detail_id,
        'p-' || (c_custkey % 700) AS platform_id_value,
        CASE WHEN c_custkey % 11 = 0 THEN 'other' ELSE 'registerOrBind' END AS belong_type,
        CASE WHEN c_custkey % 2 = 0 THEN 'TMall' ELSE 'Douyin' END AS eff_belong_channel FROM customer""",
    "ec_bind": """SELECT CAST(c_custkey AS VARCHAR) AS platform_id_value,
        CASE WHEN c_custkey % 9 = 0 THEN 'openid' ELSE 'kyid' END AS platform_id_type,
        CASE WHEN c_custkey % 10 = 0 THEN 'douyin' ELSE 'taobao' END AS platformid,
        DATE '1995-01-01' + CAST(c_custkey * 53 % 2400 AS INT) AS first_bind_time FROM customer""",
    "omni": f"""SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE n_name END AS order_city,
        CASE o_orderkey % 3 WHEN 0 THEN 'LCS' WHEN 1 THEN 'TMALL' ELSE 'DOUYIN' END AS source_channel,
        CASE o_orderkey % 4 WHEN 0 THEN 'CRM_memberid' WHEN 1 THEN 'DY_openid' WHEN 2 THEN 'TMALL_kyid'
            ELSE 'other' END AS type_name,
        'ext-' || o_custkey AS type_value,
        CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 'K' || o_custkey END AS crm_member_detail_id,
        CAST(o_orderdate AS DATE) AS order_paid_date,
        o_orderdate + INTERVAL 1 MINUTE * (CASE WHEN o_orderkey % 6 = 0 THEN 40 * 1440 ELSE 10 END) AS order_paid_time,
        l_linenumber AS sales_type,
        CASE WHEN l_linestatus = 'F' THEN 'normal' ELSE 'presale' END AS order_type,
        CASE WHEN o_custkey % 17 <> 0 THEN o_custkey % 4 <> 0 END AS is_member_order, {_EFFECTIVE} AS if_eff_order_tag,
        CAST(l_partkey AS VARCHAR) AS sku_id,
        DATE '1995-01-01' + CAST(o_custkey * 53 % 2400 AS INT) AS first_bind_time,
        CAST(o_custkey AS VARCHAR) AS kyid, CAST(o_orderkey AS VARCHAR) AS parent_order_id,
        {_QUANTITY} AS sales_qty,
        CAST({_SIGN.format("l_extendedprice")} AS DECIMAL(18,6)) AS order_rrp_amt
        FROM {_SOLD}""",
    "member_orders": f"""SELECT n_name AS city_cn,
        CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS crm_member_id,
        {_QUANTITY} AS sales_qty,
        CAST({_SIGN.format("l_extendedprice")} AS DECIMAL(18,6)) AS order_rrp_amt,
        {_EFFECTIVE} AS if_eff_order_tag, CAST(o_orderkey AS VARCHAR) AS original_order_id,
        CASE WHEN l_linenumber = 3 THEN 0 ELSE 1 END AS is_rrp_sales_type,
        {_DISTRIBUTOR.format("l_suppkey")} AS distributor_name, CAST(o_orderdate AS DATE) AS date_id
        FROM {_SOLD}""",
    "offline_mart": f"""SELECT n_name AS city_cn, CAST(l_shipdate AS DATE) AS date_id,
        count(DISTINCT l_orderkey) AS transactions,
        CAST(sum(CAST(l_quantity AS DECIMAL(18,6))) AS DECIMAL(18,6)) AS traffic_amt,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,6))) AS DECIMAL(18,6)) AS gmv_rsp,
        CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,6)) ELSE 0 END)
            AS DECIMAL(18,6)) AS return_gmv_rsp
        FROM {_SHOPS} GROUP BY n_name, CAST(l_shipdate AS DATE)""",
    "traffic": f"""SELECT n_name AS city_cn, CAST(l_shipdate AS DATE) AS date_id,
        CAST(l_quantity AS DECIMAL(18,6)) AS traffic_amt,
        CASE WHEN l_linenumber % 2 = 1 THEN 'brand' ELSE 'other' END AS agg_type,
        {_DISTRIBUTOR.format("l_suppkey")} AS distributor FROM {_SHOPS}""",
    "calendar": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_id, 'day' AS date_type,
        year(o_orderdate) AS fiscal_year, quarter(o_orderdate) AS fiscal_quarter, month(o_orderdate) AS fiscal_month
        FROM orders""",
    "product": """SELECT CAST(p_partkey AS VARCHAR) AS sku_id, CASE p_partkey % 6 WHEN 0 THEN p_size || '+'
        WHEN 1 THEN p_size || '-' || (p_size + 3) WHEN 2 THEN '1 1/2' WHEN 3 THEN 'N/A' WHEN 4 THEN NULL
        ELSE CAST(p_size AS VARCHAR) END AS age_mark FROM part""",
    "portfolio": """SELECT CAST(p_partkey AS VARCHAR) AS sku_id,
        CASE WHEN p_size >= 25 THEN 'adult product' ELSE 'kids product' END AS kids_vs_adult FROM part""",
    "prop_log": """SELECT CAST(user_id AS VARCHAR) AS gio_id,
        CASE WHEN event_type = 'signup' THEN 'usr_crm_member_id' ELSE event_type END AS prop_key,
        CASE WHEN event_type = 'signup' THEN CAST(user_id AS VARCHAR) WHEN event_id % 2 = 0 THEN '1' ELSE '0' END
            AS prop_value,
        date_trunc('day', ts) AS update_time FROM events""",
    "segment_map": """SELECT * FROM (VALUES ('view', 'NATION_0'), ('click', 'NATION_1'), ('purchase', 'NATION_2'),
        ('purchase', 'NATION_3')) AS pairs(prop_key, city_cn)""",
}


def with_tables(body: str, helpers: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the tables and helper expressions it mentions, directly or not."""
    known = {**TABLES, **(helpers or {})}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in order and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(known[name])
                if name not in order:
                    order.append(name)

    visit(body)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({known[name]})" for name in order) + "\n" + body
