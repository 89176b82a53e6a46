"""Canonical tables: the columns the reports read, as Spark DDL.

Ids are text and compared as text; amounts keep six decimals.
"""

from __future__ import annotations

SCHEMAS: dict[str, str] = {
    # Attribute log of tracked users, and which location segment stands for which city
    "prop_log": "gio_id string, prop_key string, prop_value string, update_time timestamp_ntz",
    "segment_map": "prop_key string, city_cn string",
    # Members
    "member": "member_detail_id bigint, city_cn string, eff_reg_channel string, eff_reg_store string, join_time date",
    "crm": "id string, member_id string, join_time date",
    "belong": "member_detail_id bigint, platform_id_value string, belong_type string, eff_belong_channel string",
    "ec_bind": "platform_id_value string, platform_id_type string, platformid string, first_bind_time date",
    # Cities and stores
    "store": "store_code string, city_cn string, store_status string, distributor string",
    "city_type": "city_chn string, city_type string",
    "city_tier": "city_chn string, city_tier string",
    "population": "city_cn string, city_maturity_level string, target_kids_population bigint, "
    "adult_shopper_population bigint",
    # Orders and daily store figures
    "omni": "order_city string, source_channel string, type_name string, type_value string, "
    "crm_member_detail_id string, order_paid_date date, order_paid_time timestamp_ntz, sales_type int, order_type string, "
    "is_member_order boolean, if_eff_order_tag boolean, sku_id string, first_bind_time date, kyid string, "
    "parent_order_id string, sales_qty double, order_rrp_amt decimal(18,6)",
    "member_orders": "city_cn string, crm_member_id string, sales_qty double, order_rrp_amt decimal(18,6), "
    "if_eff_order_tag boolean, original_order_id string, is_rrp_sales_type int, distributor_name string, "
    "date_id date",
    "offline_mart": "city_cn string, date_id date, transactions bigint, traffic_amt decimal(18,6), "
    "gmv_rsp decimal(18,6), return_gmv_rsp decimal(18,6)",
    "traffic": "city_cn string, date_id date, traffic_amt decimal(18,6), agg_type string, distributor string",
    # Calendar and products
    "calendar": "date_id date, date_type string, fiscal_year bigint, fiscal_quarter bigint, fiscal_month bigint",
    "product": "sku_id string, age_mark string",
    "portfolio": "sku_id string, kids_vs_adult string",
}

# Written by the location job and read by the penetration reports.
LOCATED_SCHEMA = "prop_key string, city_cn string, crm_member_id string"
