"""The canonical tables, derived from the generated star-schema tables.

Customers act as members, nations as cities and order lines as sales; the rules are listed in
``FIXTURES.md``.  Every table is a lazy DataFrame over the Parquet files.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyaltylens.functions import fixed
from loyaltylens.functions.exprs import MONEY
from loyaltylens.plans.location import segment_members

AS_OF = date(2001, 6, 15)

# Stated, so that planning a query reads no file footers.
RAW_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
FOOTFALL_ROWS = "brand"

_JOINED = "date '1995-01-01' + cast(c_custkey * 37 % 2400 as int)"
_SIGNED = "case when l_returnflag = 'R' then -{0} else {0} end"
_QUANTITY = f"case l_linenumber when 6 then 0 when 7 then null else {_SIGNED.format('l_quantity')} end"
_EFFECTIVE = "case when o_orderkey % 19 <> 0 then o_orderstatus <> 'P' end"
_DISTRIBUTOR = "case {0} % 3 when 0 then 'LCS-A' when 1 then 'LCS-B' else 'LBR' end"


class RetailBinding(Mapping[str, DataFrame]):
    """Canonical tables by name over one folder of generated Parquet files."""

    _names = (
        "prop_log", "segment_map", "member", "crm", "belong", "ec_bind", "store", "city_type", "city_tier",
        "population", "omni", "member_orders", "offline_mart", "traffic", "calendar", "product", "portfolio",
        "located",
    )

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark = spark
        self._dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._cache:
            self._cache[name] = getattr(self, f"_{name}")()
        return self._cache[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def raw(self, name: str) -> DataFrame:
        return self._spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self._dir}/{name}.parquet")

    # -- cities and stores ---------------------------------------------------------------------

    def _city_type(self) -> DataFrame:
        return self.raw("nation").filter("n_regionkey < 3").selectExpr(
            "n_name city_chn",
            "case n_regionkey when 0 then '1_mature' when 1 then '2_core' else '3_uprising' end city_type",
        )

    def _city_tier(self) -> DataFrame:
        return self.raw("nation").filter("n_nationkey < 20").selectExpr(
            "n_name city_chn", "concat('T', cast(n_nationkey % 4 + 1 as string)) city_tier"
        )

    def _store(self) -> DataFrame:
        nation = self.raw("nation")
        return self.raw("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
            "cast(s_suppkey as string) store_code",
            "n_name city_cn",
            f"case when s_acctbal > 0 then '{fixed.OPEN_STATUS}' else 'closed' end store_status",
            f"{_DISTRIBUTOR.format('s_suppkey')} distributor",
        )

    def _population(self) -> DataFrame:
        cities = self.raw("nation").filter("n_nationkey < 22")
        heads = self.raw("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("heads"))
        return cities.join(heads, F.col("n_nationkey") == F.col("c_nationkey")).selectExpr(
            "n_name city_cn",
            "case n_regionkey when 0 then 'Mature' when 1 then 'Core' when 2 then 'Uprising' end city_maturity_level",
            "1000 + 37 * heads target_kids_population",
            "5000 + 91 * heads adult_shopper_population",
        )

    # -- members -------------------------------------------------------------------------------

    def _member(self) -> DataFrame:
        nation = self.raw("nation")
        return self.raw("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
            "c_custkey member_detail_id",
            "n_name city_cn",
            "case c_mktsegment when 'HOUSEHOLD' then 'LCS' when 'BUILDING' then 'LCS,WMP' when 'MACHINERY' then 'WMP'"
            " when 'FURNITURE' then 'TMALL' else 'DOUYIN' end eff_reg_channel",
            "cast(c_custkey div 15 as string) eff_reg_store",
            f"{_JOINED} join_time",
        )

    def _crm(self) -> DataFrame:
        """Keys that are no numbers, other join dates than the members', and members that are missing here."""
        return self.raw("customer").filter("c_custkey % 13 <> 0").selectExpr(
            "cast(c_custkey as string) id", "concat('K', cast(c_custkey as string)) member_id", f"{_JOINED} + 200 join_time"
        )

    def _belong(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "case when c_custkey % 3 <> 0 then c_custkey end member_detail_id",
            "concat('p-', cast(c_custkey % 700 as string)) platform_id_value",
            "case when c_custkey % 11 = 0 then 'other' else 'registerOrBind' end belong_type",
            "case when c_custkey % 2 = 0 then 'TMall' else 'Douyin' end eff_belong_channel",
        )

    def _ec_bind(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "cast(c_custkey as string) platform_id_value",
            "case when c_custkey % 9 = 0 then 'openid' else 'kyid' end platform_id_type",
            "case when c_custkey % 10 = 0 then 'douyin' else 'taobao' end platformid",
            "date '1995-01-01' + cast(c_custkey * 53 % 2400 as int) first_bind_time",
        )

    # -- orders --------------------------------------------------------------------------------

    def _sold_lines(self) -> DataFrame:
        """Order lines with the buyer's city."""
        nation = self.raw("nation").select("n_nationkey", "n_name")
        city = self.raw("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        orders = self.raw("orders").join(city, F.col("o_custkey") == F.col("c_custkey"))
        return self.raw("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def _omni(self) -> DataFrame:
        return self._sold_lines().selectExpr(
            "case when o_orderpriority <> '4-NOT SPECIFIED' then n_name end order_city",
            "case o_orderkey % 3 when 0 then 'LCS' when 1 then 'TMALL' else 'DOUYIN' end source_channel",
            "case o_orderkey % 4 when 0 then 'CRM_memberid' when 1 then 'DY_openid' when 2 then 'TMALL_kyid'"
            " else 'other' end type_name",
            "concat('ext-', cast(o_custkey as string)) type_value",
            "case when o_custkey % 5 <> 0 then concat('K', cast(o_custkey as string)) end crm_member_detail_id",
            "cast(o_orderdate as date) order_paid_date",
            "o_orderdate + make_dt_interval(if(o_orderkey % 6 = 0, 40, 0), 0, if(o_orderkey % 6 = 0, 0, 10)) order_paid_time",
            "l_linenumber sales_type",
            "case when l_linestatus = 'F' then 'normal' else 'presale' end order_type",
            "case when o_custkey % 17 <> 0 then o_custkey % 4 <> 0 end is_member_order",
            f"{_EFFECTIVE} if_eff_order_tag",
            "cast(l_partkey as string) sku_id",
            "date '1995-01-01' + cast(o_custkey * 53 % 2400 as int) first_bind_time",
            "cast(o_custkey as string) kyid",
            "cast(o_orderkey as string) parent_order_id",
            f"{_QUANTITY} sales_qty",
            f"cast({_SIGNED.format('l_extendedprice')} as {MONEY}) order_rrp_amt",
        )

    def _member_orders(self) -> DataFrame:
        return self._sold_lines().selectExpr(
            "n_name city_cn",
            "case when o_custkey % 7 <> 0 then cast(o_custkey as string) end crm_member_id",
            f"{_QUANTITY} sales_qty",
            f"cast({_SIGNED.format('l_extendedprice')} as {MONEY}) order_rrp_amt",
            f"{_EFFECTIVE} if_eff_order_tag",
            "cast(o_orderkey as string) original_order_id",
            "case when l_linenumber = 3 then 0 else 1 end is_rrp_sales_type",
            f"{_DISTRIBUTOR.format('l_suppkey')} distributor_name",
            "cast(o_orderdate as date) date_id",
        )

    def _offline_mart(self) -> DataFrame:
        nation = self.raw("nation").select("n_nationkey", "n_name")
        shops = self.raw("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        lines = self.raw("lineitem").join(shops, F.col("l_suppkey") == F.col("s_suppkey")).selectExpr(
            "n_name city_cn",
            "cast(l_shipdate as date) date_id",
            "l_orderkey",
            f"cast(l_quantity as {MONEY}) quantity",
            f"cast(l_extendedprice as {MONEY}) price",
            "l_returnflag = 'R' returned",
        )
        zero = F.lit(0).cast(MONEY)
        return lines.groupBy("city_cn", "date_id").agg(
            F.count_distinct("l_orderkey").alias("transactions"),
            F.sum("quantity").cast(MONEY).alias("traffic_amt"),
            F.sum("price").cast(MONEY).alias("gmv_rsp"),
            F.sum(F.when(F.col("returned"), F.col("price")).otherwise(zero)).cast(MONEY).alias("return_gmv_rsp"),
        )

    def _traffic(self) -> DataFrame:
        """Daily visitors per shop city: half of the rows carry the brand's own count."""
        nation = self.raw("nation").select("n_nationkey", "n_name")
        shops = self.raw("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        return self.raw("lineitem").join(shops, F.col("l_suppkey") == F.col("s_suppkey")).selectExpr(
            "n_name city_cn",
            "cast(l_shipdate as date) date_id",
            f"cast(l_quantity as {MONEY}) traffic_amt",
            f"case when l_linenumber % 2 = 1 then '{FOOTFALL_ROWS}' else 'other' end agg_type",
            f"{_DISTRIBUTOR.format('l_suppkey')} distributor",
        )

    # -- calendar and products -----------------------------------------------------------------

    def _calendar(self) -> DataFrame:
        return self.raw("orders").selectExpr("cast(o_orderdate as date) date_id").distinct().selectExpr(
            "date_id",
            f"'{fixed.DAY_ROW}' date_type",
            "cast(year(date_id) as bigint) fiscal_year",
            "cast(quarter(date_id) as bigint) fiscal_quarter",
            "cast(month(date_id) as bigint) fiscal_month",
        )

    def _product(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "cast(p_partkey as string) sku_id",
            "case p_partkey % 6 when 0 then concat(cast(p_size as string), '+')"
            " when 1 then concat(cast(p_size as string), '-', cast(p_size + 3 as string))"
            " when 2 then '1 1/2' when 3 then 'N/A' when 5 then cast(p_size as string) end age_mark",
        )

    def _portfolio(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "cast(p_partkey as string) sku_id",
            f"case when p_size >= 25 then '{fixed.ADULT_PRODUCT}' else 'kids product' end kids_vs_adult",
        )

    # -- location attributes -------------------------------------------------------------------

    def _prop_log(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "cast(user_id as string) gio_id",
            f"case when event_type = 'signup' then '{fixed.CRM_ID_PROPERTY}' else event_type end prop_key",
            "case when event_type = 'signup' then cast(user_id as string) when event_id % 2 = 0 then '1' else '0' end"
            " prop_value",
            "cast(date_trunc('day', ts) as timestamp_ntz) update_time",
        )

    def _segment_map(self) -> DataFrame:
        # Fixed values of the binding: location segment -> city.
        return self._spark.sql(
            "select * from values ('view', 'NATION_0'), ('click', 'NATION_1'), ('purchase', 'NATION_2'),"
            " ('purchase', 'NATION_3') as pairs(prop_key, city_cn)"
        )

    def _located(self) -> DataFrame:
        return segment_members(self["prop_log"], self["segment_map"])
