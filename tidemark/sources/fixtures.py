"""Business entities derived from the test tables.

Raw (bronze) frames have upper-case columns and untrimmed text, as a staged extract would; the smaller ones carry
numbers and dates as text. Every derivation covers its whole table and uses integer or decimal arithmetic only.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import keep_latest
from tidemark.operators.quality import dq_check, valid_rows
from tidemark.plans.entities import ENTITIES, standardise
from tidemark.plans.quality_rules import SILVER_DQ
from tidemark.sources.calendar import build_dim_date

# Calendar of the test data, and the tie order that makes duplicate order lines unambiguous.
CALENDAR = (date(1994, 1, 1), date(2025, 12, 31))
LINE_TIE = (
    "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"
)
CHANNELS = ("Paid Social", "Organic", "Affiliate", "Direct", "Email", "Search", "Display")


def _channel(number: str) -> str:
    return f"element_at(array({', '.join(repr(c) for c in CHANNELS)}), cast({number} as int) + 1)"


class Raw:
    """Bronze frames over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        zoned = {
            f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"
        }
        return df.withColumns(zoned) if zoned else df

    def customers(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "cast(c_custkey as string) as CUSTOMER_ID",
            "case when c_custkey % 97 = 0 then 'invalid-email' "
            "else concat(' USER', c_custkey, '@Example.com ') end as EMAIL",
            "concat(' 555-', 1000000 + c_custkey) as PHONE",
            "' Customer ' as FIRST_NAME",
            "c_name as LAST_NAME",
            "case when c_nationkey % 2 = 0 then 'f' else ' M' end as GENDER",
            "case when c_acctbal >= 9000 then ' Vip' else 'Regular ' end as CUSTOMER_TYPE",
            "case when c_acctbal < 0 then 'Churned' when c_custkey % 89 = 0 then null "
            "when c_acctbal < 1000 then ' Inactive ' else 'active' end as STATUS",
            "case when c_custkey % 2 = 0 then 'true' else 'false' end as MARKETING_OPT_IN",
            "cast(date_add(date'1994-01-01', cast(c_custkey % 365 as int)) as string) as REGISTRATION_DATE",
            "cast(date_add(date'1994-01-01', cast(c_custkey % 365 as int)) as string) as LAST_UPDATE_DATE",
            "c_mktsegment as _segment",
            "'I' as _cdc_operation",
        )

    def customers_change(self) -> DataFrame:
        """A second full extract: one market segment changed status in 1998, another changed its e-mail."""
        base = self.customers()
        moved = F.col("_segment") == "BUILDING"
        churned = F.coalesce(F.trim("STATUS") == "Churned", F.lit(False))
        return base.withColumns(
            {
                "STATUS": F.when(moved, F.when(churned, F.lit("active")).otherwise(F.lit("Churned"))).otherwise(
                    F.col("STATUS")
                ),
                "LAST_UPDATE_DATE": F.when(moved, F.lit("1998-06-01")).otherwise(F.col("LAST_UPDATE_DATE")),
                "EMAIL": F.when(
                    F.col("_segment") == "MACHINERY", F.concat(F.lit("New"), F.trim("EMAIL"))
                ).otherwise(F.col("EMAIL")),
                "_cdc_operation": F.lit("U"),
            }
        )

    def oe_order_headers_all(self) -> DataFrame:
        sub = "cast(o_totalprice as decimal(15,2))"
        disc = f"cast({sub} * 0.10 as decimal(15,2))"
        tax = f"cast({sub} * 0.05 as decimal(15,2))"
        return self.table("orders").selectExpr(
            "o_orderkey as ORDER_ID",
            "concat(' ORD-', o_orderkey) as ORDER_NUMBER",
            "case when o_orderkey % 101 = 0 then null when o_orderkey % 103 = 0 then 9000000 + o_custkey "
            "else o_custkey end as CUSTOMER_ID",
            "o_orderdate as ORDER_DATE",
            "case when o_orderkey % 11 = 0 then 'Cancelled' when o_orderkey % 13 = 0 then 'Returned' "
            "when o_orderstatus = 'F' then ' Delivered' when o_orderstatus = 'O' then 'Booked' else 'Processing ' end "
            "as ORDER_STATUS",
            f"{sub} as SUBTOTAL_AMOUNT",
            f"{disc} as DISCOUNT_AMOUNT",
            f"{tax} as TAX_AMOUNT",
            "cast(null as decimal(15,2)) as SHIPPING_AMOUNT",
            f"case when o_orderkey % 107 = 0 then cast(-1 as decimal(15,2)) "
            f"else cast({sub} - {disc} + {tax} as decimal(15,2)) end as TOTAL_AMOUNT",
            "o_custkey as SHIPPING_ADDRESS_ID",
            "case when o_orderstatus = 'F' and o_orderkey % 17 <> 0 then o_orderdate end as DELIVERED_DATE",
            "o_orderpriority as ORDER_SOURCE",
            "o_orderdate as LAST_UPDATE_DATE",
            "'I' as _cdc_operation",
        )

    def keyed_lines(self) -> DataFrame:
        """The staged columns of the order lines with their key; everything else of a line is derived from them."""
        return self.table("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber as LINE_ID", "l_orderkey", "l_shipdate", *LINE_TIE
        )

    def oe_order_lines_all(self, keyed: DataFrame | None = None) -> DataFrame:
        cents = "cast(round(l_extendedprice * 100) as bigint)"
        qty = "cast(l_quantity as bigint)"
        sign = "case when l_suppkey % 51 = 0 then -1 else 1 end"
        return (self.keyed_lines() if keyed is None else keyed).selectExpr(
            "LINE_ID",
            "l_orderkey as ORDER_ID",
            "l_partkey as PRODUCT_ID",
            "case when l_suppkey % 50 = 0 then 0 else cast(l_quantity as int) end as QUANTITY",
            f"cast(cast({sign} * ((2 * {cents} + {qty}) div (2 * {qty})) as decimal(17,0)) / 100 as decimal(15,2)) "
            "as UNIT_PRICE",
            f"cast(cast({sign} * {cents} as decimal(17,0)) / 100 as decimal(15,2)) as LINE_TOTAL",
            "l_shipdate as LAST_UPDATE_DATE",
            "l_shipdate as _ingest_timestamp",
            "'I' as _cdc_operation",
        )

    def addresses(self) -> DataFrame:
        c, n, r = self.table("customer"), self.table("nation"), self.table("region")
        return (
            c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .selectExpr(
                "cast(c_custkey as string) as ADDRESS_ID",
                "cast(c_custkey as string) as CUSTOMER_ID",
                "concat(' ', c_custkey, ' Main Street') as ADDRESS_LINE1",
                "concat(lower(n_name), ' ') as CITY",
                "lower(r_name) as STATE",
                "concat('p', 10000 + c_nationkey) as POSTAL_CODE",
                "'us' as COUNTRY",
                "'I' as _cdc_operation",
            )
        )

    def city_tier_master(self) -> DataFrame:
        """Every nation outside one region; addresses there have no tier."""
        n, r = self.table("nation"), self.table("region")
        return (
            n.join(r, n.n_regionkey == r.r_regionkey)
            .filter("r_name <> 'EUROPE'")
            .selectExpr(
                "lower(n_name) as CITY", "concat(' ', r_name) as STATE",
                "concat('tier ', n_nationkey % 3 + 1) as TIER", "'I' as _cdc_operation",
            )
        )

    def mtl_system_items_b(self) -> DataFrame:
        return self.table("part").selectExpr(
            "cast(p_partkey as string) as INVENTORY_ITEM_ID",
            "cast(length(p_type) * 1000 + ascii(p_type) as string) as CATEGORY_ID",
            "substring(p_brand, 7) as BRAND_ID",
            "concat('sku-', p_partkey, ' ') as SKU",
            "concat(' ', p_name) as PRODUCT_NAME",
            "cast(cast(p_retailprice as decimal(15,2)) as string) as UNIT_COST",
            "'I' as _cdc_operation",
        )

    def categories(self) -> DataFrame:
        return self.table("part").select("p_type").distinct().selectExpr(
            "cast(length(p_type) * 1000 + ascii(p_type) as string) as CATEGORY_ID", "concat(p_type, ' ') as CATEGORY_NAME",
            "'I' as _cdc_operation",
        )

    def brands(self) -> DataFrame:
        return self.table("part").select("p_brand").distinct().selectExpr(
            "substring(p_brand, 7) as BRAND_ID", "concat(' ', p_brand) as BRAND_NAME", "'I' as _cdc_operation"
        )

    def marketing_campaigns(self) -> DataFrame:
        """One campaign per brand; spend and acquired customers come from its parts."""
        per_brand = self.table("part").groupBy("p_brand").agg(
            F.sum(F.col("p_retailprice").cast("decimal(15,2)")).alias("spend"), F.count(F.lit(1)).alias("n")
        )
        per_brand = per_brand.selectExpr("cast(substring(p_brand, 7) as int) as id", "spend", "n")
        return per_brand.selectExpr(
            "cast(id as string) as CAMPAIGN_ID",
            "concat('Campaign ', id) as CAMPAIGN_NAME",
            "concat('cmp-', id) as CAMPAIGN_CODE",
            f"{_channel('id % 7')} as CHANNEL",
            "concat('sub ', id % 3) as SUB_CHANNEL",
            "cast(date_add(date'1995-01-01', id) as string) as START_DATE",
            "cast(date_add(date'2001-01-01', id) as string) as END_DATE",
            "cast(spend as string) as TOTAL_SPEND",
            "cast(case when id % 17 = 0 then 0 else n end as string) as CUSTOMERS_ACQUIRED",
            "'active' as STATUS",
            "'I' as _cdc_operation",
        )

    def customer_registration_source(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "cast(c_custkey as string) as REGISTRATION_SOURCE_ID",
            "cast(c_custkey as string) as CUSTOMER_ID",
            f"{_channel('c_custkey % 7')} as CHANNEL",
            "case when c_custkey % 7 = 1 then null else cast(c_custkey % 27 + 1 as string) end as CAMPAIGN_ID",
            "concat(' Src', c_custkey % 5) as UTM_SOURCE",
            "'CPC' as UTM_MEDIUM",
            "'Spring ' as UTM_CAMPAIGN",
            "case when c_nationkey % 2 = 0 then 'mobile' else 'web' end as DEVICE_TYPE",
            "cast(date_add(date'1994-01-01', cast(c_custkey % 365 as int)) as string) as REGISTRATION_DATE",
            "'I' as _cdc_operation",
        )

    def incidents(self) -> DataFrame:
        return self.table("events").filter("event_type = 'error'").selectExpr(
            "cast(event_id as string) as INCIDENT_ID",
            "cast(user_id as string) as CUSTOMER_ID",
            "cast(event_id as string) as ORDER_ID",
            "element_at(array('open', 'closed ', 'pending'), cast(event_id % 3 as int) + 1) as STATUS",
            "element_at(array('low', ' high', 'medium'), cast(event_id % 3 as int) + 1) as PRIORITY",
            "cast(ts as string) as CREATED_DATE",
            "'I' as _cdc_operation",
        )

    def interactions(self) -> DataFrame:
        """Clicks and views, attached to the user's first incident."""
        e = self.table("events")
        first = e.filter("event_type = 'error'").groupBy("user_id").agg(F.min("event_id").alias("incident"))
        return e.filter("event_type in ('click', 'view')").join(first, "user_id", "left").selectExpr(
            "case when event_id % 211 <> 0 then cast(event_id as string) end as INTERACTION_ID",
            "cast(incident as string) as INCIDENT_ID",
            "concat(event_type, ' ') as INTERACTION_TYPE",
            "cast(ts as string) as INTERACTION_DATE",
            "props as NOTES",
            "'I' as _cdc_operation",
        )

    def surveys(self) -> DataFrame:
        return self.table("events").filter("event_type = 'purchase'").selectExpr(
            "cast(event_id as string) as SURVEY_ID",
            "cast(user_id as string) as CUSTOMER_ID",
            "cast(event_id as string) as ORDER_ID",
            "cast(null as string) as INCIDENT_ID",
            "'nps ' as SURVEY_TYPE",
            "cast(cast(floor(value) as bigint) % 13 as string) as NPS_SCORE",
            "cast(cast(floor(value) as bigint) % 7 as string) as CSAT_SCORE",
            "cast(null as string) as NPS_CATEGORY",
            "cast(ts as string) as RESPONSE_DATE",
            "'I' as _cdc_operation",
        )

    def accounts(self) -> DataFrame:
        """Keyed bronze table for change feeds: all customers outside one market segment."""
        return self.table("customer").filter("c_mktsegment <> 'BUILDING'").selectExpr(
            "c_custkey as CUSTOMER_ID", "c_name as NAME", "cast(c_acctbal as decimal(15,2)) as AMOUNT",
            "'I' as _cdc_operation",
        )

    def change_feed(self) -> DataFrame:
        """Every event as a change of its user: signup inserts, error deletes, the rest updates."""
        return self.table("events").selectExpr(
            "user_id as CUSTOMER_ID",
            "event_id as SYS_CHANGE_VERSION",
            "case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end as SYS_CHANGE_OPERATION",
            "concat(event_type, ' ', event_id) as NAME",
            "cast(value as decimal(15,2)) as AMOUNT",
            "case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end as _cdc_operation",
        )

    def dim_date(self) -> DataFrame:
        return build_dim_date(self.spark, *CALENDAR)


class Silver:
    """Deduplicated, standardised and quality-checked entities over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.raw = Raw(spark, sf_dir)

    def deduped(self, name: str) -> DataFrame:
        if name == "oe_order_lines_all":
            # part, supplier, price and so on only break ties between copies of a line with the same time; the rows are
            # sorted and moved as staged, and amounts are derived from those that stay
            return self.raw.oe_order_lines_all(keep_latest(self.raw.keyed_lines(), ["LINE_ID"], ["l_shipdate"], LINE_TIE))
        return getattr(self.raw, name)()

    def standardised(self, name: str) -> DataFrame:
        return standardise(name, self.deduped(name))

    def checked(self, name: str) -> DataFrame:
        return dq_check(self.standardised(name), SILVER_DQ[name])

    def __call__(self, name: str) -> DataFrame:
        """Valid rows."""
        return valid_rows(self.checked(name)).drop("_dq_warnings", "_cdc_operation", "_ingest_timestamp", "_segment")
