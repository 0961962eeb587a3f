"""Column lineage of the whole run, bronze to marts, read from the plans that build the tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.lineage import ColumnSource, as_table, column_sources
from tidemark.plans import aggregates, dims, facts, views
from tidemark.plans.entities import standardise
from tidemark.sources.calendar import build_dim_date

BRONZE = "bronze_"
_ANY_DAYS = (date(2020, 1, 1), date(2020, 1, 2))  # the calendar's columns don't depend on its days


def medallion_sources(spark: SparkSession, bronze: Mapping[str, DataFrame]) -> list[ColumnSource]:
    """The direct sources of all columns of silver tables, dimensions, facts, aggregates and marts.

    ``bronze`` holds a frame for each entity; only its columns matter, and nothing is read. Bronze tables are called
    ``bronze_`` and the entity, the others as in ``run_medallion``. Dimensions are traced up to where their keys are assigned
    and their versions joined into a history: assigned keys and validity columns have no source.
    """
    rows: list[ColumnSource] = []

    def made(table: str, df: DataFrame) -> DataFrame:
        rows.extend(column_sources(table, df))
        return as_table(df, table)

    s = {name: made(name, standardise(name, as_table(df, BRONZE + name))) for name, df in bronze.items()}
    sources = {
        "dim_customer": dims.customer_source(s["customers"]),
        "dim_product": dims.product_source(s["mtl_system_items_b"], s["categories"], s["brands"]),
        "dim_location": dims.location_source(s["addresses"], s["city_tier_master"]),
        "dim_campaign": s["marketing_campaigns"],
        "dim_registration_source": s["customer_registration_source"],
    }
    d = {name: made(name, dims.shape(source, name)) for name, source in sources.items()}
    d["dim_date"] = as_table(build_dim_date(spark, *_ANY_DAYS), "dim_date")
    sales = made(
        "fact_sales",
        facts.build_fact_sales(
            s["oe_order_lines_all"], s["oe_order_headers_all"], d, s["customer_registration_source"], versions_per_key=1
        ),
    )
    made("fact_interactions", facts.build_fact_interactions(s["interactions"], s["incidents"], d["dim_customer"], versions_per_key=1))
    made("fact_surveys", facts.build_fact_surveys(s["surveys"], d["dim_customer"], versions_per_key=1))
    roi = made(
        "agg_monthly_campaign_roi",
        aggregates.campaign_roi(sales, d["dim_date"], d["dim_campaign"], s["marketing_campaigns"]),
    )
    clv = made("agg_customer_clv_metrics", aggregates.customer_clv(sales, d["dim_customer"], d["dim_date"]))
    made("vw_sales_dashboard", views.vw_sales_dashboard(sales, d))
    made("vw_churn_features", views.vw_churn_features(clv, d["dim_customer"]))
    made("vw_marketing_performance", views.vw_marketing_performance(roi))
    return rows
