"""Mart views and the documented BI queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import ORGANIC_KEY, UNKNOWN_KEY, per_30_days
from tidemark.operators.joins import salted_lookup

_SPECIAL = (UNKNOWN_KEY, ORGANIC_KEY)


def vw_sales_dashboard(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Sales lines with readable attributes. Only the needed columns of each dimension take part.

    Many rows may point at a special member, so those keys are salted in the joins that can be large.
    """
    f = fact.select(
        "dim_date_key", "dim_customer_key", "dim_product_key", "dim_location_key", "dim_campaign_key",
        "order_number", "quantity", "line_total", "allocated_discount_amount",
    )
    f = f.join(dims["dim_date"].select("dim_date_key", F.col("full_date").alias("order_date")), "dim_date_key", "left")
    f = f.join(
        dims["dim_campaign"].select(
            "dim_campaign_key", "campaign_name", F.col("channel").alias("acquisition_channel")
        ),
        "dim_campaign_key",
    )
    customer = dims["dim_customer"].select(
        "dim_customer_key", F.col("full_name").alias("customer_name"), "customer_type"
    )
    product = dims["dim_product"].select("dim_product_key", "product_name", "category_name", "brand_name")
    location = dims["dim_location"].select("dim_location_key", "city", "state")
    f = salted_lookup(f, customer, "dim_customer_key", _SPECIAL)
    f = salted_lookup(f, product, "dim_product_key", _SPECIAL)
    f = salted_lookup(f, location, "dim_location_key", _SPECIAL)
    return f.select(
        "order_number", "order_date", "customer_name", "customer_type", "product_name", "category_name",
        "brand_name", "city", "state", "campaign_name", "acquisition_channel", "quantity", "line_total",
        "allocated_discount_amount",
    )


def vw_churn_features(clv: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Features of current customer versions; frequency is orders per 30 days of lifespan."""
    now = dim_customer.filter("_is_current").select("dim_customer_key", "customer_id", "status", "customer_type")
    return clv.drop("customer_id", "status").join(now, "dim_customer_key").select(
        "customer_id",
        "status",
        "customer_type",
        "lifetime_revenue",
        "average_order_value",
        "customer_lifespan_days",
        "total_orders",
        per_30_days("total_orders", "customer_lifespan_days").alias("purchase_frequency_monthly"),
    )


def vw_marketing_performance(roi: DataFrame) -> DataFrame:
    return roi.select(
        "year_month", "campaign_name", "channel", "total_revenue", "total_spend", "customers_acquired",
        "customer_acquisition_cost", "return_on_ad_spend",
    ).orderBy(F.desc("year_month"))


def churn_feature_query(clv: DataFrame, dim_customer: DataFrame) -> DataFrame:
    now = dim_customer.filter("_is_current").select("dim_customer_key", "customer_id", "status")
    return clv.drop("customer_id", "status").join(now, "dim_customer_key").select(
        "customer_id", "status", "lifetime_revenue", "average_order_value", "customer_lifespan_days"
    )


def cac_vs_roas_query(roi: DataFrame) -> DataFrame:
    return roi.select(
        "year_month", "campaign_name", "customer_acquisition_cost", "return_on_ad_spend"
    ).orderBy(F.desc("year_month"))
