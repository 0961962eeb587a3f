"""Fact builders.

Header-grain lookups (customer version, campaign, location) run on the order headers, which are fewer and
narrower than the lines; the lines then move once, for the join on the order id.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import (
    NON_REVENUE_STATES,
    ORGANIC_KEY,
    UNKNOWN_KEY,
    allocate,
    date_key,
    is_organic,
    year_month,
)
from tidemark.operators.joins import asof_join, lookup, salted_lookup, with_parent
from tidemark.operators.latest import keep_latest
from tidemark.operators.quality import dq_split
from tidemark.plans.quality_rules import GOLD_DQ


def _audit(df: DataFrame, run_id: str | None, now: datetime | None) -> DataFrame:
    ts = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    return df.withColumns({"_created_date": ts, "_last_modified_date": ts, "_pipeline_run_id": F.lit(run_id)})


def campaign_attribution(crs: DataFrame, dim_campaign: DataFrame) -> DataFrame:
    """One campaign key per customer: the campaign's key, -2 for organic without a campaign, else -1.

    The registration source is reduced to one row per customer first, so it can never multiply fact rows.
    """
    order = ["registration_date"] if "registration_date" in crs.columns else []
    tie = ["registration_source_id"] if "registration_source_id" in crs.columns else ["channel", "campaign_id"]
    one = keep_latest(crs.filter(F.col("customer_id").isNotNull()), ["customer_id"], order, tie)
    campaigns = dim_campaign.select("campaign_id", F.col("dim_campaign_key").alias("_key"))
    organic = is_organic("channel") & F.col("campaign_id").isNull()
    # organic customers have no campaign: the null keys are spread instead of meeting in one task
    return salted_lookup(one, campaigns, "campaign_id", (), "left").select(
        "customer_id",
        F.coalesce(F.col("_key"), F.when(organic, F.lit(ORGANIC_KEY)).otherwise(F.lit(UNKNOWN_KEY)))
        .cast("long")
        .alias("dim_campaign_key"),
    )


def customer_version(
    facts: DataFrame, dim_customer: DataFrame, at: str, versions_per_key: int | None = None
) -> DataFrame:
    """``dim_customer_key`` valid at the event, -1 when no version covers it."""
    members_out = dim_customer.filter(F.col("dim_customer_key") > 0)
    found = asof_join(
        facts, members_out, "customer_id", at, {"dim_customer_key": "dim_customer_key"},
        versions_per_key=versions_per_key,
    )
    return found.withColumn("dim_customer_key", F.coalesce("dim_customer_key", F.lit(UNKNOWN_KEY).cast("long")))


def version_bound(dim: DataFrame, version: str = "_version") -> int:
    """Highest number of versions any key has: one column of a stored dimension is read."""
    return dim.agg(F.max(version)).first()[0] or 0


def build_fact_sales(
    lines: DataFrame,
    headers: DataFrame,
    dims: dict[str, DataFrame],
    crs: DataFrame,
    run_id: str | None = None,
    now: datetime | None = None,
    versions_per_key: int | None = None,
    hot_customers: Sequence = (),
    hot_products: Sequence = (),
) -> DataFrame:
    """One row per valid order line."""
    valid, _ = dq_split(
        lines.select("line_id", "order_id", "product_id", "quantity", "line_total", "unit_price"), GOLD_DQ["fact_sales"]
    )
    h = headers.select(
        "order_id", "order_number", "customer_id", "order_date", "order_status", "shipping_address_id",
        "subtotal_amount", "discount_amount", "tax_amount",
    )
    h = customer_version(h, dims["dim_customer"], "order_date", versions_per_key)
    h = lookup(
        h, campaign_attribution(crs, dims["dim_campaign"]), "customer_id", "customer_id", "dim_campaign_key",
        UNKNOWN_KEY, hot_customers,
    )
    h = lookup(h, dims["dim_location"], "shipping_address_id", "address_id", "dim_location_key", UNKNOWN_KEY)
    h = h.withColumns({"dim_date_key": date_key("order_date"), "order_year_month": year_month("order_date")})
    h = h.drop("customer_id", "shipping_address_id", "order_date")
    # the product is looked up on the narrow lines, before the order's columns hang on each of them
    valid = lookup(
        valid, dims["dim_product"], "product_id", "inventory_item_id", "dim_product_key", UNKNOWN_KEY, hot_products
    )
    f = valid.join(h, "order_id")
    f = f.select(
        "dim_date_key",
        "dim_customer_key",
        "dim_product_key",
        "dim_location_key",
        "dim_campaign_key",
        "order_id",
        "order_number",
        "line_id",
        "order_status",
        "quantity",
        "line_total",
        allocate("line_total", "subtotal_amount", "discount_amount").alias("allocated_discount_amount"),
        allocate("line_total", "subtotal_amount", "tax_amount").alias("allocated_tax_amount"),
        "unit_price",
        "order_year_month",
    )
    return _audit(f, run_id, now)


def build_fact_interactions(
    interactions: DataFrame,
    incidents: DataFrame,
    dim_customer: DataFrame,
    run_id: str | None = None,
    now: datetime | None = None,
    versions_per_key: int | None = None,
) -> DataFrame:
    valid, _ = dq_split(interactions, GOLD_DQ["fact_interactions"])
    parent = incidents.select(
        "incident_id", "customer_id", F.col("status").alias("incident_status"),
        F.col("priority").alias("incident_priority"),
    )
    f = valid.select("interaction_id", "incident_id", "interaction_type", "interaction_date").join(parent, "incident_id")
    f = customer_version(f, dim_customer, "interaction_date", versions_per_key)
    f = f.select(
        date_key("interaction_date").alias("dim_date_key"),
        "dim_customer_key",
        "interaction_id",
        "incident_id",
        "interaction_type",
        "incident_status",
        "incident_priority",
        F.lit(1).alias("interaction_count"),
        year_month("interaction_date").alias("interaction_year_month"),
    )
    return _audit(f, run_id, now)


def build_fact_surveys(
    surveys: DataFrame,
    dim_customer: DataFrame,
    run_id: str | None = None,
    now: datetime | None = None,
    versions_per_key: int | None = None,
) -> DataFrame:
    valid, _ = dq_split(surveys, GOLD_DQ["fact_surveys"])
    f = customer_version(valid, dim_customer, "response_date", versions_per_key)
    f = f.select(
        date_key("response_date").alias("dim_date_key"),
        "dim_customer_key",
        "survey_id",
        "order_id",
        "incident_id",
        "survey_type",
        "nps_category",
        "nps_score",
        "csat_score",
        year_month("response_date").alias("response_year_month"),
    )
    return _audit(f, run_id, now)


def surveys_on_delivered(surveys: DataFrame, headers: DataFrame) -> DataFrame:
    """Surveys whose order was delivered."""
    delivered = headers.filter(F.upper("order_status") == "DELIVERED")
    return with_parent(surveys, delivered, "order_id")


def revenue_orders(headers: DataFrame) -> DataFrame:
    """Orders that count as revenue: not cancelled, not returned."""
    return headers.filter(~F.upper(F.trim("order_status")).isin(*NON_REVENUE_STATES))


def order_rule_violations(headers: DataFrame) -> DataFrame:
    """Headers whose amounts do not add up, or that are delivered without a delivery date."""
    expected = (
        F.col("subtotal_amount") - F.col("discount_amount") + F.col("tax_amount") + F.col("shipping_amount")
    )
    amount = ~F.coalesce(F.col("total_amount") == expected, F.lit(False))
    delivered = (F.upper("order_status") == "DELIVERED") & F.col("delivered_date").isNull()
    return headers.withColumns(
        {"amount_mismatch": amount, "delivered_date_missing": F.coalesce(delivered, F.lit(False))}
    ).filter("amount_mismatch or delivered_date_missing")
