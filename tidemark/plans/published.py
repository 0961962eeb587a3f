"""Gold tables in the shape of their published contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.contracts import CONTRACTS, to_contract, validate_contract

# How each contract column follows from the gold table.
PROJECTIONS = {
    "dim_customer": {
        "customer_sk": "md5(concat_ws('||', customer_id, cast(_valid_from as string)))",
        "first_name": "substring_index(full_name, ' ', 1)",
        "last_name": "nullif(substring(full_name, instr(full_name, ' ') + 1), full_name)",
        "_is_deleted": "coalesce(_is_deleted, false)",
    },
    "fact_sales": {
        "order_line_id": "line_id",
        "customer_sk": "dim_customer_key",
        "product_sk": "dim_product_key",
        "campaign_sk": "dim_campaign_key",
        "order_date": "cast(try_to_timestamp(cast(dim_date_key as string), 'yyyyMMdd') as date)",
        "total_amount": "line_total",
    },
    "agg_customer_clv_metrics": {"total_lifetime_revenue": "lifetime_revenue"},
    "agg_monthly_campaign_roi": {
        "reporting_month": "make_date(year_month div 100, year_month % 100, 1)",
    },
}


def published(dataset: str, gold: DataFrame, dim_customer: DataFrame | None = None) -> DataFrame:
    """A gold table as its contract states it. The table must have one row per primary key of the contract.

    With ``dim_customer`` the customer key of a fact is the published key of its version, on which the two published
    tables join; without it, it is the gold key as text.
    """
    mapping = PROJECTIONS[dataset]
    if dim_customer is not None and mapping.get("customer_sk") == "dim_customer_key":
        key = F.expr(PROJECTIONS["dim_customer"]["customer_sk"]).alias("_customer_sk")
        gold = gold.join(dim_customer.select("dim_customer_key", key), "dim_customer_key", "left")
        mapping = mapping | {"customer_sk": "_customer_sk"}
    return to_contract(gold, CONTRACTS[dataset], mapping)


def check_published(dataset: str, gold: DataFrame, dim_customer: DataFrame | None = None) -> dict:
    return validate_contract(published(dataset, gold, dim_customer), CONTRACTS[dataset])
