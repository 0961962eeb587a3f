"""Schema drift and dataset contracts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Metadata columns left out of drift reports.
METADATA_COLUMNS = frozenset(
    {
        "_cdc_operation", "_cdc_version", "_ingest_timestamp", "_pipeline_run_id", "_load_timestamp", "_is_deleted",
        "_is_current", "_valid_from", "_valid_to", "_hash_key", "_version", "_source_system", "ingest_date",
    }
)


def schema_drift(source: DataFrame, target: DataFrame, ignore=METADATA_COLUMNS) -> dict[str, list[str]]:
    """New, missing and retyped columns, ignoring case. Works on schemas only: no job runs."""
    skip = {c.lower() for c in ignore}
    src = {f.name.lower(): f.dataType.simpleString() for f in source.schema.fields if f.name.lower() not in skip}
    tgt = {f.name.lower(): f.dataType.simpleString() for f in target.schema.fields if f.name.lower() not in skip}
    return {
        "new_columns": sorted(src.keys() - tgt.keys()),
        "missing_columns": sorted(tgt.keys() - src.keys()),
        "retyped_columns": sorted(c for c in src.keys() & tgt.keys() if src[c] != tgt[c]),
    }


class SchemaDriftError(ValueError):
    """A batch has lost, gained or retyped columns."""


def require_no_drift(source: DataFrame, target: DataFrame, name: str) -> None:
    found = {kind: columns for kind, columns in schema_drift(source, target).items() if columns}
    if found:
        raise SchemaDriftError(f"{name}: {found}")


@dataclass(frozen=True)
class Contract:
    dataset: str
    columns: dict[str, str]
    primary_key: tuple[str, ...]
    partition_keys: tuple[str, ...] = ()
    pii: tuple[str, ...] = ()


# Published contracts, in gold names and types.
CONTRACTS = {
    c.dataset: c
    for c in (
        Contract(
            "dim_customer",
            {
                "customer_sk": "string", "customer_id": "string", "first_name": "string", "last_name": "string",
                "email": "string", "status": "string", "_valid_from": "timestamp", "_valid_to": "timestamp",
                "_is_current": "boolean", "_is_deleted": "boolean",
            },
            ("customer_sk",),
            pii=("first_name", "last_name", "email"),
        ),
        Contract(
            "fact_sales",
            {
                "order_line_id": "string", "order_id": "string", "customer_sk": "string", "product_sk": "string",
                "campaign_sk": "string", "order_date": "date", "total_amount": "decimal(18,2)",
                "order_status": "string",
            },
            ("order_line_id",),
            ("order_date",),
        ),
        Contract(
            "agg_customer_clv_metrics",
            {
                "customer_id": "string", "average_order_value": "decimal(18,2)",
                "purchase_frequency": "decimal(10,4)", "total_lifetime_revenue": "decimal(18,2)",
            },
            ("customer_id",),
        ),
        Contract(
            "agg_monthly_campaign_roi",
            {
                "campaign_id": "string", "reporting_month": "date", "total_spend": "decimal(18,2)",
                "customers_acquired": "int", "customer_acquisition_cost": "decimal(18,2)",
            },
            ("campaign_id", "reporting_month"),
            ("reporting_month",),
        ),
    )
}


def schema_issues(df: DataFrame, contract: Contract) -> list[tuple[str, str, bool]]:
    """(column, issue, breaking). A missing or retyped column breaks the contract, an extra one does not."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    issues = []
    for name, kind in contract.columns.items():
        if name not in have:
            issues.append((name, "MISSING_COLUMN", True))
        elif have[name] != kind:
            issues.append((name, f"TYPE {have[name]} INSTEAD OF {kind}", True))
    issues += [(name, "EXTRA_COLUMN", False) for name in have if name not in contract.columns]
    return issues


def key_issues(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null and duplicate primary keys: one row with two counts, from one map-side combined aggregate."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(null_key, F.col("_n"))), F.lit(0)).cast("long").alias("null_key_rows"),
        F.count_if(~null_key & (F.col("_n") > 1)).alias("duplicate_keys"),
    )


def validate_contract(df: DataFrame, contract: Contract) -> dict:
    """Schema comparison plus the primary-key check (one row comes to the driver)."""
    issues = schema_issues(df, contract)
    report = {"dataset": contract.dataset, "issues": issues, "breaking": any(b for *_, b in issues)}
    if all(k in df.columns for k in contract.primary_key):
        keys = key_issues(df, contract.primary_key).first()
        report |= {"null_key_rows": keys.null_key_rows, "duplicate_keys": keys.duplicate_keys}
        report["breaking"] = report["breaking"] or keys.null_key_rows > 0 or keys.duplicate_keys > 0
    return report


def to_contract(df: DataFrame, contract: Contract, mapping: dict[str, str]) -> DataFrame:
    """Project a gold table onto a contract: names through ``mapping`` (contract name -> expression), types cast."""
    return df.select(
        *[F.expr(mapping.get(name, name)).cast(kind).alias(name) for name, kind in contract.columns.items()]
    )
