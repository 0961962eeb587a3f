"""Rule-driven column transforms and the metadata columns of each layer."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import keep_latest


def rule(kind: str, source: str | None = None, target: str | None = None, expression: str | None = None, seq: int = 0,
         active: bool = True) -> dict:
    """One transform rule in the shape of a configuration row."""
    return {
        "rule_type": kind,
        "source_column": source,
        "target_column": target or source,
        "transformation_expression": expression,
        "execution_sequence": seq,
        "is_active": active,
    }


def _value(r: Mapping) -> Column | None:
    """The new column value of a column rule; None for rules that work on rows."""
    kind, source, expr = r["rule_type"].upper(), r["source_column"], r["transformation_expression"]
    if kind == "CAST":
        return F.expr(f"try_cast(`{source}` as {expr})")
    if kind in ("TRANSFORM", "EXPRESSION"):
        return F.expr(expr)
    if kind == "TRIM":
        return F.trim(F.col(source))
    if kind == "UPPER":
        return F.upper(F.col(source))
    if kind == "LOWER":
        return F.lower(F.col(source))
    if kind == "COALESCE":
        return F.expr(f"coalesce(`{source}`, {expr})")
    return None


def apply_rules(df: DataFrame, rules: Iterable[Mapping]) -> DataFrame:
    """Apply active rules in ``execution_sequence`` order; each sees the result of the one before.

    Column rules are plain projections, which Catalyst merges into one.
    """
    active = [r for r in rules if r.get("is_active", True)]
    for r in sorted(active, key=lambda r: r.get("execution_sequence") or 0):
        kind = r["rule_type"].upper()
        value = _value(r)
        if value is not None:
            df = df.withColumn(r["target_column"], value)
        elif kind == "RENAME":
            df = df.withColumnRenamed(r["source_column"], r["target_column"])
        elif kind == "FILTER":
            df = df.filter(F.expr(r["transformation_expression"]))
        elif kind == "DEDUPE":
            df = keep_latest(df, [k.strip() for k in r["source_column"].split(",")])
        else:
            raise ValueError(f"unknown rule type {kind}")
    return df


def add_ingest_metadata(
    df: DataFrame, run_id: str, source: str, op: str | None = None, now: datetime | None = None
) -> DataFrame:
    """Bronze metadata. ``op=None`` takes the operation from the change feed; initial loads pass ``"I"``."""
    ts = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    return df.withColumns(
        {
            "_pipeline_run_id": F.lit(run_id),
            "_ingest_timestamp": ts,
            "_source_system": F.lit(source.upper()),
            "_cdc_operation": F.lit(op) if op is not None else F.col("SYS_CHANGE_OPERATION"),
            "ingest_date": F.date_format(ts, "yyyy-MM-dd"),
        }
    )


def add_silver_metadata(df: DataFrame, run_id: str, now: datetime | None = None) -> DataFrame:
    """Silver metadata. Without an operation column nothing counts as deleted."""
    ts = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    has_op = "_cdc_operation" in df.columns
    return df.withColumns(
        {
            "_pipeline_run_id": F.lit(run_id),
            "_load_timestamp": ts,
            "_is_deleted": F.col("_cdc_operation").eqNullSafe(F.lit("D")) if has_op else F.lit(False),
        }
    )


def lineage_rows(spark, entity: str, rules: Iterable[Mapping], run_id: str) -> DataFrame:
    """Column lineage of one entity: source column, target column, rule."""
    rows = [
        (run_id, entity, r["source_column"], r["target_column"], r["rule_type"], r["transformation_expression"])
        for r in rules
        if r.get("is_active", True)
    ]
    schema = (
        "pipeline_run_id string, entity string, source_column string, target_column string, "
        "rule_type string, transformation string"
    )
    return spark.createDataFrame(rows, schema)
