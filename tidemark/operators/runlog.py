"""Run log and the state folded from it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.sinks import append_table

# One row per load. ``full_reload`` marks a backfill, which resets the watermark.
LOG_SCHEMA = (
    "table_id long, pipeline_run_id string, status string, records_loaded long, sync_version long, "
    "mark_initial boolean, full_reload boolean, error_message string, ended_at timestamp"
)


def append_run(
    spark: SparkSession,
    path: str,
    table_id: int,
    run_id: str,
    status: str,
    records: int = 0,
    version: int | None = None,
    mark_initial: bool = False,
    full_reload: bool = False,
    error: str | None = None,
    ended_at: datetime | None = None,
) -> None:
    """Append one load to the log."""
    row = (table_id, run_id, status, records, version, mark_initial, full_reload, error, ended_at or datetime.now())
    append_table(spark.createDataFrame([row], LOG_SCHEMA), path)


def table_state(log: DataFrame, order: Sequence[str] = ("ended_at",)) -> DataFrame:
    """Current state per table.

    Last status and counts come from the latest row; the watermark only from successful loads (a full reload that
    succeeded starts again from its own version, 0 if it has none); the initial-load flag never goes back.
    Plain aggregates combine on the map side, so a table with a very long log is no hot spot.
    """
    at = F.struct(*order)
    ok = F.col("status") == "SUCCESS"
    version = F.when(F.col("full_reload"), F.coalesce("sync_version", F.lit(0))).otherwise(F.col("sync_version"))
    return log.groupBy("table_id").agg(
        F.max_by("status", at).alias("last_status"),
        F.max_by("pipeline_run_id", at).alias("last_run_id"),
        F.max_by("records_loaded", at).alias("records_loaded"),
        F.sum(F.when(ok, F.col("records_loaded")).otherwise(F.lit(0))).alias("total_records_loaded"),
        F.max_by(version, F.when(ok, at)).alias("last_sync_version"),
        F.max(F.coalesce(F.col("mark_initial") & ok, F.lit(False))).alias("initial_load_completed"),
        F.count(F.lit(1)).alias("runs"),
    )


def batch_version(df: DataFrame, col: str = "_current_sync_version") -> DataFrame:
    """New sync version of a batch: the highest one in it (one row)."""
    return df.agg(F.max(col).alias("sync_version"))


def load_health(log: DataFrame, now: datetime) -> DataFrame:
    """Monitors per table: hours since the last success, rows in the last 24 hours, error rate, alert flags."""
    now_ = F.lit(now).cast("timestamp")
    ok = F.col("status") == "SUCCESS"
    recent = F.col("ended_at") > now_ - F.expr("interval 24 hours")
    per_table = log.filter(F.col("ended_at") <= now_).groupBy("table_id").agg(
        F.max(F.when(ok, F.col("ended_at"))).alias("last_success"),
        F.coalesce(F.sum(F.when(recent & ok, F.col("records_loaded"))), F.lit(0)).alias("rows_24h"),
        F.avg(F.when(ok, F.lit(0.0)).otherwise(F.lit(1.0))).alias("error_rate"),
    )
    lag = (F.unix_timestamp(now_) - F.unix_timestamp("last_success")) / F.lit(3600.0)
    return per_table.select(
        "table_id",
        lag.alias("lag_hours"),
        "rows_24h",
        "error_rate",
        F.coalesce(lag > 24, F.lit(True)).alias("lag_alert"),
        (F.col("rows_24h") == 0).alias("no_data_alert"),
    )
