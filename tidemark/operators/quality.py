"""Data quality: row verdicts, quarantine, set-level checks, reconciliation.

A row passes, is tagged (WARNING) or is quarantined (ERROR or SKIP_ROW). Every check is a projection or a
map-side combined aggregate; none collects rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import FAR_FUTURE, UNKNOWN_KEY
from tidemark.operators import slices
from tidemark.operators.joins import orphans

FAILED = "_dq_failed"
WARNED = "_dq_warnings"


@dataclass(frozen=True)
class Rule:
    """``valid`` is a SQL expression that is TRUE for a good row. NULL counts as a failure."""

    rule_id: str
    rule_type: str
    column: str
    valid: str
    severity: str = "SKIP_ROW"  # ERROR | SKIP_ROW | WARNING

    @property
    def quarantines(self) -> bool:
        return self.severity != "WARNING"

    def fails(self) -> Column:
        return ~F.coalesce(F.expr(self.valid), F.lit(False))


class QualityError(RuntimeError):
    """A batch broke a threshold or the circuit breaker."""


def _failed_ids(rules: Iterable[Rule]) -> Column:
    hits = [F.when(r.fails(), F.lit(r.rule_id)) for r in rules]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def dq_check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the ids of failed quarantine rules and of failed warning rules, in rule order."""
    return df.withColumns(
        {
            FAILED: _failed_ids([r for r in rules if r.quarantines]),
            WARNED: _failed_ids([r for r in rules if not r.quarantines]),
        }
    )


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(FAILED) == 0).drop(FAILED)


def quarantined_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size(FAILED) > 0)


def dq_split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid with warning tags, quarantine with the failed rule ids)."""
    checked = dq_check(df, rules)
    return valid_rows(checked), quarantined_rows(checked)


def default_key_rules(keys: Sequence[str]) -> list[Rule]:
    """Any null key column quarantines the row."""
    return [Rule(f"KEY-{k.upper()}", "NULL_CHECK", k, f"{k} is not null", "SKIP_ROW") for k in keys]


def dlq_rows(
    quarantine: DataFrame, rules: Sequence[Rule], run_id: str, table: str, now=None, broken: str = FAILED
) -> DataFrame:
    """Dead-letter log: one row per rule in ``broken`` (the failed ones, or the warnings) with the row as JSON."""
    ts = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    data = [c for c in quarantine.columns if c not in (FAILED, WARNED)]

    def attribute(get) -> Column:
        out = F
        for r in rules:
            out = out.when(F.col("rule_id") == r.rule_id, F.lit(get(r)))
        return out.otherwise(F.lit(None).cast("string"))

    return quarantine.select(
        F.explode(broken).alias("rule_id"), F.to_json(F.struct(*data)).alias("row_data")
    ).select(
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(table).alias("table_name"),
        "rule_id",
        attribute(lambda r: r.rule_type).alias("rule_type"),
        attribute(lambda r: r.column).alias("column_name"),
        attribute(lambda r: f"not valid: {r.valid}").alias("error_message"),
        "row_data",
        attribute(lambda r: r.severity).alias("severity"),
        ts.alias("exception_timestamp"),
        F.lit(False).alias("is_resolved"),
    )


def dq_summary(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """Failures per rule and rows checked: one pass, one row per rule."""
    checks = [F.count_if(r.fails()).alias(f"f{i}") for i, r in enumerate(rules)]
    totals = df.agg(F.count(F.lit(1)).alias("total"), *checks)
    per_rule = F.array(
        *[
            F.struct(
                F.lit(r.rule_id).alias("rule_id"),
                F.lit(r.severity).alias("severity"),
                F.col(f"f{i}").alias("failed_count"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return totals.select(
        F.lit(table).alias("table_name"), F.col("total").alias("total_records_checked"), F.explode(per_rule).alias("r")
    ).select("table_name", "total_records_checked", "r.*")


def ri_violations(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent."""
    return orphans(child, parent, key, parent_key)


def ri_violation_count(child: DataFrame, parent: DataFrame, key: str, rule_id: str, parent_key: str | None = None):
    """Number of orphan rows. The child is counted per key first, so a hot key is one row in the join."""
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    missing = orphans(per_key, parent, key, parent_key)
    return missing.agg(
        F.lit(rule_id).alias("rule_id"), F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("failed_count")
    )


def uniqueness_violations(df: DataFrame, keys: Sequence[str], where: str | None = None) -> DataFrame:
    """Keys that occur more than once, with their count."""
    rows = df.filter(where) if where else df
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def scd_violations(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions with an empty or reversed interval, or that overlap the next version of the key."""
    keys = list(keys)
    rows = slices.with_slice(dim, slices.day_slice("_valid_from"))
    rows = slices.next_value(rows, keys, ["_valid_from", "_version"], "_valid_from", "_next_from")
    end = F.coalesce(F.col("_valid_to"), F.lit(FAR_FUTURE).cast("timestamp"))
    reason = F.when(~F.coalesce(F.col("_valid_from") < end, F.lit(False)), F.lit("EMPTY_INTERVAL")).when(
        end > F.col("_next_from"), F.lit("OVERLAP")
    )
    return (
        rows.withColumn("violation", reason)
        .filter(F.col("violation").isNotNull())
        .select(*keys, "_valid_from", "_valid_to", "_version", "violation")
    )


def unknown_usage(fact: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Percent of fact rows at the unknown member, per key column, in one pass."""
    shares = fact.agg(
        *[F.avg(F.when(F.col(k) == UNKNOWN_KEY, F.lit(100.0)).otherwise(F.lit(0.0))).alias(k) for k in key_cols]
    )
    rows = F.array(*[F.struct(F.lit(k).alias("key_column"), F.col(k).alias("unknown_pct")) for k in key_cols])
    return shares.select(F.explode(rows).alias("r")).select(
        "r.*", (F.col("r.unknown_pct") > F.lit(5.0)).alias("over_threshold")
    )


def reconcile_sum(
    a: DataFrame, col_a: str, b: DataFrame, col_b: str, tolerance: float | str = "1.00", rule_id: str = "DQ-G-A-001"
) -> DataFrame:
    """Compare two control totals; one row."""
    left = a.agg(F.coalesce(F.sum(col_a), F.lit(0)).alias("total"))
    right = b.agg(F.coalesce(F.sum(col_b), F.lit(0)).alias("total"))
    return left.select(
        F.lit(rule_id).alias("rule_id"), F.col("total").alias("total_a"), right.scalar().alias("total_b")
    ).select(
        "*",
        F.abs(F.col("total_a") - F.col("total_b")).alias("variance"),
        (F.abs(F.col("total_a") - F.col("total_b")) < F.lit(tolerance).cast("decimal(15,2)")).alias("matched"),
    )


def load_metrics(records_read: DataFrame, checked: DataFrame) -> DataFrame:
    """read = written + filtered + quarantined, where deduplicated rows count as filtered."""
    after = checked.agg(
        F.count_if(F.size(FAILED) == 0).alias("records_written"),
        F.count_if(F.size(FAILED) > 0).alias("records_quarantined"),
    )
    read = records_read.agg(F.count(F.lit(1)).alias("n"))
    return after.select(
        read.scalar().alias("records_read"), "records_written", "records_quarantined"
    ).select(
        "*",
        (F.col("records_read") - F.col("records_written") - F.col("records_quarantined")).alias("records_filtered"),
    )


def control_totals(df: DataFrame, key: str, amount: str | None = None) -> DataFrame:
    """Row count and sums used to compare a source with its target."""
    sums = [F.count(F.lit(1)).alias("row_count"), F.sum(key).alias("key_sum")]
    if amount:
        sums.append(F.sum(amount).alias("amount_sum"))
    return df.agg(*sums)


def error_share(checked: DataFrame, rules: Sequence[Rule], key: str | None = None) -> DataFrame:
    """Share of rows that fail an ERROR rule, and of rows with a null key (one row)."""
    errors = [r.rule_id for r in rules if r.severity == "ERROR"]
    failed = F.arrays_overlap(F.col(FAILED), F.array(*[F.lit(e) for e in errors])) if errors else F.lit(False)
    null_key = F.col(key).isNull() if key else F.lit(False)
    return checked.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(failed).alias("error_rows"),
        F.count_if(null_key).alias("null_key_rows"),
    ).select("*", F.try_divide("error_rows", "rows_checked").alias("error_share"))


def quarantine_share(staged: DataFrame, key: str) -> DataFrame:
    """Share of quarantined rows, whatever the severity of their rule, and number of rows with a null key (one row)."""
    return staged.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if("quarantined").alias("error_rows"),
        F.count_if(F.col(key).isNull()).alias("null_key_rows"),
    ).select("*", F.try_divide("error_rows", "rows_checked").alias("error_share"))


def enforce_threshold(summary: DataFrame, limit: float = 0.05) -> None:
    """Raise when the error share is above the limit, or when every key in the batch is null."""
    row = summary.first()
    if row.rows_checked and row.null_key_rows == row.rows_checked:
        raise QualityError("every key in the batch is null")
    if (row.error_share or 0) > limit:
        raise QualityError(f"{row.error_share:.2%} of rows fail a rule (limit {limit:.2%})")
