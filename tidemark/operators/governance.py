"""Masking policies and row filters. The caller's groups are a parameter."""

from __future__ import annotations

from collections.abc import Collection, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.masking import MASKED, REDACTED, mask_email, mask_phone, mask_string
from tidemark.operators.lineage import ColumnSource

# Groups that read raw values, groups that see every row, and the group of each region.
PII_READERS = frozenset({"pii_readers", "data_stewards", "etl_service"})
ALL_ROWS = frozenset({"gov_admins", "data_stewards", "data_engineers", "global_analysts", "etl_service"})
REGION_GROUPS = {"analysts_na": "NA", "analysts_emea": "EMEA", "analysts_apac": "APAC"}

MASKS = {
    "email_mask": mask_email,
    "phone_mask": mask_phone,
    "string_mask": lambda c: mask_string(c, REDACTED),
    "full_mask": lambda c: mask_string(c, MASKED),
}


@dataclass(frozen=True)
class ColumnClass:
    table: str
    column: str
    tier: str
    masking: str | None = None


# Classification of the columns.
CLASSIFICATION = (
    ColumnClass("customers", "customer_id", "Public"),
    ColumnClass("customers", "first_name", "Restricted_PII", "string_mask"),
    ColumnClass("customers", "last_name", "Restricted_PII", "string_mask"),
    ColumnClass("customers", "email", "Restricted_PII", "email_mask"),
    ColumnClass("customers", "phone", "Restricted_PII", "phone_mask"),
    ColumnClass("customers", "status", "Public"),
    ColumnClass("addresses", "address_id", "Public"),
    ColumnClass("addresses", "address_line1", "Restricted_PII", "string_mask"),
    ColumnClass("addresses", "postal_code", "Restricted_PII", "string_mask"),
    ColumnClass("oe_order_headers_all", "order_id", "Public"),
    ColumnClass("oe_order_headers_all", "customer_id", "Public"),
    ColumnClass("oe_order_headers_all", "total_amount", "Confidential"),
    ColumnClass("oe_order_headers_all", "order_date", "Public"),
    ColumnClass("dim_customer", "customer_id", "Internal"),
    ColumnClass("dim_customer", "full_name", "Restricted_PII", "full_mask"),
    ColumnClass("dim_customer", "email", "Restricted_PII", "email_mask"),
    ColumnClass("dim_customer", "phone", "Restricted_PII", "phone_mask"),
    ColumnClass("fact_sales", "order_id", "Internal"),
    ColumnClass("fact_sales", "line_total", "Internal"),
)


# Tiers, from the least protected to the most.
TIERS = ("Public", "Internal", "Confidential", "Restricted_PII")


def inherited(lineage: Iterable[ColumnSource], policy: Iterable[ColumnClass] = CLASSIFICATION) -> tuple[ColumnClass, ...]:
    """``policy`` with a class for every column of ``lineage`` that has a classified source, at any distance.

    A stated class always holds; that is also how a derived column is declared harmless. Otherwise a column has the highest
    tier of its sources (Public only if none is unclassified) and, if it copies a masked one, that mask (the full mask, if it copies several masked ones with
    different masks). A column that is computed from a masked one, or whose source isn't known, needs a stated class: without
    it the call fails.
    """
    policy = tuple(policy)
    known: dict[tuple[str, str], ColumnClass | None] = {(c.table.lower(), c.column.lower()): c for c in policy}
    rows: dict[tuple[str, str], list[ColumnSource]] = {}
    for r in lineage:
        rows.setdefault((r.table.lower(), r.column.lower()), []).append(r)

    def class_of(key: tuple[str, str]) -> ColumnClass | None:
        if key in known or key not in rows:
            return known.get(key)
        known[key] = None  # a table that feeds itself adds nothing
        first, masks, tiers, whole = rows[key][0], set(), [], True
        for r in rows[key]:
            if r.source_table is None:
                raise ValueError(f"{r.table}.{r.column} needs a class: its source {r.source_column} is no known table's")
            source = class_of((r.source_table.lower(), r.source_column.lower()))
            if source is None:
                whole = False
                continue
            tiers.append(source.tier)
            if source.masking and not r.copied:
                raise ValueError(f"{r.table}.{r.column} needs a class: it is computed from {source.table}.{source.column}")
            if source.masking:
                masks.add(source.masking)
        tier = max(tiers, key=TIERS.index, default=None)
        if tiers and (whole or tier != TIERS[0]):
            mask = masks.pop() if len(masks) == 1 else "full_mask" if masks else None
            known[key] = ColumnClass(first.table, first.column, tier, mask)
        return known[key]

    derived = [class_of(key) for key in rows]
    return policy + tuple(c for c in derived if c is not None and c not in policy)


def apply_policy(df: DataFrame, table: str, groups: Collection[str], policy=CLASSIFICATION) -> DataFrame:
    """Mask the classified columns of a table unless one of the caller's groups reads raw values.

    Table and column names match in any case. A classified table without one of its masked columns fails: the column may
    have been renamed and would be shown in clear.
    """
    if PII_READERS & set(groups):
        return df
    names = {c.lower(): c for c in df.columns}
    wanted = [c for c in policy if c.table.lower() == table.lower() and c.masking]
    absent = [c.column for c in wanted if c.column.lower() not in names]
    if absent:
        raise ValueError(f"{table} has no column {', '.join(absent)} to mask")
    masked = {names[c.column.lower()]: MASKS[c.masking](F.col(f"`{names[c.column.lower()]}`")) for c in wanted}
    return df.withColumns(masked) if masked else df


def row_filter(df: DataFrame, col: str, groups: Collection[str], regions: dict[str, str] = REGION_GROUPS) -> DataFrame:
    """Rows of the caller's regions; nothing for a caller without any group."""
    if ALL_ROWS & set(groups):
        return df
    allowed = sorted({regions[g] for g in groups if g in regions})
    return df.filter(F.col(col).isin(allowed) if allowed else F.lit(False))
