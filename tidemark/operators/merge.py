"""Keyed merges as pure functions ``(target, source) -> new target``.

Plain Parquet has no row-level MERGE, so a merge returns the whole new table (or, for facts, the touched
partitions) and the caller writes it to a new folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import cdc_latest

# Columns of a change feed that never reach the target.
FEED_COLUMNS = ("SYS_CHANGE_OPERATION", "SYS_CHANGE_VERSION", "_current_sync_version")


@dataclass(frozen=True)
class Clause:
    """One merge branch. Conditions and values may use ``t.<column>`` and ``s.<column>``.

    ``values=None`` copies every source column that the target has.
    """

    action: str  # delete | update | insert
    condition: str | None = None
    values: dict[str, str] | None = None


def _all_keys(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def one_row_per_key(df: DataFrame, keys: Sequence[str], keep_null: bool = True) -> DataFrame:
    """Fail at run time when a non-null key occurs twice.

    A map-side combined aggregate, not a window, so even a key repeated a billion times reaches the reducer as
    one row per map task. Rows with a null key match nothing and pass through (at a second scan), unless the caller has
    no use for them.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    keyed = df.filter(_all_keys(keys)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*rest) if rest else F.lit(1)).alias("_row")
    )
    message = F.concat(F.lit("several source rows for one key: "), F.to_json(F.struct(*keys)))
    guarded = keyed.filter(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    unique = guarded.select(*keys, *([F.col("_row")[c].alias(c) for c in rest]))
    unique = unique.select(*df.columns)
    return unique.unionByName(df.filter(~_all_keys(keys))) if keep_null else unique


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    clauses: Sequence[Clause],
    check_unique: bool = True,
) -> DataFrame:
    """Full outer join on the keys, then the first clause that applies to each row.

    Pass ``check_unique=False`` when the source is already deduplicated on the keys.
    """
    keys = list(keys)
    if check_unique:
        source = one_row_per_key(source, keys)
    keyed_t, keyed_s = target.filter(_all_keys(keys)), source.filter(_all_keys(keys))
    t = keyed_t.withColumn("_in", F.lit(True)).alias("t")
    s = keyed_s.withColumn("_in", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.join(s, on, "full_outer")

    # rows with a null key match nothing: target rows stay, source rows can only be inserted
    loose = target.filter(~_all_keys(keys))
    return (
        _apply(joined, target, source, clauses)
        .unionByName(loose)
        .unionByName(_insert_only(source.filter(~_all_keys(keys)), target, source, clauses))
    )


def _insert_only(loose: DataFrame, target: DataFrame, source: DataFrame, clauses: Sequence[Clause]) -> DataFrame:
    """Source rows that match nothing, beside a target side of nulls."""
    nothing = F.struct(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields), F.lit(None).cast("boolean").alias("_in")
    )
    pairs = loose.select(F.struct("*", F.lit(True).alias("_in")).alias("s"), nothing.alias("t"))
    return _apply(pairs, target, source, clauses)


def _apply(joined: DataFrame, target: DataFrame, source: DataFrame, clauses: Sequence[Clause]) -> DataFrame:
    in_t = F.col("t._in").isNotNull()
    in_s = F.col("s._in").isNotNull()
    action = F
    for i, clause in enumerate(clauses):
        scope = (in_s & ~in_t) if clause.action == "insert" else (in_s & in_t)
        cond = F.coalesce(F.expr(clause.condition), F.lit(False)) if clause.condition else F.lit(True)
        action = action.when(scope & cond, F.lit(i))
    action = action.otherwise(F.lit(-1))
    joined = joined.withColumn("_do", action)

    deletes = [i for i, c in enumerate(clauses) if c.action == "delete"]
    kept = in_t & ~F.col("_do").isin(deletes) if deletes else in_t
    joined = joined.filter(kept | (~in_t & (F.col("_do") >= 0)))

    out = []
    source_names = {c.lower(): c for c in source.columns}
    for field in target.schema.fields:
        value = F
        for i, clause in enumerate(clauses):
            if clause.action == "delete":
                continue
            if clause.values is not None:
                expr = next((v for k, v in clause.values.items() if k.lower() == field.name.lower()), None)
            else:
                name = source_names.get(field.name.lower())
                expr = None if name is None else f"s.`{name}`"
            if expr is not None:
                value = value.when(F.col("_do") == i, F.expr(expr).cast(field.dataType))
        fallback = F.col(f"t.`{field.name}`")
        out.append((fallback if value is F else value.otherwise(fallback)).alias(field.name))
    return joined.select(*out)


def add_missing_columns(df: DataFrame, like: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Additive schema change: null columns for what ``like`` has and ``df`` has not."""
    have = {c.lower() for c in df.columns} | {c.lower() for c in skip}
    new = {f.name: F.lit(None).cast(f.dataType) for f in like.schema.fields if f.name.lower() not in have}
    return df.withColumns(new) if new else df


def apply_cdc(
    target: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    delete: str = "hard",
    op: str = "SYS_CHANGE_OPERATION",
    version: str = "SYS_CHANGE_VERSION",
    tracked_version: str = "_cdc_version",
    tombstones: bool = False,
) -> DataFrame:
    """Apply a change feed: last change per key, then delete / update / insert.

    ``hard``: D removes the row. ``soft``: D sets ``_is_deleted``, I and U clear it, an unmatched D is ignored.
    The version of the last applied change stays in ``_cdc_version``, and an older change for the same key is
    ignored, so batches may arrive late or twice. With ``tombstones`` a D for a key the table has never seen stays as a
    deleted row with its version (soft deletes only), so that an older insert arriving later loses.
    """
    keys = list(keys)
    latest = cdc_latest(feed, keys, version)
    latest = latest.withColumn(tracked_version, F.col(version).cast("long"))
    target = add_missing_columns(target, latest, skip=[c for c in FEED_COLUMNS if c not in target.columns])
    if delete == "soft":
        target = add_missing_columns(
            target, latest.select(F.lit(False).alias("_is_deleted")), skip=()
        ).withColumn("_is_deleted", F.coalesce("_is_deleted", F.lit(False)))

    newer = f"coalesce(s.{tracked_version} > t.{tracked_version}, true)"
    target_names = {c.lower() for c in target.columns}
    copied = [c for c in latest.columns if c.lower() in target_names and c not in FEED_COLUMNS]
    insert_values = {c: f"s.`{c}`" for c in copied}
    update_values = {c: f"s.`{c}`" for c in copied if c not in keys and c != "ingest_date"}
    if delete == "hard":
        removal = Clause("delete", f"s.{op} = 'D' and {newer}")
    elif delete == "soft":
        insert_values["_is_deleted"] = update_values["_is_deleted"] = "false"
        marked = {"_is_deleted": "true", tracked_version: f"s.{tracked_version}"}
        for col in ("_cdc_operation", "_load_timestamp", "_pipeline_run_id"):
            if col in update_values:
                marked[col] = f"s.`{col}`"
        removal = Clause("update", f"s.{op} = 'D' and {newer}", marked)
    else:
        raise ValueError(delete)
    clauses = [
        removal,
        Clause("update", f"s.{op} in ('U', 'I') and {newer}", update_values),
        Clause("insert", f"s.{op} <> 'D'", insert_values),
    ]
    if tombstones:
        kept = {**{k: f"s.`{k}`" for k in keys}, tracked_version: f"s.{tracked_version}", "_is_deleted": "true"}
        clauses.append(Clause("insert", f"s.{op} = 'D'", kept))
    return merge(target, latest, keys, clauses, check_unique=False)


def scd1(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    check_unique: bool = True,
    version: str | None = None,
) -> DataFrame:
    """Upsert: source rows win, unmatched target rows stay; columns the source lacks keep the target's values.

    Target rows whose key is in the source are dropped by an anti join and the source is appended, so only the
    source *keys* are shuffled, not its rows. With ``version`` a source row older than the target's is ignored.
    """
    keys = list(keys)
    if check_unique:
        source = one_row_per_key(source, keys)
    if target is None:
        return source
    if version is not None and version in target.columns and version in source.columns:
        known = target.select(*keys, F.col(version).alias("_known"))
        fresh = F.coalesce(F.col(version) >= F.col("_known"), F.lit(True))
        source = source.join(known, keys, "left").filter(fresh).drop("_known")
    source = with_kept_columns(source, target, keys)
    untouched = target.join(source.select(*keys), keys, "left_anti")
    return untouched.unionByName(source, allowMissingColumns=True)


def with_kept_columns(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` and, from the target row of its key, the columns that it does not bring."""
    have = {c.lower() for c in source.columns}
    kept = [c for c in target.columns if c.lower() not in have]
    return source.join(target.select(*keys, *kept), list(keys), "left") if kept else source


def soft_delete(target: DataFrame, deleted: DataFrame, keys: Sequence[str], flag: str = "_is_deleted") -> DataFrame:
    """Mark the rows whose key is in ``deleted``; everything else about them stays."""
    marks = deleted.select(*keys).distinct().withColumn("_gone", F.lit(True))
    marked = target.join(marks, list(keys), "left").withColumn(flag, F.coalesce("_gone", flag, F.lit(False)))
    return marked.select(*target.columns)


def delete_where(df: DataFrame, condition: Column | str) -> DataFrame:
    """Remove rows for which the condition is TRUE (a NULL verdict keeps the row)."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return df.filter(~F.coalesce(cond, F.lit(False)))


def missing_keys(target: DataFrame, full_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys in the target that a full key extract no longer has: hard deletes a watermark cannot see."""
    keys = list(keys)
    return target.select(*keys).join(full_keys.select(*keys), keys, "left_anti")


def merge_fact(
    target: DataFrame,
    source: DataFrame,
    key: str,
    partition: str,
    created: str | None = "_created_date",
    deleted: DataFrame | None = None,
    touched: Sequence | None = None,
) -> DataFrame:
    """Upsert on the degenerate key; returns only the partitions that change, for a dynamic overwrite.

    A row whose date moved leaves its old partition, so both the old and the new partition are rewritten; so are
    those of the keys in ``deleted``, whose rows go. The null partition is one like any other. Columns the source lacks
    keep the target's values, and two source rows for one key fail.

    ``touched`` (the values of exactly those partitions, if the caller has them) only becomes a filter on the scan; the
    rows it returns are the same without.
    """
    source = one_row_per_key(source, [key])
    gone = source.select(key)
    if deleted is not None:
        gone = gone.unionByName(deleted.select(key)).distinct()
    if touched is not None:
        part = F.col(partition).cast("string")
        hit = part.isin([str(v) for v in touched if v is not None])
        target_rows = target.filter(hit | part.isNull() if None in touched else hit)
    else:
        target_rows = target
    moved = target_rows.select(key, F.col(partition).alias("_p")).join(gone, key, "left_semi").select("_p")
    changed = source.select(F.col(partition).alias("_p")).unionByName(moved).distinct()
    rest = target_rows.join(changed, F.col(partition).eqNullSafe(F.col("_p")), "left_semi")
    rest = rest.join(gone, key, "left_anti").select(*target.columns)
    source = with_first_values(source, target_rows, key, created)
    return rest.unionByName(source, allowMissingColumns=True)


def with_first_values(source: DataFrame, stored: DataFrame, key: str, created: str | None = "_created_date") -> DataFrame:
    """``source`` with what the stored row of its key keeps: when it was created, and the columns the source lacks."""
    if created is not None and created in stored.columns:
        first_seen = stored.select(key, F.col(created).alias("_first"))
        source = source.join(first_seen, key, "left")
        source = source.withColumn(created, F.coalesce("_first", created)).drop("_first")
    return with_kept_columns(source, stored, [key])
