"""Surrogate keys and special members."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.functions.exprs import ORGANIC_KEY, UNKNOWN_KEY

# Each bucket spans 2^20 business keys, each super-bucket 2^40: no window below ever sees more than 2^20 distinct
# keys (level 0 and 1) or 2^24 rows (level 2), whatever the table size.
_BITS = 20


def _offsets(counts: DataFrame) -> DataFrame:
    """(bucket, rows) -> (bucket, rows in all smaller buckets)."""
    counts = counts.withColumn("_top", F.shiftright("_bucket", _BITS))
    tops = counts.groupBy("_top").agg(F.sum("_n").alias("_n"))
    before_top = Window.orderBy("_top").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("_top", F.coalesce(F.sum("_n").over(before_top), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_top").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    inner = counts.withColumn("_inner", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    return inner.join(tops, "_top").select("_bucket", (F.col("_base") + F.col("_inner")).alias("_offset"))


def _range_bucket(df: DataFrame, key: str, buckets: int = 256, sample: int = 4096) -> Column:
    """Number of a range of keys. The bounds come from the keys with the least hashes, so the ranges are about equal;
    they decide the balance alone, and at most ``sample`` values reach the driver."""
    rows = df.select(key).dropna().distinct().orderBy(F.xxhash64(key), key).limit(sample).orderBy(key).collect()
    step = max(1, len(rows) // buckets)
    bounds = [F.lit(r[0]) for r in rows[step - 1 :: step]]
    below = F.size(F.filter(F.array(*bounds), lambda b: b < F.col(key))) if bounds else F.lit(0)
    return below.cast("long")


def assign_keys(
    df: DataFrame,
    key: str,
    surrogate: str,
    start: Column | int = 0,
    ordinal: str | None = None,
) -> DataFrame:
    """Fill null ``surrogate`` values with ``start + rank of the business key``; other rows keep theirs.

    Dense, deterministic and equal to ``start + row_number() over (order by key)``, without a global window:
    buckets of the key are ranked in parallel and a small table of bucket sizes gives the offsets. Integer keys fall into
    buckets by their high bits, other orderable types by range (:func:`_range_bucket`).
    Keys that are new must be unique, unless ``ordinal`` names a 1-based position within the key.
    """
    start = F.lit(start) if isinstance(start, int) else start
    integer = df.schema[key].dataType.typeName() in ("byte", "short", "integer", "long")
    bucket = F.shiftright(F.col(key).cast("long"), _BITS) if integer else _range_bucket(df, key)
    fresh = F.col(surrogate).isNull()
    if ordinal is not None:
        sizes = df.filter(fresh).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        prefix = Window.partitionBy("_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        ranked = sizes.withColumn("_bucket", bucket)
        ranked = ranked.withColumn("_first", F.coalesce(F.sum("_n").over(prefix), F.lit(0)))
        offsets = _offsets(ranked.groupBy("_bucket").agg(F.sum("_n").alias("_n")))
        firsts = ranked.join(offsets, "_bucket").select(key, (F.col("_first") + F.col("_offset")).alias("_first"))
        numbered = df.join(firsts, key, "left")
        new_key = (start + F.col("_first") + F.col(ordinal)).cast("long")
        return numbered.withColumn(surrogate, F.coalesce(F.col(surrogate), new_key)).drop("_first")

    marked = df.withColumn("_bucket", bucket)
    running = Window.partitionBy("_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    ranked = marked.withColumn("_rank", F.sum(fresh.cast("long")).over(running))
    counts = marked.groupBy("_bucket").agg(F.sum(fresh.cast("long")).alias("_n"))
    numbered = ranked.join(_offsets(counts), "_bucket", "left")
    new_key = (start + F.coalesce(F.col("_offset"), F.lit(0)) + F.col("_rank")).cast("long")
    return numbered.withColumn(surrogate, F.coalesce(F.col(surrogate), new_key)).drop("_bucket", "_rank", "_offset")


def max_key(df: DataFrame, surrogate: str) -> Column:
    """Highest key in use, 0 for an empty table or one with special members only (a scalar subquery)."""
    top = df.agg(F.greatest(F.coalesce(F.max(surrogate), F.lit(0)), F.lit(0)).cast("long"))
    return top.scalar()


# Special members of each dimension.
MEMBERS = {
    "dim_customer": [
        {"dim_customer_key": UNKNOWN_KEY, "customer_id": -1, "full_name": "UNKNOWN", "status": "UNKNOWN",
         "marketing_opt_in": False, "_valid_from": "1900-01-01", "_is_current": True, "_version": 1},
    ],
    "dim_product": [
        {"dim_product_key": UNKNOWN_KEY, "inventory_item_id": -1, "sku": "UNKNOWN", "product_name": "UNKNOWN"},
    ],
    "dim_location": [{"dim_location_key": UNKNOWN_KEY, "address_id": -1, "city": "UNKNOWN"}],
    "dim_campaign": [
        {"dim_campaign_key": UNKNOWN_KEY, "campaign_id": -1, "campaign_name": "UNKNOWN", "channel": "UNKNOWN"},
        {"dim_campaign_key": ORGANIC_KEY, "campaign_id": -2, "campaign_name": "ORGANIC", "channel": "ORGANIC"},
    ],
    "dim_registration_source": [
        {"dim_registration_source_key": UNKNOWN_KEY, "registration_source_id": -1, "channel": "UNKNOWN"},
    ],
}


def with_members(dim: DataFrame, members: Sequence[dict], key: str, stored: DataFrame | None = None) -> DataFrame:
    """Add the special members that ``stored`` does not have yet, with the reserved values as surrogate keys.

    ``stored`` is the dimension before this load (None: nothing is there yet). Only its reserved keys, those below
    zero, are looked at.
    """
    rows = [tuple(_member_value(m.get(f.name), f.dataType.typeName()) for f in dim.schema.fields) for m in members]
    nullable = StructType([StructField(f.name, f.dataType, True) for f in dim.schema.fields])
    constant = dim.sparkSession.createDataFrame(rows, nullable)
    if stored is not None:
        present = stored.filter(F.col(key) < 0).select(F.col(key).alias("_present"))
        constant = constant.join(present, F.col(key) == F.col("_present"), "left_anti")
    return dim.unionByName(constant)


def _member_value(value, kind: str):
    return datetime.fromisoformat(value) if kind == "timestamp" and value is not None else value
