"""Ordered look-behind, look-ahead and running counts per key, with no per-key hot task.

A plain window puts all rows of one key into one task. Here each key is cut into *slices* of its order column
(days by default). The window runs per (key, slice); one small row per slice then carries values across slice
borders. Those summary rows are bounded by the number of slices a key has, not by its number of rows.

The rows themselves are shuffled once, on (key, slice); only summaries move again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "_slice"


def day_slice(col: str) -> Column:
    """Slice number of a timestamp or date: days since the epoch."""
    return F.coalesce(F.unix_date(F.col(col).cast("date")), F.lit(-(2**31)))


def step_slice(col: str, step: int) -> Column:
    """Slice number of an integer order column."""
    return F.coalesce(F.floor(F.col(col) / F.lit(step)).cast("long"), F.lit(-(2**62)))


def with_slice(df: DataFrame, slice_: Column) -> DataFrame:
    return df.withColumn(SLICE, slice_)


def _order(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def _reverse(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols]


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the last non-null ``value`` strictly before each row of its key."""
    keys = list(keys)
    before = Window.partitionBy(*keys, SLICE).orderBy(*_order(order)).rowsBetween(Window.unboundedPreceding, -1)
    here = df.withColumn(out, F.last(value, ignorenulls=True).over(before))
    rank = F.when(F.col(value).isNotNull(), F.struct(*order))
    ends = df.groupBy(*keys, SLICE).agg(F.max_by(F.col(value), rank).alias("_end"))
    across = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*keys, SLICE, F.last("_end", ignorenulls=True).over(across).alias("_carry"))
    return (
        here.join(carry, [*keys, SLICE], "left")
        .withColumn(out, F.coalesce(out, "_carry"))
        .drop("_carry")
    )


def next_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the first non-null ``value`` strictly after each row of its key.

    Looks back along the reversed order: a frame that grows is linear, one that shrinks is quadratic.
    """
    keys = list(keys)
    after = Window.partitionBy(*keys, SLICE).orderBy(*_reverse(order)).rowsBetween(Window.unboundedPreceding, -1)
    here = df.withColumn(out, F.last(value, ignorenulls=True).over(after))
    rank = F.when(F.col(value).isNotNull(), F.struct(*order))
    starts = df.groupBy(*keys, SLICE).agg(F.min_by(F.col(value), rank).alias("_start"))
    across = Window.partitionBy(*keys).orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    carry = starts.select(*keys, SLICE, F.last("_start", ignorenulls=True).over(across).alias("_carry"))
    return (
        here.join(carry, [*keys, SLICE], "left")
        .withColumn(out, F.coalesce(out, "_carry"))
        .drop("_carry")
    )


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Add ``out``: 1-based position of each row within its key."""
    keys = list(keys)
    here = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys, SLICE).orderBy(*_order(order))))
    sizes = df.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_n"))
    across = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = sizes.select(*keys, SLICE, F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_before"))
    return (
        here.join(carry, [*keys, SLICE])
        .withColumn(out, (F.col(out) + F.col("_before")).cast("long"))
        .drop("_before")
    )
