"""Reconciliation of two large tables through digests of key ranges.

A digest doesn't depend on the order of rows: it is the number of rows and the sums of two 64-bit hashes of each row. The
digests of the leaves (ranges of keys) are stored beside a table and rolled up into wider ranges; a comparison goes down
from the widest ranges and looks only below those that differ, and reads rows only in leaves that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import durable

FAN = 6  # a range has 2^6 parts
LEVELS = 5  # the widest ranges are 2^24 leaves
INTEGERS = ("byte", "short", "integer", "long")


def _place(df: DataFrame, key: str, leaf_bits: int | None) -> Column:
    """Number of the leaf: ranges of integer keys, of the hashes of others; null keys share a leaf of their own."""
    if df.schema[key].dataType.typeName() in INTEGERS:
        return F.coalesce(F.shiftright(F.col(key).cast("long"), 12 if leaf_bits is None else leaf_bits), F.lit(-(1 << 63)))
    return F.coalesce(F.shiftright(F.xxhash64(key), 40 if leaf_bits is None else leaf_bits), F.lit(-(1 << 63)))


def _sums(cols: Sequence[str]) -> list[Column]:
    # a hash passes nulls over, so their places are hashed as well
    row = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    hashes = (F.sum(F.xxhash64(F.lit(seed), *row).cast("decimal(20,0)")) for seed in (1, 2))
    return [F.count(F.lit(1)).alias("n"), *(h.alias(f"d{i}") for i, h in enumerate(hashes))]


def digest_tree(df: DataFrame, key: str, cols: Sequence[str] | None = None, leaf_bits: int | None = None) -> DataFrame:
    """(level, bucket, n, d0, d1): digests of the leaves (level 0) and of the ranges above them. One pass over the rows,
    combined in the map tasks. Write it beside the table, or pass it on as it is."""
    cols = list(cols or df.columns)
    leaves = df.groupBy(_place(df, key, leaf_bits).alias("leaf")).agg(*_sums(sorted({key, *cols})))
    return _levels(leaves)


def _levels(leaves: DataFrame) -> DataFrame:
    ranges = F.array(
        *(F.struct(F.lit(i).alias("level"), F.shiftright("leaf", FAN * i).alias("bucket")) for i in range(LEVELS))
    )
    rows = leaves.select(F.inline(ranges), "n", "d0", "d1")
    total = (F.sum(c).cast(t).alias(c) for c, t in (("n", "long"), ("d0", "decimal(38,0)"), ("d1", "decimal(38,0)")))
    return rows.groupBy("level", "bucket").agg(*total)


def differing_leaves(left: DataFrame, right: DataFrame) -> DataFrame:
    """Leaves whose digests differ, found from the widest ranges down; both sides are :func:`digest_tree`."""
    above = None
    for level in range(LEVELS - 1, -1, -1):
        sides = []
        for side, mark in ((left, "l"), (right, "r")):
            rows = side.filter(F.col("level") == level)
            if above is not None:
                rows = rows.withColumn("_above", F.shiftright("bucket", FAN)).join(above, "_above", "left_semi")
            sides.append(rows.select("bucket", F.struct("n", "d0", "d1").alias(mark)))
        differ = sides[0].join(sides[1], "bucket", "full_outer").filter(~F.col("l").eqNullSafe(F.col("r")))
        above = differ.select(F.col("bucket").alias("_above"))
    return above.withColumnRenamed("_above", "leaf")


def reconcile_ranges(
    left: DataFrame,
    right: DataFrame,
    key: str,
    cols: Sequence[str] | None = None,
    leaf_bits: int | None = None,
    left_tree: DataFrame | None = None,
    right_tree: DataFrame | None = None,
) -> DataFrame:
    """Keys whose rows differ: (key, status, n_left, n_right), status ``missing`` (left only), ``extra`` (right only) or
    ``changed`` (other rows, or another number of them).

    Trees stored earlier over the same columns and leaves spare the pass over their table. The key has the same type on
    both sides. Null keys compare as one key; a null value differs from every other value.
    """
    cols = list(cols or left.columns)
    trees = [tree or digest_tree(df, key, cols, leaf_bits) for df, tree in ((left, left_tree), (right, right_tree))]
    leaves = durable(differing_leaves(*trees), "leaves")

    def keyed(df: DataFrame, mark: str) -> DataFrame:
        rows = df.withColumn("_leaf", _place(df, key, leaf_bits)).join(leaves.withColumnRenamed("leaf", "_leaf"), "_leaf", "left_semi")
        sums = rows.groupBy(key).agg(*_sums(sorted({key, *cols})))
        return sums.select(F.col(key).alias(f"_{mark}"), F.struct("n", "d0", "d1").alias(mark))

    both = keyed(left, "l").join(keyed(right, "r"), F.col("_l").eqNullSafe(F.col("_r")), "full_outer")
    status = F.when(F.col("r").isNull(), "missing").when(F.col("l").isNull(), "extra").otherwise("changed")
    counts = (F.coalesce(F.col(f"{m}.n"), F.lit(0)).alias(f"n_{name}") for m, name in (("l", "left"), ("r", "right")))
    return both.filter(~F.col("l").eqNullSafe(F.col("r"))).select(
        F.coalesce("_l", "_r").alias(key), status.alias("status"), *counts
    )
