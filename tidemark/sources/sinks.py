"""Writers: overwrite, dynamic partition overwrite, append, layouts clustered by ranges or along a Z curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clustered(df: DataFrame, cols: Sequence[str], files: int | None = None) -> DataFrame:
    """Range-cluster rows so that file and row-group min/max on ``cols`` can skip data.

    A row hash is the last range key: a value that holds a large share of the rows is cut into several files
    instead of landing in one task. Without a file count, AQE sizes the output partitions.
    """
    ranges = [F.col(c) for c in cols] + [F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
    return ranged.sortWithinPartitions(*cols)


def _ordinal(df: DataFrame, name: str) -> Column:
    """A number in the order of the values: exact for numbers and times up to 2^53, six bytes of a string."""
    kind = df.schema[name].dataType.typeName()
    col = F.col(name)
    if kind in ("string", "binary"):
        first = F.hex(F.substring(col.cast("binary"), 1, 6))
        return F.conv(F.rpad(first, 12, "0"), 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(col).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return col.cast("double")


def curve(df: DataFrame, cols: Sequence[str], bits: int = 6) -> Column:
    """Place of a row on a Z curve over the ranks of ``cols``, each cut into 2^bits ranges of about as many rows.

    The bounds come from mergeable quantile sketches in one pass; only they reach the driver. Null counts as least.
    """
    wide = 1 << bits
    shares = F.array(*(F.lit(i / wide) for i in range(1, wide)))
    found = df.select(*(F.percentile_approx(_ordinal(df, c), shares, 1000).alias(f"_{i}") for i, c in enumerate(cols))).first()
    place = F.lit(0).cast("long")
    for i, c in enumerate(cols):
        bounds = sorted(set(found[i] or ()))
        ordinal = _ordinal(df, c)
        rank = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < ordinal)) if bounds else F.lit(0)
        for bit in range(bits):
            one = F.shiftright(rank, bit).bitwiseAND(1).cast("long")
            place = place + F.shiftleft(one, bit * len(cols) + i)
    return place


def interleaved(df: DataFrame, cols: Sequence[str], files: int | None = None, bits: int = 6) -> DataFrame:
    """Cluster rows along a Z curve, so that min/max of files skip data for a filter on any of ``cols``, not on the first
    alone. A row hash cuts places of the curve that hold many rows. ``df`` is read once more for the bounds."""
    placed = df.withColumn("_place", curve(df, cols, bits))
    ranges = [F.col("_place"), F.xxhash64(*df.columns)]
    ranged = placed.repartitionByRange(files, *ranges) if files else placed.repartitionByRange(*ranges)
    return ranged.sortWithinPartitions("_place", *cols).drop("_place")


def rebalanced(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Group rows by partition value before a partitioned write, so that a task opens few folders.

    AQE merges small and splits large partitions from measured sizes: a hot value becomes several files.
    """
    return df.hint("rebalance", *[F.col(c) for c in cols])


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """Full write. Never point it at a folder the plan reads from: write a new folder and switch to it."""
    if len(cluster_by) > 1 and not partition_by:
        df = interleaved(df, cluster_by, files)
    elif partition_by or cluster_by:
        # partition columns lead the range, so one task writes few folders and a hot partition value is still
        # cut into several files by the cluster columns
        df = clustered(df, [*partition_by, *cluster_by], files)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, cols: Sequence[str], cluster_by: Sequence[str] = ()) -> None:
    """Replace only the partitions present in ``df``; a re-run gives the same table."""
    out = clustered(df, [*cols, *cluster_by]) if cluster_by else rebalanced(df, cols)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols)
        .parquet(path)
    )


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def save_catalog_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def bucketed_table(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    """Catalog table bucketed and sorted on the join keys, so repeated merges on them need no shuffle of it."""
    df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
