"""Keyed table that micro-batches update, on plain Parquet.

Rows live in partitions of one column. A batch writes new files only for the partitions it touches, under
``v=<batch id>``, and then appends the list of these partitions to a small manifest. Readers take the newest
committed version of each partition, so a batch that dies half-way is never seen, and its retry overwrites its own
folder. The manifest has at most one row per partition and batch, and only (partition, version) pairs reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shuffles_freed
from tidemark.sources.sinks import append_table, rebalanced

# Fixed value: folder name of a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class PartitionedState:
    def __init__(self, spark: SparkSession, path: str, partition: str, cluster_by: Sequence[str] = ()):
        """``cluster_by``: columns that rows are sorted by inside a partition, so that row groups can be skipped."""
        self.spark, self.path, self.partition, self.cluster_by = spark, path.rstrip("/"), partition, cluster_by
        self._manifest = f"{self.path}/_commits"

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema("part string, v long").parquet(self._manifest)
        except Exception as error:  # no batch has committed yet
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise

    def committed(self, batch_id: int) -> bool:
        commits = self._commits()
        return commits is not None and not commits.filter(F.col("v") == batch_id).isEmpty()

    def versions(self) -> dict[str, int]:
        """Newest committed version per partition."""
        commits = self._commits()
        if commits is None:
            return {}
        return {r.part: r.v for r in commits.groupBy("part").agg(F.max("v").alias("v")).collect()}

    def read(self, parts: Iterable[str] | None = None) -> DataFrame | None:
        """Current rows, of some partitions or of all; None while there are none."""
        versions = self.versions()
        wanted = versions if parts is None else {p: versions[p] for p in parts if p in versions}
        if not wanted:
            return None
        folders = [f"{self.path}/data/v={v}/{self.partition}={p}" for p, v in sorted(wanted.items())]
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*folders).drop("v")

    def buckets(self, rows: int, per_bucket: int = 250_000, least: int = 64) -> int:
        """Number of key buckets of this table: chosen from its first rows (a power of two) and kept with it for good."""
        path = f"{self.path}/_layout"
        try:
            return self.spark.read.schema("buckets int").parquet(path).first()[0]
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
        count = least if self.versions() else max(least, 1 << (max(1, -(-rows // per_bucket)) - 1).bit_length())
        self.spark.createDataFrame([(count,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(path)
        return count

    def horizon(self, batch_id: int) -> int | None:
        """The moment before which a batch's events are late: what earlier batches have set; None for the first."""
        try:
            marks = self.spark.read.schema("v long, h long").parquet(f"{self.path}/_horizon")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return None
        return marks.filter(F.col("v") < batch_id).agg(F.max("h")).first()[0]

    def advance(self, batch_id: int, moment: int) -> None:
        """Set the horizon for the batches after this one; it never goes back."""
        append_table(self.spark.createDataFrame([(batch_id, moment)], "v long, h long").coalesce(1), f"{self.path}/_horizon")

    def prune(self, before: int) -> None:
        """Delete what no reader of a batch from ``before`` on can need: files and commits superseded by then.

        Frames that were read earlier from older versions must no longer be used, and batches before ``before`` can't be
        retried. Commits are written anew before the old list is deleted, so a crash leaves repeats at worst.
        """
        commits = self._commits()
        if commits is None:
            return
        newest = commits.filter(F.col("v") <= before).groupBy("part").agg(F.max("v").alias("_kept"))
        marked = commits.distinct().join(newest, "part", "left")
        old = F.coalesce(F.col("v") < F.col("_kept"), F.lit(False))
        rows = [(r["part"], r["v"], r["old"]) for r in marked.select("part", "v", old.alias("old")).collect()]
        if not any(r[2] for r in rows):
            return
        spark = self.spark
        hadoop = spark._jvm.org.apache.hadoop.fs
        manifest = hadoop.Path(self._manifest)
        files = manifest.getFileSystem(spark._jsc.hadoopConfiguration())
        listed = [status.getPath() for status in files.listStatus(manifest)]
        append_table(spark.createDataFrame([r[:2] for r in rows if not r[2]], "part string, v long").coalesce(1), self._manifest)
        for path in listed:
            files.delete(path, True)
        for part, v, is_old in rows:
            if is_old:
                files.delete(hadoop.Path(f"{self.path}/data/v={v}/{self.partition}={part}"), True)

    def write(self, rows: DataFrame | Iterable[DataFrame], touched: Iterable[str] | None, batch_id: int) -> None:
        """Replace the touched partitions and commit. A partition that lost all its rows stays as an empty file.

        Without ``touched`` the partitions are those that the rows turn out to be in: they are computed once, for the write.
        Rows may come in parts: each is written by a job of its own, and all are committed together.
        """
        folder = f"{self.path}/data/v={batch_id}"
        mode = "overwrite"
        for part in [rows] if isinstance(rows, DataFrame) else rows:
            rows = part
            ordered = rebalanced(part, [self.partition])
            if inside := [c for c in self.cluster_by if c in part.columns]:
                ordered = ordered.sortWithinPartitions(self.partition, *inside)
            with shuffles_freed(self.spark):
                ordered.write.mode(mode).partitionBy(self.partition).parquet(folder)
            mode = "append"
        if touched is None:
            touched = touched_values(self.spark.read.schema(rows.schema).parquet(folder), self.partition)
        touched = list(touched)
        empty = rows.limit(0).drop(self.partition)
        present = self._present(folder)
        for part in touched:
            if part not in present:
                empty.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{self.partition}={part}")
        append_table(
            self.spark.createDataFrame([(p, batch_id) for p in touched], "part string, v long").coalesce(1),
            self._manifest,
        )

    def _present(self, folder: str) -> set[str]:
        try:
            df = self.spark.read.parquet(folder)
        except Exception as error:
            if "UNABLE_TO_INFER_SCHEMA" in str(error) or "PATH_NOT_FOUND" in str(error):
                return set()
            raise
        if self.partition not in df.columns:
            return set()
        return set(touched_values(df, self.partition))


def touched_values(df: DataFrame, col: str) -> list[str]:
    """Distinct partition values of a batch, as folder names; bounded by the number of partitions."""
    return [NULL_FOLDER if r[0] is None else str(r[0]) for r in df.select(col).distinct().collect()]
