"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. UTC keeps timestamp arithmetic the same on every machine; the
# skew-join settings let AQE split a hot probe-side partition even where that costs one more shuffle.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# What a map task sorts or groups before a shuffle is bounded by the bytes it reads, so that it fits the task's memory
# whatever the size of the table. Only Spark's own default is replaced; a size that the job or the cluster has set stays.
SPLIT = "spark.sql.files.maxPartitionBytes"
SPLIT_DEFAULT, SPLIT_BYTES = "134217728b", "32m"

FILE_ROWS = 1 << 16  # narrow rows in a file of a staged table whose size is known

# Rows of a wide table that one job of several moves, and the most jobs: each deletes its shuffles before the next begins.
PART_ROWS, MOST_PARTS = 1 << 22, 8

# The shuffles of a write are deleted once it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dir: tempfile.TemporaryDirectory | None = None
_staged: list[str] = []  # folders of staged tables, oldest first


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    if spark.conf.get(SPLIT) == SPLIT_DEFAULT:
        spark.conf.set(SPLIT, SPLIT_BYTES)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root for checkpoints and staged tables: ``spark.checkpoint.dir`` as the cluster set it.

    Only a local session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.TemporaryDirectory(prefix="tidemark-", ignore_cleanup_errors=True)
    return _local_dir.name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder (never reused between runs)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def files_for(spark: SparkSession, rows: int) -> int:
    """Tasks that write ``rows`` narrow rows: two for each core, and more as soon as that many have too much to write."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS))


def in_files(df, rows: int):
    """``df``, which has at most ``rows`` narrow rows or as many as its wide ones weigh, in no more tasks than they ask for.

    So a small table isn't staged as a file for each shuffle partition. Its rows are all there, whatever ``rows`` says.
    """
    return df.coalesce(files_for(df.sparkSession, rows))


def parts_for(rows: int) -> int:
    """The number of jobs in which so many wide rows are moved, so that the disk holds the shuffles of a part of them."""
    return max(1, min(MOST_PARTS, -(-rows // PART_ROWS)))


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs inside delete their shuffles as they end, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def durable(df, name: str = "stage", partition_by: Sequence[str] = ()):
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives executor loss.

    The shuffles of the write are not kept: whoever needs the rows again reads the folder. A job that has written its
    results gives the folders back with ``drop_scratch``. Columns of ``partition_by`` must be the last ones.
    """
    return durable_parts(df.sparkSession, [df], name, partition_by)


def durable_parts(spark: SparkSession, parts: Iterable[DataFrame], name: str = "stage", partition_by: Sequence[str] = ()):
    """One stored table of all the parts (one at least, with the same columns); each is written by a job of its own."""
    path = scratch_path(spark, name)
    _staged.append(path)
    schema = None
    with shuffles_freed(spark):
        for df in parts:
            (df.write.partitionBy(*partition_by) if partition_by else df.write).mode("append").parquet(path)
            schema = schema or df.schema
    return spark.read.schema(schema).parquet(path)


def scratch_mark() -> int:
    """Where the list of staged tables ends now; for ``drop_scratch``."""
    return len(_staged)


def last_staged() -> str:
    """The folder of the table staged last; for ``drop_table``."""
    return _staged[-1]


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete one staged table. Nothing that still reads it may be computed afterwards."""
    if path in _staged:
        at = _staged.index(path)
        drop_scratch(spark, at, at + 1)


def drop_scratch(spark: SparkSession, since: int, until: int | None = None) -> None:
    """Delete the tables staged between two marks. Nothing that still reads them may be computed afterwards."""
    paths = _staged[since:until]
    del _staged[since:until]
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
