"""Batch scans: staging folders, table sets, JDBC sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_batch(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """One staged Parquet batch. Additive columns across files are merged unless a schema is given."""
    reader = spark.read
    if schema is not None:
        return reader.schema(schema).parquet(path)
    return reader.option("mergeSchema", "true").parquet(path)


def is_empty(df: DataFrame) -> bool:
    """True for a batch with no rows: looks for one row, never counts."""
    return df.isEmpty()


def load_tables(spark: SparkSession, directory: str, names: Iterable[str], suffix: str = "", register: bool = False):
    """Read several tables below one folder; optionally register each as a temp view."""
    tables = {}
    for name in names:
        df = spark.read.parquet(f"{directory.rstrip('/')}/{name}{suffix}")
        if register:
            df.createOrReplaceTempView(name)
        tables[name] = df
    return tables


def jdbc_options(
    url: str,
    source: str,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Reader options for a whole table or a pushed-down query.

    A partitioned read needs ``dbtable`` (a query becomes a derived table), because Spark does not accept
    ``query`` together with ``partitionColumn``.
    """
    is_query = source.lstrip().lower().startswith(("select", "with"))
    options = {"url": url, "fetchsize": str(fetch_size), **extra}
    if partition_column is None:
        options["query" if is_query else "dbtable"] = source
        return options
    if lower is None or upper is None:
        raise ValueError("a partitioned read needs both bounds")
    options["dbtable"] = f"({source}) src" if is_query else source
    options |= {
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }
    return options


def read_jdbc(spark: SparkSession, url: str, source: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, source, **kwargs)).load()
