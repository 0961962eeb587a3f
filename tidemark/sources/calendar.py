"""Static date dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default calendar range.
DEFAULT_START = date(2015, 1, 1)
DEFAULT_END = date(2030, 12, 31)


def with_calendar_columns(days: DataFrame, day: str) -> DataFrame:
    """The thirteen calendar attributes for a DATE column."""
    d = F.col(day)
    return days.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int").alias("dim_date_key"),
        d.alias("full_date"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def build_dim_date(spark: SparkSession, start: date = DEFAULT_START, end: date = DEFAULT_END) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    n = (end - start).days + 1
    days = spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    return with_calendar_columns(days, "d")


def calendar_for(df: DataFrame, col: str) -> DataFrame:
    """Calendar that spans the dates found in ``df[col]`` (one min/max aggregate, then one row per day)."""
    bounds = df.agg(F.min(col).cast("date").alias("lo"), F.max(col).cast("date").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("d"))
    return with_calendar_columns(days, "d")
