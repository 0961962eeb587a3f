"""Incremental extracts: watermark windows and change feeds."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_increment(
    df: DataFrame,
    watermark: str,
    last: datetime | date | int | None,
    upper: datetime | date | int,
    lookback: timedelta | int | None = None,
) -> DataFrame:
    """Rows with ``last - lookback < watermark <= upper``.

    Both bounds are literals, so the filter reaches the Parquet or JDBC scan. ``last=None`` reads everything up
    to ``upper``; a lookback reads late commits again (the merge that follows is idempotent).
    """
    out = df.filter(F.col(watermark) <= F.lit(upper))
    if last is None:
        return out
    floor = last if lookback is None else last - lookback
    return out.filter(F.col(watermark) > F.lit(floor))


def cdc_changes(feed: DataFrame, base: DataFrame, keys: Sequence[str], current_version: int) -> DataFrame:
    """Change rows with the base table's current values.

    Keys come from the feed, so a deleted row keeps its key although the base table no longer has it.
    """
    keys = list(keys)
    return feed.join(base, keys, "left").withColumn("_current_sync_version", F.lit(current_version).cast("long"))


def split_key_list(text: str) -> list[str]:
    """``"CITY, STATE"`` -> ``["CITY", "STATE"]``."""
    return [part.strip() for part in text.split(",") if part.strip()]
