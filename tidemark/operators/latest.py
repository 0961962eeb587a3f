"""Keep-latest deduplication.

``row_number() = 1`` is planned with a group limit *before* the shuffle: each map task keeps one row per key, so
a key that holds a large share of the input reaches the reducer as at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Event-order columns, best first.
ORDER_CANDIDATES = ("_cdc_version", "LAST_UPDATE_DATE", "_ingest_timestamp")


def order_column(df: DataFrame) -> str | None:
    have = {c.lower(): c for c in df.columns}
    return next((have[c.lower()] for c in ORDER_CANDIDATES if c.lower() in have), None)


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    tie: Sequence[str | Column] = (),
) -> DataFrame:
    """One row per key: highest ``order`` (nulls last), then ``tie`` ascending.

    With no ``order`` the first available of the usual event-order columns is used; with none of those an
    arbitrary row per key stays.
    """
    if order is None:
        found = order_column(df)
        if found is None:
            return df.dropDuplicates(list(keys))
        order = [found]
    if not order and not tie:
        return df.dropDuplicates(list(keys))
    ranking = [F.col(c).desc_nulls_last() for c in order]
    ranking += [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in tie]
    w = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def cdc_latest(feed: DataFrame, keys: Sequence[str], version: str = "SYS_CHANGE_VERSION") -> DataFrame:
    """Last change per key in a feed."""
    return keep_latest(feed, keys, [version])
