"""A bit map of fixed size over hashed keys: lets tasks skip rows that can't be wanted, without a shuffle.

It may let unwanted rows through, so a join must follow; it never holds back a wanted one. Its size doesn't grow with the data,
or up to a limit where a caller asks for it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26
MOST_BITS = 1 << 29
_PAGE = 32768  # bits of one aggregate


def bits_for(n: int) -> int:
    """Bits of a map that ``n`` keys fill to an eighth at most, up to 64 megabytes."""
    return min(MOST_BITS, max(BITS, 1 << (8 * n - 1).bit_length()))


def place(key: str | Column, bits: int = BITS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)).cast("long")


def build(keys: DataFrame, key: str, bits: int = BITS) -> np.ndarray:
    """The map of the values of one column; at most ``bits``, eight megabytes, are collected."""
    rows = keys.groupBy(F.floor(place(key, bits) / _PAGE).alias("page")).agg(
        F.call_function("bitmap_construct_agg", place(key, bits) % _PAGE).alias("bits")
    )
    table = np.zeros(bits // 8, np.uint8)
    for row in rows.collect():  # in one job, not in one for each partition
        table[row["page"] * _PAGE // 8 : (row["page"] + 1) * _PAGE // 8] = np.frombuffer(row["bits"], np.uint8)
    return table


def holds(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (table[places // 8] >> (places % 8)) & 1 == 1


def may_hold(keys: DataFrame, key: str):
    """Function from a column to a boolean column: false only where the value is not in ``keys``."""
    sent = keys.sparkSession.sparkContext.broadcast(build(keys, key))

    @F.pandas_udf("boolean")
    def test(places: pd.Series) -> pd.Series:
        return pd.Series(holds(sent.value, places.to_numpy(np.int64)))

    return lambda column: test(place(column))
