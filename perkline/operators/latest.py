"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep_null_keys: bool = True) -> DataFrame:
    """First row of every key in the given order.

    ``row_number() = 1`` lets Catalyst prune to one row per key and task *before* the shuffle
    (WindowGroupLimit), so a key holding most of the rows does not reach one task whole.
    NULL keys form one group, or are dropped when ``keep_null_keys`` is off.
    """
    if not keep_null_keys:
        df = df.dropna(subset=list(keys))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def latest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str], keep_null_keys: bool = True) -> DataFrame:
    """Last row of every key by the ``by`` columns; NULLs count as the latest."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_first() for c in by], keep_null_keys)
