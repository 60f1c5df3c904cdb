"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkline.session import stage_table


def stored_keys(df: DataFrame, keys: Sequence[str], name: str = "keys") -> DataFrame:
    """The distinct keys of a side, stored, so that the optimizer picks the join by their true size."""
    return stage_table(df.select(*keys).distinct(), name)


def with_single_row(df: DataFrame, single: DataFrame, name: str) -> DataFrame:
    """Attach the only row of ``single`` as a struct column, without a join.

    A scalar subquery: no row gives NULL, more than one row is an error.
    """
    return df.withColumn(name, single.select(F.struct("*").alias("_one")).scalar())


def null_safe_equal(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def orphan_rows(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent. AQE splits skewed child partitions."""
    parents = parent.select(F.col(parent_key).alias("_parent_key"))
    return child.filter(F.col(child_key).isNotNull()).join(
        parents, F.col(child_key) == F.col("_parent_key"), "left_anti")


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Keys without a parent and their row counts: pre-aggregated, so hot keys shuffle as one row per task."""
    keys = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key")).agg(F.count("*").alias("row_count"))
    )
    parents = parent.select(F.col(parent_key).alias("key"))
    return keys.join(parents, "key", "left_anti")
