"""Positions in one total order over a table of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkline.session import stage_table

_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in its low 33 bits


def _numbered(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows in range-partitioned, sorted slices, with ``_slice`` and the position ``_at`` inside it; stored,
    since slice bounds are sampled and all uses must agree."""
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = stage_table(
        df.repartitionByRange(slices, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id()),
        "ranked",
    )
    return stored.select(
        *df.columns, F.shiftrightunsigned(F.col("_id"), 33).alias("_slice"),
        F.col("_id").bitwiseAND(F.lit(_ROW_BITS)).alias("_at"))


def _ranked(numbered: DataFrame, name: str) -> DataFrame:
    before = (
        numbered.groupBy("_slice").agg(F.count("*").alias("_size"))
        .withColumn("_before", F.coalesce(
            F.sum("_size").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("_slice", "_before")
    )
    # one row per slice, so at most spark.sql.shuffle.partitions rows are broadcast
    return (
        numbered.join(F.broadcast(before), "_slice")
        .withColumn(name, (F.col("_before") + F.col("_at") + 1).cast("bigint")).drop("_before")
    )


def total_order_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Exact global ``row_number() over (order by ...)`` without a single-task window.

    Rows are range-partitioned and sorted, numbered inside their slice, and shifted by the size of
    the slices before. ``order`` must end in a unique column: equal rows cannot be split.
    """
    return _ranked(_numbered(df, order), name).drop("_slice", "_at")


def lead_in_order(df: DataFrame, order: Sequence[Column], column: str, name: str, rank: str = "rank") -> DataFrame:
    """Adds the position and the next row's value of ``column``.

    Inside a slice that is a window over its rows; the last row of a slice takes the first value of the
    next slice that has rows, of which there is one row per slice.
    """
    numbered = _numbered(df, order)
    opening = numbered.filter("_at = 0").select("_slice", F.struct(F.col(column).alias("v")).alias("_first"))
    following = opening.select("_slice", F.lead("_first").over(Window.orderBy("_slice")).alias("_next"))
    own = F.lead(F.struct(F.col(column).alias("v"))).over(Window.partitionBy("_slice").orderBy("_at"))
    return (
        _ranked(numbered, rank).withColumn("_own", own).join(F.broadcast(following), "_slice")
        .withColumn(name, F.coalesce("_own", "_next").getField("v")).drop("_slice", "_at", "_own", "_next")
    )
