"""Snapshot calendars: one row per distinct day, numbered, with the rule in force.

Everything here holds at most one row per calendar day, whatever the size of the fact table, so the
windows without partitions and the broadcasts below are bounded by the DATE domain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perkline.functions.dates import epoch_day
from perkline.session import ensure_checkpoint_dir


def distinct_dates(df: DataFrame, column: str = "activity_date", name: str = "snapshot_date") -> DataFrame:
    return df.select(F.col(column).alias(name)).filter(F.col(name).isNotNull()).distinct()


def number_dates(dates: DataFrame, window_days: int) -> DataFrame:
    """Position of each date, and of the first date whose trailing window no longer covers it."""
    by_day = Window.orderBy(epoch_day(F.col("snapshot_date")))
    still_covering = by_day.rangeBetween(Window.unboundedPreceding, window_days)
    return dates.select(
        "*",
        F.row_number().over(by_day).alias("date_pos"),
        (F.count("*").over(still_covering) + 1).cast("int").alias("expiry_pos"),
    )


def rule_per_date(
    dates: DataFrame, validity: DataFrame, rule_columns: Sequence[str], keep_uncovered: bool = False
) -> DataFrame:
    """Attach the rule in force on each date; dates without one are dropped or kept with NULLs.

    Rule windows are disjoint, so the last non-empty window that started on or before a date is
    the only candidate. Start days and dates are merged and the rule carried forward: no range join.
    """
    rule = F.struct(*rule_columns, "effective_to_exclusive")
    starts = validity.filter(
        F.col("effective_to_exclusive").isNull() | (F.col("valid_from_inclusive") < F.col("effective_to_exclusive"))
    ).select(F.col("valid_from_inclusive").alias("snapshot_date"), F.lit(0).alias("_is_date"), rule.alias("_rule"))
    marks = starts.unionByName(dates.withColumn("_is_date", F.lit(1)), allowMissingColumns=True)
    so_far = Window.orderBy("snapshot_date", "_is_date").rowsBetween(Window.unboundedPreceding, 0)
    carried = marks.withColumn("_rule", F.last("_rule", ignorenulls=True).over(so_far)).filter("_is_date = 1")
    ends = F.col("_rule.effective_to_exclusive")
    active = F.col("_rule").isNotNull() & (ends.isNull() | (F.col("snapshot_date") < ends))
    found = carried.withColumn("_rule", F.when(active, F.col("_rule")))
    if not keep_uncovered:
        found = found.filter(F.col("_rule").isNotNull())
    return found.select(*dates.columns, *[F.col("_rule")[c].alias(c) for c in rule_columns])


def join_asof_rule(df: DataFrame, date_column: str, validity: DataFrame, rule_columns: Sequence[str]) -> DataFrame:
    """Inner as-of join of facts to the rule valid on their date: resolved per day, then a hash join."""
    per_date = rule_per_date(distinct_dates(df, date_column), validity, rule_columns)
    return df.join(F.broadcast(per_date), df[date_column] == per_date["snapshot_date"]).drop("snapshot_date")


def materialize_calendar(calendar: DataFrame) -> DataFrame:
    """Compute a calendar once (reliable checkpoint) so its users neither rescan facts nor guess its size."""
    ensure_checkpoint_dir(calendar.sparkSession)
    return calendar.coalesce(1).checkpoint()
