"""The stored benefit timeline, kept up by what changes instead of being rebuilt.

A folder holds two tables: ``daily``, valid activity per employee and day, partitioned by day, and ``timeline``,
partitioned by snapshot date. Activity of day d touches the snapshots d to d + window of its employee; only those
partitions are read and written again, and in them only rows of the employees concerned are computed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perkline.defaults import WINDOW_DAYS
from perkline.functions.dates import as_date
from perkline.operators.activity import daily_activity
from perkline.operators.calendar import distinct_dates
from perkline.plans.timeline import (
    EMPLOYEE_FIELDS, decide_runs, employee_runs, rule_calendar, snapshot_rows, spread_by_date, spread_runs,
)
from perkline.session import stage_table

Days = Sequence[tuple[date, date]]


def _within(column: str, spans: Days) -> Column:
    return reduce(lambda a, b: a | b, [F.col(column).between(as_date(a), as_date(b)) for a, b in spans], F.lit(False))


def _merged(days: Sequence[date], length: int) -> list[tuple[date, date]]:
    """The days ``d`` to ``d + length`` of all ``days`` as separate spans."""
    spans: list[tuple[date, date]] = []
    for day in sorted(days):
        end = day + timedelta(days=length)
        if spans and day <= spans[-1][1] + timedelta(days=1):
            spans[-1] = (spans[-1][0], end)
        else:
            spans.append((day, end))
    return spans


def _days(df: DataFrame, column: str) -> set[date]:
    """Distinct days: one entry per calendar day at most, whatever the size of the table."""
    return {r[0] for r in df.select(column).distinct().collect() if r[0] is not None}


def _write(df: DataFrame, path: str, key: str) -> None:
    """Replace exactly the partitions that ``df`` brings; rows that come from ``path`` must have been stored elsewhere."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def _drop(spark: SparkSession, path: str, key: str, days: set[date]) -> None:
    jvm = spark.sparkContext._jvm
    for day in sorted(days):
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{key}={day}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _read(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}")


def read_timeline(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, "timeline")


def _snapshots(employees: DataFrame, daily: DataFrame, validity: DataFrame, spans: Days, window_days: int,
               dates: DataFrame | None = None, spread: Callable[[DataFrame], DataFrame] = spread_runs) -> DataFrame:
    """Timeline rows of the employees for the snapshot dates in ``spans``, from the days that these look back on.

    ``dates`` are the calendar's, by default those of ``daily``.
    """
    back = [(a - timedelta(days=window_days), b) for a, b in spans]
    near = daily.filter(_within("activity_date", back))
    days = distinct_dates(near if dates is None else dates.filter(_within("activity_date", back)))
    calendar = rule_calendar(days, validity, window_days)
    runs = decide_runs(employee_runs(employees.select(*EMPLOYEE_FIELDS), near, calendar, window_days), calendar)
    wanted = calendar.filter(_within("snapshot_date", spans))
    ends = wanted.agg(F.min("date_pos").alias("low"), F.max("date_pos").alias("high")).first()
    if ends["low"] is None:
        wanted, ends = calendar.limit(0), {"low": 1, "high": 0}
    cut = runs.withColumns({"begins": F.greatest("begins", F.lit(ends["low"])), "ends": F.least("ends", F.lit(ends["high"]))})
    return snapshot_rows(cut.filter("begins <= ends"), wanted, spread)


def store_timeline(path: str, employees: DataFrame, activities: DataFrame, validity: DataFrame,
                   window_days: int = WINDOW_DAYS) -> DataFrame:
    """Build the timeline from scratch into the folder ``path``."""
    spark = employees.sparkSession
    valid = daily_activity(activities.filter("is_valid_activity")).filter("activity_date is not null")
    _write(valid.hint("rebalance", "activity_date"), f"{path}/daily", "activity_date")
    daily = _read(spark, path, "daily")
    _write(_snapshots(employees, daily, validity, [(date(1, 1, 1) + timedelta(days=window_days), date(9999, 12, 31))], window_days,
                      spread=spread_by_date),
           f"{path}/timeline", "snapshot_date")
    return read_timeline(spark, path)


def refresh_timeline(path: str, employees: DataFrame, activities: DataFrame, validity: DataFrame, changed: DataFrame,
                     window_days: int = WINDOW_DAYS) -> DataFrame:
    """Bring the stored timeline up to ``activities``, whose rows differ for the pairs ``changed`` only.

    ``changed`` has (employee_id, activity_date) of all activities that came, went or became another; for one whose day
    was corrected, both days. Employees and rules must be those that the timeline was stored with. A snapshot
    date that is new gets a row for every employee, and one that nobody is active on any more is removed. A refresh
    that breaks off is repeated as it is: it replaces what it had written.
    """
    spark = employees.sparkSession
    pairs = stage_table(changed.select("employee_id", "activity_date").distinct(), "changed")
    days = _days(pairs, "activity_date")
    if not days:
        return read_timeline(spark, path)
    own = _merged(days, 0)
    fresh = stage_table(daily_activity(activities.filter("is_valid_activity").filter(_within("activity_date", own))), "fresh")
    _write(fresh.hint("rebalance", "activity_date"), f"{path}/daily", "activity_date")
    _drop(spark, f"{path}/daily", "activity_date", days - _days(fresh, "activity_date"))

    daily = _read(spark, path, "daily")
    held, there = _days(read_timeline(spark, path), "snapshot_date"), _days(daily, "activity_date")
    touched = _merged(days, window_days)
    new = {d for d in days & there if d not in held}
    known = [d for a, b in touched for d in there if a <= d <= b and d not in new]
    people = pairs.filter("employee_id is not null").select("employee_id").distinct()
    parts = []
    if known:
        spans = _merged(known, 0)
        mine = employees.join(people, "employee_id", "left_semi")
        computed = _snapshots(mine, daily.join(people, "employee_id", "left_semi"), validity, spans, window_days, daily)
        stored = read_timeline(spark, path).filter(_within("snapshot_date", spans))
        parts += [computed, stored.join(people, "employee_id", "left_anti").select(*computed.columns)]
    if new:
        parts.append(_snapshots(employees, daily, validity, _merged(new, 0), window_days))
    if parts:
        rows = stage_table(reduce(DataFrame.unionByName, parts), "refreshed")
        _write(rows.hint("rebalance", "snapshot_date"), f"{path}/timeline", "snapshot_date")
    _drop(spark, f"{path}/timeline", "snapshot_date", held - there)
    return read_timeline(spark, path)
