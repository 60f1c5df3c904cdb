"""Daily roll-ups of the benefit timeline, taken from its runs: the grid of employees and dates is never built.

A run counts from its first calendar position to its last. It adds where it begins and subtracts behind its end, and
prefix sums over the calendar give the counts of every date. Marks are summed per position inside the tasks, so a
shuffle carries at most one row per task and calendar day.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkline.operators.calendar import distinct_dates, rule_per_date
from perkline.plans.bi import bi_filter
from perkline.plans.timeline import stage_daily


def sweep(runs: DataFrame, calendar: DataFrame, held: Mapping[str, Column], met: Mapping[str, Column] | None = None) -> DataFrame:
    """Sums per snapshot date over the runs ``begins..ends`` that cover it.

    ``held`` are amounts that a run contributes on each of its dates, ``met`` amounts on its first date only. The result
    has ``snapshot_date``, ``runs`` (how many cover it) and these sums, for dates that a run covers.
    """
    held, met = {"runs": F.lit(1), **held}, met or {}
    opens = F.struct(F.col("begins").alias("pos"), F.lit(1).alias("sign"))
    closes = F.struct((F.col("ends") + 1).alias("pos"), F.lit(-1).alias("sign"))
    amounts = runs.select("begins", "ends", *[F.coalesce(c, F.lit(0)).alias(n) for n, c in {**held, **met}.items()])
    marks = amounts.withColumn("mark", F.explode(F.array(opens, closes)))
    sums = marks.groupBy(F.col("mark.pos").alias("date_pos")).agg(
        *[F.sum(F.col("mark.sign") * F.col(n)).alias(n) for n in held],
        *[F.sum(F.when(F.col("mark.sign") == 1, F.col(n)).otherwise(0)).alias(n) for n in met])
    so_far = Window.orderBy("date_pos").rowsBetween(Window.unboundedPreceding, 0)
    filled = calendar.select("snapshot_date", "date_pos").join(sums, "date_pos", "left")
    return filled.select(
        "snapshot_date", *[F.coalesce(F.sum(n).over(so_far), F.lit(0)).alias(n) for n in held],
        *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in met]).filter("runs > 0")


def daily_counts(runs: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per snapshot date: employees, those eligible, those active on the date and their activities.

    What happened on a date rides on the run that begins there, if it has not been cut off its first date.
    """
    today = F.when(F.col("on_pos") == F.col("begins"), F.col("activity_count"))
    return sweep(
        runs, calendar,
        {"bonus_eligible_employees": F.col("is_bonus_eligible").cast("int"),
         "wellbeing_eligible_employees": F.col("is_wellbeing_eligible").cast("int")},
        {"employee_snapshots_with_activity": (today > 0).cast("int"), "total_activities_on_date": today},
    ).withColumnRenamed("runs", "employees")


def timeline_volumes(counts: DataFrame) -> DataFrame:
    """The gold part of the monitoring volumes, from ``daily_counts``."""
    return counts.select(
        "snapshot_date", "employee_snapshots_with_activity", "total_activities_on_date",
        F.col("wellbeing_eligible_employees").alias("wellbeing_eligible_employee_count"))


def eligibility_trend(counts: DataFrame) -> DataFrame:
    """Eligible employees per snapshot date, from ``daily_counts``."""
    return counts.select("snapshot_date", "bonus_eligible_employees", "wellbeing_eligible_employees")


def activity_trend(employees: DataFrame, activities: DataFrame, validity: DataFrame, by: str | None = None, **filters) -> DataFrame:
    """Activities per snapshot date and value of ``by``, zeros included. ``filters`` are those of ``bi_filter``.

    Only days with activity are joined to employees; a group without any on some date gets its zero from the
    calendar. No trailing metric is needed, so no run is built.
    """
    daily = stage_daily(activities)
    dates = rule_per_date(distinct_dates(daily), validity, ["rule_version"]).select("snapshot_date")
    on_dates = {k: filters.pop(k) for k in ("date_from", "date_to") if k in filters}
    dates, chosen = bi_filter(dates, **on_dates), bi_filter(employees, **filters)
    keys = [by] if by else []
    people = chosen.select("employee_id", *keys)
    active = daily.join(F.broadcast(dates), F.col("activity_date") == F.col("snapshot_date")).join(people, "employee_id")
    groups = people.select(*keys).distinct() if by else people.limit(1).select()
    days = dates.agg(F.sort_array(F.collect_list("snapshot_date"))).scalar()  # one entry per calendar day at most
    zeros = groups.select(F.explode(days).alias("snapshot_date"), *keys, F.lit(0).cast("long").alias("activity_count"))
    summed = active.groupBy("snapshot_date", *keys).agg(F.sum("activity_count").alias("activity_count"))
    return zeros.unionByName(summed).groupBy("snapshot_date", *keys).agg(F.sum("activity_count").alias("activity_count"))
