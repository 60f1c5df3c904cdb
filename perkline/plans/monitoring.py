"""Monitoring models and the dashboard queries on top of them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkline.functions.dates import as_timestamp, duration_seconds

# Task states counted per run.
TASK_STATES = ("success", "failed", "running", "queued")


def raw_volumes(bronze_activities: DataFrame) -> DataFrame:
    return bronze_activities.groupBy("process_date").agg(F.count("*").alias("raw_event_count"))


def silver_volumes(activities: DataFrame) -> DataFrame:
    """Per-day counts. Active employees are reduced per (day, employee) first, so a day holding most
    of the rows is spread over its employees before it is counted."""
    per_employee = activities.groupBy("process_date", "employee_id").agg(
        F.count("*").alias("rows"), F.count_if("is_valid_activity").alias("valid"))
    active = F.col("employee_id").isNotNull() & (F.col("valid") > 0)
    return per_employee.groupBy("process_date").agg(
        F.sum("rows").alias("silver_activity_count"),
        F.sum("valid").alias("valid_activity_count"),
        F.sum(F.col("rows") - F.col("valid")).alias("invalid_activity_count"),
        F.count_if(active).alias("active_employee_count"),
    )


def timeline_volumes(timeline: DataFrame) -> DataFrame:
    return timeline.groupBy("snapshot_date").agg(
        F.count_if(F.col("activity_count_on_date") > 0).alias("employee_snapshots_with_activity"),
        F.sum("activity_count_on_date").alias("total_activities_on_date"),
        F.count_if("is_wellbeing_eligible").alias("wellbeing_eligible_employee_count"),
    )


def monitoring_activity_volumes_daily(raw: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Full outer chain of the three daily roll-ups; missing counts are zero.

    ``gold`` may hold the snapshot dates alone, if its counts are not asked for.
    """
    raw = raw.withColumnRenamed("process_date", "metric_date")
    silver = silver.withColumnRenamed("process_date", "metric_date")
    gold = gold.withColumnRenamed("snapshot_date", "metric_date")
    merged = raw.join(silver, "metric_date", "full").join(gold, "metric_date", "full")
    measures = [c for c in merged.columns if c != "metric_date"]
    return merged.select("metric_date", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in measures])


def task_state_counts(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("dag_id", "run_id").agg(
        F.count("*").alias("task_count"),
        *[F.count_if(F.col("state") == s).alias(f"task_{s}_count") for s in TASK_STATES],
    )


def monitoring_runs(runs: DataFrame, tasks: DataFrame, as_of_ts: str) -> DataFrame:
    """Run log with duration and task counts by state; runs without tasks count zero."""
    counts = task_state_counts(tasks)
    measures = [c for c in counts.columns if c not in ("dag_id", "run_id")]
    return runs.join(counts, ["dag_id", "run_id"], "left").select(
        "dag_id", "run_id", "run_type", F.col("state").alias("dag_state"), "external_trigger",
        "execution_date", "data_interval_start", "data_interval_end", "queued_at", "start_date", "end_date",
        duration_seconds(F.col("start_date"), F.col("end_date"), as_of_ts).alias("duration_seconds"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in measures],
    )


def monitoring_table_row_counts(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Row counts of (layer, table) pairs: one global count per table."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(layer).alias("layer_name"), F.lit(table).alias("table_name"), "row_count")
        for (layer, table), df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


# --- dashboard queries -----------------------------------------------------------------------

def _moment() -> Column:
    return F.coalesce("start_date", "execution_date")


def dash_failed_runs_7d(runs: DataFrame, as_of_ts: str, days: int = 7) -> DataFrame:
    """Failed runs of the trailing days. Reads the run log only: task counts play no part."""
    since = as_timestamp(as_of_ts) - F.make_dt_interval(F.lit(days))
    return runs.filter((F.col("state") == "failed") & (_moment() >= since)).agg(
        F.count("*").alias("failed_runs_last_7d"))


def dash_latest_day_volume(volumes: DataFrame) -> DataFrame:
    """Raw, valid and invalid counts of the latest metric day, zero when there is none: one pass."""
    names = {
        "raw_event_count": "raw_events_last_day",
        "valid_activity_count": "valid_activities_last_day",
        "invalid_activity_count": "invalid_activities_last_day",
    }
    per_day = volumes.groupBy("metric_date").agg(*[F.sum(c).alias(c) for c in names])
    return per_day.agg(*[F.coalesce(F.max_by(c, "metric_date"), F.lit(0)).alias(name) for c, name in names.items()])


def _series(volumes: DataFrame, metrics: Mapping[str, str]) -> DataFrame:
    """Long form (time, value, metric): one pass that unpivots the chosen columns."""
    chosen = volumes.select(F.col("metric_date").alias("time"), *[F.col(c).alias(m) for c, m in metrics.items()])
    return (
        chosen.unpivot(["time"], list(metrics.values()), "metric", "value")
        .select("time", "value", "metric").orderBy("time", "metric")
    )


def dash_flow_series(volumes: DataFrame) -> DataFrame:
    return _series(volumes, {"raw_event_count": "raw_events", "valid_activity_count": "valid_activities"})


def dash_active_series(volumes: DataFrame) -> DataFrame:
    return _series(volumes, {
        "active_employee_count": "active_employees", "wellbeing_eligible_employee_count": "wellbeing_eligible"})


def recent_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    """The latest rows of the run log; run keys settle equal times."""
    return runs.orderBy(_moment().desc_nulls_first(), "dag_id", "run_id").limit(limit)


def dash_recent_runs(runs: DataFrame, tasks: DataFrame, as_of_ts: str, limit: int = 20) -> DataFrame:
    """Most recent runs with their task counts.

    The runs are cut first, and only their tasks are counted.
    """
    chosen = recent_runs(runs, limit)
    own_tasks = tasks.join(chosen.select("dag_id", "run_id"), ["dag_id", "run_id"], "left_semi")
    log = monitoring_runs(chosen, own_tasks, as_of_ts)
    return (
        log.orderBy(_moment().desc_nulls_first(), "dag_id", "run_id")
        .select("dag_id", "run_id", "dag_state", "start_date", "end_date",
                F.round(F.coalesce("duration_seconds", F.lit(0))).alias("duration_seconds"),
                "task_count", "task_failed_count")
    )


def dash_row_counts(counts: DataFrame) -> DataFrame:
    return counts.select("layer_name", "table_name", "row_count").orderBy("layer_name", "table_name")
