"""Daily snapshot timeline: employee x activity date with trailing activity and the rule in force.

The output has one row per employee and date, so everything that can be decided on something smaller is:
metrics per run of dates on which they do not change, rule decisions per run and rule, and only the
date itself (and what happened on it) per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perkline.defaults import WINDOW_DAYS
from perkline.operators.activity import daily_activity, known_activity, known_intervals, trailing_intervals
from perkline.operators.calendar import distinct_dates, materialize_calendar, number_dates, rule_per_date
from perkline.plans.gold import bonus_reason, potential_bonus, wellbeing_reason
from perkline.plans.silver import distance_within_rule
from perkline.session import stage_table

RULE_FIELDS = (
    "rule_version", "bonus_rate", "min_activities_per_year", "wellbeing_days",
    "max_km_walk_run", "max_km_cycle_scooter_other", "modes",
)
ROWS_PER_TASK = 500_000
DATES_PER_TASK = 4
EMPLOYEE_FIELDS = (
    "employee_id", "full_name", "business_unit", "contract_type", "gross_salary", "transport_mode",
    "distance_km_to_office",
)
COLUMNS = (
    "employee_id", "full_name", "business_unit", "contract_type", "snapshot_date", "transport_mode", "distance_km_to_office",
    "activity_count_on_date", "distance_km_on_date", "duration_min_on_date", "activity_count_12m", "sport_days_count_12m",
    "last_activity_date", "last_process_date", "is_bonus_eligible", "potential_bonus_amount", "bonus_amount", "bonus_reason",
    "is_wellbeing_eligible", "wellbeing_days_awarded", "wellbeing_reason", "rule_version",
)
ON_DATE = {"activity_count": "activity_count_on_date", "distance_km": "distance_km_on_date", "duration_min": "duration_min_on_date"}
TRAILING_COUNTS = ("activity_count_12m", "sport_days_count_12m")
TRAILING_DATES = ("last_activity_date", "last_process_date")


def stage_daily(activities: DataFrame) -> DataFrame:
    """Valid activity per employee and day, computed once and stored: dates and metrics both read it."""
    return stage_table(daily_activity(activities.filter("is_valid_activity")), "daily_activity")


def employee_runs(employees: DataFrame, daily: DataFrame, calendar: DataFrame, window_days: int,
                  intervals: Callable[..., DataFrame] = trailing_intervals) -> DataFrame:
    """Every employee's dates as runs ``begins..ends`` of calendar positions with constant trailing metrics.

    Dates before the first activity, or all dates of an idle employee, form a run of zeros. What
    happened on the first date of a run (``on_pos``) rides along.
    """
    last_pos = calendar.count()
    runs = intervals(daily, calendar, window_days, last_pos)

    def piece(begins, ends, active: bool):
        return F.struct(begins.alias("begins"), ends.alias("ends"), F.lit(active).alias("active"))

    pos, none = F.col("pos"), F.lit(1)
    own = piece(pos, F.col("next_pos") - 1, True)
    pieces = (
        F.when(pos.isNull(), F.array(piece(none, F.lit(last_pos), False)))
        .when(F.col("is_first") & (pos > 1), F.array(piece(none, pos - 1, False), own))
        .otherwise(F.array(own))
    )
    spread = (
        employees.join(runs, "employee_id", "left").filter(F.lit(last_pos > 0))
        .withColumn("piece", F.explode(pieces))
    )
    active = F.col("piece.active")
    return spread.select(
        *employees.columns, "piece.begins", "piece.ends",
        F.when(active & (F.col("entering") == 1), pos).alias("on_pos"),
        *ON_DATE,
        *[F.when(active, F.col(c)).otherwise(0).alias(c) for c in TRAILING_COUNTS],
        *[F.when(active, F.col(c)).alias(c) for c in TRAILING_DATES],
    )


def unroll(runs: DataFrame, calendar: DataFrame) -> DataFrame:
    """Runs as one row per date, inside the task: no shuffle, only a lookup of the date by position."""
    days = calendar.select("date_pos", "snapshot_date")
    rows = runs.withColumn("date_pos", F.explode(F.sequence("begins", "ends"))).join(F.broadcast(days), "date_pos")
    today = F.col("date_pos") == F.col("on_pos")
    return rows.withColumns({
        name: F.coalesce(F.when(today, F.col(measure)), F.lit(0)) for measure, name in ON_DATE.items()
    }).drop("date_pos", "begins", "ends", "on_pos", *ON_DATE)


def spread_runs(runs: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Stored runs, dealt to as many tasks as their dates need: about ``rows_per_task`` output rows each.

    Partitions are sized by what the unrolling makes of them, and not by their bytes before it.
    """
    rows = runs.agg(F.sum(F.col("ends") - F.col("begins") + 1)).first()[0] or 0
    return runs.repartition(max(1, -(-int(rows) // rows_per_task)), "employee_id", "begins")


def spread_by_date(runs: DataFrame, rows_per_task: int = ROWS_PER_TASK, dates_per_task: int = DATES_PER_TASK) -> DataFrame:
    """Stored runs, cut at every ``dates_per_task`` dates and dealt to tasks by these blocks of dates.

    What is unrolled from them lies by date already: a writer partitioned by date has large files, and the rows, of
    which there are many more than runs, need no shuffle. Blocks of many rows are shared by several tasks.
    """
    length = F.col("ends") - F.col("begins") + 1
    size = runs.agg(F.sum(length).alias("rows"), F.min("begins").alias("low"), F.max("ends").alias("high")).first()
    rows = int(size["rows"] or 0)
    in_block = dates_per_task * -(-rows // max(1, (size["high"] or 0) - (size["low"] or 0) + 1))
    shards = max(1, -(-in_block // rows_per_task))

    def block(pos: str):
        return F.floor((F.col(pos) - 1) / dates_per_task).cast("int")

    cut = runs.withColumn("block", F.explode(F.sequence(block("begins"), block("ends")))).withColumns({
        "begins": F.greatest("begins", F.col("block") * dates_per_task + 1),
        "ends": F.least("ends", (F.col("block") + 1) * dates_per_task)})
    return cut.withColumn("shard", F.pmod(F.xxhash64("employee_id"), F.lit(shards))).repartition(
        max(1, -(-rows // rows_per_task)), "block", "shard").drop("block", "shard")


def activity_grid(employees: DataFrame, daily: DataFrame, dates: DataFrame, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Every employee on every distinct date of ``daily``, with on-date and trailing metrics."""
    calendar = materialize_calendar(number_dates(dates, window_days))
    return unroll(employee_runs(employees, daily, calendar, window_days), calendar)


def split_by_rule(runs: DataFrame, calendar: DataFrame) -> DataFrame:
    """Cut runs where the rule changes and attach the rule; stretches without a rule are dropped.

    Consecutive dates under one rule form a span. A run covers the spans between those of its first
    and last date, so spans are found by number and joined by equality.
    """
    spans = calendar.groupBy("span").agg(
        F.min("date_pos").alias("span_from"), F.max("date_pos").alias("span_to"),
        *[F.any_value(c).alias(c) for c in RULE_FIELDS])
    of_position = calendar.select("date_pos", "span")
    first = F.broadcast(of_position.toDF("begins", "first_span"))
    last = F.broadcast(of_position.toDF("ends", "last_span"))
    cut = (
        runs.join(first, "begins").join(last, "ends")
        .withColumn("span", F.explode(F.sequence("first_span", "last_span")))
        .join(F.broadcast(spans.filter("rule_version is not null")), "span")
    )
    return cut.withColumns({
        "begins": F.greatest("begins", "span_from"), "ends": F.least("ends", "span_to"),
    }).drop("first_span", "last_span", "span", "span_from", "span_to")


def timeline_dates(activities: DataFrame, validity: DataFrame) -> DataFrame:
    """The snapshot dates of the timeline, without its rows: days of valid activity with a rule in force."""
    days = distinct_dates(activities.filter("is_valid_activity"))
    return rule_per_date(days, validity, ["rule_version"]).select("snapshot_date")


def rule_calendar(dates: DataFrame, validity: DataFrame, window_days: int) -> DataFrame:
    """Numbered snapshot dates with the rule of each, and spans of dates under one rule; stored."""
    # mode lists are parsed here, per version; a date without any rule keeps its position
    parsed = validity.withColumn("modes", F.from_json("sportive_transport_modes", "array<string>"))
    ruled = rule_per_date(dates, parsed, RULE_FIELDS, keep_uncovered=True)
    by_day = Window.orderBy("snapshot_date")
    changed = ~F.col("rule_version").eqNullSafe(F.lag("rule_version").over(by_day))
    spans = ruled.withColumn("changed", changed.cast("int")).withColumn("span", F.sum("changed").over(by_day)).drop("changed")
    return materialize_calendar(number_dates(spans, window_days))


def decide_runs(runs: DataFrame, calendar: DataFrame) -> DataFrame:
    """Runs cut by rule, with the decisions that hold on all their dates."""
    mode = F.col("transport_mode")
    sportive = F.array_contains("modes", mode)
    within = distance_within_rule(
        mode, F.col("distance_km_to_office"), F.col("max_km_walk_run"), F.col("max_km_cycle_scooter_other"))
    decided = split_by_rule(runs, calendar).withColumns({
        "is_bonus_eligible": F.coalesce(sportive & within, F.lit(False)),
        "potential_bonus_amount": potential_bonus(F.col("gross_salary"), F.col("bonus_rate")),
        "bonus_reason": bonus_reason(sportive, within),
        "is_wellbeing_eligible": F.col("activity_count_12m") >= F.col("min_activities_per_year"),
    })
    bonus, wellbeing = F.col("is_bonus_eligible"), F.col("is_wellbeing_eligible")
    return decided.withColumns({
        "bonus_amount": F.when(bonus, F.col("potential_bonus_amount")).otherwise(F.lit(0).cast("decimal(18,2)")),
        "wellbeing_days_awarded": F.when(wellbeing, F.col("wellbeing_days")).otherwise(0),
        "wellbeing_reason": wellbeing_reason(wellbeing),
    })


def benefit_runs(
    employees: DataFrame, activities: DataFrame, validity: DataFrame, window_days: int = WINDOW_DAYS, known_at: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The timeline before it is unrolled: runs of dates with their decisions, and the calendar of their positions."""
    if known_at:
        daily = stage_table(known_activity(activities.filter("is_valid_activity")), "known_activity")
    else:
        daily = stage_daily(activities)
    calendar = rule_calendar(distinct_dates(daily), validity, window_days)
    runs = employee_runs(employees.select(*EMPLOYEE_FIELDS), daily, calendar, window_days,
                         known_intervals if known_at else trailing_intervals)
    return decide_runs(runs, calendar), calendar


def snapshot_rows(decided: DataFrame, calendar: DataFrame, spread: Callable[[DataFrame], DataFrame] = spread_runs) -> DataFrame:
    """Decided runs as the rows of the timeline, one per employee and date of ``calendar``."""
    rows = unroll(spread(stage_table(decided, "runs")), calendar)
    return rows.withColumn("distance_km_on_date", F.col("distance_km_on_date").cast("decimal(20,2)")).select(*COLUMNS)


def gold_employee_benefit_timeline(
    employees: DataFrame, activities: DataFrame, validity: DataFrame, window_days: int = WINDOW_DAYS, known_at: bool = False
) -> DataFrame:
    """Snapshot rows for every employee and every date on which anyone was validly active.

    With ``known_at`` a snapshot holds only what had been processed by its date, so activities that arrive late leave
    earlier snapshots as they were; by default they count on their day, whenever they came.
    """
    return snapshot_rows(*benefit_runs(employees, activities, validity, window_days, known_at))
