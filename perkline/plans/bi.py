"""BI roll-ups over the status table and the timeline."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkline.functions.dates import as_date


def bi_filter(
    df: DataFrame,
    business_unit: Sequence[str] | None = None,
    contract_type: Sequence[str] | None = None,
    transport_mode: Sequence[str] | None = None,
    date_from: str | date | None = None,
    date_to: str | date | None = None,
    date_column: str = "snapshot_date",
) -> DataFrame:
    """Dashboard filters; unset ones do nothing."""
    for name, values in (("business_unit", business_unit), ("contract_type", contract_type),
                         ("transport_mode", transport_mode)):
        if values is not None:
            df = df.filter(F.col(name).isin(*values))
    if date_from is not None:
        df = df.filter(F.col(date_column) >= as_date(date_from))
    if date_to is not None:
        df = df.filter(F.col(date_column) <= as_date(date_to))
    return df


def _bonus_total() -> Column:
    return F.coalesce(F.sum("bonus_amount").cast("decimal(28,2)"), F.lit(0).cast("decimal(28,2)"))


def bi_program_kpis(status: DataFrame) -> DataFrame:
    return status.agg(
        F.count_if("is_bonus_eligible").alias("eligible_bonus_employees"),
        F.count_if("is_wellbeing_eligible").alias("eligible_wellbeing_employees"),
        _bonus_total().alias("total_bonus_cost"),
        F.coalesce(F.sum("wellbeing_days_awarded"), F.lit(0)).alias("total_wellbeing_days"),
    )


def bi_distribution(status: DataFrame, by: str) -> DataFrame:
    return status.groupBy(by).agg(
        F.count("employee_id").alias("employees"),
        F.count_if("is_bonus_eligible").alias("eligible_bonus_employees"),
        F.count_if("is_wellbeing_eligible").alias("eligible_wellbeing_employees"),
        _bonus_total().alias("total_bonus"),
    )


def bi_eligibility_trend(timeline: DataFrame) -> DataFrame:
    """Distinct eligible employees per snapshot date.

    The timeline has one row per employee and date, so counting rows counts employees: no distinct
    aggregation over the whole grid.
    """
    return timeline.groupBy("snapshot_date").agg(
        F.count_if("is_bonus_eligible").alias("bonus_eligible_employees"),
        F.count_if("is_wellbeing_eligible").alias("wellbeing_eligible_employees"),
    )


def bi_activity_trend(timeline: DataFrame, by: str | None = None) -> DataFrame:
    keys = ["snapshot_date", *([by] if by else [])]
    return timeline.groupBy(*keys).agg(F.sum("activity_count_on_date").alias("activity_count"))
