"""Expressions over activity rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkline.functions.text import render


def is_valid_activity(employee_id: Column, activity_date: Column, distance_km: Column, duration_min: Column) -> Column:
    """Never NULL: known employee and date, non-negative distance, positive duration."""
    known = employee_id.isNotNull() & activity_date.isNotNull()
    measured = F.coalesce(distance_km >= 0, F.lit(False)) & F.coalesce(duration_min > 0, F.lit(False))
    return known & measured


def activity_message(
    activity_type: Column, employee_id: Column, activity_date: Column, distance_km: Column, duration_min: Column
) -> Column:
    """Notification text of one activity. The wording is a fixed value."""
    return render([
        ":runner: Activite ", activity_type, " enregistree pour le salarie ", employee_id,
        " le ", activity_date, " (", distance_km, " km, ", duration_min, " min).",
    ])
