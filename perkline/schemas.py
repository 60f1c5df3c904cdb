"""Explicit schemas (DDL strings) of the event message and the rule document."""

from __future__ import annotations

EVENT_MESSAGE = """
    activity_id string, employee_id string, activity_type string, activity_date date,
    distance_km decimal(10,2), duration_min int, calories_burned int, source_system string,
    event_ts timestamp, process_date date
"""

RULE_DOCUMENT = """
    rule_version string, effective_from date, office_address string, bonus_rate decimal(8,4),
    wellbeing_days int, min_activities_per_year int, max_km_walk_run decimal(10,2),
    max_km_cycle_scooter_other decimal(10,2), sportive_transport_modes array<string>
"""
