"""Bronze: column selection, trimming and typing of the landing tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkline import schemas

EMPLOYEE_TEXT = ("last_name", "first_name", "business_unit", "contract_type", "home_address", "declared_transport_mode")


def trim_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Trim spaces of the named text columns, keeping the column order."""
    return df.withColumns({c: F.trim(c) for c in columns})


def brz_rh_employees(raw: DataFrame) -> DataFrame:
    return trim_columns(raw, EMPLOYEE_TEXT).select(
        "ingestion_id", "ingested_at", "process_date", "source_file", "employee_id", "last_name",
        "first_name", "birth_date_raw", "business_unit", "hire_date_raw", "gross_salary_raw",
        "contract_type", "cp_days_raw", "home_address", "declared_transport_mode", "row_hash",
    )


def brz_sport_declarations(raw: DataFrame) -> DataFrame:
    return trim_columns(raw, ["declared_sport"]).select(
        "ingestion_id", "ingested_at", "process_date", "source_file", "employee_id", "declared_sport", "row_hash",
    )


def brz_sport_activities(raw: DataFrame) -> DataFrame:
    """Typed event columns next to the payload they come from: the JSON is parsed once per row."""
    message = F.from_json(
        "payload_json",
        "employee_id string, activity_type string, activity_date string, distance_km string, "
        "duration_min string, calories_burned string, source_system string, process_date string",
    )
    # fields are read as text and cast afterwards, so a value of the wrong type raises
    return raw.withColumn("_message", message).select(
        F.col("event_id").alias("activity_id"),
        "process_date", "topic", "partition_id", "offset_id", "event_ts", "consumed_at", "payload_json",
        "_message.employee_id",
        "_message.activity_type",
        F.col("_message.activity_date").cast("date").alias("activity_date"),
        F.col("_message.distance_km").cast("decimal(10,2)").alias("distance_km"),
        F.col("_message.duration_min").cast("int").alias("duration_min"),
        F.col("_message.calories_burned").cast("int").alias("calories_burned"),
        "_message.source_system",
        F.col("_message.process_date").alias("payload_process_date"),
    )


def brz_slack_messages(raw: DataFrame) -> DataFrame:
    return raw.select(
        "message_id", "process_date", "activity_id", "employee_id", "channel_name", "message_text", "generated_at",
        "status")
