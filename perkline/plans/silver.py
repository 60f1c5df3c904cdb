"""Silver: deduplicated, typed and enriched tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkline.defaults import CYCLE_MODES, OFFICE, WALK_MODES, WINDOW_DAYS
from perkline.functions import (
    activity_message, excel_serial_to_date, full_name, geocode, haversine_km, is_valid_activity,
    normalize_mode_lookup, normalize_text_mode, nullif_trim, reference_year, strict_cast,
)
from perkline.functions.dates import as_date
from perkline.functions.geo import office_coordinates
from perkline.operators.activity import daily_activity
from perkline.operators.joins import with_single_row
from perkline.operators.latest import latest_per_key
from perkline.plans.rules import rules_current


# --- enrichment steps, usable on any table ---------------------------------------------------

def normalize_modes(df: DataFrame, column: str = "declared_transport_mode", into: str = "transport_mode",
                    vocabulary: str = "fold") -> DataFrame:
    rule = {"fold": normalize_text_mode, "lookup": normalize_mode_lookup}[vocabulary]
    return df.withColumn(into, rule(F.col(column)))


def parse_serial_dates(df: DataFrame, columns: dict[str, str], strict: bool = True) -> DataFrame:
    """``columns`` maps raw column to DATE column."""
    return df.withColumns({into: excel_serial_to_date(F.col(raw), strict) for raw, into in columns.items()})


def geocode_addresses(df: DataFrame, address: str = "home_address", method: str = "md5",
                      office: tuple[Decimal, Decimal] = OFFICE) -> DataFrame:
    lat, lon = geocode(F.col(address), method, office)
    return df.withColumns({"home_lat": lat, "home_lon": lon})


def add_office(df: DataFrame, office: tuple[Decimal, Decimal] = OFFICE) -> DataFrame:
    lat, lon = office_coordinates(office)
    return df.withColumns({"office_lat": lat, "office_lon": lon})


def add_distance(df: DataFrame, form: str = "atan2") -> DataFrame:
    positions = [F.col(c) for c in ("home_lat", "home_lon", "office_lat", "office_lon")]
    return df.withColumn("distance_km_to_office", haversine_km(*positions, form=form))


# --- rule predicates shared by silver and gold -----------------------------------------------

def parsed_modes(modes_json: Column) -> Column:
    """The rule's JSON list of modes as an array, to be parsed where there is one row per rule."""
    return F.from_json(modes_json, "array<string>")


def mode_is_sportive(mode: Column, modes: Column) -> Column:
    """Membership in the rule's modes; NULL only without a rule."""
    return F.array_contains(modes, mode)


def distance_within_rule(mode: Column, distance: Column, walk_limit: Column, cycle_limit: Column,
                         walk_modes: Sequence[str] = WALK_MODES, cycle_modes: Sequence[str] = CYCLE_MODES) -> Column:
    """Distance against the limit of the mode's family; false for modes without a limit."""
    return (
        F.when(mode.isin(*walk_modes), distance <= walk_limit)
        .when(mode.isin(*cycle_modes), distance <= cycle_limit)
        .otherwise(F.lit(False))
    )


def cast_rejects(df: DataFrame, keys: Sequence[str], parsed: dict[str, tuple[Column, str]]) -> DataFrame:
    """What lenient casts turn into NULL: (keys, column_name, raw_value, reason), one row per lost value.

    ``parsed`` maps a raw column to its lenient value and the wanted type. One pass over ``df``.
    """
    lost = [
        F.when(F.nullif(F.col(raw), F.lit("")).isNotNull() & value.isNull(), F.struct(
            F.lit(raw).alias("column_name"), F.col(raw).alias("raw_value"), F.lit(f"not a {kind}").alias("reason")))
        for raw, (value, kind) in parsed.items()]
    return df.select(*keys, F.inline(F.filter(F.array(*lost), lambda x: x.isNotNull())))


def employee_rejects(bronze: DataFrame) -> DataFrame:
    """Values of the latest employee rows that ``sil_employees(strict=False)`` reads as NULL."""
    dates = {c: (excel_serial_to_date(F.col(c), False), "date") for c in ("birth_date_raw", "hire_date_raw")}
    return cast_rejects(latest_employees(bronze), ["employee_id"], dates | {
        "gross_salary_raw": (strict_cast(F.col("gross_salary_raw"), "decimal(12,2)", False), "decimal(12,2)"),
        "cp_days_raw": (strict_cast(F.col("cp_days_raw"), "int", False), "int")})


# --- models ----------------------------------------------------------------------------------

def latest_employees(bronze: DataFrame) -> DataFrame:
    return latest_per_key(bronze, ["employee_id"], ["ingested_at", "row_hash"], keep_null_keys=False)


def latest_declarations(bronze: DataFrame) -> DataFrame:
    return latest_per_key(bronze, ["employee_id"], ["ingested_at", "row_hash"])


def latest_activities(bronze: DataFrame) -> DataFrame:
    """Partition and payload only decide between copies with equal time and offset.

    The payload enters as a hash, so its text need not travel through the shuffle.
    """
    copies = bronze.withColumn("_copy", F.xxhash64("payload_json"))
    return latest_per_key(copies, ["activity_id"], ["event_ts", "offset_id", "partition_id", "_copy"]).drop("_copy")


def sil_employees(bronze: DataFrame, validity: DataFrame, office: tuple[Decimal, Decimal] = OFFICE,
                  strict: bool = True) -> DataFrame:
    """One typed, geocoded row per employee with the flags of the current rule."""
    latest = latest_employees(bronze)
    typed = latest.select(
        "employee_id", "last_name", "first_name",
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        excel_serial_to_date(F.col("birth_date_raw"), strict).alias("birth_date"),
        excel_serial_to_date(F.col("hire_date_raw"), strict).alias("hire_date"),
        "business_unit",
        strict_cast(F.col("gross_salary_raw"), "decimal(12,2)", strict).alias("gross_salary"),
        "contract_type",
        strict_cast(F.col("cp_days_raw"), "int", strict).alias("cp_days"),
        "home_address",
        normalize_text_mode(F.col("declared_transport_mode")).alias("transport_mode"),
    )
    located = typed.transform(geocode_addresses, office=office).transform(add_office, office).transform(add_distance)
    current = rules_current(validity).select(
        "max_km_walk_run", "max_km_cycle_scooter_other", parsed_modes(F.col("sportive_transport_modes")).alias("modes"))
    ruled = with_single_row(located, current, "_rule")
    mode, rule = F.col("transport_mode"), F.col("_rule")
    sportive = F.coalesce(mode_is_sportive(mode, rule["modes"]), F.lit(False))
    within = distance_within_rule(
        mode, F.col("distance_km_to_office"), rule["max_km_walk_run"], rule["max_km_cycle_scooter_other"])
    return ruled.select(
        *located.columns, sportive.alias("is_transport_mode_sportive"), within.alias("is_distance_rule_valid"))


def sil_sport_declarations(bronze: DataFrame) -> DataFrame:
    return latest_declarations(bronze).select(
        "employee_id", nullif_trim(F.col("declared_sport")).alias("declared_sport"))


def sil_sport_activities(bronze: DataFrame) -> DataFrame:
    """One row per activity with its validity and notification text."""
    measures = [F.col(c) for c in ("employee_id", "activity_date", "distance_km", "duration_min")]
    kind = F.lower("activity_type")
    return latest_activities(bronze).select(
        "activity_id", "employee_id", kind.alias("activity_type"), "process_date", "activity_date",
        "distance_km", "duration_min", "calories_burned", "source_system", "event_ts",
        is_valid_activity(*measures).alias("is_valid_activity"),
        activity_message(kind, *measures).alias("slack_message_text"),
    )


def sil_employee_activity_yearly(activities: DataFrame, as_of: str | date, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Activity since ``as_of - window_days``, per employee with any valid activity.

    There is no upper bound, and the last activity date looks at all history. Rolled up from one
    row per employee and day, which makes the distinct-day count a plain count.
    """
    recent = F.col("activity_date") >= F.date_sub(as_date(as_of), window_days)
    daily = daily_activity(activities.filter("is_valid_activity").withColumn("activity_id", F.lit(1)))
    return daily.groupBy("employee_id").agg(
        F.coalesce(F.sum(F.when(recent, F.col("activity_count"))), F.lit(0)).alias("activity_count_12m"),
        F.count_if(recent).alias("sport_days_count"),
        F.max("activity_date").alias("last_activity_date"),
        F.max(F.when(recent, F.col("process_date"))).alias("last_process_date"),
    ).select("employee_id", reference_year(as_of).alias("activity_year"), "activity_count_12m",
             "sport_days_count", "last_activity_date", "last_process_date")


def sil_employee_activity_joined(employees: DataFrame, declarations: DataFrame, yearly: DataFrame) -> DataFrame:
    """Employee, declared sport and yearly metrics; all sides have one row per employee."""
    counts = F.coalesce("activity_count_12m", F.lit(0)), F.coalesce("sport_days_count", F.lit(0))
    return (
        employees.join(declarations, "employee_id", "left")
        .join(yearly, "employee_id", "left")
        .select(
            "employee_id", "full_name", "business_unit", "contract_type", "gross_salary", "transport_mode",
            "distance_km_to_office", "is_transport_mode_sportive", "is_distance_rule_valid", "declared_sport",
            counts[0].alias("activity_count_12m"), counts[1].alias("sport_days_count"),
            "last_activity_date", "last_process_date",
        )
    )
