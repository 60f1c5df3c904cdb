"""Small hand-written tables."""


THREE_RULES = """
    select * from values
      ('r1', date'2023-01-01', 'Site', 0.05, 5, 1, 15, 25, '["velo","marche/running"]', '{}', timestamp'2023-01-01 00:00:00'),
      ('r2', date'2024-01-10', 'Site', 0.06, 6, 4, 10, 20, '["velo","vélo","marche/running"]', '{}', timestamp'2024-01-09 00:00:00'),
      ('r3', date'2024-06-01', 'Site', 0.09, 7, 9, 1, 1, '["x"]', '{}', timestamp'2024-01-09 00:00:00')
    as t(rule_version, effective_from, office_address, bonus_rate, wellbeing_days, min_activities_per_year,
         max_km_walk_run, max_km_cycle_scooter_other, sportive_transport_modes, rules_payload, loaded_at)
"""


def three_rules(spark):
    df = spark.sql(THREE_RULES)
    return df.selectExpr(
        "rule_version", "effective_from", "office_address", "cast(bonus_rate as decimal(8,4)) bonus_rate",
        "wellbeing_days", "min_activities_per_year", "cast(max_km_walk_run as decimal(10,2)) max_km_walk_run",
        "cast(max_km_cycle_scooter_other as decimal(10,2)) max_km_cycle_scooter_other",
        "sportive_transport_modes", "rules_payload", "loaded_at")


def employees_raw(spark, records):
    """Records override the defaults of one employee landing row."""
    base = {
        "ingestion_id": "i1", "ingested_at": "2024-01-05 00:00:00", "process_date": "2024-01-05", "source_file": "f",
        "employee_id": "1", "last_name": "Doe", "first_name": "Jo", "birth_date_raw": "30000", "business_unit": "BU",
        "hire_date_raw": "44000", "gross_salary_raw": "30000", "contract_type": "CDI", "cp_days_raw": "25",
        "home_address": "1 Rue A, 34970 Lattes", "declared_transport_mode": "Vélo", "row_hash": "a",
    }
    names = list(base)
    data = [tuple({**base, **r}[n] for n in names) for r in records]
    text = spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))
    return text.selectExpr(*[
        f"cast({n} as timestamp) {n}" if n == "ingested_at" else f"cast({n} as date) {n}" if n == "process_date" else n
        for n in names])


def silver_activities(spark, records):
    """(activity_id, employee_id, activity_date, distance, duration, process_date, valid) rows."""
    df = spark.createDataFrame(records, "activity_id string, employee_id string, activity_date string, "
                                        "distance_km string, duration_min int, process_date string, is_valid_activity boolean")
    return df.selectExpr("activity_id", "employee_id", "cast(activity_date as date) activity_date",
                         "cast(distance_km as decimal(10,2)) distance_km", "duration_min",
                         "cast(process_date as date) process_date", "is_valid_activity")


def silver_employees(spark, records):
    """(employee_id, salary, mode, distance) rows."""
    df = spark.createDataFrame(records, "employee_id string, salary string, transport_mode string, km string")
    return df.selectExpr(
        "employee_id", "concat('N', employee_id) full_name", "'BU' business_unit", "'CDI' contract_type",
        "cast(salary as decimal(12,2)) gross_salary", "transport_mode", "cast(km as decimal(10,2)) distance_km_to_office")


def messages(spark, records):
    """(value, offset) messages of one partition."""
    df = spark.createDataFrame(records, "value string, offset bigint")
    return df.selectExpr("'k' key", "value", "'sport_activities' topic", "0 partition", "offset",
                         "timestamp'2024-01-01 00:00:00' timestamp")

