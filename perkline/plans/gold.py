"""Gold: eligibility decisions, status, KPIs and the anomaly feed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkline.defaults import ANOMALY_CYCLE_MODES, WALK_MODES
from perkline.functions import city_from_address, reference_year, stable_id
from perkline.functions.dates import as_timestamp
from perkline.operators.joins import with_single_row
from perkline.plans.rules import rules_active_at


def with_active_rule(df: DataFrame, validity: DataFrame, as_of: str | date) -> DataFrame:
    """Rows combined with the one rule in force, as struct ``_rule``; no rule, no rows."""
    return with_single_row(df, _decisive(validity, as_of), "_rule").filter(F.col("_rule").isNotNull())


def _decisive(validity: DataFrame, as_of: str | date) -> DataFrame:
    """What decisions need of the rule in force; its documents stay behind."""
    return rules_active_at(validity, as_of).select(
        "rule_version", "bonus_rate", "wellbeing_days", "min_activities_per_year", "max_km_walk_run",
        "max_km_cycle_scooter_other")


def potential_bonus(salary: Column, rate: Column) -> Column:
    return F.round(salary * rate, 2)


def bonus_reason(sportive: Column, within: Column) -> Column:
    """Unknown (NULL) conditions do not count as failures, as in the decision order of the rules."""
    return (
        F.when(~sportive, "transport_non_sportif")
        .when(~within, "distance_hors_regle")
        .otherwise("eligible")
    )


def wellbeing_reason(enough: Column) -> Column:
    return F.when(enough, "eligible").otherwise("insufficient_activities")


def _bonus_columns(rule: Column) -> dict[str, Column]:
    sportive, within = F.col("is_transport_mode_sportive"), F.col("is_distance_rule_valid")
    granted = F.coalesce(sportive & within, F.lit(False))
    potential = potential_bonus(F.col("gross_salary"), rule["bonus_rate"])
    return {
        "potential": potential,
        "granted": granted,
        "amount": F.when(granted, potential).otherwise(F.lit(0).cast("decimal(18,2)")),
        "reason": bonus_reason(sportive, within),
    }


def _wellbeing_columns(rule: Column) -> dict[str, Column]:
    enough = F.coalesce(F.col("activity_count_12m") >= rule["min_activities_per_year"], F.lit(False))
    return {
        "granted": enough,
        "days": F.when(enough, rule["wellbeing_days"]).otherwise(0),
        "reason": wellbeing_reason(enough),
    }


def gold_eligible_sport_bonus(joined: DataFrame, validity: DataFrame, as_of: str | date) -> DataFrame:
    base = with_active_rule(joined, validity, as_of)
    rule = F.col("_rule")
    bonus = _bonus_columns(rule)
    return base.select(
        "employee_id",
        reference_year(as_of).alias("reference_year"),
        "full_name", "business_unit", "gross_salary",
        rule["bonus_rate"].alias("bonus_rate"),
        bonus["potential"].alias("potential_bonus_amount"),
        "transport_mode", "distance_km_to_office",
        bonus["granted"].alias("eligibility_status"),
        bonus["amount"].alias("bonus_amount"),
        bonus["reason"].alias("eligibility_reason"),
        rule["rule_version"].alias("rule_version"),
    )


def gold_eligible_wellbeing_days(joined: DataFrame, validity: DataFrame, as_of: str | date) -> DataFrame:
    base = with_active_rule(joined, validity, as_of)
    rule = F.col("_rule")
    wellbeing = _wellbeing_columns(rule)
    return base.select(
        "employee_id",
        reference_year(as_of).alias("reference_year"),
        "full_name", "business_unit", "activity_count_12m",
        wellbeing["days"].alias("wellbeing_days_awarded"),
        wellbeing["granted"].alias("eligibility_status"),
        wellbeing["reason"].alias("eligibility_reason"),
        rule["rule_version"].alias("rule_version"),
    )


STATUS_COLUMNS = (
    "employee_id", "full_name", "business_unit", "contract_type", "is_bonus_eligible", "bonus_amount",
    "potential_bonus_amount", "bonus_reason", "is_wellbeing_eligible", "wellbeing_days_awarded",
    "wellbeing_reason", "activity_count_12m", "last_activity_date", "last_process_date",
    "transport_mode", "distance_km_to_office",
)


def gold_kpi_employee_status(joined: DataFrame, bonus: DataFrame, wellbeing: DataFrame) -> DataFrame:
    """One status row per employee from the stored decision tables."""
    bonus = bonus.select(
        "employee_id", F.col("eligibility_status").alias("is_bonus_eligible"), "bonus_amount",
        "potential_bonus_amount", F.col("eligibility_reason").alias("bonus_reason"))
    wellbeing = wellbeing.select(
        "employee_id", F.col("eligibility_status").alias("is_wellbeing_eligible"),
        "wellbeing_days_awarded", F.col("eligibility_reason").alias("wellbeing_reason"))
    return joined.join(bonus, "employee_id", "left").join(wellbeing, "employee_id", "left").select(*STATUS_COLUMNS)


def employee_status(joined: DataFrame, validity: DataFrame, as_of: str | date) -> DataFrame:
    """The same status rows in one pass over ``joined``: both decisions are columns, so no join is needed.

    Without a rule in force the decision columns are NULL.
    """
    base = with_single_row(joined, _decisive(validity, as_of), "_rule")
    rule = F.col("_rule")
    bonus, wellbeing = _bonus_columns(rule), _wellbeing_columns(rule)
    decisions = {
        "is_bonus_eligible": bonus["granted"],
        "bonus_amount": bonus["amount"],
        "potential_bonus_amount": bonus["potential"],
        "bonus_reason": bonus["reason"],
        "is_wellbeing_eligible": wellbeing["granted"],
        "wellbeing_days_awarded": wellbeing["days"],
        "wellbeing_reason": wellbeing["reason"],
    }
    ruled = {name: F.when(rule.isNotNull(), value) for name, value in decisions.items()}
    return base.select(*[ruled[c].alias(c) if c in ruled else F.col(c) for c in STATUS_COLUMNS])


def gold_employee_map(employees: DataFrame, status: DataFrame) -> DataFrame:
    flags = status.select("employee_id", "is_bonus_eligible", "is_wellbeing_eligible")
    return employees.join(flags, "employee_id", "left").select(
        "employee_id", "full_name", "business_unit", "contract_type",
        city_from_address(F.col("home_address")).alias("home_city"),
        "home_lat", "home_lon", "distance_km_to_office", "is_bonus_eligible", "is_wellbeing_eligible",
    )


def gold_slack_messages(bronze: DataFrame) -> DataFrame:
    return bronze.drop("process_date")


def decision_totals(status: DataFrame) -> DataFrame:
    """Counts and costs of both decisions in one row and one pass over the status rows."""
    granted = F.when(F.col("is_bonus_eligible"), F.col("bonus_amount"))
    cost = F.coalesce(F.sum(granted).cast("decimal(28,2)"), F.lit(0).cast("decimal(28,2)"))
    # avg() keeps six decimals only, too few to round to cents without double rounding
    average = F.try_divide(cost, F.count(granted).cast("decimal(19,0)"))
    return status.agg(
        F.count_if("is_bonus_eligible").alias("eligible_bonus_employees"),
        F.count_if("is_wellbeing_eligible").alias("eligible_wellbeing_employees"),
        cost.alias("total_bonus_cost"),
        F.round(F.coalesce(average, F.lit(0)), 2).alias("avg_bonus_amount"),
    )


def gold_kpi_finance(status: DataFrame, activities: DataFrame, as_of: str | date) -> DataFrame:
    """Executive KPIs in exactly one row: one pass over the status rows and one over the activities."""
    valid = activities.agg(F.count_if("is_valid_activity").alias("n"))
    return decision_totals(status).select(
        reference_year(as_of).alias("reference_year"),
        "eligible_bonus_employees",
        "eligible_wellbeing_employees",
        "total_bonus_cost",
        "avg_bonus_amount",
        valid.scalar().alias("activity_count_total"),
    )


def _anomaly(key: str, suffix: str, kind: str, detail: str) -> Column:
    return F.struct(
        stable_id(F.col(key), suffix).alias("anomaly_id"), F.col(key).alias("record_id"),
        F.lit(kind).alias("anomaly_type"), F.lit(detail).alias("anomaly_detail"))


def _findings(df: DataFrame, table: str, detected_at: str, found: Sequence[tuple[Column, Column]]) -> DataFrame:
    """One row for each condition that holds, in one pass."""
    chosen = F.filter(F.array(*[F.when(holds, finding) for holds, finding in found]), lambda x: x.isNotNull())
    rows = df.select(F.inline(chosen))
    return rows.select(
        "anomaly_id", as_timestamp(detected_at).alias("detected_at"), F.lit(table).alias("table_name"), "record_id",
        "anomaly_type", "anomaly_detail")


def gold_quality_anomalies(
    employees: DataFrame, activities: DataFrame, validity: DataFrame, as_of: str | date, detected_at: str,
    walk_modes: Sequence[str] = WALK_MODES, cycle_modes: Sequence[str] = ANOMALY_CYCLE_MODES,
) -> DataFrame:
    """Distance, salary and invalid-activity findings in one feed. The labels are fixed values."""
    ruled = with_single_row(employees, _decisive(validity, as_of), "_rule")
    distance, mode, rule = F.col("distance_km_to_office"), F.col("transport_mode"), F.col("_rule")
    off_limits = rule.isNotNull() & (
        (distance < 0)
        | (mode.isin(*walk_modes) & (distance > rule["max_km_walk_run"]))
        | (mode.isin(*cycle_modes) & (distance > rule["max_km_cycle_scooter_other"]))
    )
    return _findings(ruled, "sil_employees", detected_at, [
        (off_limits, _anomaly("employee_id", "distance", "distance_rule_issue",
                              "Distance negative ou hors seuil reglementaire")),
        (F.col("gross_salary") <= 0, _anomaly("employee_id", "salary", "salary_issue", "Salaire brut non positif")),
    ]).unionByName(_findings(activities, "sil_sport_activities", detected_at, [
        (~F.col("is_valid_activity"), _anomaly("activity_id", "activity", "invalid_activity",
                                               "Activite invalide detectee dans le flux"))]))
