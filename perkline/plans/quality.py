"""Data-quality checks: failing rows, one-pass suites and the validation report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkline.defaults import CONTRACT_TYPES
from perkline.functions.dates import as_timestamp
from perkline.operators.joins import orphan_rows
from perkline.session import stage_table


# --- failing rows ----------------------------------------------------------------------------

def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once, with their counts; NULLs are ignored."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count("*").alias("n_records")).filter("n_records > 1")
    )


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows outside the list; NULL passes."""
    return df.filter(~F.col(column).isin(*values))


check_in_set = check_accepted_values


def check_relationships(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return orphan_rows(child, parent, child_key, parent_key)


def check_non_negative(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0)


def check_positive_value(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) <= 0)


def _out_of_range(value: Column, min_value=None, max_value=None, strict_min: bool = False, strict_max: bool = False) -> Column:
    low = F.lit(False) if min_value is None else (value <= min_value if strict_min else value < min_value)
    high = F.lit(False) if max_value is None else (value >= max_value if strict_max else value > max_value)
    return low | high


def check_between(df: DataFrame, column: str, min_value=None, max_value=None,
                  strict_min: bool = False, strict_max: bool = False) -> DataFrame:
    """Rows outside the bounds; NULL passes."""
    return df.filter(_out_of_range(F.col(column), min_value, max_value, strict_min, strict_max))


# --- suites ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    """One expectation on a column.

    not_null, in_set, accepted_values, non_negative, positive_value and between fail single rows and let NULL
    pass (but for not_null). unique fails every row whose key occurs more than once, relationships every row
    whose key the ``parent`` (table, column) lacks; both ignore NULL keys.
    """

    kind: str
    column: str
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    strict_min: bool = False
    parent: tuple[str, str] = ("", "")

    def failure(self) -> Column:
        value = F.col(self.column)
        if self.kind == "not_null":
            return value.isNull()
        if self.kind in ("in_set", "accepted_values"):
            return ~value.isin(*self.values)
        if self.kind == "non_negative":
            return value < 0
        if self.kind == "positive_value":
            return value <= 0
        if self.kind == "between":
            return _out_of_range(value, self.min_value, self.max_value, self.strict_min)
        raise ValueError(f"{self.kind} is not a row check")


KEY_CHECKS = ("unique", "relationships")


@dataclass(frozen=True)
class Suite:
    """Checks of one table."""

    table: str
    checks: tuple[Check, ...] = field(default=())

    def split(self) -> tuple[list[Check], list[Check]]:
        """Checks of single rows, and checks on keys."""
        return [c for c in self.checks if c.kind not in KEY_CHECKS], [c for c in self.checks if c.kind in KEY_CHECKS]


def _required(table: str, *columns: str) -> Suite:
    return Suite(table, tuple(Check("not_null", c) for c in columns))


# Expectations of the validation run.
SUITES = (
    Suite("sil_employees", (
        Check("not_null", "employee_id"),
        Check("unique", "employee_id"),
        Check("between", "gross_salary", min_value=0, strict_min=True),
        Check("between", "distance_km_to_office", min_value=0),
    )),
    Suite("sil_sport_activities", (
        Check("not_null", "activity_id"),
        Check("unique", "activity_id"),
        Check("not_null", "employee_id"),
        Check("not_null", "activity_date"),
        Check("between", "distance_km", min_value=0),
    )),
    Suite("gold_kpi_employee_status", (
        Check("not_null", "employee_id"),
        Check("unique", "employee_id"),
        Check("in_set", "is_bonus_eligible", values=(True, False)),
        Check("in_set", "is_wellbeing_eligible", values=(True, False)),
        Check("between", "bonus_amount", min_value=0),
        Check("between", "wellbeing_days_awarded", min_value=0),
    )),
)

# Tests of the models, by layer.
MODEL_SUITES = {
    "bronze": (
        Suite("business_rules_history", (Check("not_null", "rule_version"), Check("unique", "rule_version"))),
        Suite("business_rules_validity", (
            Check("not_null", "rule_version"), Check("unique", "rule_version"), Check("not_null", "effective_from"))),
        Suite("business_rules", (Check("not_null", "rule_version"), Check("unique", "rule_version"))),
        _required("business_rule_parameters_history", "rule_version", "rule_path", "rule_value_json"),
        _required("business_rule_parameters", "rule_version", "rule_path", "rule_value_json"),
        _required("brz_rh_employees", "employee_id"),
        _required("brz_sport_declarations", "employee_id"),
        Suite("brz_sport_activities", (Check("not_null", "activity_id"), Check("unique", "activity_id"))),
    ),
    "silver": (
        Suite("sil_employees", (
            Check("not_null", "employee_id"), Check("unique", "employee_id"),
            Check("not_null", "gross_salary"), Check("positive_value", "gross_salary"),
            Check("not_null", "distance_km_to_office"), Check("non_negative", "distance_km_to_office"),
            Check("accepted_values", "contract_type", values=CONTRACT_TYPES))),
        Suite("sil_sport_activities", (
            Check("not_null", "activity_id"), Check("unique", "activity_id"), Check("not_null", "employee_id"),
            Check("relationships", "employee_id", parent=("sil_employees", "employee_id")),
            Check("non_negative", "distance_km"))),
        _required("sil_employee_activity_yearly", "employee_id"),
    ),
    "gold": (
        Suite("gold_eligible_sport_bonus", (
            Check("not_null", "employee_id"),
            Check("relationships", "employee_id", parent=("sil_employees", "employee_id")))),
        _required("gold_eligible_wellbeing_days", "employee_id"),
        _required("gold_kpi_employee_status", "employee_id"),
        _required("gold_employee_benefit_timeline", "employee_id", "snapshot_date"),
        Suite("gold_employee_map", (
            Check("not_null", "employee_id"), Check("unique", "employee_id"), Check("not_null", "home_lat"),
            Check("not_null", "home_lon"))),
    ),
    "monitoring": (
        _required("monitoring_runs", "dag_id", "run_id"),
        _required("monitoring_activity_volumes_daily", "metric_date"),
    ),
}


def _entries(name: str, suites: Sequence[Suite], flags: int) -> list[Column]:
    """What a row of table ``name`` adds to the stacked keys of all suites.

    One entry (check 0) counts the row and its failures of row checks, one per check on keys carries the key, and one
    per check of another table that names this one as parent tells that the key exists.
    """
    def entry(suite: int, check: int, key: Column, n: int, parent: int, failures: Sequence[Column] = ()) -> Column:
        marks = [*failures, *[F.lit(False)] * (flags - len(failures))]
        return F.struct(
            F.lit(suite).alias("suite"), F.lit(check).alias("check"), key.cast("string").alias("key"), F.lit(n).alias("n"),
            F.lit(parent).alias("parent"), *[F.coalesce(m, F.lit(False)).cast("int").alias(f"f{i}") for i, m in enumerate(marks)])

    out = []
    for number, suite in enumerate(suites):
        rows, keys = suite.split()
        if suite.table == name:
            out.append(entry(number, 0, F.lit(None), 1, 0, [c.failure() for c in rows]))
            out += [entry(number, at, F.col(c.column), 1, 0) for at, c in enumerate(keys, 1)]
        out += [entry(number, at, F.col(c.parent[1]), 0, 1) for at, c in enumerate(keys, 1) if c.parent[0] == name]
    return out


def validation_suite(tables: Mapping[str, DataFrame], suites: Sequence[Suite] = SUITES) -> DataFrame:
    """(table, check, column, rows, failing rows, success) of all checks of all suites.

    Every table is read once: its rows are stacked with those of the others as (suite, check, key) and counted per
    key in one aggregation, which is partial in the tasks, so what shuffles is one row per task and distinct key. Keys of
    parents are stacked onto the checks that ask for them, so no join is needed. A second, small aggregation sums up.
    """
    split = [s.split() for s in suites]
    flags, most = (max((len(s[k]) for s in split), default=0) for k in (0, 1))
    names = list(dict.fromkeys([*(s.table for s in suites), *(c.parent[0] for _, keys in split for c in keys if c.parent[0])]))
    parts = [tables[name].select(F.inline(F.array(*_entries(name, suites, flags)))) for name in names]
    # a suite of an empty table has results too
    spark = parts[0].sparkSession
    parts.append(spark.range(len(suites)).select(
        F.col("id").cast("int").alias("suite"), F.lit(0).alias("check"), F.lit(None).cast("string").alias("key"), F.lit(0).alias("n"),
        F.lit(0).alias("parent"), *[F.lit(0).alias(f"f{i}") for i in range(flags)]))
    per_key = reduce(DataFrame.unionByName, parts).groupBy("suite", "check", "key").agg(
        F.sum("n").alias("n"), F.max("parent").alias("parent"), *[F.sum(f"f{i}").alias(f"f{i}") for i in range(flags)])

    kinds = [[c.kind for c in keys] for _, keys in split]
    unique = [F.struct(F.lit(s), F.lit(at)) for s, row in enumerate(kinds) for at, k in enumerate(row, 1) if k == "unique"]
    is_unique = F.struct("suite", "check").isin(*unique) if unique else F.lit(False)
    bad = F.col("key").isNotNull() & F.when(is_unique, F.col("n") > 1).otherwise(F.col("parent") == 0)
    per_suite = per_key.groupBy("suite").agg(
        F.sum(F.when(F.col("check") == 0, F.col("n"))).alias("row_count"),
        *[F.sum(F.when(F.col("check") == 0, F.col(f"f{i}"))).alias(f"f{i}") for i in range(flags)],
        *[F.coalesce(F.sum(F.when((F.col("check") == at) & bad, F.col("n"))), F.lit(0)).alias(f"k{at}") for at in range(1, most + 1)])

    def results(suite: Suite, rows: list[Check], keys: list[Check]) -> Column:
        found = [*zip(rows, (f"f{i}" for i in range(flags)), strict=False), *zip(keys, (f"k{i}" for i in range(1, most + 1)), strict=False)]
        return F.array(*[F.struct(
            F.lit(suite.table).alias("table_name"), F.lit(c.kind).alias("check_name"), F.lit(c.column).alias("column_name"),
            F.col("row_count").alias("row_count"), F.col(n).alias("failing_rows"), (F.col(n) == 0).alias("success")) for c, n in found])

    labelled = F.coalesce(*[F.when(F.col("suite") == i, results(s, *split[i])) for i, s in enumerate(suites)])
    return per_suite.select(F.inline(labelled))


def run_suite(df: DataFrame, suite: Suite, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The results of one table."""
    return validation_suite({**(tables or {}), suite.table: df}, [suite])


def validation_report(results: DataFrame, generated_at: str) -> DataFrame:
    """One row per table: totals, statistics and the single results."""
    passed = F.count_if("success")
    return results.groupBy("table_name").agg(
        F.max("row_count").alias("row_count"),
        F.every("success").alias("success"),
        F.count("*").alias("evaluated_checks"),
        passed.alias("successful_checks"),
        (F.count("*") - passed).alias("unsuccessful_checks"),
        F.round(F.lit(100.0) * passed / F.count("*"), 2).alias("success_percent"),
        F.array_sort(F.collect_list(F.struct("check_name", "column_name", "failing_rows", "success"))).alias("details"),
    ).withColumn("generated_at", as_timestamp(generated_at))


def report_document(report: DataFrame) -> DataFrame:
    """The whole report as one row: when, whether all passed, and one entry per checked table."""
    entries = F.struct(*[c for c in report.columns if c != "generated_at"])
    return report.agg(
        F.max("generated_at").alias("generated_at"), F.coalesce(F.every("success"), F.lit(True)).alias("success"),
        F.array_sort(F.collect_list(entries)).alias("validations"))


class ValidationFailed(RuntimeError):
    """At least one check found failing rows."""


def publish_report(report: DataFrame, folder: str, run_label: str, fail: bool = True) -> bool:
    """Write the report document as latest and archived JSON, then raise if any table failed.

    A report has one entry per checked table, so its one document is written from one task.
    """
    stored = stage_table(report_document(report), "report")
    stored.write.mode("overwrite").json(f"{folder}/archive/{run_label}")
    stored.write.mode("overwrite").json(f"{folder}/latest")
    failed = [r.name for r in stored.select(F.inline("validations")).filter("not success").select(
        F.col("table_name").alias("name")).collect()]
    if failed and fail:
        raise ValidationFailed(f"validation failed for {', '.join(sorted(failed))}")
    return not failed
