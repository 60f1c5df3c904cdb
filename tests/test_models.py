"""Silver, gold and timeline on adversarial rows."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from perkline.operators.ranking import lead_in_order, total_order_rank
from perkline.plans import bronze, gold, quality, silver
from perkline.plans import rules as R
from perkline.plans.timeline import gold_employee_benefit_timeline
from tests.domain import employees_raw, silver_activities, silver_employees, three_rules

D = dt.date


def validity(spark, as_of="2024-01-31"):
    return R.rules_validity(three_rules(spark), as_of)


def test_employee_dedup(spark):
    raw = employees_raw(spark, [
        {"employee_id": "1", "row_hash": "a", "gross_salary_raw": "1"},
        {"employee_id": "1", "row_hash": "b", "gross_salary_raw": "2"},
        {"employee_id": "2", "ingested_at": "2024-02-01 00:00:00", "process_date": "2023-01-01", "gross_salary_raw": "3"},
        {"employee_id": "2", "process_date": "2024-01-30", "gross_salary_raw": "4"},
        {"employee_id": None}, {"employee_id": None},
    ])
    found = silver.sil_employees(bronze.brz_rh_employees(raw), validity(spark))
    assert {r.employee_id: r.gross_salary for r in found.collect()} == {"1": Decimal("2.00"), "2": Decimal("3.00")}


def test_declaration_dedup_keeps_one_null_key(spark, rows):
    raw = spark.sql("""select * from values ('1', ' ', timestamp'2024-01-01', 'a'), ('1', ' Judo ', timestamp'2024-01-02', 'a'),
        (null, 'x', timestamp'2024-01-01', 'a'), (null, 'y', timestamp'2024-01-01', 'b')
        as t(employee_id, declared_sport, ingested_at, row_hash)""")
    assert rows(silver.sil_sport_declarations(raw)) == [("1", "Judo"), (None, "y")]


def test_flags_without_a_current_rule(spark):
    raw = employees_raw(spark, [{"employee_id": "1", "declared_transport_mode": "Vélo"},
                                {"employee_id": "2", "declared_transport_mode": "Bus"}])
    found = {r.employee_id: r for r in silver.sil_employees(bronze.brz_rh_employees(raw), validity(spark, "2022-01-01")).collect()}
    assert (found["1"].is_transport_mode_sportive, found["1"].is_distance_rule_valid) == (False, None)
    assert (found["2"].is_transport_mode_sportive, found["2"].is_distance_rule_valid) == (False, False)


def joined(spark, as_of="2024-01-31", acts=()):
    raw = employees_raw(spark, [
        {"employee_id": "1", "declared_transport_mode": "Vélo", "gross_salary_raw": "30000.55"},
        {"employee_id": "2", "declared_transport_mode": "VÉLO"},
        {"employee_id": "3", "declared_transport_mode": "Vélo/Trottinette/Autres"},
        {"employee_id": "4", "declared_transport_mode": "Vélo", "gross_salary_raw": ""},
    ])
    employees = silver.sil_employees(bronze.brz_rh_employees(raw), validity(spark, as_of))
    declarations = spark.createDataFrame([("1", "Judo")], "employee_id string, declared_sport string")
    yearly = silver.sil_employee_activity_yearly(silver_activities(spark, list(acts) or [
        ("a", "1", "2024-01-01", "1", 1, "2024-01-01", True)]), as_of)
    return employees, silver.sil_employee_activity_joined(employees, declarations, yearly)


def test_bonus_reasons_and_amounts(spark):
    _, base = joined(spark)
    found = {r.employee_id: (r.eligibility_reason, r.eligibility_status, r.bonus_amount)
             for r in gold.gold_eligible_sport_bonus(base, validity(spark), "2024-01-31").collect()}
    assert found["1"] == ("eligible", True, Decimal("1800.03"))
    assert found["2"] == ("distance_hors_regle", False, Decimal("0.00"))
    assert found["3"] == ("transport_non_sportif", False, Decimal("0.00"))
    assert found["4"] == ("eligible", True, None)


def test_no_rule_empties_decisions_but_not_status(spark):
    as_of = "2022-01-01"
    _, base = joined(spark, as_of)
    v = validity(spark, as_of)
    bonus = gold.gold_eligible_sport_bonus(base, v, as_of)
    wellbeing = gold.gold_eligible_wellbeing_days(base, v, as_of)
    assert bonus.count() == 0 == wellbeing.count()
    for status in (gold.gold_kpi_employee_status(base, bonus, wellbeing), gold.employee_status(base, v, as_of)):
        assert status.count() == 4
        assert status.filter("is_bonus_eligible is not null or bonus_reason is not null or wellbeing_days_awarded is not null").count() == 0
    totals = gold.gold_kpi_finance(gold.employee_status(base, v, as_of), silver_activities(spark, [("a", "1", "2024-01-01", "1", 1, "2024-01-01", True)]), as_of)
    assert [tuple(r) for r in totals.collect()] == [(2022, 0, 0, Decimal("0.00"), Decimal("0.00"), 1)]


def test_status_forms_agree(spark, rows):
    _, base = joined(spark)
    v = validity(spark)
    by_join = gold.gold_kpi_employee_status(
        base, gold.gold_eligible_sport_bonus(base, v, "2024-01-31"), gold.gold_eligible_wellbeing_days(base, v, "2024-01-31"))
    assert rows(by_join) == rows(gold.employee_status(base, v, "2024-01-31"))


def test_yearly_has_no_upper_bound(spark):
    acts = silver_activities(spark, [
        ("a", "1", "2024-03-01", "1", 1, "2024-03-02", True),
        ("b", "1", "2023-01-31", "1", 1, "2023-02-01", True),
        ("c", "1", "2023-01-30", "1", 1, "2025-01-01", True),
        ("d", "2", "2020-01-01", "1", 1, "2020-01-01", True),
        ("e", "3", "2024-01-01", "1", 1, "2024-01-01", False),
    ])
    found = {r.employee_id: tuple(r)[2:] for r in silver.sil_employee_activity_yearly(acts, "2024-01-31").collect()}
    assert found == {"1": (2, 2, D(2024, 3, 1), D(2024, 3, 2)), "2": (0, 0, D(2020, 1, 1), None)}


def test_anomalies_have_ids_and_skip_the_combined_mode(spark):
    employees = silver_employees(spark, [("1", "0", "velo", "21"), ("2", "-5", "velo/trottinette/autres", "99"), ("3", "1", "marche", "10.01")])
    acts = silver_activities(spark, [("a", None, "2024-01-01", "1", 1, "2024-01-01", False)])
    found = gold.gold_quality_anomalies(employees, acts, validity(spark), "2024-01-31", "2024-01-31 00:00:00").collect()
    assert sorted((r.record_id, r.anomaly_type) for r in found) == [
        ("1", "distance_rule_issue"), ("1", "salary_issue"), ("2", "salary_issue"), ("3", "distance_rule_issue"), ("a", "invalid_activity")]
    assert all(r.anomaly_id for r in found) and len({r.anomaly_id for r in found}) == 5


# --- timeline --------------------------------------------------------------------------------

def brute_force(employees, acts, window):
    """The timeline's activity columns by plain loops."""
    valid = [a for a in acts if a[6]]
    days = sorted({a[2] for a in valid})
    out = {}
    for e in employees:
        for day in days:
            d = D.fromisoformat(day)
            seen = [a for a in valid if a[1] == e and 0 <= (d - D.fromisoformat(a[2])).days <= window]
            today = [a for a in seen if a[2] == day]
            out[(e, d)] = (
                len(today), sum((Decimal(a[3]) for a in today), Decimal("0.00")), sum(a[4] for a in today), len(seen),
                len({a[2] for a in seen}), max((D.fromisoformat(a[2]) for a in seen), default=None),
                max((D.fromisoformat(a[5]) for a in seen), default=None))
    return out


def activity_columns(timeline):
    return {(r.employee_id, r.snapshot_date): (
        r.activity_count_on_date, r.distance_km_on_date, r.duration_min_on_date, r.activity_count_12m,
        r.sport_days_count_12m, r.last_activity_date, r.last_process_date) for r in timeline.collect()}


def random_activities(seed, n, employees, span, hot):
    """Random rows of which a third fall on one hot employee and a third on one hot day."""
    rng = random.Random(seed)
    acts = []
    for i in range(n):
        day = D(2023, 6, 1) + dt.timedelta(days=rng.randrange(span) if i % 3 else span // 2)
        who = hot if i % 3 == 1 else rng.choice(employees + ["ghost"])
        lag = rng.choice([0, 0, 1, 30, -2])
        acts.append((f"a{i}", who, day.isoformat(), f"{rng.randrange(0, 5000) / 100:.2f}", rng.randrange(1, 90),
                     (day + dt.timedelta(days=lag)).isoformat(), rng.random() > 0.1))
    return acts


def test_timeline_equals_brute_force(spark):
    names = ["1", "2", "3", "idle"]
    employees = silver_employees(spark, [(n, "1000", "velo", "5") for n in names])
    for seed, window, span in ((1, 7, 60), (2, 30, 400), (3, 365, 900), (4, 1, 20), (5, 0, 20)):
        acts = random_activities(seed, 150, names[:3], span, "1")
        found = gold_employee_benefit_timeline(employees, silver_activities(spark, acts), validity(spark), window)
        assert activity_columns(found) == brute_force(names, acts, window), (seed, window)


def test_window_edges_and_future(spark):
    acts = [("a", "1", "2023-01-31", "1", 1, "2023-01-31", True), ("b", "2", "2024-01-31", "1", 1, "2024-01-31", True),
            ("c", "2", "2024-02-01", "1", 1, "2024-02-01", True)]
    employees = silver_employees(spark, [("1", "1000", "velo", "5"), ("2", "1000", "velo", "5")])
    found = activity_columns(gold_employee_benefit_timeline(employees, silver_activities(spark, acts), validity(spark)))
    assert found[("1", D(2024, 1, 31))][3] == 1  # exactly 365 days back
    assert found[("1", D(2024, 2, 1))][3] == 0   # 366 days back
    assert found[("2", D(2024, 1, 31))][3] == 1  # the later activity is not known yet


def test_timeline_decisions_follow_the_rule_of_the_day(spark):
    acts = [("a", "1", "2024-01-09", "1", 1, "2024-01-09", True), ("b", "1", "2024-01-10", "1", 1, "2024-01-10", True)]
    employees = silver_employees(spark, [("1", "1000", "velo", "5"), ("2", "1000", "vélo", "5"), ("3", "1000", "velo", None)])
    found = {(r.employee_id, r.rule_version): r for r in gold_employee_benefit_timeline(
        employees, silver_activities(spark, acts), validity(spark)).collect()}
    assert found[("1", "r1")].bonus_amount == Decimal("50.00") and found[("1", "r2")].bonus_amount == Decimal("60.00")
    assert found[("1", "r1")].is_wellbeing_eligible and not found[("1", "r2")].is_wellbeing_eligible
    assert found[("2", "r1")].bonus_reason == "transport_non_sportif"
    assert found[("2", "r2")].bonus_reason == "distance_hors_regle"
    # an unknown distance is neither within nor beyond the limit
    assert (found[("3", "r1")].is_bonus_eligible, found[("3", "r1")].bonus_reason) == (False, "eligible")


def test_future_rule_does_not_change_past_snapshots(spark, rows):
    acts = silver_activities(spark, random_activities(9, 60, ["1", "2"], 200, "1"))
    employees = silver_employees(spark, [("1", "1000", "velo", "5"), ("2", "1000", "marche", "9")])
    rules = three_rules(spark)
    late = rules.filter("rule_version = 'r3'").withColumns({
        "rule_version": F.lit("r4"), "effective_from": F.lit("2024-09-01").cast("date")})
    before = gold_employee_benefit_timeline(employees, acts, R.rules_validity(rules, "2024-01-31"))
    after = gold_employee_benefit_timeline(employees, acts, R.rules_validity(rules.union(late), "2024-01-31"))
    assert rows(before) == rows(after)


def test_timeline_without_activity_is_empty(spark):
    acts = silver_activities(spark, [("a", "1", "2024-01-09", "1", 0, "2024-01-09", False)])
    employees = silver_employees(spark, [("1", "1000", "velo", "5")])
    assert gold_employee_benefit_timeline(employees, acts, validity(spark)).count() == 0


# --- ranking and quality ---------------------------------------------------------------------

def test_total_order_rank(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("g"))
    ranked = lead_in_order(df, [F.asc("g"), F.desc("id")], "id", "next_id")
    expected = sorted(((i % 3, -i) for i in range(5000)))
    found = {r.rank: (r.g, -r.id, r.next_id) for r in ranked.collect()}
    assert [found[i + 1][:2] for i in range(5000)] == expected
    assert all(found[i][2] == -found[i + 1][1] for i in range(1, 5000)) and found[5000][2] is None
    assert total_order_rank(df.limit(0), [F.asc("id")]).count() == 0


def test_suite_and_report(spark, tmp_path):
    df = spark.sql("select * from values ('1', 5.0), ('1', 0.0), (null, null), (null, -1.0), ('2', 1.0) as t(k, v)")
    suite = quality.Suite("t", (
        quality.Check("not_null", "k"), quality.Check("unique", "k"),
        quality.Check("between", "v", min_value=0, strict_min=True), quality.Check("in_set", "k", values=("1", "2")),
        quality.Check("non_negative", "v"), quality.Check("positive_value", "v"),
        quality.Check("accepted_values", "k", values=("1",)), quality.Check("relationships", "k", parent=("p", "x"))))
    results = quality.run_suite(df, suite, {"p": spark.sql("select '2' x")})
    assert {(r.check_name): (r.row_count, r.failing_rows, r.success) for r in results.collect()} == {
        "not_null": (5, 2, False), "unique": (5, 2, False), "between": (5, 2, False), "in_set": (5, 0, True),
        "non_negative": (5, 1, False), "positive_value": (5, 2, False), "accepted_values": (5, 1, False),
        "relationships": (5, 2, False)}
    report = quality.validation_report(results, "2024-01-31 00:00:00")
    row = report.first()
    assert (row.row_count, row.success, row.evaluated_checks, row.successful_checks) == (5, False, 8, 1)
    import pytest
    with pytest.raises(quality.ValidationFailed, match="t"):
        quality.publish_report(report, str(tmp_path / "r"), "run1")
    document = spark.read.json(str(tmp_path / "r" / "latest")).first()
    assert document.success is False and len(document.validations) == 1 and len(document.validations[0].details) == 8
    assert spark.read.json(str(tmp_path / "r" / "archive" / "run1")).count() == 1


def test_failing_rows(spark):
    df = spark.sql("select * from values (1, 'a'), (-1, 'b'), (0, null) as t(n, s)")
    assert quality.check_non_negative(df, "n").count() == 1
    assert quality.check_positive_value(df, "n").count() == 2
    assert quality.check_accepted_values(df, "s", ["a"]).count() == 1
    assert quality.check_not_null(df, "s").count() == 1
    assert quality.check_between(df, "n", 0, 0).count() == 2
