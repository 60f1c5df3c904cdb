"""The stored timeline after refreshes against a full rebuild, and snapshots as known on their date."""

import datetime as dt
import random
import re

import pytest

from pyspark.sql import functions as F

from perkline.catalogue.queries import _sum_of_some
from perkline.plans import refresh
from perkline.plans import rules as R
from perkline.plans.timeline import COLUMNS, gold_employee_benefit_timeline, spread_by_date
from tests.domain import silver_activities, silver_employees, three_rules

PEOPLE = [(str(i), "30000", ["velo", "vélo", "marche/running", None][i % 4], str(3 + 4 * i)) for i in range(6)]


def day(rng, low=0, high=120):
    return (dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(low, high))).isoformat()


def records(rng, n):
    """Late ones, some processed before their day, some of nobody, some not valid."""
    out = {}
    for i in range(n):
        on = day(rng)
        late = (dt.date.fromisoformat(on) + dt.timedelta(days=rng.choice([-3, 0, 0, 0, 1, 2, 15, 40]))).isoformat()
        out[f"a{i}"] = (f"a{i}", rng.choice(["0", "1", "2", "3", "77", None]), on, "1.50", i % 30, late, i % 9 > 0)
    return out


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in (path / "timeline").rglob("*.parquet")}


@pytest.mark.parametrize(("seed", "window"), [(2, 30)])
def test_refreshes_equal_a_rebuild(spark, rows, tmp_path, seed, window):
    rng = random.Random(seed)
    employees, validity = silver_employees(spark, PEOPLE), R.rules_validity(three_rules(spark), "2024-09-01")
    state = records(rng, 50)
    path = str(tmp_path / "t")
    refresh.store_timeline(path, employees, silver_activities(spark, list(state.values())), validity, window)
    for step in range(2):
        before, old = dict(state), files(tmp_path / "t")
        for key in rng.sample(sorted(state), 2):  # gone, and moved to another day and person
            state.pop(key)
        moved = rng.choice(sorted(state))
        state[moved] = (moved, "2", day(rng), *state[moved][3:6], True)
        state[f"new{step}"] = (f"new{step}", "1", day(rng, 130, 140), "2.00", 9, "2024-06-01", True)  # a new date
        pairs = {(r[1], r[2]) for k in {*before, *state} if before.get(k) != state.get(k) for r in (before.get(k), state.get(k)) if r}
        changed = spark.createDataFrame(sorted(pairs, key=str), "employee_id string, d string").selectExpr(
            "employee_id", "cast(d as date) activity_date")
        activities = silver_activities(spark, list(state.values()))
        got = refresh.refresh_timeline(path, employees, activities, validity, changed, window).select(*COLUMNS)
        full = gold_employee_benefit_timeline(employees, activities, validity, window)
        assert rows(got) == rows(full)
        again = refresh.refresh_timeline(path, employees, activities, validity, changed, window).select(*COLUMNS)
        assert rows(again) == rows(full)
        days = [dt.date.fromisoformat(d) for _, d in pairs]
        for name, written in files(tmp_path / "t").items():
            on = dt.date.fromisoformat(re.search(r"snapshot_date=([\d-]+)", name).group(1))
            if not any(d <= on <= d + dt.timedelta(days=window) for d in days):
                assert old.get(name) == written


def test_a_refresh_reads_touched_partitions_only(spark, tmp_path, monkeypatch):
    employees, validity = silver_employees(spark, PEOPLE), R.rules_validity(three_rules(spark), "2024-09-01")
    state = [(f"a{i}", str(i % 4), (dt.date(2024, 1, 1) + dt.timedelta(days=i)).isoformat(), "1", 5, "2024-01-01", True) for i in range(60)]
    path = str(tmp_path / "t")
    refresh.store_timeline(path, employees, silver_activities(spark, state), validity, 7)
    plans = []
    stage = refresh.stage_table
    monkeypatch.setattr(refresh, "stage_table", lambda df, name: plans.append(df) or stage(df, name))
    late = ("late", "2", "2024-01-20", "1", 5, "2024-03-01", True)
    changed = spark.sql("select '2' employee_id, date'2024-01-20' activity_date")
    refresh.refresh_timeline(path, employees, silver_activities(spark, [*state, late]), validity, changed, 7)
    text = "".join(p._jdf.queryExecution().executedPlan().toString() for p in plans)
    filters = re.findall(r"PartitionFilters: \[([^\]]*snapshot_date[^\]]*)\]", text)
    assert filters and all(re.search(r">= 2024-01-20\), .*<= 202", f) for f in filters)  # the text of a plan is cut short


def brute_known(people, acts, window, snapshots):
    out = {}
    for p in people:
        for s in snapshots:
            mine = [a for a in acts if a[1] == p and a[6] and (a[5] or a[2]) <= s.isoformat()]
            back = [a for a in mine if s - dt.timedelta(days=window) <= dt.date.fromisoformat(a[2]) <= s]
            out[p, s] = (
                sum(a[2] == s.isoformat() for a in mine), len(back), len({a[2] for a in back}),
                max((a[2] for a in back), default=None), max((a[5] or a[2] for a in back), default=None))
    return out


@pytest.mark.parametrize(("seed", "window"), [(5, 7), (6, 40)])
def test_known_at_equals_brute_force(spark, seed, window):
    rng = random.Random(seed)
    acts = list(records(rng, 90).values())
    acts[3] = (*acts[3][:5], None, True)
    employees, validity = silver_employees(spark, PEOPLE), R.rules_validity(three_rules(spark), "2024-09-01")
    found = gold_employee_benefit_timeline(employees, silver_activities(spark, acts), validity, window, known_at=True).collect()
    got = {(r.employee_id, r.snapshot_date): (
        r.activity_count_on_date, r.activity_count_12m, r.sport_days_count_12m, r.last_activity_date and str(r.last_activity_date),
        r.last_process_date and str(r.last_process_date)) for r in found}
    snapshots = sorted({dt.date.fromisoformat(a[2]) for a in acts if a[6]})
    assert got == brute_known([p[0] for p in PEOPLE], acts, window, snapshots)


def test_known_at_on_empty_inputs(spark):
    employees, validity = silver_employees(spark, PEOPLE), R.rules_validity(three_rules(spark), "2024-09-01")
    none = silver_activities(spark, list(records(random.Random(1), 5).values())).limit(0)
    assert gold_employee_benefit_timeline(employees, none, validity, 7, known_at=True).count() == 0


def test_storing_copies_no_rows_and_shuffles_runs_only(spark, rows, tmp_path, monkeypatch):
    rng = random.Random(5)
    employees, validity = silver_employees(spark, PEOPLE), R.rules_validity(three_rules(spark), "2024-09-01")
    state = records(rng, 40)
    activities = silver_activities(spark, list(state.values()))
    staged, written = [], []
    keep, write = refresh.stage_table, refresh._write
    monkeypatch.setattr(refresh, "stage_table", lambda df, name: staged.append(name) or keep(df, name))

    def watched(df, path, key):
        written.append((path.rsplit("/", 1)[1], df._jdf.queryExecution().optimizedPlan().toString()))
        write(df, path, key)

    monkeypatch.setattr(refresh, "_write", watched)
    path = str(tmp_path / "t")
    refresh.store_timeline(path, employees, activities, validity, 30)
    plan = dict(written)["timeline"]
    assert "RebalancePartitions" not in plan and plan.count("RepartitionByExpression") == 1
    changed = activities.filter("employee_id = '1'").select("employee_id", "activity_date")
    refresh.refresh_timeline(path, employees, activities, validity, changed, 30)
    assert staged == ["changed", "fresh", "refreshed"]
    full = gold_employee_benefit_timeline(employees, activities, validity, 30)
    assert rows(refresh.read_timeline(spark, path).select(*COLUMNS)) == rows(full)


def test_blocks_of_dates_keep_every_date_of_a_run(spark, rows):
    runs = spark.createDataFrame([("a", 1, 11), ("b", 3, 3), ("b", 4, 9), ("c", 2, 2)], "employee_id string, begins int, ends int")

    def dates(df):
        return rows(df.selectExpr("employee_id", "explode(sequence(begins, ends)) d"))

    for size in (1, 5, 1000):
        dealt = spread_by_date(runs, size, 4)
        assert dates(dealt) == dates(runs)
        assert dealt.filter("floor((begins - 1) / 4) <> floor((ends - 1) / 4)").isEmpty()
    assert spread_by_date(runs.filter("false")).isEmpty()


def test_sums_of_the_grid_leave_zeros_out(spark):
    df = spark.createDataFrame([(1, "1.50"), (1, "0"), (1, None), (1, "-2.25"), (2, "0"), (3, None)], "g int, t string").selectExpr(
        "g", "cast(t as decimal(18,2)) x")
    got = df.groupBy("g").agg(F.sum("x").alias("plain"), _sum_of_some("x"))
    assert sorted(r.plain for r in got.collect() if r.plain is not None) and all(r.plain == r.x for r in got.collect())
    assert got.schema["x"].dataType == got.schema["plain"].dataType
    assert "FILTER" in got._jdf.queryExecution().optimizedPlan().toString()
