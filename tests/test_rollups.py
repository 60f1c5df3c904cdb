"""Roll-ups from runs against the same roll-ups of the unrolled timeline."""

import random

import pytest
from pyspark.sql import functions as F

from perkline.catalogue.queries import QUERIES
from perkline.plans import bi, monitoring, rollups
from perkline.plans import rules as R
from perkline.plans.timeline import benefit_runs, gold_employee_benefit_timeline
from tests.domain import silver_activities, silver_employees, three_rules


def random_inputs(spark, seed):
    rng = random.Random(seed)
    modes = ["velo", "vélo", "marche/running", "autres", None]
    people = [(str(i), "30000", modes[i % 5], str(rng.choice([3, 12, 18, 30]))) for i in range(12)] + [(None, "1", "velo", "3")]
    records = []
    for n in range(140):
        day = f"2024-{rng.randint(1, 7):02d}-{rng.randint(1, 28):02d}" if n % 4 else f"2022-12-{rng.randint(20, 31)}"
        # employees 9 to 11 stay idle, one is unknown
        records.append((f"a{n}", rng.choice(["0", "1", "2", "3", "8", "77", None]), day, "1.50", n % 40, day, n % 9 > 0))
    employees = silver_employees(spark, people).withColumn("business_unit", F.when(F.col("employee_id") != "3", F.expr("'B' || length(transport_mode) % 2")))
    return employees, silver_activities(spark, records), R.rules_validity(three_rules(spark), "2024-09-01")


@pytest.mark.parametrize(("seed", "window"), [(1, 7), (2, 40)])
def test_equal_the_unrolled_timeline(spark, rows, seed, window):
    employees, activities, validity = random_inputs(spark, seed)
    grid = gold_employee_benefit_timeline(employees, activities, validity, window).cache()
    counts = rollups.daily_counts(*benefit_runs(employees, activities, validity, window)).cache()
    assert rows(rollups.timeline_volumes(counts)) == rows(monitoring.timeline_volumes(grid))
    assert rows(rollups.eligibility_trend(counts)) == rows(bi.bi_eligibility_trend(grid))
    assert rows(counts.select("snapshot_date", "employees")) == rows(grid.groupBy("snapshot_date").agg(F.count("*")))
    for by in (None, "business_unit", "transport_mode"):
        for filters in ({}, {"transport_mode": ["velo", "autres"], "date_from": "2024-02-01", "date_to": "2024-06-05"}):
            got = rollups.activity_trend(employees, activities, validity, by, **filters)
            assert rows(got) == rows(bi.bi_activity_trend(bi.bi_filter(grid, **filters), by))
    grid.unpersist()
    counts.unpersist()


def test_empty_inputs(spark):
    employees, activities, validity = random_inputs(spark, 4)
    for people, acts in ((employees.limit(0), activities), (employees, activities.limit(0))):
        assert rollups.daily_counts(*benefit_runs(people, acts, validity, 30)).count() == 0
        assert rollups.activity_trend(people, acts, validity).count() == 0


@pytest.mark.parametrize("name", [
    "agg_timeline_daily", "monitoring_activity_volumes_daily", "dash_active_series", "bi_eligibility_trend", "bi_activity_trend"])
def test_no_grid_in_the_plan(spark, name):
    """Unrolling is a sequence between the ends of a run; a roll-up has marks at its ends instead."""
    text = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "sequence(begins" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
