"""Physical plans: what must and must not appear in them."""

import re

import pytest

from perkline.catalogue.queries import QUERIES, Domain
from perkline.plans import bi, timeline
from perkline.sources import tables

SF = "/root/testdata/sf0.001"

LAZY_MODELS = (
    "sil_employees", "sil_sport_activities", "sil_employee_activity_joined", "gold_eligible_sport_bonus",
    "gold_kpi_employee_status", "gold_kpi_finance", "gold_quality_anomalies", "join_asof_rule", "rules_validity",
    "gold_employee_benefit_timeline", "monitoring_runs", "dash_recent_runs", "validation_suite",
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY_MODELS)
def test_no_pairwise_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


@pytest.mark.parametrize("name", ["dedup_latest_employee", "dedup_latest_declaration", "dedup_latest_activity"])
def test_dedup_prunes_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert text.index(" Final") < text.index("Exchange hashpartitioning") < text.index(" Partial")


def test_payload_text_stays_out_of_the_silver_shuffle(spark):
    text = plan(Domain(spark, SF).activities)
    below_exchange = text[text.index("Exchange hashpartitioning"):]
    shuffled = re.search(r"Project \[(.*)", below_exchange).group(1)
    assert "payload_json#" not in shuffled.split("AS _copy")[-1]


def test_grid_is_not_shuffled(spark):
    text = plan(Domain(spark, SF).timeline())
    above_unrolling = text[:text.index("Generate explode(sequence")]
    assert "Exchange hash" not in above_unrolling and "Sort" not in above_unrolling


def test_columns_are_pruned_at_the_scan(spark):
    text = plan(QUERIES["sort_series"](spark, SF))
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>", text)


def test_stored_timeline_prunes_dates(spark, tmp_path):
    d = Domain(spark, SF)
    stored = tables.materialize_layer(
        {"gold_employee_benefit_timeline": d.timeline(7)}, "gold", str(tmp_path))["gold_employee_benefit_timeline"]
    chosen = bi.bi_activity_trend(bi.bi_filter(stored, date_from="2024-01-10", date_to="2024-01-11"))
    text = plan(chosen)
    assert "PartitionFilters: [isnotnull(snapshot_date" in text
    assert re.search(r"ReadSchema: struct<activity_count_on_date:bigint>", text)
    assert chosen.count() == 2


@pytest.mark.parametrize("name", ["replace_batch", "upsert_by_key", "replace_by_key", "insert_if_absent", "json_array_explode_in"])
def test_no_funnel_into_one_task(spark, name):
    assert "SinglePartition" not in plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize(("name", "table", "reads"), [
    ("gold_kpi_finance", "customer", 1), ("join_cross_scalars", "customer", 1), ("join_left_status", "customer", 0),
    ("gold_quality_anomalies", "customer", 1), ("gold_quality_anomalies", "events", 1), ("dash_flow_series", "customer", 0)])
def test_inputs_are_built_once(spark, name, table, reads):
    assert len(re.findall(rf"FileScan parquet .*/{table}\.parquet", plan(QUERIES[name](spark, SF)))) <= reads


def test_rule_documents_are_parsed_once(spark):
    assert plan(QUERIES["rules_wide"](spark, SF)).count("from_json(") == 1
    lines = plan(QUERIES["sil_employees"](spark, SF)).splitlines()
    assert not any("array_contains(from_json" in line for line in lines)


def test_lead_needs_no_second_copy(spark):
    text = plan(QUERIES["lead_next"](spark, SF))
    assert text.count("SortMergeJoin") == 0


def test_unrolled_tasks_have_bounded_output(spark):
    """Tasks follow employees x dates: ten times the dates, ten times the tasks."""
    sizes = []
    for dates in (300, 3000):
        runs = spark.range(200).selectExpr("string(id) employee_id", "1 begins", f"{dates} ends")
        dealt = timeline.spread_runs(runs, 10_000)
        rows = [sum(r.ends - r.begins + 1 for r in part) for part in dealt.rdd.glom().collect()]
        sizes.append(len(rows))
        assert max(rows) <= 4 * 10_000
    assert sizes == [6, 60]


def test_a_second_run_rewrites_touched_dates_only(spark, tmp_path):
    def run(query):
        tables.materialize_layer({"sil_sport_activities": spark.sql(query)}, "silver", str(tmp_path))
        return {f.parent.name: f.name for f in tmp_path.rglob("*.parquet")}

    first = run("select id, date_add(date'2024-01-01', int(id % 3)) process_date from range(9)")
    second = run("select id, date'2024-01-02' process_date from range(4)")
    changed = {d for d in first if first[d] != second[d]}
    assert changed == {"process_date=2024-01-02"} and len(second) == 3


def test_batches_are_written_without_a_file_per_task(spark, tmp_path):
    df = spark.range(0, 4000, 1, 40).selectExpr("id", "concat('f', id % 2) source_file", "date'2024-01-01' process_date")
    tables.write_batches(df, str(tmp_path / "b"))
    assert len(list((tmp_path / "b").rglob("*.parquet"))) <= 4


def test_key_checks_share_one_scan_and_one_exchange(spark):
    text = plan(QUERIES["validation_suite_faults"](spark, SF))
    assert text.count("Exchange hashpartitioning(suite#") - text.count("Exchange hashpartitioning(suite#", text.index("Initial Plan") if "Initial Plan" in text else len(text)) <= 2
    for table in ("orders", "customer"):
        assert len(re.findall(rf"FileScan parquet .*/{table}\.parquet", text)) == 1
    assert "Join" not in text
