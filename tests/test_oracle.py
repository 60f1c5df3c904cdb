"""Registered queries against their DuckDB SQL on the smallest tables.

``PERKLINE_ALL=1`` compares every query; by default a cross-section of the models is compared.
"""

import os

import pytest

from perkline.catalogue.oracle import ORACLE
from perkline.catalogue.queries import QUERIES
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
CROSS_SECTION = (
    "land_table", "replace_batch", "excel_serial_to_date", "pseudo_geocode_sha", "flatten_rules", "rules_history",
    "sil_employees", "sil_sport_activities", "gold_kpi_employee_status", "gold_employee_benefit_timeline_7d",
    "gold_quality_anomalies", "monitoring_runs", "dash_recent_runs", "bi_distribution", "stream_notify_once",
    "flatten_event_props", "rules_wide", "validation_suite_faults", "validation_report", "lenient_cast_rejects",
    "gold_kpi_finance", "join_cross_scalars", "lead_next", "dash_flow_series", "stream_dedup_first", "stream_progress_metrics",
    "agg_timeline_daily_long", "monitoring_activity_volumes_daily", "upsert_by_key",
)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("PERKLINE_ALL") else CROSS_SECTION)
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, SF, QUERIES[name], ORACLE[name]) is None
