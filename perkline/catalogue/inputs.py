"""Driver tables as domain tables.

Every domain table is derived from the given tables by Spark and grows with them. Defects (missing
ids, unreadable dates, replays, ties) are built in by key arithmetic on whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkline.functions import row_hash
from perkline.plans import rules as R
from perkline.sources.landing import EMPLOYEE_HEADERS

AS_OF = "2024-01-31"
AS_OF_TS = "2024-01-31 12:00:00"
RUNS_AS_OF_TS = "2001-08-02 00:00:00"
SHORT_WINDOW = 7
INGEST_DATE = "2024-01-20"
# a rule nested twelve levels deep, and numbers of every kind
DEEP = '{"l1":{"l2":{"l3":{"l4":{"l5":{"l6":{"l7":{"l8":{"l9":{"l10":{"l11":"é}"}}}}}}}}}}}'
NUMBERS = '"one":1.0,"thousand":1e3,"big":12345678901234567890,"under":-0.25,"list":[[1,{"a":2.5}],"é"]'

# Schemas as stored, so that reading a table starts no inference job.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


EMPLOYEE_SQL = {
    "employee_id": "case when k % 97 <> 13 then string(k) end",
    "last_name": "concat(' Name', k, ' ')",
    "first_name": "case when k % 11 <> 0 then concat('First', c_nationkey) end",
    "birth_date_raw": "string(20000 + k % 9000)",
    "business_unit": "concat(c_mktsegment, ' ')",
    "hire_date_raw": """case when k % 50 = 7 then '' when k % 4 = 0 then string(40000 + k % 4000)
        when k % 4 = 1 then date_format(date_add(date'2009-07-06', int(k % 4000)), 'yyyy-MM-dd 00:00:00')
        when k % 4 = 2 then concat(40000 + k % 4000, '.5') else concat(40000 + k % 4000, '.0') end""",
    "gross_salary_raw": """case when k % 101 = 5 then '0' when k % 103 = 7 then ''
        else concat(20000 + k % 400 * 100 + (version - 1) * 500, '.50') end""",
    "contract_type": """case when k % 89 = 3 then ' Interim'
        else array('CDI', 'CDD', 'Stage', 'Alternance', 'Freelance')[int(k % 5)] end""",
    "cp_days_raw": "case when k % 53 = 9 then '' else string(20 + k % 10) end",
    "home_address": """case when k % 71 = 2 then null when k % 73 = 4 then 'sans code'
        else concat(' No ', k % 90, ', ', 10000 + (k * 37) % 80000, ' City', c_nationkey) end""",
    "declared_transport_mode": """array('Vélo', 'Marche/running', ' Trottinette ', 'VÉLO', 'Transports en commun',
        'Vélo/Trottinette/Autres', '', null)[int((k + version) % 8)]""",
}


def _batch_columns(prefix: str, source_file: str) -> list[str]:
    """Lineage of the landing batches: version 2 is the later delivery."""
    return [
        f"concat('{prefix}-', version) ingestion_id",
        "case when version = 2 then timestamp'2024-01-20 06:00:00' else timestamp'2024-01-05 06:00:00' end ingested_at",
        "case when version = 2 then date'2024-01-20' else date'2024-01-05' end process_date",
        f"'{source_file}' source_file",
    ]


def employees_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows of employees: two batches, with ties inside the first."""
    delivered = """explode(case when k % 3 = 0 and k % 7 = 0 then array(1, 2, 3) when k % 3 = 0 then array(1, 2)
                   when k % 7 = 0 then array(1, 3) else array(1) end) version"""
    base = table(spark, sf_dir, "customer").selectExpr("c_custkey k", "c_nationkey", "c_mktsegment").selectExpr("*", delivered)
    landed = base.selectExpr(*_batch_columns("hr", "employees.csv"), *[f"{sql} {name}" for name, sql in EMPLOYEE_SQL.items()])
    return landed.withColumn("row_hash", row_hash([F.col(c) for c in EMPLOYEE_HEADERS.values()]))


def declarations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey k", "explode(case when c_custkey % 4 = 1 then array(1, 2) else array(1) end) version")
    return base.selectExpr(
        *_batch_columns("sport", "sports.csv"),
        "case when k % 97 <> 13 then string(k) end employee_id",
        "array('Running ', '', '  ', 'Vélo', null, ' Natation')[int((k + version) % 6)] declared_sport",
    ).withColumn("row_hash", row_hash([F.col("employee_id"), F.col("declared_sport")]))


def activities_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event landing rows. Replays repeat an id at a later offset with another payload."""
    base = table(spark, sf_dir, "events").selectExpr(
        "event_id e", "user_id", "event_type", "timestamp(ts) ts", "date(ts) day",
        "date_add(date(ts), int(event_id % 3)) process_date", "value", "props",
        "explode(case when event_id % 10 = 3 then array(1, 2) else array(1) end) version")
    payload = """concat_ws('', '{"activity_id":"', e, '"', case when e % 40 <> 11 then concat(',"employee_id":"', user_id, '"') end,
        ',"activity_type":"', upper(event_type), '"', case when e % 60 <> 29 then concat(',"activity_date":"', day, '"') end,
        ',"distance_km":', case when e % 50 = 17 then '-1.00'
            else string(cast(cast(value as decimal(10,2)) + cast(version - 1 as decimal(10,2)) as decimal(10,2))) end,
        ',"duration_min":', case when e % 8 = 0 then '0' else get_json_object(props, '$.k') end,
        ',"calories_burned":', e % 500 + 100, ',"source_system":"feed","event_ts":"',
        date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), 'Z","process_date":"', process_date, '"}')"""
    return base.selectExpr(
        "string(e) event_id",
        "process_date",
        "'sport_activities' topic",
        "int(user_id % 4) partition_id",
        "case when version = 2 then e + 1000000000 else e end offset_id",
        "case when version = 2 and e % 20 = 3 then ts + interval 1 second else ts end event_ts",
        "case when version = 2 then ts + interval 60 minute else ts + interval 1 minute end consumed_at",
        f"{payload} payload_json",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic messages: the events with their replays, and some unreadable values."""
    return activities_raw(spark, sf_dir).selectExpr(
        "get_json_object(payload_json, '$.employee_id') key",
        "case when offset_id % 100 = 57 then concat('{bad ', event_id) else payload_json end value",
        "topic", "partition_id partition", "offset_id offset", "consumed_at timestamp",
    )


def rule_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested JSON rule document per supplier, effective over about three months."""
    document = f"""concat_ws('', '{{"rule_version":"r', k, '","effective_from":"', date_add(date'2023-11-10', int((k * 13) % 97)),
        '","office_address":"Site ', k, '","bonus_rate":0.0', k % 5 + 3, ',"wellbeing_days":', k % 4 + 3,
        ',"min_activities_per_year":', k % 20 + 5, ',"max_km_walk_run":', k % 10 + 8,
        ',"max_km_cycle_scooter_other":', k % 12 + 15,
        case when k % 10 <> 9 then concat(',"sportive_transport_modes":', array('["velo","marche/running"]',
            '["velo","vélo","marche/running","trottinette"]', '["marche/running","trottinette"]')[int(k % 3)]) end,
        ',"limits":{{"city":{{"max":', k % 7, '}},"note":null,"ratio":1.5,{NUMBERS},"deep":{DEEP},"empty":{{}}}},"active":true}}')"""
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey k").selectExpr(
        "concat('r', k) rule_version", f"{document} document",
        "timestampadd(MINUTE, int(k), timestamp'2024-01-01 00:00:00') loaded_at")


def rules_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.rules_wide(rule_documents(spark, sf_dir))


def validity(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    return R.rules_validity(rules_raw(spark, sf_dir), as_of)


def parameters_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = R.spread_documents(rule_documents(spark, sf_dir))
    normalized = docs.withColumn("document", R.normalize_rules_payload(F.col("document")))
    return R.flatten_rules(normalized, ["rule_version", "loaded_at"], "document").select(
        "rule_version", "rule_path", "rule_value_json", "value_type", "loaded_at")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a run log."""
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('dag_', o_orderkey % 5) dag_id",
        "string(o_orderkey) run_id",
        "'scheduled' run_type",
        "case o_orderstatus when 'F' then 'success' when 'O' then 'failed' else 'running' end state",
        "o_custkey % 2 = 0 external_trigger",
        "timestamp(o_orderdate) execution_date",
        "timestamp(o_orderdate) data_interval_start",
        "timestamp(o_orderdate) + interval 1 day data_interval_end",
        "timestamp(o_orderdate) + interval 1 minute queued_at",
        "case when o_orderkey % 37 <> 0 then timestampadd(SECOND, int(o_orderkey % 3600), timestamp(o_orderdate)) end start_date",
        """case when o_orderkey % 37 <> 0 and o_orderstatus <> 'P'
           then timestampadd(SECOND, int(o_orderkey % 3600 + o_custkey % 5000), timestamp(o_orderdate)) end end_date""",
    )


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as task instances of the runs."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('dag_', l_orderkey % 5) dag_id",
        "string(l_orderkey) run_id",
        """case when l_linestatus = 'F' and l_returnflag <> 'R' then 'success' when l_linestatus = 'F' then 'failed'
           when l_returnflag = 'A' then 'running' when l_returnflag = 'N' then 'queued' else 'skipped' end state""",
    )


def long_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as silver activities: more than six years, so the 365-day window moves."""
    return table(spark, sf_dir, "orders").selectExpr(
        "string(o_orderkey) activity_id",
        "string(o_custkey) employee_id",
        "date_add(date(o_orderdate), int(o_orderkey % 3)) process_date",
        "date(o_orderdate) activity_date",
        "cast(o_totalprice as decimal(10,2)) distance_km",
        "int(o_orderkey % 120) duration_min",
        "o_orderkey % 120 > 0 is_valid_activity",
    )


def faulty_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Orders and customers with planted failures of every kind of check."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "case when o_orderkey % 40 <> 1 then o_orderkey - o_orderkey % 3 end order_id",
        "case when o_orderkey % 50 <> 2 then o_custkey end customer_id", "o_orderstatus status",
        "cast(o_totalprice as decimal(12,2)) - 20000 amount", "case when o_orderkey % 7 <> 0 then o_orderkey % 5 end priority")
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey customer_id").filter("customer_id % 10 <> 3")
    return {"orders": orders, "customers": customers}
