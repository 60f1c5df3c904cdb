"""Rule documents and validity windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from perkline.operators.calendar import distinct_dates, join_asof_rule, number_dates, rule_per_date
from perkline.plans import rules as R
from tests.domain import three_rules

DOC = ('{"rule_version":"2026-01","effective_from":"2026-01-01","office_address":"x","bonus_rate":0.05,"wellbeing_days":5,'
       '"min_activities_per_year":15,"max_km_walk_run":15,"max_km_cycle_scooter_other":25,'
       '"sportive_transport_modes":["marche","velo"]}')


def docs(spark, *documents):
    return spark.createDataFrame([(str(i), d) for i, d in enumerate(documents)], "id string, document string")


def test_windows(spark):
    found = {r.rule_version: (r.valid_from_inclusive, r.effective_to_exclusive, r.is_current)
             for r in R.rules_validity(three_rules(spark), "2024-01-31").collect()}
    assert found == {
        "r1": (dt.date(1900, 1, 1), dt.date(2024, 1, 10), False),
        "r2": (dt.date(2024, 1, 10), dt.date(2024, 6, 1), True),
        "r3": (dt.date(2024, 6, 1), None, False),
    }


def test_latest_may_be_a_future_rule(spark):
    assert [r.rule_version for r in R.rules_history(three_rules(spark)).filter("is_latest").collect()] == ["r3"]


def test_current_counts_from_the_effective_date(spark):
    early = R.rules_validity(three_rules(spark), "2022-12-31")
    assert R.rules_current(early).count() == 0
    dates = spark.sql("select date'2022-12-31' as snapshot_date")
    assert rule_per_date(dates, early, ["rule_version"]).first().rule_version == "r1"


def test_equal_effective_dates_leave_an_empty_window(spark):
    rules = three_rules(spark)
    twin = rules.filter("rule_version = 'r2'").withColumns({
        "rule_version": F.lit("r2b"), "loaded_at": F.expr("loaded_at + interval 1 hour")})
    first_twin = rules.filter("rule_version = 'r1'").withColumn("rule_version", F.lit("r1b"))
    v = R.rules_validity(rules.union(twin).union(first_twin), "2024-01-31")
    w = {r.rule_version: (r.valid_from_inclusive, r.effective_to_exclusive, r.is_current) for r in v.collect()}
    assert w["r1"] == (dt.date(1900, 1, 1), dt.date(2023, 1, 1), False)
    assert w["r1b"] == (dt.date(2023, 1, 1), dt.date(2024, 1, 10), False)
    assert w["r2"] == (dt.date(2024, 1, 10), dt.date(2024, 1, 10), False)
    assert w["r2b"] == (dt.date(2024, 1, 10), dt.date(2024, 6, 1), True)
    asof = rule_per_date(spark.sql("select date'2024-01-10' as snapshot_date"), v, ["rule_version"])
    assert asof.first().rule_version == "r2b"


def test_asof_boundary(spark, rows):
    facts = spark.sql("select * from values (1, date'2024-01-09'), (2, date'2024-01-10'), (3, date'2024-06-01'), "
                      "(4, date'1899-12-31'), (5, cast(null as date)) as t(id, d)")
    found = join_asof_rule(facts, "d", R.rules_validity(three_rules(spark), "2024-01-31"), ["rule_version"])
    assert rows(found.select("id", "rule_version")) == [(1, "r1"), (2, "r2"), (3, "r3")]


def test_number_dates(spark, rows):
    dates = spark.sql("select explode(array(date'2024-01-01', date'2024-01-03', date'2024-01-10')) as activity_date")
    found = number_dates(distinct_dates(dates), 2).select("date_pos", "expiry_pos")
    assert rows(found) == [(1, 3), (2, 3), (3, 4)]


def test_flatten(spark, rows):
    found = R.flatten_rules(docs(spark, DOC), ["id"], "document")
    assert found.count() == 9
    nested = docs(spark, '{"a":{"b":{"c":1.5,"d":null},"e":{}},"f":[1,{"g":2}],"h":true,"i":"x","j":"1"}')
    assert rows(R.flatten_rules(nested, ["id"], "document").drop("id")) == [
        ("a.b.c", "1.5", "float"), ("a.b.d", "null", "NoneType"), ("f", '[1,{"g":2}]', "array"),
        ("h", "true", "bool"), ("i", '"x"', "str"), ("j", '"1"', "str")]


def test_flatten_has_no_depth_limit(spark, rows):
    deep = '{"k":' * 30 + '"}{"' + "}" * 30
    assert rows(R.flatten_rules(docs(spark, deep), ["id"], "document").drop("id")) == [(".".join("k" * 30), '"}{"', "str")]
    assert R.flatten_rules(docs(spark, "{}"), ["id"], "document").count() == 0


def test_flatten_keeps_numbers(spark, rows):
    text = '{"a":1.0,"b":1e3,"c":12345678901234567890,"d":-0.0,"e":[1,[2.5,{"x":1.0}]],"f":"é","g":-7,"h":"12"}'
    assert rows(R.flatten_rules(docs(spark, text), ["id"], "document").drop("id")) == [
        ("a", "1.0", "float"), ("b", "1000.0", "float"), ("c", "12345678901234567890", "int"), ("d", "-0.0", "float"),
        ("e", '[1,[2.5,{"x":1.0}]]', "array"), ("f", '"é"', "str"), ("g", "-7", "int"), ("h", '"12"', "str")]


def test_flatten_in_one_pass(spark, rows):
    """The machine's own traps: escapes, marks inside strings, white space, empty names and lists, texts without an object."""
    texts = {
        '{ "a\\"{" : { "b.c" : "x\\\\" } ,\n "l" : [ "]" , { "k" : [ ] } ] , "e" : "" }': [
            ('a"{.b.c', '"x\\\\"', "str"), ("e", '""', "str"), ("l", '["]",{"k":[]}]', "array")],
        '{"":{"a":1},"b":{"":2},"n":{"":{"":[]}}}': [("a", "1", "int"), ("b.", "2", "int"), ("n..", "[]", "array")],
        '{"a":{},"b":[{}],"\\u00e9":{"c":"\\u00e9\\n"}}': [("b", "[{}]", "array"), ("é.c", '"é\\n"', "str")],
        "[1, {\"a\": 2}]": [("", '[1,{"a":2}]', "array")], " 3 ": [("", "3", "int")], "null": [("", "null", "NoneType")]}
    for text, leaves in texts.items():
        assert rows(R.flatten_rules(docs(spark, text), ["id"], "document").drop("id")) == leaves, text
    none = spark.sql("select 1 id, cast(null as string) document")
    assert rows(R.flatten_rules(none, ["id"], "document")) == [(1, "", "null", "NoneType")]
    for broken in ('{"a":', '{"a" 1}', "{]", "", '{"a":"\x02"}'):
        with pytest.raises(Exception, match="MALFORMED_RECORD|PARSE"):
            R.flatten_rules(docs(spark, broken), ["id"], "document").collect()


def test_flatten_plan_does_not_follow_the_depth(spark):
    flat, deep = (R.flatten_rules(docs(spark, t), ["id"], "document") for t in ('{"a":1}', '{"k":' * 40 + "1" + "}" * 40))
    plans = [f._jdf.queryExecution().executedPlan().toString().count("Generate") for f in (flat, deep)]
    assert plans == [1, 1] and deep.first().rule_path == ".".join("k" * 40)


def test_missing_keys(spark):
    broken = docs(spark, DOC, DOC.replace('"wellbeing_days":5,', "").replace('"bonus_rate":0.05,', ""), "[1]")
    complete, rejects = R.split_rule_documents(broken)
    assert complete.count() == 1
    found = {r.id: r.missing_keys for r in rejects.collect()}
    assert found["1"] == ["bonus_rate", "wellbeing_days"] and len(found["2"]) == 8
    with pytest.raises(Exception, match="without its mandatory keys: bonus_rate, wellbeing_days"):
        R.require_rule_keys(broken.filter("id < 2")).collect()


def test_wide_row_and_missing_modes(spark):
    without = DOC.replace(',"sportive_transport_modes":["marche","velo"]', "")
    df = docs(spark, DOC, without).withColumn("loaded_at", F.lit("2026-01-01").cast("timestamp"))
    wide = {r.sportive_transport_modes: r for r in R.rules_wide(df).collect()}
    assert wide['["marche","velo"]'].rules_payload == DOC
    assert wide["[]"].rules_payload == without[:-1] + ',"sportive_transport_modes":[]}'
    assert float(wide["[]"].bonus_rate) == 0.05 and wide["[]"].effective_from == dt.date(2026, 1, 1)


def test_parameters_follow_their_version(spark, rows):
    parameters = spark.sql("select 'r2' rule_version, 'p' rule_path, '1' rule_value_json, 'int' value_type, "
                           "timestamp'2024-01-01' loaded_at union all select 'gone', 'p', '1', 'int', timestamp'2024-01-01'")
    history = R.rule_parameters_history(parameters, R.rules_validity(three_rules(spark), "2024-01-31"))
    assert rows(R.rule_parameters_current(history).select("rule_version", "is_latest")) == [("r2", True)]


def test_documents_are_flattened_by_many_tasks_and_never_broadcast(spark):
    docs = spark.range(50).selectExpr("concat('r', id) rule_version", """concat('{"a":', id, ',"b":{"c":1}}') rules_payload""")
    dealt = R.spread_documents(docs.coalesce(1), documents_per_task=10)
    assert dealt.rdd.getNumPartitions() == 5 and sorted(dealt.collect()) == sorted(docs.collect())
    assert R.spread_documents(docs.filter("false")).isEmpty()
    windows = docs.selectExpr("rule_version", "date'2024-01-01' effective_from", "cast(null as date) effective_to_exclusive",
                              "rule_version = 'r7' is_current")
    flat = R.flatten_rules(dealt).withColumn("loaded_at", F.lit(None).cast("timestamp"))
    history = R.rule_parameters_history(flat, windows)
    assert history.count() == 100 and R.rule_parameters_current(history).count() == 2
    assert "Broadcast" not in history._jdf.queryExecution().executedPlan().toString()
