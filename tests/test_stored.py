"""Tables on storage: what a batch rewrites, what it reads, and schemas that widen."""

import re

import pytest
from pyspark.sql import functions as F

from perkline.sources import stored, tables


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("bucket=*/*.parquet")}


def buckets(names):
    return {int(re.search(r"bucket=(\d+)", n).group(1)) for n in names}


def table(spark, n=200):
    return spark.range(n).selectExpr("string(id) k", "int(id) v", "0 at")


def test_a_batch_rewrites_its_buckets_only(spark, rows, tmp_path):
    path = str(tmp_path)
    stored.create_keyed(table(spark), path, ["k"], buckets=16)
    before = files(tmp_path)
    batch = spark.createDataFrame([("7", -1, 1), ("7", -2, 2), ("new", -3, 1), (None, -4, 1)], "k string, v int, at int")
    touched = {r[0] for r in batch.select(F.pmod(F.xxhash64("k"), F.lit(16))).distinct().collect()}
    stored.upsert_stored(path, batch, ["at"])
    after = files(tmp_path)
    assert buckets(n for n in before if after.get(n) != before[n]) <= touched
    assert {n for n in before if buckets([n]).isdisjoint(touched)} <= {n for n in after if after[n] == before.get(n)}
    expected = tables.upsert_by_key(table(spark), batch, ["k"], ["at"])
    assert rows(stored.read_keyed(spark, path)) == rows(expected)
    stored.upsert_stored(path, batch, ["at"])
    assert rows(stored.read_keyed(spark, path)) == rows(expected)


def test_replace_and_insert_equal_the_plain_forms(spark, rows, tmp_path):
    old = spark.range(60).selectExpr("string(id % 20) k", "int(id) v", "0 at")
    new = spark.createDataFrame([("3", 500, 1), ("x", 501, 1), (None, 502, 1)], "k string, v int, at int")
    stored.create_keyed(old, str(tmp_path / "a"), ["k"], buckets=8)
    stored.replace_stored(str(tmp_path / "a"), new)
    assert rows(stored.read_keyed(spark, str(tmp_path / "a"))) == rows(tables.replace_by_key(old, new, ["k"]))
    stored.create_keyed(old, str(tmp_path / "b"), ["k"], buckets=8)
    before = files(tmp_path / "b")
    twice = new.unionByName(new.withColumn("v", F.col("v") - 100))
    for _ in range(2):
        stored.insert_stored(str(tmp_path / "b"), twice, [F.asc("v")])
    added = stored.read_keyed(spark, str(tmp_path / "b")).filter("v >= 100").collect()
    assert {tuple(r) for r in added} == {("x", 401, 1), (None, 402, 1)} and len(added) == 2
    assert all(files(tmp_path / "b")[n] == t for n, t in before.items())


def test_untouched_buckets_are_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    stored.create_keyed(table(spark), path, ["k"], buckets=16)
    plans = []
    stage = stored.stage_table
    monkeypatch.setattr(stored, "stage_table", lambda df, name: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or stage(df, name))
    stored.insert_stored(path, spark.createDataFrame([("7", 1, 1)], "k string, v int, at int"), [F.asc("v")])
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#", plans[-1]) and "ReadSchema: struct<k:string>" in plans[-1]
    found = stored.find_stored(spark, path, ["7", "8", "none"])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.v for r in found.collect()) == [7, 8] and "In(k, [7,8,none])" in text


def test_batches_of_two_layouts_read_back_as_one(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    batches = ["select 1 k, 'a' name, cast(1.5 as decimal(4,1)) amount, 1 b", "select 5000000000 k, 'b' name, 'x' segment, 2 b",
               "select 3 k, cast(12345.25 as decimal(9,2)) amount, 3 b", "select 9 k, 'again' name, 1 b"]
    for sql in batches:
        stored.write_evolving(spark.sql(sql), path, ["b"])
    got = stored.read_stored(spark, path)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema.fields] == [
        ("k", "bigint"), ("name", "string"), ("amount", "decimal(9,2)"), ("b", "int"), ("segment", "string")]
    assert sorted((r.k, r.name, r.amount and str(r.amount), r.segment) for r in got.collect()) == [
        (3, None, "12345.25", None), (9, "again", None, None), (5000000000, "b", None, "x")]
    with pytest.raises(ValueError, match="name"):
        stored.write_evolving(spark.sql("select 1 k, 7 name, 4 b"), path, ["b"])
    assert rows(stored.read_stored(spark, path)) == rows(got)


def test_a_keyed_table_gains_columns(spark, tmp_path):
    path = str(tmp_path)
    stored.create_keyed(table(spark, 30), path, ["k"], buckets=4)
    stored.upsert_stored(path, spark.sql("select '3' k, 5000000000 v, 1 at, 'n' note"), ["at"])
    got = {r.k: (r.v, r.note) for r in stored.read_keyed(spark, path).collect()}
    assert got["3"] == (5000000000, "n") and got["4"] == (4, None) and len(got) == 30
