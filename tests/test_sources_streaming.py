"""Landing, idempotent writes and the event stream."""

import json

import pytest
from pyspark.sql import functions as F

from perkline.sources import jsonl, landing, tables
from perkline.streaming import events as S
from tests.domain import messages


def test_land_table_keeps_nulls_and_hashes_content(spark):
    source = spark.sql("select 7.0d as `ID salarié`, 'Judo' as `Pratique d'un sport` union all select null, null")
    runs = [landing.land_table(source, landing.DECLARATION_HEADERS, "s.csv", "2024-01-05", run, "2024-01-05 00:00:00")
            for run in ("r1", "r2")]
    first, second = [{r.employee_id: r for r in df.collect()} for df in runs]
    assert set(first) == {"7", None} and first[None].declared_sport is None
    assert first["7"].row_hash == second["7"].row_hash != first[None].row_hash


def test_replace_batch_is_idempotent(spark, rows):
    old = spark.sql("select * from values ('f', date'2024-01-01', 1), ('f', date'2024-01-02', 2), (null, date'2024-01-01', 3) as t(source_file, process_date, v)")
    new = spark.sql("select * from values ('f', date'2024-01-01', 10) as t(source_file, process_date, v)")
    once = tables.replace_batch(old, new)
    assert sorted(r.v for r in once.collect()) == [2, 3, 10]
    assert rows(tables.replace_batch(once, new)) == rows(once)


def test_write_batches_replaces_only_its_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = "select * from values ('f', date'2024-01-0{d}', {v}) as t(source_file, process_date, v)"
    for d, v in ((1, 1), (2, 2), (1, 10), (1, 10)):
        tables.write_batches(spark.sql(frame.format(d=d, v=v)), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [2, 10]


def test_upserts(spark, rows):
    old = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "k string, v int, at int")
    new = spark.createDataFrame([("a", 2, 2), ("a", 3, 3), ("c", 4, 1)], "k string, v int, at int")
    assert rows(tables.upsert_by_key(old, new, ["k"], ["at"])) == [("a", 3, 3), ("b", 1, 1), ("c", 4, 1)]
    assert rows(tables.replace_by_key(old, new, ["k"])) == [("a", 2, 2), ("a", 3, 3), ("b", 1, 1), ("c", 4, 1)]


def test_insert_if_absent_takes_the_first_arrival(spark, rows):
    held = spark.createDataFrame([("a", 0)], "k string, at int")
    batch = spark.createDataFrame([("a", 1), ("b", 3), ("b", 2)], "k string, at int")
    assert rows(tables.insert_if_absent(held, batch, "k", [F.asc("at")])) == [("b", 2)]


def test_evolve_schema(spark, rows):
    assert rows(tables.evolve_schema(spark.sql("select 1 a"), spark.sql("select 2 b"))) == [(1, None), (None, 2)]


def test_backfill_range(spark):
    assert landing.backfill_dates(spark, "2024-02-28", "2024-03-01").count() == 3
    with pytest.raises(ValueError):
        landing.backfill_dates(spark, "2024-03-01", "2024-02-28")
    with pytest.raises(ValueError):
        landing.backfill_slice(spark.sql("select date'2024-01-01' process_date"), "2024-03-01", "2024-02-28")


def test_jsonl_partition_replay(spark, tmp_path):
    path = str(tmp_path / "j")
    df = spark.sql("select '1' activity_id, cast(1.5 as decimal(10,2)) distance_km, date'2024-01-01' process_date")
    jsonl.write_jsonl(df, path)
    jsonl.write_jsonl(df, path)
    assert [(r.activity_id, str(r.distance_km)) for r in jsonl.read_jsonl(spark, path).collect()] == [("1", "1.50")]


def test_publish_rows(spark):
    row = jsonl.publish_rows(spark.sql("select 1 id, 'x' v"), "id").first()
    assert row.key == "1" and json.loads(row.value) == {"id": 1, "v": "x"}


# --- streaming -------------------------------------------------------------------------------

def event(i, day="2024-01-02", process_date="2024-01-02", **extra):
    body = {"activity_id": f"a{i}", "employee_id": f"e{i % 3}", "activity_type": "Run", "activity_date": day,
            "distance_km": 5.0, "duration_min": 30, "event_ts": f"{day}T10:00:00+00:00", **extra}
    if process_date:
        body["process_date"] = process_date
    return json.dumps(body)


def test_parse_events(spark):
    bad = ["{bad", "[]", "null", '{"activity_id": "x"}', event(9, day="2024-13-45", process_date=None)]
    df = messages(spark, [(event(1, process_date=None), 1), (event(2, process_date="2024-01-05"), 2)]
                  + [(b, 10 + i) for i, b in enumerate(bad)])
    parsed = S.parse_events(df)
    good = {r.event_id: str(r.process_date) for r in S.readable_events(parsed).collect()}
    assert good == {"a1": "2024-01-02", "a2": "2024-01-05"}
    assert sorted(r.payload_json for r in S.dead_letters(parsed).collect()) == sorted(bad)


def run_stream(spark, tmp_path, chunks, name, process_date=None, restart_after=None):
    """Feed chunks of (value, offset) through the ingestion; optionally restart after some chunks."""
    source, root, progress = (str(tmp_path / f"{name}-{p}") for p in ("in", "out", "progress"))
    counts = []
    for i, chunk in enumerate(chunks):
        messages(spark, chunk).coalesce(1).write.mode("append").json(source)
        if restart_after is not None and i < restart_after:
            S.drain(S.start_ingest(S.stream_source(spark, path=source, max_files=1), root, progress, process_date,
                                   lambda b, c: counts.append(c)))
    for _ in range(2):  # the second run finds nothing new
        S.drain(S.start_ingest(S.stream_source(spark, path=source, max_files=1), root, progress, process_date,
                               lambda b, c: counts.append(c)))
    return root, counts


def landed(spark, root):
    events = sorted((r.event_id, r.offset_id) for r in S.read_sink(spark, root, "events").collect())
    notes = sorted((r.message_id, r.activity_id, r.message_text) for r in S.read_sink(spark, root, "messages").collect())
    dead = sorted(r.payload_json for r in S.read_sink(spark, root, "dead_letters").collect())
    return events, notes, dead


def test_first_arrival_wins_and_notifies_once(spark, tmp_path):
    first = [(event(i), i) for i in range(6)] + [(event(0, distance_km=9.0), 50), ("{bad", 51)]
    again = [(event(i, distance_km=8.0), 100 + i) for i in range(4, 8)]
    root, counts = run_stream(spark, tmp_path, [first, again, first], "a", process_date="2024-01-03")
    events, notes, dead = landed(spark, root)
    assert events == [(f"a{i}", i if i < 6 else 100 + i) for i in range(8)]
    assert len(notes) == 8 and len({n[0] for n in notes}) == 8 and dead == ["{bad", "{bad"]
    assert notes and all(":runner: Activite Run" in n[2] for n in notes)
    total = {k: sum(c[k] for c in counts) for k in counts[0]}
    assert total == {"consumed": 20, "unreadable": 2, "other_process_date": 18, "accepted": 8, "duplicates": 10}


def test_batch_split_and_restart_do_not_matter(spark, tmp_path):
    everything = [(event(i % 7, distance_km=float(i)), i) for i in range(20)]
    one, _ = run_stream(spark, tmp_path, [everything], "one")
    split, _ = run_stream(spark, tmp_path, [everything[:5], everything[5:6], everything[6:]], "split")
    restarted, _ = run_stream(spark, tmp_path, [everything[:5], everything[5:6], everything[6:]], "restarted", restart_after=2)
    assert landed(spark, one) == landed(spark, split) == landed(spark, restarted)


def test_retried_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path / "sinks")
    S.prepare_sinks(spark, root)
    batch = S.first_arrivals_of_batch(S.parse_events(messages(spark, [(event(1), 1), (event(2), 2), (event(1), 3)])))
    first = S.land_batch(batch, root, "q", 0)
    before = landed(spark, root)
    assert S.land_batch(batch, root, "q", 0) == first == {
        "consumed": 3, "unreadable": 0, "other_process_date": 0, "accepted": 2, "duplicates": 1}
    assert landed(spark, root) == before
    assert S.land_batch(batch, root, "other", 0)["accepted"] == 0  # a new checkpoint starts over at batch 0
    assert landed(spark, root) == before


def test_stream_dedup_with_and_without_horizon(spark, tmp_path):
    source = str(tmp_path / "in")
    for shift in (0, 100):
        messages(spark, [(event(i), i + shift) for i in range(5)]).write.mode("append").json(source)
    for name, horizon in (("plain", None), ("bounded", "1 day")):
        events = S.readable_events(S.parse_events(S.stream_source(spark, path=source)))
        out = str(tmp_path / name)
        S.drain(S.stream_dedup_first(events, out, str(tmp_path / f"{name}-cp"), "event_ts", horizon))
        assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [f"a{i}" for i in range(5)]


def test_a_batch_reads_nothing_that_its_stream_has_landed(spark, tmp_path):
    """The only earlier rows a batch may read are those of streams with another checkpoint."""
    chunks = [[(event(10 * k + i), 10 * k + i) for i in range(3)] for k in range(4)]
    root, counts = run_stream(spark, tmp_path, chunks, "s")
    streams = [p.name.split("=")[1] for p in (tmp_path / "s-out" / "events").iterdir() if p.name.startswith("stream_id=")]
    assert len(streams) == 1 and sum(c["accepted"] for c in counts) == 12
    assert S._other_streams(spark, root, streams[0]) is None
    assert S._other_streams(spark, root, "new").count() == 12
    paths = {"/".join(p.relative_to(tmp_path / "s-out" / "events").parts[1:2]) for p in (tmp_path / "s-out" / "events").rglob("*.parquet")}
    assert paths == {"process_date=2024-01-02"}


def test_first_copy_wins_inside_a_batch(spark, tmp_path):
    copies = [(event(1, distance_km=float(k)), k) for k in (7, 3, 9, 5)]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    messages(spark, copies).write.json(source)
    for name, horizon in (("plain", None), ("bounded", "1 day")):
        events = S.readable_events(S.parse_events(S.stream_source(spark, path=source)))
        S.drain(S.stream_dedup_first(events, f"{out}-{name}", str(tmp_path / f"{name}-cp"), "event_ts", horizon))
        assert [(r.offset_id, json.loads(r.payload_json)["distance_km"]) for r in spark.read.parquet(f"{out}-{name}").collect()] == [(3, 3.0)]


def test_both_branches_of_the_dedup_read_one_source(spark, tmp_path):
    """What the ids are taken from and what is landed must be the same messages, batch by batch."""
    chunks = [[(event(10 * k + i), 10 * k + i) for i in range(3)] for k in range(3)]
    run_stream(spark, tmp_path, chunks, "s")
    assert [p.name for p in (tmp_path / "s-progress" / "sources").iterdir()] == ["0"]


def test_ingestion_runs_without_python_workers(spark, tmp_path):
    source = str(tmp_path / "in")
    messages(spark, [(event(1), 1), ("{bad", 2)]).write.json(source)
    plans = []

    def handle(batch, batch_id):
        decided = S.decide(batch)
        plans.append(decided._jdf.queryExecution().executedPlan().toString())
        decided.write.format("noop").mode("overwrite").save()

    query = (S.first_arrivals(S.parse_events(S.stream_source(spark, path=source))).writeStream.foreachBatch(handle)
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    S.drain(query)
    stream = query._jsq.explainInternal(True) + "".join(plans)
    assert plans and "StreamingDeduplicate" in stream
    assert not any(word in stream for word in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("max_files", [1])
def test_a_limit_lands_exactly_its_messages_and_the_next_run_goes_on(spark, tmp_path, max_files):
    values = [event(i % 9, distance_km=float(i)) for i in range(12)] + ["{bad", event(9), event(10), "[]"]
    chunks = [values[:7], values[7:9], values[9:]]
    source, offset = str(tmp_path / "in"), 0
    for chunk in chunks:
        messages(spark, [(v, offset + k) for k, v in enumerate(chunk)]).coalesce(1).write.mode("append").json(source)
        offset += len(chunk)

    def run(name, limit):
        counts = []
        taken = S.ingest(S.stream_source(spark, path=source, max_files=max_files), str(tmp_path / name), str(tmp_path / f"{name}-cp"),
                         max_messages=limit, on_batch=lambda b, c: counts.append(c))
        assert taken == sum(c["consumed"] for c in counts)
        return taken

    assert run("whole", None) == 16 and run("whole", None) == 0
    total = 0
    for limit in (4, 1, 5, 100):
        taken = run("parts", limit)
        assert taken == min(limit, 16 - total)
        total += taken
        progress = S.read_sink(spark, str(tmp_path / "parts"), "progress").agg(F.sum("consumed")).first()[0]
        assert progress == total
        landed_places = [r.offset_id for r in S.read_sink(spark, str(tmp_path / "parts"), "events").collect()]
        assert all(p < total for p in landed_places)
    assert run("parts", None) == 0
    assert landed(spark, str(tmp_path / "parts")) == landed(spark, str(tmp_path / "whole"))


def test_an_attempt_with_another_limit_replaces_the_first(spark, tmp_path, monkeypatch):
    """A run that breaks off after landing, before its batch is committed, leaves nothing that the next one keeps."""
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    messages(spark, [(event(i, process_date=f"2024-01-{i + 1:02d}"), i) for i in range(8)]).coalesce(1).write.json(source)
    land = S.land_batch

    def broken(*args):
        land(*args)
        raise OSError("lost")

    monkeypatch.setattr(S, "land_batch", broken)
    with pytest.raises(Exception, match="lost"):
        S.ingest(S.stream_source(spark, path=source), root, checkpoint, max_messages=6)
    monkeypatch.setattr(S, "land_batch", land)
    assert S.ingest(S.stream_source(spark, path=source), root, checkpoint, max_messages=3) == 3
    assert sorted(r.offset_id for r in S.read_sink(spark, root, "events").collect()) == [0, 1, 2]
    assert S.ingest(S.stream_source(spark, path=source), root, checkpoint) == 5
    assert sorted(r.offset_id for r in S.read_sink(spark, root, "events").collect()) == list(range(8))


def test_landing_parses_no_message_again_and_keeps_no_text_of_copies(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "sinks")
    S.prepare_sinks(spark, root)
    batch = S.parse_events(messages(spark, [(event(1), 1), ("{bad", 2), (event(1), 3)]))
    rows = S._messages(batch, "2024-01-03")
    new = spark.createDataFrame([("id:a1", True)], "id string, is_new boolean")
    arrivals = rows.withColumn("is_new", F.lit(False)).unionByName(new, allowMissingColumns=True)
    judged = S.decide_messages(arrivals)
    assert sorted((r.offset, r.accepted, r.value is not None) for r in judged.collect()) == [
        (1, True, True), (2, False, True), (3, False, False)]
    expected = S.parse_events(messages(spark, [(event(1), 1)])).drop("is_readable").collect()
    decided = S.decide(arrivals)
    plan = decided._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan  # payloads are sorted behind the shuffle only
    decided = spark.createDataFrame(decided.collect(), decided.schema)
    parsed = []
    monkeypatch.setattr(S, "parse_events", lambda *args: parsed.append(args))
    counts = S.land_batch(decided, root, "q", 0)
    monkeypatch.undo()
    assert parsed == [] and counts == {"consumed": 3, "unreadable": 1, "other_process_date": 2, "accepted": 1, "duplicates": 1}
    assert "process_date" not in judged.columns
    landed_rows = S.read_sink(spark, root, "events").drop("stream_id", "batch_id")
    assert landed_rows.columns == S.parse_events(messages(spark, [])).drop("is_readable").columns
    assert landed_rows.collect() == expected


def test_a_limit_ranks_places_and_not_payloads(spark, tmp_path, monkeypatch):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    # equal places: the same messages delivered twice in one micro-batch
    messages(spark, [(event(i), i) for i in range(6)] * 2).coalesce(1).write.json(source)
    rank, ranked = S.total_order_rank, []

    def watched(df, *args):
        ranked.append(set(df.columns))
        return rank(df, *args)

    monkeypatch.setattr(S, "total_order_rank", watched)
    for limit, taken in ((5, 5), (2, 2), (None, 5), (None, 0)):
        assert S.ingest(S.stream_source(spark, path=source), root, checkpoint, max_messages=limit) == taken
    assert ranked and not any("value" in columns for columns in ranked)
    assert sorted(r.offset_id for r in S.read_sink(spark, root, "events").collect()) == list(range(6))


def test_a_backlog_of_an_earlier_version_is_landed(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    messages(spark, [(event(i), i) for i in range(6)]).coalesce(1).write.json(source)
    assert S.ingest(S.stream_source(spark, path=source), root, checkpoint, max_messages=2) == 2
    path = S._backlog(root, S._stream_of(spark, checkpoint), 0)
    held = spark.read.parquet(path).filter("offset > 1").withColumn("place", F.col("offset") - 1).drop("row")
    held = spark.createDataFrame(held.collect(), held.schema)
    held.write.mode("overwrite").parquet(path)
    for limit, taken in ((1, 1), (None, 3), (None, 0)):
        assert S.ingest(S.stream_source(spark, path=source), root, checkpoint, max_messages=limit) == taken
    landed_rows = S.read_sink(spark, root, "events").collect()
    assert sorted(r.offset_id for r in landed_rows) == list(range(6)) and all(r.process_date and r.event_ts for r in landed_rows)
