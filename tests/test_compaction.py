"""Compaction of landed micro-batches: the same rows before, during and after it, and what goes on landing."""

import pytest
from pyspark.sql import functions as F

from perkline.streaming import events as S
from perkline.streaming import segments
from tests.test_sources_streaming import event, landed, messages


def feed(spark, source, start, n):
    values = [event((start + i) % 9, process_date=f"2024-01-{1 + i % 3:02d}") for i in range(n - 1)] + ["{bad"]
    messages(spark, [(v, start + i) for i, v in enumerate(values)]).coalesce(1).write.mode("append").json(source)


def run(spark, source, root, checkpoint, limit=None):
    return S.ingest(S.stream_source(spark, path=source, max_files=1), root, checkpoint, max_messages=limit)


def files(tmp_path, part=""):
    return sorted(p for p in (tmp_path / "out" / part).rglob("*.parquet"))


def test_replay_across_compactions(spark, tmp_path):
    source, root, checkpoint, plain = (str(tmp_path / n) for n in ("in", "out", "cp", "plain"))
    for k in range(3):
        feed(spark, source, 10 * k, 6)
    assert S.compact(spark, root, checkpoint) == 0  # nothing has run
    run(spark, source, root, checkpoint)
    early, progress = S.read_sink(spark, root, "events"), S.read_sink(spark, root, "progress")  # planned by the folders of the batches
    before, counts = landed(spark, root), progress.drop("batch_id").collect()
    assert S.compact(spark, root, checkpoint) == 4 and S.compact(spark, root, checkpoint) == 0
    assert landed(spark, root) == before and early.count() == len(before[0])
    assert sorted(S.read_sink(spark, root, "progress").drop("batch_id").collect()) == sorted(counts)
    merged = segments.segments(spark, f"{root}/events")
    assert [(s.low, s.high) for s in merged] == [(0, 2)]
    per_date = [len(list(p.glob("*.parquet"))) for p in (tmp_path / "out" / "events_segments" / "data").glob("segment=*/process_date=*")]
    assert per_date == [1, 1, 1]
    assert S.remove_compacted(spark, root) > 0 and not files(tmp_path, "events") and landed(spark, root) == before
    assert S.remove_compacted(spark, root) == 0
    feed(spark, source, 5, 6)  # ids of merged and removed batches are not accepted again
    run(spark, source, root, checkpoint)
    run(spark, source, plain, str(tmp_path / "plain-cp"))
    assert landed(spark, root) == landed(spark, plain)
    assert S.compact(spark, root, checkpoint) == 4 and landed(spark, root) == landed(spark, plain)
    # a stream with another checkpoint sees what the first one has landed, merged or not
    S.remove_compacted(spark, root)
    assert run(spark, source, root, str(tmp_path / "other")) == 24
    assert run(spark, source, root, str(tmp_path / "third")) == 24  # two other streams, one of them merged
    assert landed(spark, root)[:2] == landed(spark, plain)[:2]


def test_batches_with_a_rest_wait(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for k in range(2):
        feed(spark, source, 10 * k, 6)
    assert run(spark, source, root, checkpoint, 8) == 8  # ends inside the second batch
    S.compact(spark, root, checkpoint)
    assert [(s.low, s.high) for s in segments.segments(spark, f"{root}/progress")] == [(0, 0)]
    assert run(spark, source, root, checkpoint, 2) == 2 and run(spark, source, root, checkpoint) == 2
    expected = landed(spark, root)
    S.compact(spark, root, checkpoint)
    S.remove_compacted(spark, root)
    assert landed(spark, root) == expected
    assert S.read_sink(spark, root, "progress").agg(F.sum("consumed")).first()[0] == 12
    assert not files(tmp_path, "events") and not files(tmp_path, "dead_letters")


def test_segments_merge_geometrically(spark, tmp_path):
    folder = str(tmp_path / "t")
    schema = spark.sql("select 1L v, '' stream_id, 0L batch_id limit 0").schema
    spans = []
    for batch in range(8):
        rows = spark.range(3).select((F.col("id") + 10 * batch).alias("v"), F.lit("s").alias("stream_id"), F.lit(batch).cast("long").alias("batch_id"))
        rows.write.mode("append").partitionBy("stream_id", "batch_id").parquet(folder)
        segments.merge(spark, folder, schema, "s", batch, [])
        spans.append([s.high - s.low + 1 for s in segments.segments(spark, folder)])
    assert spans == [[1], [2], [2, 1], [4], [4, 1], [4, 2], [4, 2, 1], [8]]
    assert sorted(r.v for r in segments.read(spark, folder, schema).collect()) == sorted(10 * b + i for b in range(8) for i in range(3))


def test_a_broken_merge_changes_nothing(spark, tmp_path, monkeypatch):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    feed(spark, source, 0, 6)
    run(spark, source, root, checkpoint)
    before = landed(spark, root)

    def broken(**_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(segments, "asdict", lambda s: broken())  # after the data, before the list
        with pytest.raises(OSError, match="lost"):
            S.compact(spark, root, checkpoint)
    assert segments.segments(spark, f"{root}/events") == [] and landed(spark, root) == before
    assert S.compact(spark, root, checkpoint) == 4 and landed(spark, root) == before
