"""Event stream: source, parsing, first-wins dedup, one notification per accepted event.

Which ids have been accepted is kept in the state store of the stream, one key each, so a micro-batch looks up
its own ids and never reads what earlier batches have landed.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from py4j.java_gateway import JavaObject
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from perkline.defaults import CHANNEL, TOPIC
from perkline.functions import activity_message
from perkline.functions.dates import as_date
from perkline.operators.ranking import total_order_rank
from perkline.streaming import segments

# Columns of a Kafka-protocol source, as strings.
MESSAGE_COLUMNS = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"

# What parsing needs of a message; its other members are checked as JSON and stay in the payload.
_FIELDS = "activity_id string, activity_date string, event_ts string, process_date string, _corrupt string"


def stream_source(spark: SparkSession, brokers: str | None = None, topic: str = TOPIC, path: str | None = None,
                  max_files: int | None = None, max_offsets: int | None = None) -> DataFrame:
    """Messages from the earliest offset of a topic, or from a folder of message files.

    Progress lives in the query's checkpoint. ``max_*`` bounds the size of a micro-batch.
    Lost offsets are skipped, not fatal.
    """
    if path is not None:
        reader = spark.readStream.schema(MESSAGE_COLUMNS)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.json(path)
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic).option("startingOffsets", "earliest").option("failOnDataLoss", "false")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})


def _with_event(messages: DataFrame) -> DataFrame:
    """Adds ``_event``, the object in the text, and the typed dates of it."""
    event = F.from_json("value", _FIELDS, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    # a value that was read has its key; the keys are only looked for where there is none
    has_process_date = (F.col("_event.process_date").isNotNull() & F.col("_event._corrupt").isNull()) | F.array_contains(
        F.json_object_keys("value"), "process_date")
    processed = F.when(has_process_date, F.col("_event.process_date")).otherwise(F.col("_event.activity_date"))
    return messages.withColumn("_event", event).withColumns(
        {"process_date": processed.try_cast("date"), "event_ts": F.col("_event.event_ts").try_cast("timestamp")})


def parse_events(messages: DataFrame) -> DataFrame:
    """Event rows with ``is_readable``; works on streams and tables alike.

    The processing date falls back to the activity date only when the key is absent. A message is
    readable if it is a JSON object with an id and dates that can be typed.
    """
    row = _with_event(messages).select(
        F.col("_event.activity_id").alias("event_id"),
        "process_date",
        "topic",
        F.col("partition").alias("partition_id"),
        F.col("offset").alias("offset_id"),
        "event_ts",
        F.col("timestamp").alias("consumed_at"),
        F.col("value").alias("payload_json"),
        F.col("_event._corrupt").isNull().alias("_well_formed"),
    )
    complete = F.col("event_id").isNotNull() & F.col("process_date").isNotNull() & F.col("event_ts").isNotNull()
    return row.withColumn("is_readable", F.coalesce(F.col("_well_formed") & complete, F.lit(False))).drop("_well_formed")


def readable_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter("is_readable").drop("is_readable")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Messages that cannot be landed, kept with their position for repair."""
    return parsed.filter("not is_readable").select("topic", "partition_id", "offset_id", "consumed_at", "payload_json")


def _messages(parsed: DataFrame, process_date: str | date | None) -> DataFrame:
    """What deciding and landing need: the message, its place, its key and what was parsed, so that nothing is parsed
    again. Unreadable messages are keys of their own."""
    expected = as_date(process_date) if process_date else F.col("process_date")
    numbers = (F.col(c).cast("string") for c in ("partition_id", "offset_id"))
    place = F.concat_ws(":", F.lit("unreadable"), "topic", *numbers)
    return parsed.select(
        F.when(F.col("is_readable"), F.concat(F.lit("id:"), F.col("event_id"))).otherwise(place).alias("id"),
        F.col("payload_json").alias("value"), "topic", F.col("partition_id").cast("long").alias("partition"),
        F.col("offset_id").cast("long").alias("offset"), F.unix_micros("consumed_at").alias("micros"), "process_date",
        "event_ts", "is_readable",
        F.coalesce(F.col("is_readable") & (F.col("process_date") != expected), F.lit(False)).alias("other_date"))


PARSED = ("process_date", "event_ts")
PLACE = ("partition", "offset", "topic")
MESSAGE = ("value", "topic", "partition", "offset", "micros", "process_date", "event_ts", "is_readable")


def first_arrivals(parsed: DataFrame, process_date: str | date | None = None, event_time: str | None = None,
                   horizon: str | None = None) -> DataFrame:
    """Stream of parsed messages -> the same messages, and one row more (``is_new``) for each id met for the first time.

    Both branches read one source, so they see the same messages in every micro-batch. The new ids come from the
    stream's dedup operator, whose state holds ids and nothing else; which copy it meets does not matter, as
    ``decide`` picks the first of the batch. With a horizon an id is forgotten ``horizon`` of event time after its first copy.
    """
    rows = _messages(parsed, process_date)
    key = F.concat(F.lit("id:"), F.col("event_id")).alias("id")
    readable = parsed.filter("is_readable")
    if horizon is None:
        ids = readable.select(key).dropDuplicates(["id"])
    else:
        ids = readable.withWatermark(event_time, horizon).select(key, event_time).dropDuplicatesWithinWatermark(["id"])
    blank = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c != "id"]
    return rows.withColumn("is_new", F.lit(False)).unionByName(ids.select("id", *blank, F.lit(True).alias("is_new")))


def decide(batch: DataFrame) -> DataFrame:
    """Rows of ``first_arrivals`` of one micro-batch -> one decided row per id, and every unreadable message.

    The copy with the smallest partition and offset stands for the id; it is accepted if the id is new.
    ``copies`` counts the messages a row stands for. Rows meet by id before they are aggregated, so that payloads are
    sorted once and not a second time in front of the shuffle.
    """
    is_message = ~F.col("is_new")
    message = F.struct(*MESSAGE)
    place = F.when(is_message, F.struct("partition", "offset", "topic"))
    return batch.repartition("id").groupBy("id").agg(
        F.min_by(message, place).alias("m"), F.max("is_new").alias("accepted"), F.count_if(is_message).alias("copies"),
        F.count_if("other_date").alias("other_dates"),
    ).filter("m is not null").select("id", "m.*", "accepted", "copies", "other_dates")


def _landable(decided: DataFrame) -> DataFrame:
    """Decided rows as parsed messages again."""
    return decided.select(
        F.when(F.col("is_readable"), F.substr("id", F.lit(len("id:") + 1))).alias("event_id"), "process_date", "topic",
        F.col("partition").cast("int").alias("partition_id"), F.col("offset").alias("offset_id"), "event_ts",
        F.timestamp_micros("micros").alias("consumed_at"), F.col("value").alias("payload_json"), "is_readable")


def _needed_value() -> Column:
    """The text of a decided row if it is landed; of other copies only the number is."""
    return F.when(F.col("accepted") | ~F.col("is_readable"), F.col("value"))


def first_arrivals_of_batch(parsed: DataFrame, process_date: str | date | None = None) -> DataFrame:
    """The decision about one batch that stands alone, without any state: every id is new."""
    rows = _messages(parsed, process_date).withColumn("is_new", F.lit(False))
    return decide(rows).withColumn("accepted", F.col("is_readable"))


def stream_dedup_first(events: DataFrame, path: str, checkpoint: str, event_time: str | None = None,
                       horizon: str | None = None) -> StreamingQuery:
    """Append the first event per id to the table ``path``, and stop when the input is used up.

    First is by partition and offset inside a micro-batch and by batches otherwise. The state store holds ids only. Without
    a horizon they are remembered forever; with one, an id is forgotten ``horizon`` of event time after its first
    copy, so state is bounded. A retried batch replaces its own rows.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        accepted = readable_events(_landable(decide(batch).filter("accepted")))
        (accepted.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    rows = first_arrivals(events.withColumn("is_readable", F.lit(True)), None, event_time, horizon)
    return (rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def notifications(accepted: DataFrame, channel: str = CHANNEL) -> DataFrame:
    """One message per event, with an id derived from the event id so that retries repeat it exactly.

    An event without an employee is notified too; its ``employee_id`` is NULL.
    """
    fields = "employee_id string, activity_type string, activity_date string, distance_km string, duration_min string"
    event = F.from_json("payload_json", fields)
    rows = accepted.withColumn("_event", event)
    measures = [F.col(f"_event.{c}") for c in
                ("activity_type", "employee_id", "activity_date", "distance_km", "duration_min")]
    return rows.select(
        F.sha2(F.concat(F.lit("notification-"), F.col("event_id")), 256).alias("message_id"),
        "process_date",
        F.col("event_id").alias("activity_id"),
        F.col("_event.employee_id").alias("employee_id"),
        F.lit(channel).alias("channel_name"),
        activity_message(*measures).alias("message_text"),
        F.col("consumed_at").alias("generated_at"),
        F.lit("generated").alias("status"),
    )


def _sink(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


SINKS = ("events", "messages", "dead_letters", "progress")
SINK_KEYS = {"events": "process_date", "messages": "process_date"}


def _store(df: DataFrame, root: str, name: str, stream_id: str, batch_id: int) -> None:
    """Overwrite exactly this micro-batch's partitions, so a retried batch replaces itself. Rows of tables by date come
    dealt to dates."""
    keys = ["stream_id", *([SINK_KEYS[name]] if name in SINK_KEYS else []), "batch_id"]
    rows = df.withColumns({"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("bigint")})
    (rows if name in SINK_KEYS else rows.hint("rebalance", *keys)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(_sink(root, name))


def _empty_sinks(spark: SparkSession) -> dict[str, DataFrame]:
    parsed = parse_events(spark.createDataFrame([], MESSAGE_COLUMNS))
    events = readable_events(parsed)
    counts = "consumed long, unreadable long, other_process_date long, accepted long, duplicates long"
    return {"events": events, "messages": notifications(events), "dead_letters": dead_letters(parsed),
            "progress": spark.createDataFrame([], counts)}


def prepare_sinks(spark: SparkSession, root: str) -> None:
    """Create the empty tables if they are missing."""
    for name, df in _empty_sinks(spark).items():
        df.withColumns({"stream_id": F.lit(""), "batch_id": F.lit(0).cast("bigint")}).write.mode("ignore").partitionBy(
            "stream_id", *([SINK_KEYS[name]] if name in SINK_KEYS else []), "batch_id").parquet(_sink(root, name))


def _schema(spark: SparkSession, name: str) -> StructType:
    return _empty_sinks(spark)[name].schema.add("stream_id", "string").add("batch_id", "long")


def read_sink(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the landed tables, with the stream and batch that wrote each row.

    Folders are by stream, processing date and batch, those of compacted batches by date; all readers filter on the date.
    """
    return segments.read(spark, _sink(root, name), _schema(spark, name))


def _other_streams(spark: SparkSession, root: str, stream_id: str) -> DataFrame | None:
    """Ids that streams with another checkpoint have landed; None, and nothing is listed further, if there are none."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(_sink(root, "events"))
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath() for f in store.listStatus(folder) if f.getPath().getName().startswith("stream_id=")]
    others = [p.toString() for p in names if p.getName() != f"stream_id={stream_id}"]
    merged = [s for s in segments.segments(spark, _sink(root, "events")) if s.stream_id != stream_id]
    schema = StructType().add("event_id", "string")
    ids = [spark.read.schema(schema).option("basePath", folder.toString()).parquet(*others).select("event_id")] if others else []
    if merged:
        ids.append(segments.of_segments(spark, _sink(root, "events"), merged, schema))
    return reduce(DataFrame.union, ids) if ids else None


def land_batch(decided: DataFrame, root: str, stream_id: str, batch_id: int) -> dict[str, int]:
    """Land one micro-batch of decided rows: accepted events, their notifications, and unreadable messages.

    The stream's state has already sorted out what the stream itself has seen. Only what streams with other
    checkpoints have landed is compared here; that is fixed while this stream runs, so the work of a batch
    does not grow with the batches before it. Ids, contents and target partitions depend on the input only, so
    any retry gives the same files. The counts are observed while the progress row is written.
    """
    spark = decided.sparkSession
    others = _other_streams(spark, root, stream_id)
    if others is not None:
        held = others.select(F.concat(F.lit("id:"), F.col("event_id")).alias("held")).distinct()
        decided = decided.join(held, F.col("id") == F.col("held"), "left").withColumn(
            "accepted", F.col("accepted") & F.col("held").isNull()).drop("held")
    decided = decided.withColumn("value", _needed_value())
    if "event_ts" not in decided.columns:
        decided = _with_event(decided).drop("_event")
    # dealt to dates once, for events and notifications alike
    rows = decided.hint("rebalance", "process_date").persist()
    try:
        accepted = readable_events(_landable(rows.filter("accepted")))
        _store(accepted, root, "events", stream_id, batch_id)
        _store(notifications(accepted), root, "messages", stream_id, batch_id)
        _store(dead_letters(_landable(rows)), root, "dead_letters", stream_id, batch_id)
        sums = {"consumed": F.col("copies"), "unreadable": F.when(~F.col("is_readable"), F.col("copies")),
                "other_process_date": F.col("other_dates"), "accepted": F.col("accepted").cast("long")}
        counts = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in sums.items()])
        counts = counts.withColumn("duplicates", F.col("consumed") - F.col("unreadable") - F.col("accepted"))
        seen = Observation(f"batch-{batch_id}")
        observed = counts.observe(seen, *[F.max(c).alias(c) for c in counts.columns])
        _store(observed, root, "progress", stream_id, batch_id)
    finally:
        rows.unpersist()
    return dict(seen.get)


def _start(messages: DataFrame, checkpoint: str, process_date: str | date | None, handle: Callable) -> StreamingQuery:
    return (
        first_arrivals(parse_events(messages), process_date).writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _stream_id(batch: DataFrame) -> str:
    """The id of the query, which is stable over restarts and changes with a new checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def start_ingest(messages: DataFrame, root: str, checkpoint: str, process_date: str | date | None = None,
                 on_batch: Callable[[int, dict[str, int]], None] | None = None) -> StreamingQuery:
    """Consume everything available, batch by batch, then stop. Offsets and seen ids persist in ``checkpoint``.

    The counts of each batch go to the ``progress`` table and to ``on_batch``. Rows of another processing date
    than expected are counted, never dropped.
    """
    prepare_sinks(messages.sparkSession, root)

    def handle(batch: DataFrame, batch_id: int) -> None:
        counts = land_batch(decide(batch), root, _stream_id(batch), batch_id)
        if on_batch:
            on_batch(batch_id, counts)

    return _start(messages, checkpoint, process_date, handle)


class LimitReached(RuntimeError):
    """Ends a run before a micro-batch that is over its limit; the next run starts with that batch."""


def decide_messages(batch: DataFrame) -> DataFrame:
    """Rows of ``first_arrivals`` of one micro-batch -> every message with the decision about it, and a number ``row`` that
    tells equal places apart once the rows are stored. Landing them in parts, in any number of runs, lands what ``decide``
    says about all. What was parsed is left out: only texts that are landed are parsed again, then."""
    copies = Window.partitionBy("id")
    first = F.row_number().over(copies.orderBy(F.asc("is_new"), *[F.asc(c) for c in PLACE])) == 1
    judged = batch.drop(*PARSED).withColumn("accepted", first & F.max("is_new").over(copies)).filter("not is_new")
    return judged.withColumn("value", _needed_value()).select(
        "id", *[c for c in MESSAGE if c not in PARSED], "accepted", F.lit(1).cast("long").alias("copies"),
        F.col("other_date").cast("long").alias("other_dates"), F.monotonically_increasing_id().alias("row"))


def _between_places(stored: DataFrame, low: int, high: int | None) -> DataFrame:
    """The rows behind the first ``low`` ones of stored decided messages, up to the first ``high``, by partition and offset.

    Only places are ranked, and what is carried on are the two rows that bound the part; payloads are neither sorted nor
    shuffled. Backlogs of earlier versions hold the ``place``.
    """
    if "place" in stored.columns:
        part = stored.filter(F.col("place") > low)
        return (part if high is None else part.filter(F.col("place") <= high)).drop("place")
    order = (*PLACE, "row")
    bounds = [n for n in (low, high) if n]
    found = {}
    if bounds:
        ranked = total_order_rank(stored.select(*order), [F.asc(c) for c in order], "position")
        found = {r["position"]: r for r in ranked.filter(F.col("position").isin(bounds)).collect()}
    types = {f.name: f.dataType for f in stored.schema}
    place = F.struct(*order)

    def bound(at: Row):
        return F.struct(*[F.lit(at[c]).cast(types[c]).alias(c) for c in order])

    if low and low not in found:
        stored = stored.limit(0)
    elif low:
        stored = stored.filter(place > bound(found[low]))
    if high is not None:
        stored = stored.filter(place <= bound(found[high])) if high in found else stored.limit(0) if high < 1 else stored
    return stored.drop("row")


def _files(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _forget(spark: SparkSession, root: str, stream_id: str, batch_id: int) -> None:
    """Remove what an attempt at this batch with another limit has landed."""
    for name in SINKS:
        day = f"{SINK_KEYS[name]}=*/" if name in SINK_KEYS else ""
        store, pattern = _files(spark, f"{_sink(root, name)}/stream_id={stream_id}/{day}batch_id={batch_id}")
        for found in store.globStatus(pattern) or []:
            store.delete(found.getPath(), True)


def _backlog(root: str, stream_id: str, batch_id: int | None = None) -> str:
    return _sink(root, f"backlog/stream_id={stream_id}") + ("" if batch_id is None else f"/batch_id={batch_id}")


def _stream_of(spark: SparkSession, checkpoint: str) -> str | None:
    """The id of the query that writes this checkpoint; None if it has never run."""
    store, metadata = _files(spark, f"{checkpoint.rstrip('/')}/metadata")
    return spark.read.json(metadata.toString()).first()["id"] if store.exists(metadata) else None


def _waiting(spark: SparkSession, root: str, stream_id: str | None) -> list[int]:
    """Micro-batches with a rest in the backlog."""
    store, pattern = _files(spark, f"{_sink(root, 'backlog')}/stream_id={stream_id}/batch_id=*")
    return sorted(int(f.getPath().getName().split("=")[1]) for f in store.globStatus(pattern) or [])


def _land_backlog(spark: SparkSession, root: str, checkpoint: str, limit: int | None, on_batch: Callable | None) -> int:
    """Land messages that earlier runs have read and left for later, ``limit`` at most; returns their number.

    Only batches that the stream has committed count: an uncommitted one is read again and stored anew. How far
    a batch has been landed is the sum of the counts it and its parts have written to ``progress``.
    """
    stream_id = _stream_of(spark, checkpoint)
    store, _ = _files(spark, root)
    taken = 0
    for batch_id in _waiting(spark, root, stream_id):
        log, committed = _files(spark, f"{checkpoint.rstrip('/')}/commits/{batch_id}")
        stored = spark.read.parquet(_backlog(root, stream_id, batch_id))
        ids, size = -((batch_id + 1) << 32), stored.count()
        while log.exists(committed) and (limit is None or taken < limit):
            own = F.col("stream_id") == stream_id
            sums = [F.coalesce(F.sum(F.when(c, F.col("consumed"))), F.lit(0)) for c in (F.col("batch_id") < 0, F.col("batch_id") >= 0)]
            done, before = read_sink(spark, root, "progress").filter(own & (
                F.col("batch_id").between(ids - (1 << 32) + 1, ids) | (F.col("batch_id") == batch_id))).agg(*sums).first()
            low = done if "place" in stored.columns else before + done
            _forget(spark, root, stream_id, ids - done)
            if low >= size:
                _, used_up = _files(spark, _backlog(root, stream_id, batch_id))
                store.delete(used_up, True)
                break
            part = _between_places(stored, low, None if limit is None else low + limit - taken)
            counts = land_batch(part, root, stream_id, ids - done)
            taken += counts["consumed"]
            if on_batch:
                on_batch(ids - done, counts)
    return taken


def ingest(messages: DataFrame, root: str, checkpoint: str, process_date: str | date | None = None,
           max_messages: int | None = None, on_batch: Callable[[int, dict[str, int]], None] | None = None) -> int:
    """Consume what is available, or exactly ``max_messages`` of it, and return the number of messages.

    The limit cuts a micro-batch by partition and offset. It has been read and decided as a whole, so it is kept in the
    ``backlog`` of the stream, and the next run lands its rest before anything else; later micro-batches are not begun. The
    reader's ``max_files`` or ``max_offsets`` bounds such a batch.
    """
    spark = messages.sparkSession
    prepare_sinks(spark, root)
    taken = _land_backlog(spark, root, checkpoint, max_messages, on_batch)
    if max_messages is not None and taken >= max_messages:
        return taken

    def handle(batch: DataFrame, batch_id: int) -> None:
        nonlocal taken
        stream_id = _stream_id(batch)
        if max_messages is None:
            counts = land_batch(decide(batch), root, stream_id, batch_id)
        else:
            left = max_messages - taken
            if left <= 0:
                raise LimitReached(f"{max_messages} messages")
            _forget(spark, root, stream_id, batch_id)
            path = _backlog(root, stream_id, batch_id)
            # stored first: it is read more than once, and the stream's state must be asked once
            decide_messages(batch).write.mode("overwrite").parquet(path)
            stored = spark.read.parquet(path)
            if stored.count() > left:
                counts = land_batch(_between_places(stored, 0, left), root, stream_id, batch_id)
            else:
                counts = land_batch(stored.drop("row"), root, stream_id, batch_id)
                store, used_up = _files(spark, path)
                store.delete(used_up, True)
        taken += counts["consumed"]
        if on_batch:
            on_batch(batch_id, counts)

    query = _start(messages, checkpoint, process_date, handle)
    try:
        drain(query)
    except StreamingQueryException as failure:
        if LimitReached.__name__ not in str(failure):
            raise
    return taken


def compact(spark: SparkSession, root: str, checkpoint: str) -> int:
    """Merge the small files of all finished micro-batches of the stream with this checkpoint; how many sinks had some.

    Finished is what the stream has committed, up to the first micro-batch with a rest in the backlog: nothing lands in these
    batches any more. Runs beside readers, and between the runs of the ingestion.
    """
    stream_id = _stream_of(spark, checkpoint)
    store, pattern = _files(spark, f"{checkpoint.rstrip('/')}/commits/[0-9]*")
    committed = [int(f.getPath().getName()) for f in store.globStatus(pattern) or [] if f.getPath().getName().isdigit()]
    rests = (b for b in _waiting(spark, root, stream_id) if not spark.read.parquet(_backlog(root, stream_id, b)).isEmpty())
    through = min(max(committed, default=-1), next(rests, 1 << 62) - 1)
    merged = [
        segments.merge(spark, _sink(root, name), _schema(spark, name), stream_id, through, [SINK_KEYS[name]] if name in SINK_KEYS else [])
        for name in SINKS]
    return sum(m is not None for m in merged)


def remove_compacted(spark: SparkSession, root: str) -> int:
    """Remove files that compaction has replaced, once no reader that began before it is left; returns the number of folders."""
    return sum(segments.remove_merged(spark, _sink(root, name)) for name in SINKS)


def drain(query: StreamingQuery) -> None:
    """Wait until an available-now query has used up its input; its failure is raised here."""
    query.awaitTermination()
