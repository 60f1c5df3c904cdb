"""Merged files of landed micro-batches, and the committed list that tells readers which files count.

Every micro-batch lands in folders of its own, so that a retry replaces exactly itself. ``merge`` writes finished batches anew
as a segment, with large files a date, and commits a new list. From then on readers take these batches from the
segment and prune their own folders by partition; until then they read the old ones, so no row is seen twice or not at
all. Neighbouring segments merge geometrically: a row is rewritten as often as the logarithm of the number of batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Segment:
    """The micro-batches ``low`` to ``high`` of a stream, in the files below ``path``."""

    stream_id: str
    low: int
    high: int
    path: str


SEGMENT = "stream_id string, low long, high long, path string"


def origin(batch_id: Column) -> Column:
    """The micro-batch that rows were read in. Parts of a backlog have negative numbers, 2**32 of them per micro-batch."""
    return F.when(batch_id >= 0, batch_id).otherwise(F.shiftright(-batch_id, 32) - 1)


def _files(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _found(spark: SparkSession, pattern: str) -> list[JavaObject]:
    store, path = _files(spark, pattern)
    return [f.getPath() for f in store.globStatus(path) or []]


def _lists(spark: SparkSession, folder: str, committed: bool = True) -> list[int]:
    """Numbers of the lists; an attempt that broke off has no success mark."""
    found = _found(spark, f"{folder}_segments/list-*" + ("/_SUCCESS" if committed else ""))
    return sorted(int((p.getParent() if committed else p).getName().split("-")[1]) for p in found)


def segments(spark: SparkSession, folder: str) -> list[Segment]:
    """The segments of the last committed list: a number that grows with the logarithm of the batches of each stream."""
    lists = _lists(spark, folder)
    if not lists:
        return []
    rows = spark.read.schema(SEGMENT).json(f"{folder}_segments/list-{lists[-1]}").collect()
    return sorted((Segment(**r.asDict()) for r in rows), key=lambda s: (s.stream_id, s.low))


def _rows(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(folder).select(*schema.names)


def _data(folder: str) -> str:
    return f"{folder}_segments/data"


def of_segments(spark: SparkSession, folder: str, held: Sequence[Segment], schema: StructType) -> DataFrame:
    """The rows of some segments; their names are partitions of one folder."""
    return spark.read.schema(schema).option("basePath", _data(folder)).parquet(*[s.path for s in held]).select(*schema.names)


def read(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All landed rows, each once: merged batches from their segments, all others from their own folders."""
    held = segments(spark, folder)
    rows = _rows(spark, folder, schema)
    for stream_id in {s.stream_id for s in held}:
        through = max(s.high for s in held if s.stream_id == stream_id)
        rows = rows.filter((F.col("stream_id") != stream_id) | (origin(F.col("batch_id")) > through))
    return rows.unionByName(of_segments(spark, folder, held, schema)) if held else rows


def merge(spark: SparkSession, folder: str, schema: StructType, stream_id: str, through: int, keys: Sequence[str]) -> Segment | None:
    """Merge what the stream has landed up to the micro-batch ``through``, all of it finished, into a segment.

    Segments before it that cover no more batches than the new one are merged with it. One merge may run at a time; what a
    broken one leaves behind is in no list. Returns None if there is nothing new.
    """
    held = segments(spark, folder)
    mine = [s for s in held if s.stream_id == stream_id]
    low = mine[-1].high + 1 if mine else 0
    if through < low:
        return None
    rows = _rows(spark, folder, schema).filter((F.col("stream_id") == stream_id) & origin(F.col("batch_id")).between(low, through))
    absorbed: list[Segment] = []
    while mine and mine[-1].high - mine[-1].low <= through - low:
        absorbed.append(mine.pop())
        low = absorbed[-1].low
    if absorbed:
        rows = rows.unionByName(of_segments(spark, folder, absorbed, schema))
    number = max(_lists(spark, folder, committed=False), default=0) + 1
    new = Segment(stream_id, low, through, f"{_data(folder)}/segment={stream_id}-{low}-{through}-{number}")
    (rows.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*keys).parquet(new.path))
    kept = [s for s in held if s not in absorbed] + [new]
    spark.createDataFrame([asdict(s) for s in kept], SEGMENT).coalesce(1).write.mode("errorifexists").json(
        f"{folder}_segments/list-{number}")
    return new


def remove_merged(spark: SparkSession, folder: str) -> int:
    """Remove the files that the last committed list replaces, and return the number of folders.

    A reader that has planned by an older list still needs them: call this when no such reader runs, nor any merge.
    """
    held, lists = segments(spark, folder), _lists(spark, folder)
    gone = []
    for stream_id in {s.stream_id for s in held}:
        through = max(s.high for s in held if s.stream_id == stream_id)
        for pattern in ("batch_id=*", "*=*/batch_id=*"):
            for path in _found(spark, f"{folder}/stream_id={stream_id}/{pattern}"):
                number = int(path.getName().split("=")[1])
                if (number if number >= 0 else (-number >> 32) - 1) <= through:
                    gone.append(path)
    names = {s.path.rsplit("/", 1)[1] for s in held}
    gone += [p for p in _found(spark, f"{_data(folder)}/*") if lists and p.getName() not in names]
    gone += [p for p in _found(spark, f"{folder}_segments/list-*") if lists and int(p.getName().split("-")[1]) != lists[-1]]
    store, _ = _files(spark, folder)
    for path in gone:
        store.delete(path, True)
    return len(gone)
