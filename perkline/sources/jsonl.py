"""JSON-lines files and topic messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkline import schemas


def read_jsonl(spark: SparkSession, path: str, schema: str = schemas.EVENT_MESSAGE) -> DataFrame:
    """One JSON object per line, with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str, partition: str = "process_date") -> None:
    """JSON lines, one set of files per processing date; a rewritten date replaces itself."""
    (df.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition).json(path))


def publish_rows(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(key, value) messages with the row as JSON, ready for any topic-like sink."""
    fields = list(columns or df.columns)
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def send_to_topic(messages: DataFrame, brokers: str, topic: str) -> None:
    """Write messages to a Kafka-protocol topic; needs the Kafka connector on the class path."""
    (messages.write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).save())
