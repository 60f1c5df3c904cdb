"""Tables on storage that grow by batches: laid out by the hash of their key, or by batch, with a schema that may widen.

A keyed table is cut into buckets by the hash of its key, one partition each. A batch reads and overwrites the
buckets that its keys fall into and leaves the files of all others alone. Parquet Bloom filters on the key let a lookup of
given keys skip the row groups without them.

The schema of a table is stored beside its files and widened before a batch with new columns or wider numbers is
written, so old files are never rewritten and a reader needs no pass over all footers.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.operators.joins import null_safe_equal, stored_keys
from perkline.operators.latest import first_per_key, latest_per_key
from perkline.session import stage_table
from perkline.sources.tables import BATCH_KEYS, evolve_schema

BUCKETS = 64
BUCKET = "bucket"
#: Numbers in order of width: a stored column may become any later kind of its line.
WIDER = (("tinyint", "smallint", "int", "bigint"), ("tinyint", "smallint", "int", "double"), ("float", "double"))


def _note(spark: SparkSession, path: str, name: str, value: object) -> None:
    """Store a small description beside the files; readers of the table skip names with an underscore."""
    spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_{name}")


def _noted(spark: SparkSession, path: str, name: str) -> object | None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_{name}/_SUCCESS")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return json.loads(spark.read.text(f"{path}/_{name}").first()[0])


def _wider(name: str, old: T.DataType, new: T.DataType) -> T.DataType:
    if old == new:
        return old
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale, digits = max(old.scale, new.scale), max(old.precision - old.scale, new.precision - new.scale)
        if scale + digits <= 38:
            return T.DecimalType(scale + digits, scale)
    kinds = old.simpleString(), new.simpleString()
    for line in WIDER:
        if all(k in line for k in kinds):
            return new if line.index(kinds[1]) > line.index(kinds[0]) else old
    raise ValueError(f"column {name}: {kinds[1]} does not fit the stored {kinds[0]}")


def widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The schema that holds rows of both: all columns, the old ones first, numbers in the wider kind."""
    known = {f.name.lower(): f for f in new.fields}
    fields = [T.StructField(f.name, _wider(f.name, f.dataType, known.pop(f.name.lower(), f).dataType)) for f in old.fields]
    return T.StructType([*fields, *[T.StructField(f.name, f.dataType) for f in new.fields if f.name.lower() in known]])


def _widen(df: DataFrame, path: str) -> T.StructType:
    """Bring the stored schema of ``path`` up to the columns of ``df``."""
    spark = df.sparkSession
    held = _noted(spark, path, "schema")
    schema = T.StructType.fromJson(held) if held else None
    wide = widened(schema, df.schema) if schema else widened(df.schema, df.schema)
    if schema != wide:
        _note(spark, path, "schema", wide.jsonValue())
    return wide


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a stored table; what a batch had no column for is NULL."""
    held = _noted(spark, path, "schema")
    if held is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    schema = T.StructType.fromJson(held)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def write_evolving(df: DataFrame, path: str, keys: Sequence[str] = BATCH_KEYS) -> None:
    """Write batches, each with the columns it has; writing one again replaces exactly that batch.

    The stored schema is widened first: a reader in between sees NULL in the new columns.
    """
    _widen(df, path)
    (df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*keys).parquet(path))


def _bucket(keys: Sequence[str], schema: T.StructType, buckets: int) -> Column:
    typed = [F.col(k).cast(schema[k].dataType) for k in keys]
    return F.pmod(F.xxhash64(*typed), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, keys: Sequence[str], mode: str) -> None:
    writer = rows.hint("rebalance", BUCKET).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.partitionBy(BUCKET).parquet(path)


def create_keyed(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """Store a table by the hash of its key. Rows that share a key share a bucket."""
    schema = df.schema
    placed = df.withColumn(BUCKET, _bucket(keys, schema, buckets))
    _note(df.sparkSession, path, "layout", {"keys": list(keys), "buckets": buckets, "types": T.StructType([schema[k] for k in keys]).jsonValue()})
    _widen(placed, path)
    _write(placed, path, keys, "overwrite")


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return read_stored(spark, path).drop(BUCKET)


class _Touched:
    """A batch, stored with its buckets, and the part of the table that lies in these buckets."""

    def __init__(self, path: str, batch: DataFrame):
        self.spark, self.path = batch.sparkSession, path
        layout = _noted(self.spark, path, "layout")
        self.keys, types = layout["keys"], T.StructType.fromJson(layout["types"])
        typed = batch.withColumns({k: F.col(k).cast(types[k].dataType) for k in self.keys})
        self.batch = stage_table(typed.withColumn(BUCKET, _bucket(self.keys, types, layout["buckets"])), "batch")
        # at most as many as the table has buckets
        numbers = sorted(r[0] for r in self.batch.select(BUCKET).distinct().collect())
        self.held = read_stored(self.spark, path).filter(F.col(BUCKET).isin(numbers))

    def replace(self, incoming: DataFrame) -> None:
        """Write the touched buckets anew: the held rows of other keys, and the incoming ones."""
        gone = stored_keys(self.batch, self.keys)
        kept = self.held.join(gone, null_safe_equal(self.held, gone, self.keys), "left_anti")
        rows = stage_table(evolve_schema(kept, incoming), "buckets")  # the files it reads are those it replaces
        _widen(rows, self.path)
        _write(rows, self.path, self.keys, "overwrite")


def upsert_stored(path: str, batch: DataFrame, latest_by: Sequence[str]) -> None:
    """New rows replace stored rows of the same key; the last one wins inside the batch."""
    touched = _Touched(path, batch)
    touched.replace(latest_per_key(touched.batch, touched.keys, latest_by))


def replace_stored(path: str, batch: DataFrame) -> None:
    """All stored rows of the incoming keys go, so children that no longer exist vanish."""
    touched = _Touched(path, batch)
    touched.replace(touched.batch)


def insert_stored(path: str, batch: DataFrame, arrival: Sequence[Column]) -> None:
    """Add the first arrival of every key that the table does not hold; a batch that is repeated adds nothing.

    Of the touched buckets only the key columns are read, and no file is rewritten.
    """
    touched = _Touched(path, batch)
    first = first_per_key(touched.batch, touched.keys, arrival)
    present = touched.held.select(*touched.keys)
    new = stage_table(first.join(present, null_safe_equal(first, present, touched.keys), "left_anti"), "new")
    _widen(new, path)
    _write(new, path, touched.keys, "append")


def find_stored(spark: SparkSession, path: str, values: Sequence[object]) -> DataFrame:
    """Rows of the given values of a key of one column: their buckets are computed, the Bloom filters do the rest."""
    layout = _noted(spark, path, "layout")
    types = T.StructType.fromJson(layout["types"])
    asked = spark.createDataFrame([(v,) for v in values], types)
    numbers = [r[0] for r in asked.select(_bucket(layout["keys"], types, layout["buckets"])).distinct().collect()]
    return read_stored(spark, path).filter(F.col(BUCKET).isin(numbers) & F.col(layout["keys"][0]).isin(list(values))).drop(BUCKET)
