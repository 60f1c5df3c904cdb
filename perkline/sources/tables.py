"""Idempotent writes: DataFrame forms (old table + batch -> new table) and Parquet sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from perkline.operators.joins import null_safe_equal, stored_keys
from perkline.operators.latest import first_per_key, latest_per_key

BATCH_KEYS = ("source_file", "process_date")


def evolve_schema(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Union in which columns missing on either side are NULL."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def _without_keys(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    replaced = stored_keys(incoming, keys)
    return existing.join(replaced, null_safe_equal(existing, replaced, keys), "left_anti")


def replace_batch(existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = BATCH_KEYS) -> DataFrame:
    """Replay of batches: rows of the incoming batch keys are replaced, other batches stay."""
    return evolve_schema(_without_keys(existing, incoming, keys), incoming)


def upsert_by_key(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """New rows replace old rows of the same key; the last one wins inside the batch."""
    return evolve_schema(_without_keys(existing, incoming, keys), latest_per_key(incoming, keys, latest_by))


def replace_by_key(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All old rows of the incoming keys go, so children that no longer exist vanish."""
    return evolve_schema(_without_keys(existing, incoming, keys), incoming)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: str, arrival: Sequence[Column]) -> DataFrame:
    """Accepted rows: the first arrival of every key the target does not hold yet.

    The target is reduced to the batch's keys by a semi join before the anti join, so at most
    one batch worth of target keys is carried on, and only the key column of the target is read.
    """
    first = first_per_key(incoming, [key], arrival)
    batch_keys = stored_keys(incoming, [key])
    present = existing.select(key).join(batch_keys, key, "left_semi").distinct()
    return first.join(present, key, "left_anti")


def write_batches(df: DataFrame, path: str, keys: Sequence[str] = BATCH_KEYS) -> None:
    """Parquet sink in which writing a batch again replaces exactly that batch."""
    (df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*keys).parquet(path))


# Date partitions of the stored tables that grow with time.
PARTITIONS = {
    "sil_sport_activities": ("process_date",),
    "gold_employee_benefit_timeline": ("snapshot_date",),
}


def materialize_layer(
    tables: dict[str, DataFrame], layer: str, path: str, partitions: dict[str, Sequence[str]] = PARTITIONS
) -> dict[str, DataFrame]:
    """Silver and gold are stored and read back; bronze and monitoring stay lazy views.

    Partitioned tables are rebalanced on their partition columns before the write: AQE splits hot
    dates and merges small ones, so there is neither one huge task nor a file per task and date.
    A run may bring the touched dates only: partitions it brings are replaced, the others stay.
    """
    if layer in ("bronze", "monitoring"):
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        return tables
    stored = {}
    for name, df in tables.items():
        target, columns = f"{path}/{layer}/{name}", list(partitions.get(name, ()))
        ready = df.hint("rebalance", *columns) if columns else df
        (ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if columns else "static")
         .partitionBy(*columns).parquet(target))
        stored[name] = df.sparkSession.read.schema(df.schema).parquet(target)
    return stored
