"""Landing: canonical names, text measures and batch lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkline.functions import clean_numeric_key, row_hash
from perkline.functions.dates import as_date, as_timestamp

# Headers of the source files and their canonical columns.
EMPLOYEE_HEADERS = {
    "ID salarié": "employee_id",
    "Nom": "last_name",
    "Prénom": "first_name",
    "Date de naissance": "birth_date_raw",
    "BU": "business_unit",
    "Date d'embauche": "hire_date_raw",
    "Salaire brut": "gross_salary_raw",
    "Type de contrat": "contract_type",
    "Nombre de jours de CP": "cp_days_raw",
    "Adresse du domicile": "home_address",
    "Moyen de déplacement": "declared_transport_mode",
}
DECLARATION_HEADERS = {"ID salarié": "employee_id", "Pratique d'un sport": "declared_sport"}


def tag_process_date(df: DataFrame, process_date: str | date) -> DataFrame:
    return df.withColumn("process_date", as_date(process_date))


def add_row_hash(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Content hash of the named columns. Batch lineage stays out, so equal rows hash equally."""
    return df.withColumn("row_hash", row_hash([F.col(c) for c in columns]))


def land_table(
    df: DataFrame, mapping: Mapping[str, str], source_file: str, process_date: str | date,
    ingestion_id: str, ingested_at: str, key: str = "employee_id",
) -> DataFrame:
    """Source rows as a landing batch. Missing headers land as NULL, NULL stays NULL."""
    def landed(header: str, name: str):
        value = F.col(f"`{header}`").cast("string") if header in df.columns else F.lit(None).cast("string")
        return (clean_numeric_key(value) if name == key else value).alias(name)

    rows = df.select(*[landed(h, n) for h, n in mapping.items()])
    tagged = tag_process_date(
        rows.withColumns({
            "ingestion_id": F.lit(ingestion_id),
            "ingested_at": as_timestamp(ingested_at),
            "source_file": F.lit(source_file),
        }), process_date)
    hashed = add_row_hash(tagged, list(mapping.values()))
    return hashed.select(
        "ingestion_id", "ingested_at", "process_date", "source_file", *mapping.values(), "row_hash")


def backfill_dates(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """Inclusive list of processing days; a reversed range is an error."""
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    if first > last:
        raise ValueError(f"the range to refill ends on {last}, before it starts on {first}")
    days = (last - first + timedelta(days=1)).days
    return spark.range(days).select(F.date_add(as_date(first), F.col("id").cast("int")).alias("process_date"))


def backfill_slice(df: DataFrame, start: str | date, end: str | date, column: str = "process_date") -> DataFrame:
    """Rows of the backfill range in one job: a range filter, so partitions are pruned at the scan."""
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    if first > last:
        raise ValueError(f"the range to refill ends on {last}, before it starts on {first}")
    return df.filter(F.col(column).between(as_date(first), as_date(last)))
