"""The corpus pipeline: each stage reads what its predecessor wrote.

``STAGES`` names the stages in order; ``run`` applies them to ``documents`` and cuts between them at tables
in the shared folder, so a lost executor costs one stage at most. All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkline.llm import mixing, near_dup, pieces, quality, suffix_dedup
from perkline.session import stage_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def drop_rejected(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps. It learns from ``labels`` of the documents at hand."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = quality.classify(docs, model)
    return judged.filter("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    groups = near_dup.near_duplicates(docs)
    gone = groups.filter("not kept").select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 100 bytes or more that start earlier; what is left empty goes."""
    others = [c for c in docs.columns if c != "text"]
    cut = suffix_dedup.cut_repeats(docs.select("doc_id", "text", F.struct(*others).alias("row")))
    left = cut.filter(~F.col("cut") | F.col("text").rlike(r"\S"))
    kind = docs.schema["n_chars"].dataType
    new = {"text": F.col("text"), "n_chars": F.when(F.col("cut"), F.length("text").cast(kind)).otherwise(F.col("row.n_chars"))}
    return left.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards tempered source shares, in global random order."""
    return mixing.mix_sources(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids."""
    return pieces.encode_decode(docs, pieces.PieceModel.load(VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", drop_rejected),
    ("minhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("source_mixing", mix),
    ("sentencepiece", encode),
]

#: Stages 1 to 3 and 5 are beyond SQL; the tests compare them with brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
