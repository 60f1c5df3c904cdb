"""Columns of the input that are named like something inside an operator, in small and capital letters."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from perkline.llm import mixing, pieces, quality
from perkline.llm.pieces import PieceModel

NAMES = ("_source", "_parts", "_steps", "parts", "steps", "of", "row", "id", "rate", "_h", "_p", "_host", "_path", "_evidence", "_text",
         "n", "s", "mean", "_gone", "_id", "cut", "d", "h", "rest", "runs", "places", "asked", "bucket", "kind", "data", "component_id")
RESULTS = ("Copy", "Position", "Token_Ids", "N_Tokens", "Kept", "Evidence", "Site")


@pytest.fixture(scope="module", params=[str, str.upper])
def docs(spark, request):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = [request.param(n) for n in NAMES]
    return base.select("*", *[F.lit(f"own {n}").alias(n) for n in names], *[F.lit("own").alias(n) for n in RESULTS])


def same(spark, out, plain, docs, added):
    """The rows are those of the plain input, and the extra columns come through."""
    extra = [c for c in docs.columns if c.lower() in NAMES]
    assert [c for c in out.columns if c in extra] == extra
    rows = out.select("doc_id", *added, *extra).collect()
    assert all(r[c] == f"own {c}" for r in rows for c in extra)
    assert sorted(tuple(r)[:1 + len(added)] for r in rows) == sorted(tuple(r) for r in plain.select("doc_id", *added).collect())


def test_mixing(spark, docs):
    plain = mixing.mix_sources(docs.select("doc_id", "source", "text"))
    same(spark, mixing.mix_sources(docs), plain, docs, ["copy", "position"])


def test_classifier(spark, docs):
    model = quality.train(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    plain = quality.classify(docs.select("doc_id", "source", "lang", "text"), model)
    same(spark, quality.classify(docs, model), plain, docs, ["kept", "text"])


def test_pieces(spark, docs):
    model = PieceModel.load(corpus_pipeline.VOCABULARY)
    plain = pieces.encode_decode(docs.select("doc_id", "text"), model)
    same(spark, pieces.encode_decode(docs, model), plain, docs, ["n_tokens", "text"])


@pytest.mark.parametrize("stage", [corpus_pipeline.drop_near_copies, corpus_pipeline.cut_repeats])
def test_stages(spark, docs, stage):
    plain = stage(spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), "")
    out = stage(spark, docs, "")
    assert out.columns == docs.columns
    same(spark, out, plain, docs, ["text", "n_chars"])
