from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.test_near_dup import brute as near_brute
from tests.llm.test_suffix_dedup import brute as cut_brute

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "minhash_near_dedup", "suffix_array_dedup", "source_mixing", "sentencepiece"]
    kept = stages["quality_classifier"](spark, docs, SF)
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r["doc_id"] for r in kept.collect()}
    clean = [i for i, x in labels.items() if x == (1, 0)]
    assert kept.columns == docs.columns and sum(i in left for i in clean) > 0.95 * len(clean)

    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    single = stages["minhash_near_dedup"](spark, docs, SF)
    groups = near_brute(rows, 5, 80)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(i for i, (_, c) in groups.items() if i == c)

    cut = stages["suffix_array_dedup"](spark, docs, SF)
    want = {}
    for i, (_, left_bytes, spans) in cut_brute(rows).items():
        want[i] = left_bytes.decode("utf-8", "ignore") if spans else dict(rows)[i]
    got = {r["doc_id"]: r for r in cut.collect()}
    assert {i: r["text"] for i, r in got.items()} == {i: t for i, t in want.items() if t.strip()}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values()) and cut.columns == docs.columns

    mixed = stages["source_mixing"](spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.dtypes == docs.dtypes
    texts = dict(rows)
    assert all(texts[r["doc_id"]] == r["text"] for r in mixed.collect())

    coded = stages["sentencepiece"](spark, docs, SF)
    assert coded.filter(~F.col("round_trip")).count() == 0 and coded.columns[:len(docs.columns)] == docs.columns


def test_run_applies_all_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    size = Counter(r["doc_id"] for r in out.collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert 0 < len(size) < docs and "token_ids" in out.columns


def test_null_rows_pass_all_stages(spark, tmp_path):
    rows = [(1, None, None, None, None), (None, "some words " * 30, "en", "s", 5), (2, "", "en", None, 0),
            (3, "plain words in a row that differ " * 8, "en", "s", 9), (3, "plain words in a row that differ " * 8, "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert "token_ids" in corpus_pipeline.run(spark, str(tmp_path)).columns


def test_repeated_row_survives_all_stages(spark, tmp_path):
    text = "a plain sentence about the weather of last week and the harvest that followed it, " + " ".join(map(str, range(60)))
    docs = spark.createDataFrame([(3, text, "en", "s", len(text)), (3, text, "en", "s", len(text)), (4, "short", "en", "s", 5)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    cut = dict(corpus_pipeline.STAGES)["suffix_array_dedup"](spark, docs, str(tmp_path)).collect()
    assert [r["text"] for r in cut if r["doc_id"] == 3] == [text, text]
    assert text in {r["text"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}


def test_cut_texts_of_one_id_stay_apart(spark):
    first, second, third = (" ".join(f"{w}{k}" for k in range(60)) for w in ("alpha", "beta", "gamma"))
    rows = [(1, first), (3, first + " end"), (3, second), (None, third), (None, second[:90]), (9, third + " tail")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = dict(corpus_pipeline.STAGES)["suffix_array_dedup"](spark, docs, SF).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(
        [(1, first), (3, " end"), (3, second), (None, third), (None, second[:90]), (9, " tail")], key=str)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
