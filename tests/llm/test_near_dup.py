import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from perkline.llm import graph, near_dup
from perkline.llm.text import as_bytes, shingles, words

SCHEMA = "doc_id long, text string, n_shingles string, node string, key int"


def shingle_set(text, width):
    found = (text or "").encode().lower().split()
    if len(found) < width:
        return {b" ".join(found)} if found else set()
    return {b" ".join(found[i:i + width]) for i in range(len(found) - width + 1)}


def brute(rows, width, percent):
    """(n_shingles, component) of each id by comparing all pairs."""
    sets = {i: shingle_set(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def mutate(rng, text, share):
    return " ".join(f"x{rng.randrange(10**9)}" if rng.random() < share else w for w in text.split())


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for size, copies, share in ((150, 160, 0.02), (60, 40, 0.01), (30, 20, 0.03), (12, 12, 0.02), (400, 10, 0.01)):
        base = " ".join(rng.choice(vocabulary) for _ in range(size))
        texts += [base] + [mutate(rng, base, share) for _ in range(copies)]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 80))) for _ in range(80)]
    texts += [texts[0]] * 15 + ["", None, " \t\n", "one", "one two", "ONE  two", "one two", "a b c", "A B\x0bC"]
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(30_000)))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("width", "percent", "task_links"), [(3, 85, 1 << 17), (5, 80, 0)])
def test_groups_equal_brute_force(spark, monkeypatch, width, percent, task_links):
    monkeypatch.setattr(graph, "TASK_LINKS", task_links)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA).repartition(5)
    got = {r["doc_id"]: r for r in near_dup.near_duplicates(docs, width, percent).collect()}
    want = brute(rows, width, percent)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (4, "a b c d"), (None, None)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
                  for r in near_dup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (3, 1, 3, True), (None, 1, 3, None),
                          (4, 1, 3, False), (None, 0, None, None)], key=str)
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_signature_estimates_similarity_with_low_variance():
    rng = np.random.default_rng(3)
    errors, slots = [], 96
    for _ in range(200):
        pool = rng.integers(0, 2**63, 150).astype(np.uint64)
        a, b = np.unique(pool[:120]), np.unique(pool[30:])
        signature = near_dup.super_min_hash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), slots)
        errors.append((signature[0] == signature[1]).mean() - 90 / 150)
    independent = 0.6 * 0.4 / slots
    assert abs(np.mean(errors)) < 0.01
    assert np.var(errors) < independent
    single = near_dup.super_min_hash(np.array([5], np.uint64), np.array([0, 1]), slots)
    assert len(set((single[0] >> np.uint64(32)).tolist())) == slots


def test_words_and_shingles_of_whole_texts():
    import pyarrow as pa
    texts = ["A b\u000bC  D", None, "", "é x ", "q" * 70_000 + " end"]
    raw, bounds = as_bytes(pa.array(texts))
    found = words(raw, bounds)
    assert found.counts.tolist() == [4, 0, 0, 1, 2]
    again = words(*as_bytes(pa.array(["a B c\td"])))
    assert again.prints.tolist() == found.prints[:4].tolist()
    elements, cuts = shingles(found, 3)
    assert np.diff(cuts).tolist() == [2, 0, 0, 1, 1] and len(elements) == 4


def test_banding_misses_no_pair_at_the_threshold():
    """Half of the pairs at 0.85 share few bands only; none of 2,000 shares none."""
    rng = np.random.default_rng(9)
    sets = []
    for _ in range(2000):
        pool = rng.integers(0, 2**63, 200).astype(np.uint64)
        sets += [pool[:185], pool[15:]]
    cuts = np.arange(0, len(sets) * 185 + 1, 185)
    signature = near_dup.super_min_hash(np.concatenate(sets), cuts, 96)
    same = (signature[::2] == signature[1::2]).reshape(-1, near_dup.ROWS, near_dup.BANDS).all(axis=1).any(axis=1)
    assert same.all()


def test_pipeline_columns_survive(spark):
    import corpus_pipeline
    docs = spark.createDataFrame([(1, "a b c d e f", "s"), (2, "a b c d e f", "s"), (3, None, "s")],
                                 "doc_id long, text string, kept string")
    out = dict(corpus_pipeline.STAGES)["minhash_near_dedup"](spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.select(F.col("doc_id")).collect()) == [1, 3]
