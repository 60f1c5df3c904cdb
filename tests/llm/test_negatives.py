import numpy as np
import pytest
from pyspark.sql import functions as F

from perkline.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label string, asks string, v string, block string, cap string, anchor_id string"
NAN, INF = float("nan"), float("inf")


def vectors(seed=1, dim=20):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = []
    for i in range(360):
        x = centres[i % 6] + rng.normal(size=dim) * (0.2 if i % 3 else 1.5)
        rows.append((i, x / np.linalg.norm(x), "hot" if i % 2 else f"l{i % 6}"))
    hot = centres[0] / np.linalg.norm(centres[0])
    rows += [(400 + i, hot, "hot" if i % 3 else "l0") for i in range(40)]
    rows += [(500, 4 * hot, "l2"), (501, -hot, "l2"), (520, -hot, "alone"), (540, np.zeros(dim), "l4")]
    data = [(i, x.tolist(), label) for i, x, label in rows]
    odd = [None, [], [None] + [1.0] * (dim - 1), [NAN] + [1.0] * (dim - 1), [INF] + [1.0] * (dim - 1), [1.0, 2.0]]
    data += [(600 + 20 * i, x, "l1") for i, x in enumerate(odd)] + [(800, hot.tolist(), None), (None, hot.tolist(), "hot")]
    data += [(820, [0.5, 0.5], "l1"), (821, [0.25, 0.5], "l1"), (822, [0.5, 0.4], "l2")]
    return data


def brute(data, scale=256, k=5, low=80, high=100):
    ok = [(i, [int(np.floor(scale * v)) for v in x], c) for i, x, c in data
          if i is not None and c is not None and x and all(v is not None and np.isfinite(v) for v in x)]
    out = []
    for a, x, c in ok:
        if a % 20:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), b, d) for b, y, d in ok if b != a and len(y) == len(x))
        for s, b in [(s, b) for s, b, d in scored if d == c][:k]:
            inside = [(t, e) for t, e, d in scored if d != c and low * -s <= 100 * -t <= high * -s][:k]
            out += [(a, b, r, e, -s, -t) for r, (t, e) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize(("block_rows", "anchor_rows"), [(8192, 1024), (50, 7)])
def test_equals_brute_force(spark, block_rows, anchor_rows):
    data = vectors()
    df = spark.createDataFrame([(*r, "a", "v", "b", "c", "d") for r in data], SCHEMA).repartition(4)
    got = negatives.hard_negatives(df, F.col("vec_id") % 20 == 0, block_rows=block_rows, anchor_rows=anchor_rows).collect()
    assert sorted(tuple(r) for r in got) == brute(data)


def test_edge_cases(spark):
    schema = "vec_id long, embedding array<double>, label int"
    big = [(0, [1e17, 1.0], 1), (1, [1e17, 1.0], 1), (2, [1e17, 0.0], 2), (20, [1.0, 1.0], 1), (20, [1.0, 1.0], 1), (3, [1.0, 1.0], 2),
           (3, [1.0, 1.0], 2)]
    got = sorted(tuple(r) for r in negatives.hard_negatives(
        spark.createDataFrame(big, schema), F.col("vec_id") % 20 == 0, positives=1).collect())
    most = (1 << 63) - 1
    assert got[0] == (0, 1, 1, 2, most, most)
    empty = spark.createDataFrame([], schema)
    assert negatives.hard_negatives(empty, F.col("vec_id") % 20 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 1), (5, [1.0], 2)], schema)
    assert negatives.hard_negatives(alone, F.col("vec_id") % 20 == 0).count() == 0


def test_lists_are_cut_and_nothing_is_lost():
    rng = np.random.default_rng(2)
    rows = np.rint(rng.normal(size=(32, 2000)) * np.geomspace(200, 2, 32)[:, None])
    rows[:, ::4] = np.rint(rows[:, ::4] / 20)
    query = np.rint(rng.normal(size=32) * np.geomspace(200, 2, 32))
    rest, own = negatives.suffix_norms(rows), negatives.suffix_norms(query[:, None])[:, 0]
    exact = query @ rows
    for least in (np.sort(exact)[-20], np.sort(exact)[-300], -1e9):
        cover = least / own[0] if least > 0 else 0.0
        index = negatives.InvertedIndex(rows, rest, cover)
        if least > 0:
            assert index.listed.sum() < 2000 * len(index.listed) * 0.8
        place, score = index.join(query, own, np.ones(2000, bool), least)
        assert sorted(place.tolist()) == np.flatnonzero(exact >= least).tolist()
        assert score.tolist() == exact[place].tolist()
