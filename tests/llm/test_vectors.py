import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from perkline.llm import embed_dedup, topk

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, score string"
NAN, INF = float("nan"), float("inf")


def vectors(seed=0, dim=24):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(150):
        rows.append((rng.normal(size=dim), int(rng.integers(0, 3))))
    hot = rng.normal(size=dim)
    for _ in range(250):
        rows.append((hot + rng.normal(size=dim) * 0.11, 1))
    rows += [(hot, 1)] * 40 + [(hot, 2)] * 3 + [(3 * hot, 1)]
    for _ in range(60):
        x = rng.normal(size=dim)
        rows += [(x, 0), (x + rng.normal(size=dim) * 0.12, 0)]
    rng.shuffle(rows)
    data = [(i, np.float32(x).tolist(), label, "c", "s") for i, (x, label) in enumerate(rows)]
    n = len(data)
    odd = [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [NAN] + [1.0] * (dim - 1), [INF] + [1.0] * (dim - 1), [1.0, 2.0]]
    data += [(n + i, x, 1, None, None) for i, x in enumerate(odd)]
    data += [(n + 20, np.float32(hot).tolist(), None, None, None), (n + 21, [2.0, 4.0], 1, None, None)]
    return data


def usable(x):
    return x is not None and len(x) > 0 and all(v is not None and np.isfinite(v) for v in x)


def brute(data, least=0.98):
    ok = [(i, np.array(x, float), lab) for i, x, lab, *_ in data if usable(x) and lab is not None and any(x)]
    root = {i: i for i, *_ in data}
    links = dict.fromkeys(root, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, x, a) in enumerate(ok):
        for j, y, b in ok[k + 1:]:
            if a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: (links[i], find(i)) for i in root}


@pytest.mark.parametrize(("cell_rows", "block_rows"), [(2048, 1024), (40, 30)])
def test_near_vectors_equal_brute_force(spark, cell_rows, block_rows):
    data = vectors()
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.near_vectors(
        df, cell_rows=cell_rows, block_rows=block_rows).collect()}
    assert got == brute(data)


def test_pairs_along_centre_differences_share_a_cell():
    rng = np.random.default_rng(3)
    centres = embed_dedup.unit(rng.normal(size=(12, 384)))
    left, right = [], []
    for i in range(12):
        for k in range(i):
            middle, step = centres[i] + centres[k], centres[i] - centres[k]
            middle, step = middle / np.linalg.norm(middle), step / np.linalg.norm(step)
            half = np.arccos(0.9801) / 2
            left.append(np.cos(half) * middle + np.sin(half) * step)
            right.append(np.cos(half) * middle - np.sin(half) * step)
    x, y = np.array(left), np.array(right)
    assert ((x * y).sum(axis=1) >= 0.98).all()
    cells = []
    batch = pa.RecordBatch.from_arrays([pa.array([*x.tolist(), *y.tolist()])], names=["vec"])
    for out in embed_dedup._assign(centres, 0.98)(iter([batch])):
        cells += out.column("cells").to_pylist()
    assert all(set(a) & set(b) for a, b in zip(cells[:len(x)], cells[len(x):], strict=True))
    assert sum(map(len, cells)) < len(cells) * 6


def test_near_vectors_edge_cases(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1, "", ""), (1, [2.0, 0.0], 1, "", ""), (None, [1.0, 0.0], 1, "", "")], SCHEMA)
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in embed_dedup.near_vectors(df).collect()), key=str)
    assert got[0][:1] == (1,) and got[0][2] == got[1][2] == 1 and got[2] == (None, 0, None)
    assert embed_dedup.near_vectors(df.limit(0)).count() == 0


def test_top_k_equals_brute_force(spark):
    data = vectors(5)
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    got = {}
    rows = topk.top_k(df, F.col("vec_id") % 20 == 0, 7, query_rows=10, candidate_rows=90).collect()
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    whole = {i: np.floor(64 * np.array(x, float)).astype(int) for i, x, *_ in data if usable(x)}
    want = {}
    for i, x in whole.items():
        others = [(-int(x @ y), j) for j, y in whole.items() if j != i and len(y) == len(x)]
        if i % 20 == 0 and others:
            want[i] = [(j, -s) for s, j in sorted(others)[:7]]
    assert got == want


def test_top_k_edge_cases(spark):
    big = 1e17
    df = spark.createDataFrame([(0, [1.0, big], 1, "", ""), (5, [1.0, big], 1, "", ""), (20, [0.0, 0.0], 1, "", ""),
                                (None, [1.0, 1.0], 1, "", ""), (40, [1.0], 1, "", "")], SCHEMA)
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, 2).orderBy("query_id", "rank").collect()]
    assert [g[:3] for g in got] == [(0, 1, 5), (0, 2, 20), (20, 1, 0), (20, 2, 5)]
    assert got[0][3] == (1 << 63) - 1 and got[2][3] == 0
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_branch_and_bound_prunes_but_loses_nothing():
    rng = np.random.default_rng(8)
    columns = rng.integers(-40, 40, (32, 3000)).astype(float)
    columns[:, :30] *= 8
    query = rng.integers(-40, 40, 32).astype(float)
    rest = np.sqrt(np.vstack([(columns[min(low + 8, 31):] ** 2).sum(axis=0) for low in range(0, 32, 8)]))
    ids, score = topk.branch_and_bound(query, columns, rest, np.arange(3000), 17, 20)
    exact = query @ columns
    exact[17] = -np.inf
    assert ids.tolist() == np.lexsort((np.arange(3000), -exact))[:20].tolist()
    assert score.tolist() == exact[ids].tolist()
