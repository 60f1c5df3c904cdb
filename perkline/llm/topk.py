"""Exact top-k search by inner product: columnar branch and bound over blocks of queries and candidates."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkline.llm.embed_dedup import usable

QUERY_ROWS = 2048
CANDIDATE_ROWS = 16384
DIMENSIONS = 8


def _exact(values: np.ndarray, others: np.ndarray, dim: int) -> np.dtype:
    """The cheapest type in which all sums of products are exact."""
    most = dim * (int(np.abs(values).max(initial=0)) + 1) * (int(np.abs(others).max(initial=0)) + 1)
    return np.dtype(np.float64) if most < 1 << 53 else np.dtype(np.int64) if most < 1 << 62 else np.dtype(object)


def branch_and_bound(query: np.ndarray, columns: np.ndarray, rest: np.ndarray, ids: np.ndarray, own: int,
                     k: int, step: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best (id, score) of one query among candidates in vertical layout (dimension x candidate).

    After each block of dimensions a candidate's score lies within the Cauchy-Schwarz bound on what is left:
    the mass of the query's and of the candidate's other dimensions (``rest``: block x candidate). Candidates
    whose upper bound is under the k-th best lower bound are dropped and the others compacted.
    """
    dim = len(query)
    mass = query.astype(np.float64) ** 2
    live = np.flatnonzero(ids != own)
    score = np.zeros(len(live), columns.dtype)
    for number, low in enumerate(range(0, dim, step)):
        high = min(low + step, dim)
        score = score + query[low:high] @ columns[low:high, live]
        if high == dim or len(live) <= k:
            continue
        slack = np.sqrt(mass[high:].sum()) * rest[number, live] * (1 + 1e-9) + 1e-6
        about = score.astype(np.float64)
        bar = np.partition(about - slack, len(live) - k)[len(live) - k]
        stay = about + slack >= bar
        if not stay.all():
            live, score = live[stay], score[stay]
    order = np.lexsort((ids[live], -score))[:k] if score.dtype != object else np.array(
        sorted(range(len(live)), key=lambda i: (-score[i], ids[live[i]]))[:k], np.int64)
    return ids[live[order]], score[order]


def _search(k: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        asks = table["asks"].to_numpy()
        ids = table["vec_id"].to_numpy()
        values = table["v"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        queries, candidates = values[asks], values[~asks]
        query_ids, candidate_ids = ids[asks], ids[~asks]
        if not len(candidates):
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        kind = _exact(queries, candidates, dim)
        columns = np.ascontiguousarray(candidates.T).astype(kind)
        squares = np.cumsum((columns.astype(np.float64) ** 2)[::-1], axis=0)[::-1]
        rest = np.sqrt(np.vstack([squares[min(low + DIMENSIONS, dim - 1)] for low in range(0, dim, DIMENSIONS)]))
        out: tuple[list, list, list] = ([], [], [])
        for own, query in zip(query_ids.tolist(), queries.astype(kind), strict=True):
            found, score = branch_and_bound(query, columns, rest, candidate_ids, own, k)
            out[0].append(np.full(len(found), own))
            out[1].append(found)
            out[2].append(np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in score], np.int64))
        joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, joined), strict=True)))
    return run


def quantised(vector: Column, scale: int = 64) -> Column:
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(F.lit(scale) * x))


def top_k(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          query_rows: int = QUERY_ROWS, candidate_rows: int = CANDIDATE_ROWS) -> DataFrame:
    """The ``k`` best candidates of each query: (query_id, rank, vec_id, score), ties to the smaller id.

    ``queries`` selects the asking rows; candidates are all rows but those of the query's own id. Vectors are
    compared by the exact integer inner product of floor(64 * x); only vectors of equal length are compared.
    Queries and candidates meet in blocks of about ``query_rows`` and ``candidate_rows`` rows, each block
    pair yields at most k rows a query, and a window keeps the best.

    Vectors that are null, empty or hold null or non-finite components, and rows without id, take no part.
    Candidate rows that repeat an id are ranked each; of query rows that repeat one the least vector asks.
    Scores beyond a long are cut to its range. Fewer than k candidates are all returned; an empty table gives
    an empty result; other columns are ignored.
    """
    used = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.coalesce(queries, F.lit(False)).alias("asks"),
        quantised(F.col(vector_col)).alias("v"))
    counts = used.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    parts = max(1, -(-counts["n"] // candidate_rows))
    turns = max(1, -(-counts["q"] // query_rows))
    spot = F.xxhash64("vec_id")
    asking = (
        used.filter("asks").groupBy("vec_id", F.size("v").alias("dim")).agg(F.min("v").alias("v"))
        .select("dim", "vec_id", "v", F.lit(True).alias("asks"), F.pmod(spot, F.lit(turns)).alias("turn"),
                F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>")).alias("part")))
    offered = used.select(
        F.size("v").alias("dim"), "vec_id", "v", F.lit(False).alias("asks"),
        F.explode(F.sequence(F.lit(0), F.lit(turns - 1)).cast("array<long>")).alias("turn"),
        F.pmod(spot, F.lit(parts)).alias("part"))
    best = asking.unionByName(offered).groupBy("dim", "turn", "part").applyInArrow(
        _search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score"))
