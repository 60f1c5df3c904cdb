"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative per group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from perkline.llm.graph import components, spanning_forest
from perkline.session import stage_table

SAMPLE = 8192
CELL_ROWS = 2048
MAX_CELLS = 1024
BLOCK_ROWS = 1024


def usable(vector: Column) -> Column:
    """Not null, not empty, all components present and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """Unit centres of ``cells`` clusters of unit rows by Lloyd steps; an empty cell keeps its centre."""
    centres = x[:cells].copy()
    for _ in range(rounds):
        near = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres


def _vectors(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _close(score: np.ndarray, centres: np.ndarray, least: float) -> np.ndarray:
    """Which cells each row joins, by its scores: any two unit vectors of cosine ``least`` or more share one.

    Let i and k be their best cells. What x prefers i by and y prefers k by is (x - y)(i - k) together, at most
    sqrt(2 - 2 least) times the distance of the centres, so one of both is at most half of that.
    """
    apart = np.sqrt(np.maximum(
        (centres * centres).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2 * centres @ centres.T, 0))
    best = np.argmax(score, axis=1)
    margin = np.sqrt(max(2 - 2 * least, 0)) / 2 * apart[best] + 1e-9
    return score >= score[np.arange(len(score)), best][:, None] - margin


def _assign(centres: np.ndarray, least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vec")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            cells: list[list[int]] = [[0]] * batch.num_rows
            same = np.flatnonzero(sizes == centres.shape[1])
            if len(same):
                first = np.cumsum(sizes) - sizes
                at = first[same][:, None] + np.arange(centres.shape[1])
                score = unit(flat[at]) @ centres.T
                for i, row in zip(same.tolist(), _close(score, centres, least), strict=True):
                    cells[i] = np.flatnonzero(row).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"])
    return run


def _compare(least: float) -> Callable[[tuple, pa.Table], pa.Table]:
    """Cosines of two blocks of a cell: link counts and a spanning forest of the links.

    A pair that shares several cells counts in the first of them only.
    """
    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, dim, cell, low, high = (x.as_py() for x in key)
        block = table["block"].to_numpy()
        ids, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        x = unit(_vectors(table["vec"], dim))
        cells = table["cells"].combine_chunks()
        earlier = np.zeros((len(ids), cell + 1), np.float32)
        owner = np.repeat(np.arange(len(ids)), cells.value_lengths().to_numpy())
        flat = cells.flatten().to_numpy()
        earlier[owner[flat < cell], flat[flat < cell]] = 1
        a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
        linked = (x[a] @ x[b].T >= least) & ~((earlier[a] @ earlier[b].T) > 0)
        if low == high:
            np.fill_diagonal(linked, False)
        counts = np.zeros(len(ids), np.int64)
        counts[a] = linked @ copies[b]
        if low != high:
            counts[b] = linked.T @ copies[a]
        some = np.flatnonzero(counts)
        both = np.concatenate([ids[a], ids[b]])
        pairs = [(both[s], both[t]) for s, t in spanning_forest(linked)]
        left, right = [int(p[0]) for p in pairs], [int(p[1]) for p in pairs]
        return pa.table({
            "kind": pa.array([0] * len(some) + [1] * len(pairs), pa.int32()),
            "a": pa.array([*ids[some].tolist(), *left], pa.int64()),
            "b": pa.array([*counts[some].tolist(), *right], pa.int64())})
    return run


def near_vectors(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", sample: int = SAMPLE, cell_rows: int = CELL_ROWS,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Groups of near-duplicate vectors: (vec_id, n_links, component_id, kept).

    Vectors of equal labels and lengths are linked if their cosine in double precision is at least ``least``.
    Equal vectors become one node. Centres are fitted on the at most ``sample`` nodes of least hash; every
    node goes to each cell whose score is within half of sqrt(2 - 2 least) times the distance of that centre from
    its best one, so every linked pair shares a cell. A cell of any size is compared block by block, in tasks of
    two blocks of about ``block_rows`` rows each.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and so do
    null labels. Rows that repeat an id count as vectors of their own, those without id link with nothing. An
    empty table gives an empty result; other columns are ignored.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          vector.alias("vec"))
    nonzero = F.exists("vec", lambda x: x != 0)
    part = usable(F.col("vec")) & nonzero & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    keyed = rows.withColumn("part", F.coalesce(part, F.lit(False)))
    keyed = keyed.select(
        "vec_id", "label", "vec", *(F.when(F.col("part"), h).alias(n) for n, h in (
            ("h0", F.xxhash64("vec")), ("h1", F.hash("vec")))))
    nodes = stage_table(
        keyed.filter("h0 is not null").groupBy("label", "h0", "h1")
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.any_value("vec").alias("vec"))
        .withColumn("dim", F.size("vec")), "vectors")
    sized = nodes.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    dim, n = (sized["dim"], sized["n"]) if sized else (1, 0)
    picked = nodes.filter(F.col("dim") == dim).orderBy(F.xxhash64("node"), "node").limit(sample).select("vec").collect()
    few = unit(np.array([r["vec"] for r in picked], np.float64)) if picked else np.ones((1, 1))
    centres = spherical_kmeans(few, int(min(max(1, -(-n // cell_rows)), MAX_CELLS, len(few))))
    placed = stage_table(
        nodes.select("node", "label", "dim", "copies", "vec").mapInArrow(
            _assign(centres, least), nodes.select("node", "label", "dim", "copies", "vec").schema
            .add("cells", ArrayType(IntegerType()))), "cells")
    entries = placed.withColumn("cell", F.explode("cells"))
    sizes = stage_table(
        entries.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")),
        "sizes")
    dealt = (
        entries.join(sizes, ["label", "dim", "cell"])
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("node", "copies", "vec", "cells", "block", "label", "dim", "cell",
                F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")))
    found = stage_table(dealt.groupBy("label", "dim", "cell", "low", "high").applyInArrow(
        _compare(least), "kind int, a long, b long"), "links")
    groups = components(found.filter("kind = 1").select("a", "b"))
    counts = found.filter("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("others"))
    classes = stage_table(
        nodes.join(groups, "node", "left").join(counts, "node", "left")
        .filter("copies > 1 or component is not null")
        .select("label", "h0", "h1", F.coalesce("component", "node").alias("component"),
                (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links")), "classes")
    return (
        keyed.select("vec_id", "label", "h0", "h1").join(classes, ["label", "h0", "h1"], "left")
        .select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"),
                F.coalesce("component", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id") == F.col("component_id")))
