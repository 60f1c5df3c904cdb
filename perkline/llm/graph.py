"""Connected components of links, by union-find inside tasks and contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkline.session import stage_table

#: Links that one task's union-find may hold; a bound on its memory.
TASK_LINKS = 1 << 17


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over a task's links: every node with its root, a forest of the same components."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up] if up in parent else up
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(root(x), x) for x in list(parent)]
    yield pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["a", "b"], dtype="int64")


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b long) -> (node, component): the smallest node reachable, for each linked node.

    Every task reduces its links to a forest. If no more than ``TASK_LINKS`` are left, one task joins these
    forests; else they are contracted by rounds, with the same result. Each round every label joins the neighbour of least random priority, which contracts any graph by a
    constant factor. Links and labels stay distributed; each round is cut at a stored table.
    """
    edges = stage_table(
        links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
        .mapInPandas(_forest, "a long, b long").distinct(), "links")
    if edges.count() <= TASK_LINKS:
        whole = stage_table(edges.coalesce(1).mapInPandas(_forest, "a long, b long"), "forest")
        return whole.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
            whole.select("a", F.col("a").alias("b")).distinct())
    labels = stage_table(
        edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node")),
        "labels")
    turn = 0
    while not edges.isEmpty():
        turn += 1
        both = edges.union(edges.select("b", "a"))
        priority = F.xxhash64(F.col("x"), F.lit(turn))
        moves = stage_table(
            both.select("a", F.col("b").alias("x")).union(edges.select("a", F.col("a").alias("x")))
            .union(edges.select(F.col("b").alias("a"), F.col("b").alias("x")))
            .groupBy("a").agg(F.min(F.struct(priority.alias("p"), F.col("x"))).getField("x").alias("to")), "moves")
        edges = stage_table(
            edges.join(moves, "a").select(F.col("to").alias("na"), F.col("b"))
            .join(moves.withColumnRenamed("a", "b"), "b").select(F.col("na").alias("a"), F.col("to").alias("b"))
            .filter("a <> b").distinct(), "links")
        labels = stage_table(
            labels.join(moves.withColumnRenamed("a", "label"), "label", "left")
            .select("node", F.coalesce("to", "label").alias("label")), "labels")
    least = stage_table(labels.groupBy("label").agg(F.min("node").alias("component")), "components")
    return labels.join(least, "label").select("node", "component")


def spanning_forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a bipartite graph, rows first and then columns, as (root, member)."""
    rows, columns = adjacent.shape
    left, right = np.ones(rows, bool), np.ones(columns, bool)
    out = []
    for start in np.flatnonzero(adjacent.any(axis=1)):
        if not left[start]:
            continue
        left[start] = False
        reached = np.array([start])
        while len(reached):
            fresh = np.flatnonzero(adjacent[reached].any(axis=0) & right)
            right[fresh] = False
            out += [(start, rows + int(x)) for x in fresh]
            reached = np.flatnonzero(adjacent[:, fresh].any(axis=1) & left) if len(fresh) else fresh
            left[reached] = False
            out += [(start, int(x)) for x in reached]
    return out
