"""Hard negatives by threshold joins on an inverted index whose lists leave out what norm bounds cover.

Anchors and rows meet in blocks. In a block the dimensions are ordered by mass, and a row is listed under its leading
dimensions only: what is left of it is too short to reach an anchor's threshold alone. Partial scores are accumulated
list by list and dropped as soon as the norms of what remains cannot lift them to the threshold. Thresholds start
high and are lowered, for the windows that are not full yet, over all blocks at once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkline.llm.embed_dedup import usable
from perkline.llm.topk import quantised
from perkline.session import stage_table

BLOCK_ROWS = 8192
ANCHOR_ROWS = 1024
#: Anchors that share an index, and dimensions that are accumulated at a time.
GROUP = 128
STEP = 8
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Thresholds of positives as shares of the largest possible score, and of negatives as shares of the way from a
#: window's upper end to its lower one. After the last there is nothing left to find.
POSITIVE_LEVELS = (0.8, 0.5, 0.3)
NEGATIVE_LEVELS = (0.15, 0.5, 1.0)
_FOUND = "anchor_id long, cap long, vec_id long, score long"


def _kind(values: np.ndarray, others: np.ndarray) -> np.dtype:
    """The cheapest type in which all sums of products are exact."""
    largest = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (values, others)]
    most = values.shape[1] * (largest[0] + 1) * (largest[1] + 1)
    return np.dtype(np.float64 if most < 1 << 53 else np.int64 if most < 1 << 62 else object)


class InvertedIndex:
    """Rows in vertical layout, each listed under leading dimensions until its suffix norm falls under ``cover``.

    ``cover`` is the least share threshold / anchor norm of the anchors that will ask: a suffix shorter than that adds less
    than the threshold, so a row that reaches it has a part in the lists. Rows are ordered by the length of their
    listed part, so every list is a leading range; the dimensions left out stay for verification.
    """

    def __init__(self, columns: np.ndarray, rest: np.ndarray, cover: float):
        steps = len(rest) - 1
        length = np.full(columns.shape[1], steps)
        if cover > 0:
            covered = rest[:steps] * (1 + 1e-9) + 1e-6 < cover
            length = np.where(covered.any(axis=0), covered.argmax(axis=0), steps)
        self.order = np.argsort(-length, kind="stable")
        self.columns = np.ascontiguousarray(columns[:, self.order])
        self.rest = rest[:, self.order]
        self.listed = np.searchsorted(-length[self.order], -np.arange(steps), "left")

    def join(self, query: np.ndarray, rest: np.ndarray, allowed: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the allowed rows with a score of at least ``least``."""
        live = np.flatnonzero(allowed[self.order[:self.listed[0]]])
        score = np.zeros(len(live), self.columns.dtype)
        done = []

        def reach(score: np.ndarray, step: int, rows: np.ndarray) -> np.ndarray:
            return score.astype(np.float64) + rest[step] * self.rest[step, rows] * (1 + 1e-9) + 1e-6 >= least

        for step, listed in enumerate(self.listed.tolist()):
            ended = int(np.searchsorted(live, listed))
            if ended < len(live):
                done.append((step, live[ended:], score[ended:]))
                live, score = live[:ended], score[:ended]
            low, high = step * STEP, (step + 1) * STEP
            score = score + query[low:high] @ self.columns[low:high, live]
            keep = reach(score, step + 1, live)
            if not keep.all():
                live, score = live[keep], score[keep]
        for step, rows, partial in done:
            keep = reach(partial, step, rows)
            rows = rows[keep]
            live = np.concatenate([live, rows])
            score = np.concatenate([score, partial[keep] + query[step * STEP:] @ self.columns[step * STEP:, rows]])
        found = score >= least
        return self.order[live[found]], score[found]


def suffix_norms(rows: np.ndarray) -> np.ndarray:
    """Norms of what is left of each column of dimensions behind every step: (steps + 1) x rows."""
    squares = rows.astype(np.float64) ** 2
    left = np.vstack([np.cumsum(squares[::-1], axis=0)[::-1], np.zeros((1, rows.shape[1]))])
    return np.sqrt(np.vstack([left[::STEP], left[-1:]]) if len(rows) % STEP else left[::STEP])


def _search(same: bool, k: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """The ``k`` best rows of each window (cap, floor) of the anchors of a block pair."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        asks = table["asks"].to_numpy()
        label = table["label"].combine_chunks().dictionary_encode().indices.to_numpy()
        ids = table["vec_id"].to_numpy()
        values = table["v"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        queries, rows = values[asks], values[~asks]
        out: tuple[list, list, list, list] = ([], [], [], [])
        if len(queries) and len(rows):
            kind = _kind(queries, rows)
            columns = rows.T.astype(kind)
            heavy = np.argsort(-(columns.astype(np.float64) ** 2).sum(axis=1), kind="stable")
            columns, queries = columns[heavy], queries[:, heavy].astype(kind)
            rest, own_rest = suffix_norms(columns), suffix_norms(queries.T)
            windows = table["windows"].filter(pa.array(asks)).to_pylist()
            floor = np.array([float(min(w["floor"] for w in ws)) for ws in windows])
            with np.errstate(divide="ignore", invalid="ignore"):
                cover = np.where(floor > 0, np.where(own_rest[0] > 0, floor / own_rest[0], np.inf), 0.0)
            row_ids, row_label = ids[~asks], label[~asks]
            turn = np.argsort(-cover, kind="stable")
            for low in range(0, len(turn), GROUP):
                group = turn[low:low + GROUP]
                index = InvertedIndex(columns, rest, float(cover[group].min()))
                for a in group.tolist():
                    own = label[asks][a]
                    allowed = ((row_label == own) if same else (row_label != own)) & (row_ids != ids[asks][a])
                    place, score = index.join(queries[a], own_rest[:, a], allowed, floor[a])
                    _windows(windows[a], row_ids[place], score, k, int(ids[asks][a]), out)
        joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        return pa.table(dict(zip(("anchor_id", "cap", "vec_id", "score"), map(pa.array, joined), strict=True)))
    return run


def _windows(windows: list[dict], ids: np.ndarray, score: np.ndarray, k: int, anchor: int, out: tuple) -> None:
    score = np.array([min(max(int(s), LEAST), MOST) for s in score], np.int64) if score.dtype == object else score.astype(np.int64)
    order = np.lexsort((ids, np.invert(score)))
    ids, score = ids[order], score[order]
    for window in windows:
        # scores fall, so a window is a range of them
        inside = np.flatnonzero((score <= window["cap"]) & (score >= window["floor"]))[:k]
        for column, value in zip(out, (np.full(len(inside), anchor), np.full(len(inside), window["cap"]), ids[inside],
                                       score[inside]), strict=True):
            column.append(value)


def _indexed(vectors: DataFrame, anchors: Column, id_col: str, label_col: str, vector_col: str, scale: int,
             block_rows: int) -> tuple[DataFrame, int]:
    """The rows that take part, stored with their blocks, and the number of blocks.

    A label with more rows than a block has is dealt to several (``split``), so anchors look for rows of their own
    label in few blocks, and no block follows the size of a label.
    """
    used = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("asks"), quantised(F.col(vector_col), scale).alias("v"))
    used = stage_table(used, "vectors")
    parts = max(1, -(-used.count() // block_rows))
    large = used.groupBy("label").agg(F.count("*").alias("n")).filter(F.col("n") > block_rows).select(
        F.col("label").alias("of"), F.ceil(F.col("n") / block_rows).alias("pieces"))
    dealt = used.join(stage_table(large, "large"), F.col("label") == F.col("of"), "left").withColumn(
        "split", F.coalesce("pieces", F.lit(1).cast("long")))
    salt = F.pmod(F.xxhash64("vec_id"), F.col("split"))
    return stage_table(dealt.select(
        "vec_id", "label", "asks", "v", F.size("v").alias("dim"), "split", _block(salt, parts).alias("block")), "index"), parts


def _block(salt: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64("label", salt), F.lit(parts)).cast("long")


def _round(rows: DataFrame, parts: int, asking: DataFrame, turns: int, same: bool, k: int) -> DataFrame:
    """The ``k`` best rows of each asking window: (anchor_id, cap, vec_id, score, place). Anchors come in ``turns``."""
    salts = F.sequence(F.lit(0).cast("long"), F.col("split") - 1)
    blocks = (F.array_distinct(F.transform(salts, lambda s: _block(s, parts))) if same
              else F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    spot = F.pmod(F.xxhash64("vec_id"), F.lit(turns))
    queries = asking.select(
        "dim", spot.alias("turn"), F.explode(blocks).alias("block"), F.lit(True).alias("asks"), "vec_id", "label", "v", "windows")
    offered = rows.select(
        "dim", F.explode(F.sequence(F.lit(0), F.lit(turns - 1)).cast("array<long>")).alias("turn"), "block",
        F.lit(False).alias("asks"), "vec_id", "label", "v", F.lit(None).cast("array<struct<cap:bigint,floor:bigint>>").alias("windows"))
    pairs = queries.unionByName(offered).repartition(parts * turns, "dim", "turn", "block")
    best = pairs.groupBy("dim", "turn", "block").applyInArrow(_search(same, k), _FOUND)
    order = Window.partitionBy("anchor_id", "cap").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _lowering(rows: DataFrame, parts: int, anchors: DataFrame, windows: DataFrame, floors: Sequence[Column], same: bool, k: int,
              anchor_rows: int) -> DataFrame:
    """Rounds with ever lower floors until every window (anchor_id, cap) has ``k`` rows or the last floor is reached.

    A window that is full at a floor is settled, as no row above the floor is missing; only the others ask again.
    """
    results = []
    left = windows.count()
    for number, floor in enumerate(floors if left else floors[-1:]):
        asked = windows.groupBy(F.col("anchor_id").alias("of")).agg(
            F.collect_list(F.struct("cap", floor.alias("floor"))).alias("windows"))
        asking = anchors.join(asked, F.col("vec_id") == F.col("of")).drop("of")
        turns = max(1, -(-left // anchor_rows))  # an anchor has one window at least
        found = stage_table(_round(rows, parts, asking, turns, same, k), "found")
        if number + 1 == len(floors):
            results.append(found)
            break
        full = found.filter(F.col("place") == k).select("anchor_id", "cap")
        results.append(found.join(full, ["anchor_id", "cap"], "left_semi"))
        windows = stage_table(windows.join(full, ["anchor_id", "cap"], "left_anti"), "windows")
        left = windows.count()
        if not left:
            break
    return reduce(DataFrame.unionByName, results)


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                   scale: int = 256, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                   block_rows: int = BLOCK_ROWS, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` selects the anchors. An anchor's positives are the ``positives`` other rows of its label with the
    highest exact integer inner product of floor(scale * x); for each of them the negatives are the first ``negatives``
    rows of other labels whose score is ``low`` to ``high`` percent of the positive's. Ties go to the smaller id.

    Rows without id, with a null label, or whose vector is null, empty or holds null or non-finite components take no part;
    only vectors of equal length are compared. Rows that carry the anchor's id are not its partners; other rows that
    repeat an id are ranked each; of anchors that repeat one, that of the least label and vector asks. A positive
    without negatives, such as one of a negative score, has no row. Components and scores beyond a long are cut to its
    range. An empty table gives an empty result; other columns are ignored, whatever their names.
    """
    rows, parts = _indexed(vectors, anchors, id_col, label_col, vector_col, scale, block_rows)
    first = Window.partitionBy("vec_id").orderBy("label", "v")
    asking = rows.filter("asks").withColumn("copy", F.row_number().over(first)).filter("copy = 1").select(
        "vec_id", "label", "dim", "split", "v")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    asking = stage_table(asking.withColumn("norm", norm), "anchors")
    longest = rows.agg(F.max(norm)).first()[0] or 0.0

    whole = asking.select(F.col("vec_id").alias("anchor_id"), F.lit(MOST).alias("cap"), "norm")
    bars = [F.ceil(F.col("norm") * (longest * level)) for level in POSITIVE_LEVELS]
    own = _lowering(rows, parts, asking, whole, [*bars, F.lit(LEAST)], True, positives, anchor_rows)
    own = stage_table(own.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                                 F.col("place").alias("position")), "positives")

    def percent(share: int) -> Column:
        return F.col("positive_score").cast("decimal(20,0)") * F.lit(share).cast("decimal(10,0)") / 100

    cap, floor = F.floor(percent(high)).cast("long"), F.ceil(percent(low)).cast("long")
    bounded = own.withColumns({"cap": cap, "floor": floor})
    windows = stage_table(bounded.filter("floor <= cap").select("anchor_id", "cap", "floor").distinct(), "windows")
    way = F.col("cap").cast("double") - F.col("floor").cast("double")
    steps = [F.greatest("floor", (F.col("cap") - F.ceil(way * level)).cast("long")) for level in NEGATIVE_LEVELS[:-1]]
    other = _lowering(rows, parts, asking, windows, [*steps, F.col("floor")], False, negatives, anchor_rows)
    return bounded.join(other, ["anchor_id", "cap"]).select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
