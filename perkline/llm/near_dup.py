"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, union-find."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkline.llm.graph import components, spanning_forest
from perkline.llm.text import as_bytes, chunks, mix, seeded, shingles, words
from perkline.session import stage_table

BANDS, ROWS = 24, 4
BLOCK_ITEMS = 1 << 18
BLOCK_ROWS = 1024
SLAB = 2048
MANY = 1 << 40
_UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)


def super_min_hash(elements: np.ndarray, bounds: np.ndarray, slots: int) -> np.ndarray:
    """SuperMinHash signatures (sets x slots) of sets given as concatenated 64-bit elements.

    Element e has one random permutation of the slots; at level j it offers the value j + r(e, j) to the
    slot that its permutation names j-th. The ranks of an element are thus correlated over the slots,
    which lowers the variance. Offers of level j + 1 exceed all of level j, so a set stops as soon as each
    of its slots has a value. The permutations grow by one Fisher-Yates step per level.
    """
    sets = len(bounds) - 1
    owner = np.repeat(np.arange(sets), np.diff(bounds))
    signature = np.full(sets * slots, _UNSET, np.uint64)
    live = elements
    order: np.ndarray | None = None
    for level in range(slots):
        if not len(live):
            break
        draw = seeded(live, 2 * level + 1)
        swap = level + (seeded(live, 2 * level + 2) % np.uint64(slots - level)).astype(np.int64)
        if order is None:
            slot = swap
        else:
            rows = np.arange(len(live))
            slot = order[rows, swap]
            order[rows, swap] = order[rows, level]
            order[rows, level] = slot
        value = (np.uint64(level) << np.uint64(32)) | (draw >> np.uint64(32))
        np.minimum.at(signature, owner * slots + slot, value)
        open_sets = (signature.reshape(sets, slots) == _UNSET).any(axis=1)
        more = open_sets[owner]
        if order is None:
            first = swap[more]
            order = np.tile(np.arange(slots, dtype=np.uint8), (len(first), 1))
            order[np.arange(len(first)), first] = 0
            order[:, 0] = first
        else:
            order = order[more]
        live, owner = live[more], owner[more]
    return signature.reshape(sets, slots)


def _sketch(width: int, bands: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = as_bytes(batch.column(1))
            for low, high in chunks(bounds, 1 << 19):
                elements, cuts = shingles(words(raw, bounds[low:high + 1]), width)
                signature = super_min_hash(elements, cuts, bands * rows)
                keys = np.zeros((high - low, bands), np.uint64)
                keys += np.arange(1, bands + 1, dtype=np.uint64)
                for r in range(rows):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + signature[:, r::rows])
                sizes = np.diff(cuts)
                sums = np.zeros((2, high - low), np.uint64)
                full = sizes > 0
                for k in range(2):
                    sums[k, full] = np.add.reduceat(seeded(elements, 101 + k), cuts[:-1][full]) if full.any() else 0
                some = pa.array(~full)
                same = [pa.array(mix(sums[k]).view(np.int64), mask=~full) for k in range(2)]
                flat = pa.array(keys.reshape(-1).view(np.int64))
                offsets = pa.array(np.arange(0, bands * (high - low) + 1, bands, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(sizes), *same,
                     pa.ListArray.from_arrays(offsets, flat, mask=some)],
                    names=["doc_id", "n_shingles", "f0", "f1", "bands"])
    return run


def _sets(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = as_bytes(batch.column(1))
            for low, high in chunks(bounds):
                elements, cuts = shingles(words(raw, bounds[low:high + 1]), width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low),
                     pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(elements.view(np.int64)))],
                    names=["node", "items"])
    return run


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity. A hot node's pairs are split by AQE."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("left_items"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("right_items"))
    common = F.size(F.array_intersect("left_items", "right_items"))
    return (
        pairs.join(left, "a").join(right, "b")
        .select("a", "b", common.alias("common"), (F.size("left_items") + F.size("right_items")).alias("both"))
        .filter(100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select("a", "b").distinct())


def _block_links(percent: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Links between two blocks of sets, as a spanning forest of those between different components.

    Sizes of all intersections come from products of 0/1 matrices over the items that occur more than once.
    """
    def run(key: tuple, table: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        block, node, c = (table[x].to_numpy() for x in ("block", "node", "c"))
        lists = table["items"].combine_chunks()
        sizes = lists.value_lengths().to_numpy().astype(np.int64)
        _, item, seen = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(node)), sizes)
        often = seen[item] > 1
        number = np.cumsum(seen > 1) - 1
        owner, item = owner[often], number[item[often]]
        order = np.argsort(item, kind="stable")
        owner, item = owner[order], item[order]
        a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
        common = np.zeros((len(a), len(b)), np.float32)
        for start in range(0, int(item[-1]) + 1 if len(item) else 0, SLAB):
            i, j = np.searchsorted(item, [start, start + SLAB])
            has = np.zeros((len(node), SLAB), np.float32)
            has[owner[i:j], item[i:j] - start] = 1
            common += has[a] @ has[b].T
        either = sizes[a][:, None] + sizes[b][None, :] - common
        linked = (100 * common.astype(np.float64) >= percent * either) & (c[a][:, None] != c[b][None, :])
        both = np.concatenate([node[a], node[b]])
        pairs = spanning_forest(linked)
        return pa.table({"a": pa.array([int(both[x]) for x, _ in pairs], pa.int64()),
                         "b": pa.array([int(both[y]) for _, y in pairs], pa.int64())})
    return run


def _compare_groups(crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside groups whose buckets hold several components (key, node, n, pivot, c).

    A group is what such buckets connect. It is cut into classes of sizes, of which only equal and adjacent
    ones can hold links, and these into blocks of a bounded number of items and rows; a task compares two blocks.
    """
    edges = crowd.select(F.col("pivot.node").alias("a"), F.col("node").alias("b")).filter("a <> b").distinct()
    group = components(edges).withColumnRenamed("component", "grp")
    one = crowd.select("node", "n", "c").distinct()
    size_class = F.floor(F.log(F.col("n").cast("double")) / (math.log(100 / percent) * (1 + 1e-9))).cast("long")
    members = stage_table(one.join(group, "node").withColumn("size_class", size_class), "members")
    blocks = stage_table(
        members.groupBy("grp", "size_class").agg(F.ceil(
            F.greatest(F.sum("n") / BLOCK_ITEMS, F.count("*") / BLOCK_ROWS)).cast("long").alias("blocks")),
        "blocks")
    counted = blocks.withColumnRenamed("size_class", "own").withColumnRenamed("blocks", "own_blocks")
    near = stage_table(
        counted.join(blocks, "grp").filter(F.abs(F.col("own") - F.col("size_class")) <= 1)
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("grp", F.col("own").alias("size_class"), "own_blocks", (F.col("size_class") * MANY + F.col("part")).alias("other")),
        "near")
    dealt = (
        members.join(near, ["grp", "size_class"])
        .withColumn("block", F.col("size_class") * MANY + F.pmod(F.xxhash64("node"), "own_blocks"))
        .select("node", "c", "grp", "block", F.least("block", "other").alias("low"),
                F.greatest("block", "other").alias("high")))
    return dealt.join(sets, "node").groupBy("grp", "low", "high").applyInArrow(_block_links(percent), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS,
                    rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of near-duplicate documents: (doc_id, n_shingles, component_id, kept).

    Two documents are linked if 100 * |A & B| >= percent * |A | B| on their full sets of ``width``-word
    shingles (64-bit fingerprints). ``component_id`` is the smallest id reachable by links. Candidates share
    one of ``bands`` bands of ``rows`` SuperMinHash values; at similarity 0.85 a link goes unseen with a
    probability of 2e-8, at 0.8 of 4e-6.

    Equal sets become one node before anything is compared. In a bucket every node is compared with the
    smallest node only, and links merge nodes into components. Only where a bucket still holds several
    components are its nodes compared further, block by block, which yields at most a forest of links.

    Null or empty texts and texts of white space have no shingles and link with nothing. Rows that repeat an
    id are results of their own with the same component if their texts are equal. An empty table gives an
    empty result; other columns are ignored. Rows of one id with different texts count as linked, each text
    with its own links. Null ids are kept and form no component: ``component_id`` and
    ``kept`` of copies without a smaller id are null.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketch = stage_table(base.mapInArrow(
        _sketch(width, bands, rows),
        "doc_id long, n_shingles long, f0 long, f1 long, bands array<long>"), "sketch")
    nodes = stage_table(
        sketch.filter("f0 is not null and doc_id is not null").groupBy("f0", "f1")
        .agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"),
             F.min("n_shingles").alias("n"), F.any_value("bands").alias("bands")), "nodes")
    entries = nodes.select("node", "n", F.explode("bands").alias("key"))
    crowded = stage_table(
        entries.groupBy("key").agg(F.min(F.struct("node", "n")).alias("pivot"), F.count("*").alias("members"))
        .filter("members > 1"), "crowded")
    buckets = stage_table(entries.join(crowded, "key").select("key", "node", "n", "pivot", "members"), "buckets")

    def near(pairs: DataFrame) -> DataFrame:
        sized = pairs.filter(
            (F.col("a") != F.col("b")) & (100 * F.least("an", "bn") >= percent * F.greatest("an", "bn")))
        return sized.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    first = stage_table(near(buckets.select(
        F.col("pivot.node").alias("a"), F.col("pivot.n").alias("an"), F.col("node").alias("b"),
        F.col("n").alias("bn"))), "pairs")
    wanted = buckets.select(F.col("node").alias("doc_id")).distinct()
    texts = base.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    sets = stage_table(texts.mapInArrow(_sets(width), "node long, items array<long>"), "sets")
    links = stage_table(_confirm(first, sets, percent), "links")
    groups = components(links)
    named = stage_table(
        buckets.filter("members > 2").join(groups, "node", "left")
        .select("key", "node", "n", "pivot", F.coalesce("component", "node").alias("c")), "named")
    mixed = named.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high")
    crowd = stage_table(named.join(mixed.select("key"), "key", "left_semi"), "mixed")
    if not crowd.isEmpty():
        more = stage_table(_compare_groups(crowd, sets, percent), "links")
        groups = components(links.union(more))
    groups = stage_table(groups, "groups")
    copied = stage_table(
        nodes.join(groups, "node", "left").filter("copies > 1 or component is not null")
        .select("f0", "f1", F.coalesce("component", "node").alias("component")), "classes")
    return (
        sketch.select("doc_id", "n_shingles", "f0", "f1").join(copied, ["f0", "f1"], "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id")))
