"""Quality classifier: document evidence combined with site posteriors by hierarchical empirical Bayes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from perkline.llm.html_text import host_of, section_of
from perkline.llm.text import LETTERS, as_bytes, chunks, words
from perkline.session import stage_table

SAMPLE = 12_000
BUCKETS = 1 << 16
LEVELS = 24
SHAPES = 10
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def shape_levels(raw: np.ndarray, bounds: np.ndarray, first: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Form of each text as levels (texts x measures): case, symbols, digits, length, repetition."""
    texts, size = len(bounds) - 1, np.maximum(np.diff(bounds), 1)
    count = np.diff(first)

    def share(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[bounds[1:]] - sums[bounds[:-1]]) / size

    text = np.repeat(np.arange(texts), count)

    def distinct(width: int) -> np.ndarray:
        """Share of different sequences of ``width`` words."""
        n = np.maximum(count - width + 1, 0)
        value = prints.copy()
        for k in range(1, width):
            value[:len(value) - k] = value[:len(value) - k] * np.uint64(0x9E3779B97F4A7C15) + prints[k:]
        inside = np.arange(len(prints)) - first[text] < n[text]
        pairs = np.stack([text[inside].astype(np.uint64), value[inside]], axis=1)
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        pairs = pairs[order]
        new = np.ones(len(pairs), bool)
        new[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
        return np.bincount(pairs[new, 0].astype(np.int64), minlength=texts) / np.maximum(n, 1)

    again = np.zeros(len(prints), bool)
    again[1:] = (prints[1:] == prints[:-1]) & (text[1:] == text[:-1])
    shares = [share(_UPPER[raw]), share(_SYMBOL[raw]), share(_DIGIT[raw]), share(raw >= 128), share(raw == 10),
              np.bincount(text, again, minlength=texts) / np.maximum(count, 1), 1 - distinct(1), 1 - distinct(3)]
    levels = [np.sqrt(np.clip(s, 0, 1)) * (LEVELS - 1) for s in shares]
    levels += [2 * np.log2(1 + count), 4 * np.log2(size / np.maximum(count, 1))]
    return np.clip(np.stack(levels, axis=1), 0, LEVELS - 1).astype(np.int64)


def features(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of consecutive texts as pairs (text, feature): hashed words present, and levels of form."""
    raw, bounds = raw[bounds[0]:bounds[-1]], bounds - bounds[0]
    found = words(raw, bounds, LETTERS)
    texts = len(bounds) - 1
    text = np.repeat(np.arange(texts), found.counts)
    pair = np.unique(text * BUCKETS + (found.prints >> np.uint64(48)).astype(np.int64))
    levels = shape_levels(raw, bounds, found.first, found.prints) + BUCKETS + LEVELS * np.arange(SHAPES)
    return (np.concatenate([pair // BUCKETS, np.repeat(np.arange(texts), SHAPES)]),
            np.concatenate([pair % BUCKETS, levels.reshape(-1)]))


@dataclass
class Model:
    """Weights of the features, the intercept included: the evidence is their sum."""

    weight: np.ndarray
    bias: float

    def logits(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        text, feature = features(raw, bounds)
        return self.bias + np.bincount(text, self.weight[feature], minlength=len(bounds) - 1)


def fit(rows: list[np.ndarray], good: np.ndarray, least: float = 14.0, ridge: float = 0.5, rounds: int = 300) -> Model:
    """Logistic regression on the features whose presence tells the classes apart (a G statistic of ``least``)."""
    size = BUCKETS + LEVELS * SHAPES
    weight = np.zeros(size)
    n, positive = len(good), int(good.sum())
    if positive in (0, n):
        return Model(weight, 8.0 if positive or not n else -8.0)
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    feature = np.concatenate(rows).astype(np.int64)
    seen = np.bincount(feature, good[owner], minlength=size), np.bincount(feature, 1.0 - good[owner], minlength=size)
    tells = np.zeros(size)
    for own, other, total in ((seen[0], seen[1], positive), (seen[1], seen[0], n - positive)):
        for count in (own, total - own):
            expected = (own + other if count is own else n - own - other) * (total / n)
            tells += 2 * count * np.log(np.maximum(count, 1e-9) / np.maximum(expected, 1e-9))
    chosen = (tells >= least) | (np.arange(size) >= BUCKETS)
    use = chosen[feature]
    owner, feature = owner[use], feature[use]
    bias, step = float(np.log(positive / (n - positive))), np.zeros(size + 1)
    square = np.zeros(size + 1)
    for turn in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-(bias + np.bincount(owner, weight[feature], minlength=n))))
        error = p - good
        slope = np.append(np.bincount(feature, error[owner], minlength=size) + ridge * weight, error.sum()) / n
        step = 0.9 * step + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        move = 0.05 * (step / (1 - 0.9 ** turn)) / (np.sqrt(square / (1 - 0.99 ** turn)) + 1e-8)
        weight, bias = weight - np.where(chosen, move[:-1], 0), bias - float(move[-1])
    return Model(weight, bias)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, bounds = as_bytes(batch.column(1))
        out: list[bytes] = []
        for a, b in chunks(bounds):
            text, feature = features(raw, bounds[a:b + 1])
            order = np.argsort(text, kind="stable")
            cuts = np.searchsorted(text[order], np.arange(1, b - a))
            out += [x.astype(np.int32).tobytes() for x in np.split(feature[order], cuts)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["good", "features"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text") -> Model:
    """Fit on the at most ``sample`` labelled documents of least hash; good is quality 1 and not toxic.

    Labels that lack a value are left out; of labels that repeat an id the worst counts, of documents any one.
    Without both classes the model knows nothing but the class there is.
    """
    known = (
        labels.filter(F.col(id_col).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("_id"))
        .agg(((F.min("quality") == 1) & (F.max("toxic") == 0)).alias("good"))
        .orderBy(F.xxhash64("_id"), "_id").limit(sample))
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    few = texts.join(F.broadcast(stage_table(known, "labelled")), "_id").dropDuplicates(["_id"]).select("good", "text")
    rows = few.mapInArrow(_extract, "good boolean, features binary").collect()
    return fit([np.frombuffer(r["features"], np.int32) for r in rows], np.array([r["good"] for r in rows], float))


def _scores(model: Model, at: int, keep_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Append the evidence of column ``at``, which itself goes unless ``keep_text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = as_bytes(batch.column(at))
            parts = [model.logits(raw, bounds[a:b + 1]) for a, b in chunks(bounds)]
            logit = np.concatenate(parts) if parts else np.zeros(0)
            kept = [(c, n) for i, (c, n) in enumerate(zip(batch.columns, batch.schema.names, strict=True))
                    if keep_text or i != at]
            yield pa.RecordBatch.from_arrays(
                [*(c for c, _ in kept), pa.array(logit)], names=[*(n for _, n in kept), "_evidence"])
    return run


def _chance(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def _strength(groups: DataFrame, mean: Column) -> float:
    """Prior strength by the moments of group means: large if groups differ no more than chance makes them.

    ``groups`` has n rows and the sum s of each group, ``mean`` is the parent's mean.
    """
    m = F.least(F.greatest(mean, F.lit(1e-6)), F.lit(1 - 1e-6))
    own = F.col("s") / F.col("n")
    got = groups.agg(
        F.sum(F.col("n") * (own - m) ** 2 / (m * (1 - m))).alias("between"), F.sum(F.col("n") - 1).alias("free"),
        F.count("*").alias("groups")).first()
    if not got["free"] or not got["groups"]:
        return 1e6
    alike = (got["between"] - got["groups"]) / got["free"]
    return float(min(max(1 / max(alike, 1e-6) - 1, 1.0), 1e6))


def with_site(docs: DataFrame, url_col: str = "url", host_col: str = "host", path_col: str = "path") -> DataFrame:
    """``docs`` with the host of each document's address and its first folder below it, for ``classify``.

    Both are null without an address; a page in no folder has a host only. Columns of these names are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in (host_col.lower(), path_col.lower())]
    url = docs[url_col].cast("string")
    return docs.select(*[docs[c] for c in kept], host_of(url).alias(host_col), section_of(url).alias(path_col))


def classify(docs: DataFrame, model: Model, host_col: str = "source", path_col: str = "lang",
             text_col: str = "text") -> DataFrame:
    """``docs`` with (evidence, site, probability double, kept boolean), one row each.

    ``evidence`` is the model's chance that the document is good; ``site`` the posterior mean of its path
    below its host. Sums of evidence are grouped by path and by host; the global mean is the prior of the
    hosts, each host's posterior mean the prior of its paths, with strengths from the moments of the groups,
    so sparse sites shrink towards what stands above them. ``probability`` is the evidence moved by the odds
    of the site against the global odds, and a document is kept from 0.5 on.

    The texts are read twice and never shuffled; only sums per path are. Null hosts and paths are groups of
    their own; null and empty texts are judged by their form; repeated rows are judged each and alike. An
    empty table gives an empty result; columns named like the results are replaced.
    """
    own = ("evidence", "site", "probability", "kept")
    kept = [c for c in docs.columns if c.lower() not in own]
    others = F.struct(*[c for c in kept if c != text_col]).alias("row")
    # a row's other columns travel as one, so their names meet no other
    base = docs.select(F.col(host_col).alias("_host"), F.col(path_col).alias("_path"), others,
                       F.col(text_col).cast("string").alias("_text"))
    slim = base.drop("row")
    sums = slim.mapInArrow(_scores(model, 2, False), _scored(slim.drop("_text"))).groupBy("_host", "_path").agg(
        F.count("*").alias("n"), F.sum(_chance(F.col("_evidence"))).alias("s"))
    paths = stage_table(sums, "paths")
    hosts = stage_table(paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "hosts")
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    prior = min(max(whole["s"] / whole["n"], 1e-6), 1 - 1e-6) if whole["n"] else 0.5
    strong = _strength(hosts, F.lit(prior))
    means = hosts.select(F.col("_host").alias("_h"),
                         ((F.col("s") + strong * prior) / (F.col("n") + strong)).alias("mean"))
    below = stage_table(
        paths.join(means, F.col("_host").eqNullSafe(F.col("_h"))).select("_host", "_path", "n", "s", "mean"), "below")
    close = _strength(below, F.col("mean"))
    site = (F.col("s") + close * F.col("mean")) / (F.col("n") + close)
    sites = stage_table(below.select(F.col("_host").alias("_h"), F.col("_path").alias("_p"), site.alias("site")), "sites")
    scored = base.mapInArrow(_scores(model, 3, True), _scored(base))
    joined = scored.join(sites, F.col("_host").eqNullSafe(F.col("_h")) & F.col("_path").eqNullSafe(F.col("_p")))
    bounded = F.least(F.greatest("site", F.lit(1e-6)), F.lit(1 - 1e-6))
    shift = F.log(bounded / (1 - bounded)) - float(np.log(prior / (1 - prior)))
    return joined.select(
        *[F.col("_text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in kept],
        _chance(F.col("_evidence")).alias("evidence"), "site",
        _chance(F.col("_evidence") + shift).alias("probability"),
        (F.col("_evidence") + shift >= 0).alias("kept"))


def _scored(df: DataFrame) -> StructType:
    return StructType([*df.schema.fields, StructField("_evidence", DoubleType())])
