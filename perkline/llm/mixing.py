"""Mixing sources to target weights by Poisson replication, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkline.session import stage_table

DRAW = 16.0
STEPS = 96


def uniform(key: Column, seed: int, draw: Column) -> Column:
    """A number in (0, 1) from the hash of a key, a seed and the number of the draw."""
    text = F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("null")), F.lit(str(seed)), draw.cast("string"))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def poisson_steps(rate: Column) -> Column:
    """The distribution function of a Poisson law of mean ``rate`` (at most 16) at 0, 1, 2, ..."""
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("sums"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + p)).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step, lambda state: state["sums"])


def rates(docs: DataFrame, source_col: str, weights: Mapping[str, float] | None, temperature: float,
          total: float | None) -> DataFrame:
    """Mean repetitions of each source: (source, parts, rate). A rate over 16 is drawn in several parts.

    The law of a sum of independent Poisson draws is Poisson, so parts are exact at any rate.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weighted = sizes.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(float(temperature))))
    else:
        named = docs.sparkSession.createDataFrame(
            [(k, float(w)) for k, w in weights.items()], "name string, w double")
        text = F.col("source").cast("string")
        weighted = sizes.join(named, text.eqNullSafe(F.col("name")), "left").select(
            text.alias("source"), "n", F.coalesce("w", F.lit(0.0)).alias("w"))
    sums = weighted.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    size = float(total if total is not None else sums["n"] or 0)
    scale = size / sums["w"] if sums["w"] else 0.0
    mean = F.lit(scale) * F.col("w") / F.col("n")
    parts = F.greatest(F.lit(1), F.ceil(mean / DRAW)).cast("int")
    return weighted.select("source", parts.alias("parts"), (mean / parts).alias("rate"))


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, temperature: float = 0.5,
                total: float | None = None, seed: int = 7, id_col: str = "doc_id",
                source_col: str = "source") -> DataFrame:
    """Rows of ``docs``, each repeated by a Poisson count, in a global random order, with (copy int, position long).

    The expected share of a source is its weight: given by ``weights`` (sources without one get none), else
    its number of rows to the power ``temperature``. The expected size is ``total`` rows, by default as many as
    come in. A row's count inverts the Poisson distribution at a number hashed from its id and the seed, so a
    retried task repeats it exactly; sources need no pass over their rows beyond one count. ``position`` is
    the hash that orders the result.

    Null sources are a source of their own. Rows that repeat an id get equal counts, and so do rows without
    id. Texts play no part, so null, empty and long ones are kept as they are. An empty table gives an empty
    result; columns named ``copy`` or ``position`` are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ("copy", "position")]
    steps = poisson_steps(F.col("rate"))
    table = stage_table(rates(docs, source_col, weights, temperature, total).select(
        "source", "parts", steps.alias("steps")), "rates")
    # rows travel as one column, so their names meet no other
    rows = docs.select(F.struct(*kept).alias("row"), F.col(id_col).alias("id"),
                       F.col(source_col).cast(table.schema["source"].dataType).alias("of"))
    joined = rows.join(table, F.col("of").eqNullSafe(F.col("source")))

    def drawn(number: Column) -> Column:
        return F.size(F.filter("steps", lambda step: step <= number))

    # every draw is hashed once and then compared with all steps
    numbers = F.transform(F.sequence(F.lit(1), F.col("parts")), lambda part: uniform(F.col("id"), seed, part))
    count = F.aggregate(F.transform(numbers, drawn), F.lit(0), lambda a, b: a + b)
    copies = F.explode(F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>")))
    position = F.xxhash64(F.md5(F.concat_ws(
        ":", F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(str(seed)), F.lit("order"),
        F.col("copy").cast("string"))))
    ordered = joined.select("row", "id", copies.alias("copy")).withColumn("position", position).orderBy("position", "id", "copy")
    return ordered.select("row.*", "copy", "position")
