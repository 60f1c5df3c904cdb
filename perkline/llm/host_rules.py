"""Quality rules at the level of hosts: what a document is held to depends on the record of its host.

DataFrame functions only. The measures of a text are taken with array functions inside its row; only sums per
host are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkline.session import stage_table

# White space between words, symbols that are counted.
WHITE = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WIDTH = 5

#: Rules every document must meet, and rules it must meet where its host often breaks them.
BASE_RULES: dict[str, Callable[[], Column]] = {
    "short": lambda: F.col("n_words") < 10,
    "repeats": lambda: 100 * F.col("n_repeat_words") > 20 * F.col("n_words"),
}
HOST_RULES: dict[str, Callable[[], Column]] = {
    "symbols": lambda: 10 * F.col("n_symbols") > F.col("n_words"),
    "lines": lambda: 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
    "word_length": lambda: (F.col("word_chars") < 3 * F.col("n_words")) | (F.col("word_chars") > 10 * F.col("n_words")),
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(text: Column) -> Column:
    core = F.btrim(text, F.lit(WHITE))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, GAP))


def _windows(words: Column) -> Column:
    """A 64-bit hash of every window of ``WIDTH`` words."""
    at = F.sequence(F.lit(0), F.size(words) - WIDTH)
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WIDTH)]))
    return F.when(F.size(words) >= WIDTH, hashes).otherwise(F.array().cast("array<bigint>"))


def _repeat_words(windows: Column) -> Column:
    """Words in windows that stand at least twice in the text.

    Texts without equal windows, which are most, are settled by counting distinct ones. Of the others the
    windows are sorted with their places: equal ones are neighbours. Windows that follow each other within
    their width share words, which count once.
    """
    def covered(starts: Column) -> Column:
        following = F.slice(starts, F.lit(2), F.greatest(F.size(starts), F.lit(1)))
        steps = F.zip_with(starts, following, lambda a, b: F.least(F.lit(WIDTH), b - a).cast("long"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def places(ordered: Column) -> Column:
        equal = F.filter(ordered, lambda x, i: (x["h"] == F.get(ordered, i - 1)["h"]) | (x["h"] == F.get(ordered, i + 1)["h"]))
        return F.sort_array(F.transform(equal, lambda x: x["at"]))

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    found = _let(_let(ordered, places), covered)
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(found)


def text_measures(text: Column) -> Column:
    """Struct of the counts that rules use; null counts as an empty text.

    ``n_repeat_words`` compares 64-bit hashes of windows inside one text. ``n_lines`` are the lines with a word,
    ``n_dup_lines`` those of them that equal an earlier line, ``word_chars`` the code points of all words.
    """
    def measured(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")

        def of_words(words: Column) -> Column:
            return F.struct(
                F.size(words).cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                _let(_windows(words), _repeat_words).alias("n_repeat_words"))

        def of_lines(kept: Column) -> Column:
            return F.struct(F.size(kept).cast("long").alias("n_lines"),
                            (F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"))

        return F.struct(_let(_words(t), of_words).alias("words"), _let(lines, of_lines).alias("lines"),
                        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    return _let(F.coalesce(text, F.lit("")), measured)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def beta_prior(hosts: DataFrame, failed: str) -> tuple[float, float]:
    """Parameters of a beta distribution of the hosts' failure rates, from their first two moments.

    Each host's rate counts by its documents. What varies between hosts beyond the binomial noise of their sizes sets how
    strong the prior is; hosts that are no more different than chance makes them get a prior of a million documents.
    """
    sums = hosts.agg(F.sum("n").alias("n"), F.sum(failed).alias("f"), F.count("*").alias("hosts"),
                     F.sum(F.col(failed) * F.col(failed) / F.col("n")).alias("squares")).first()
    if not sums["n"]:
        return 1.0, 1.0
    mean = (sums["f"] + 0.5) / (sums["n"] + 1)
    rate = sums["f"] / sums["n"]
    noise = mean * (1 - mean) * sums["hosts"] / sums["n"]
    between = sums["squares"] / sums["n"] - rate * rate - noise
    strength = mean * (1 - mean) / between - 1 if between > 0 else 1e6
    strength = min(max(strength, 1.0), 1e6)
    return mean * strength, (1 - mean) * strength


def host_verdicts(judged: DataFrame, reject: float = 0.5, strict: float = 0.05) -> DataFrame:
    """(host, n, rates, rejected, held_to): the record of every host and what follows from it.

    ``rates`` are posterior means of the failure rates: the host's own counts with the beta prior of all hosts, so a
    host of few documents stays near the rate of all. A host is rejected if its rate of base failures reaches
    ``reject``, and held to each host rule whose rate reaches ``strict``.
    """
    rules = ("base", *HOST_RULES)
    counts = judged.groupBy("host").agg(F.count("*").alias("n"), *[F.count_if(F.col(f"fails_{r}")).alias(f"f_{r}") for r in rules])
    hosts = stage_table(counts, "hosts")

    def rate(rule: str) -> Column:
        alpha, beta = beta_prior(hosts, f"f_{rule}")
        return (F.col(f"f_{rule}") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))

    rates = F.struct(*[rate(r).alias(r) for r in rules])
    return hosts.select("host", "n", rates.alias("rates")).select(
        "host", "n", "rates", (F.col("rates.base") >= reject).alias("rejected"),
        F.struct(*[(F.col(f"rates.{r}") >= strict).alias(r) for r in HOST_RULES]).alias("held_to"))


def judge(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """(id, host, counts, base_failed, fails_base, fails_<rule>) of each whole text."""
    counted = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"),
                          text_measures(F.col(text_col).cast("string")).alias("m"))
    flat = counted.select("id", "host", "m.words.n_words", "m.words.word_chars", "m.n_symbols", "m.lines.n_dup_lines",
                          "m.words.n_repeat_words", "m.lines.n_lines")
    base = F.lit(False)
    for rule in BASE_RULES.values():
        base = base | rule()
    return flat.withColumn("base_failed", base).select(
        "*", F.col("base_failed").alias("fails_base"), *[rule().alias(f"fails_{name}") for name, rule in HOST_RULES.items()])


def apply_rules(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text",
                reject: float = 0.5, strict: float = 0.05) -> DataFrame:
    """(id, host, counts, base_failed, host_rejected, broken, kept), one row for each row of ``docs``.

    A document goes if it fails a base rule, if its host is rejected, or if it breaks a host rule that its host
    is held to (``broken`` names these); a clean document of a host with a poor record stays, unless most of the host's
    documents fail.

    Texts are read once and not shuffled: their counts are stored, summed by host, and joined with the verdicts.
    Null texts are empty ones, and without words they fail; documents without a host form one host; rows that
    repeat an id are judged each, ties do not arise. An empty table gives an empty result; other columns are ignored,
    whatever their names.
    """
    judged = stage_table(judge(docs, id_col, host_col, text_col), "judged")
    verdicts = host_verdicts(judged, reject, strict).select(F.col("host").alias("of"), "rejected", "held_to")
    broken = F.array_compact(F.array(*[
        F.when(F.col(f"fails_{r}") & F.col(f"held_to.{r}"), F.lit(r)) for r in HOST_RULES]))
    joined = judged.join(verdicts, F.col("host").eqNullSafe(F.col("of"))).withColumn("broken", broken)
    return joined.select(
        F.col("id").alias(id_col), "host", *MEASURES, "base_failed", F.col("rejected").alias("host_rejected"), "broken",
        (~F.col("base_failed") & ~F.col("rejected") & (F.size("broken") == 0)).alias("kept"))
