import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from perkline.llm import host_rules

SCHEMA = "doc_id long, text string, source string, id string, host string, m string, kept string, n_words string, `of` string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(lines))


def fails(m):
    n, chars, symbols, dup, repeat, lines = m
    return {"base": n < 10 or 100 * repeat > 20 * n, "symbols": 10 * symbols > n, "lines": 10 * dup > 3 * lines,
            "word_length": chars < 3 * n or chars > 10 * n}


def prior(hosts, rule):
    n, f = np.array([h["n"] for h in hosts.values()], float), np.array([h[rule] for h in hosts.values()], float)
    mean = (f.sum() + 0.5) / (n.sum() + 1)
    between = (f * f / n).sum() / n.sum() - (f.sum() / n.sum()) ** 2 - mean * (1 - mean) * len(n) / n.sum()
    strength = min(max(mean * (1 - mean) / between - 1, 1), 1e6) if between > 0 else 1e6
    return mean, strength


def brute(data, reject=0.5, strict=0.05):
    judged = [(i, s, measures(t), fails(measures(t))) for i, t, s in data]
    hosts = {}
    for _, s, _, f in judged:
        own = hosts.setdefault(s, {"n": 0, **dict.fromkeys(f, 0)})
        own["n"] += 1
        for rule, failed in f.items():
            own[rule] += failed
    rates = {s: {} for s in hosts}
    for rule in ("base", "symbols", "lines", "word_length"):
        mean, strength = prior(hosts, rule)
        for s, h in hosts.items():
            rates[s][rule] = (h[rule] + mean * strength) / (h["n"] + strength)
    out = []
    for i, s, m, f in judged:
        rejected = rates[s]["base"] >= reject
        broken = [r for r in ("symbols", "lines", "word_length") if f[r] and rates[s][r] >= strict]
        out.append((i, s, *m, f["base"], rejected, broken, not f["base"] and not rejected and not broken))
    return out


def prose(rng, n):
    return " ".join("w" + "".join(rng.choice(list("abcdefgh"), 4)) for _ in range(n))


def corpus():
    rng = np.random.default_rng(6)
    data = []
    for k in range(40):
        data.append((f"clean{k % 4}", prose(rng, 40)))
    for k in range(30):  # every third page of a hot host is full of symbols
        data.append(("hot", prose(rng, 30) + (" # $ % & | <" if k % 3 == 0 else "")))
    for k in range(12):  # nearly all pages are too short
        data.append(("junk", prose(rng, 30) if k == 5 else "buy now"))
    data.append(("clean0", prose(rng, 30) + " # $ % & | <"))
    line = prose(rng, 6)
    data += [("lines", "\n".join([prose(rng, 8), *[f"{line} {k}" for k in range(2)], line, line, " ", "", "\t", line])) for _ in range(6)]
    data += [("odd", None), ("odd", ""), ("odd", " \n "), (None, prose(rng, 20)), (None, "a b"), ("odd", "a b c d e a b c d e"),
             ("odd", "a b c d e x a b c d e " + prose(rng, 40)), ("odd", "r " * 30), ("odd", "é ü 😀 語 " * 5), ("odd", "a b " * 12),
             ("long", prose(rng, 30_000)), ("long", prose(rng, 50) + " same five words come here " * 900), ("long", "x" * 200_000)]
    ids = list(range(len(data)))
    rows = [(i, t, s) for i, (s, t) in zip(ids, data, strict=True)]
    return [*rows, rows[0], (None, prose(rng, 15), "odd"), (None, prose(rng, 15), "odd")]


def test_equals_brute_force(spark):
    data = corpus()
    df = spark.createDataFrame([(*r, "i", "h", "m", "k", "n", "o") for r in data], SCHEMA).repartition(5)
    got = [tuple(r) for r in host_rules.apply_rules(df, strict=0.25).collect()]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted(brute(data, strict=0.25), key=key)
    held = {(r[1], tuple(r[10])) for r in got}
    assert ("hot", ("symbols",)) in held and ("clean0", ("symbols",)) not in held
    assert all(r[9] for r in got if r[1] == "junk") and not any(r[9] for r in got if r[1] == "hot")


def test_repeat_words_of_random_texts(spark):
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice(list("abc"), int(rng.integers(0, 60)))) for _ in range(150)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = df.select("i", host_rules.text_measures(F.col("t")).alias("m")).select("i", "m.words.n_repeat_words").collect()
    assert {r[0]: r[1] for r in got} == {i: measures(t)[4] for i, t in enumerate(texts)}


def test_empty_table_and_plan(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert host_rules.apply_rules(empty).count() == 0
    df = spark.createDataFrame([(1, "a b", "h", *"abcdef")], SCHEMA)
    plan = host_rules.apply_rules(df)._jdf.queryExecution().toString() + host_rules.judge(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("failed", [[0, 0, 0], [50, 50, 50], [0, 0, 50], [1, 2, 3]])
def test_prior_is_finite(spark, failed):
    hosts = spark.createDataFrame([(50, f) for f in failed], "n long, f long")
    alpha, beta = host_rules.beta_prior(hosts, "f")
    assert 0 < alpha < 1e7 and 0 < beta < 1e7
    assert host_rules.beta_prior(hosts.limit(0), "f") == (1.0, 1.0)
