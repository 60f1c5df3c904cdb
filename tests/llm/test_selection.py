import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from perkline.llm import mixing, quality

SF = "/root/testdata/sf0.01"


def test_replication_follows_the_weights(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("aaaaaab") if i % 50 else None) for i in range(6000)]
    docs = spark.createDataFrame([(i, s, None if i % 9 else "t", "x", 5) for i, s in rows],
                                 "doc_id long, source string, text string, copy string, n int")
    mixed = mixing.mix_sources(docs, {"a": 1, "b": 3, "zz": 9}, total=20_000)
    assert mixed.columns == ["doc_id", "source", "text", "n", "copy", "position"]
    out = mixed.collect()
    size = Counter(r["source"] for r in out)
    assert set(size) == {"a", "b"}
    assert size["b"] / size["a"] == pytest.approx(3, rel=0.06) and len(out) == pytest.approx(20_000, rel=0.05)
    assert [r["position"] for r in out] == sorted(r["position"] for r in out)
    counts = Counter(r["doc_id"] for r in out if r["source"] == "b")
    rate = 15_000 / sum(s == "b" for _, s in rows)
    drawn = np.array([counts[i] for i, s in rows if s == "b"])
    assert rate > mixing.DRAW and drawn.var() == pytest.approx(rate, rel=0.2)
    assert all(sorted(r["copy"] for r in out if r["doc_id"] == i) == list(range(1, n + 1)) for i, n in list(counts.items())[:20])
    again = mixing.mix_sources(docs.repartition(7), {"a": 1, "b": 3, "zz": 9}, total=20_000).collect()
    assert [(r["doc_id"], r["copy"]) for r in again] == [(r["doc_id"], r["copy"]) for r in out]


def test_mixing_by_temperature_and_edge_cases(spark):
    docs = spark.createDataFrame([(i, "a" if i < 900 else "b") for i in range(1000)] + [(None, None), (7, "a"), (7, "a")],
                                 "doc_id long, source string")
    size = Counter(r["source"] for r in mixing.mix_sources(docs, temperature=0.0, total=3000).collect())
    assert all(size[s] == pytest.approx(1000, rel=0.15) for s in ("a", "b"))
    same = Counter((r["doc_id"], r["copy"]) for r in mixing.mix_sources(docs, temperature=1.0, total=5000).collect())
    assert len({n for (i, _), n in same.items() if i == 7}) == 1
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_poisson_steps_are_the_distribution(spark):
    row = spark.range(1).select(mixing.poisson_steps(F.lit(3.5)).alias("s")).first()["s"]
    for k in (0, 1, 4, 12):
        assert row[k] == pytest.approx(sum(math.exp(-3.5) * 3.5 ** j / math.factorial(j) for j in range(k + 1)))


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = docs.join(labels, "doc_id").select("doc_id", "quality", "toxic").collect()
    fold = {r["doc_id"] for r in known if r["doc_id"] % 4 == 1}
    model = quality.train(docs, labels.filter("doc_id % 4 <> 1"))
    kept = {r["doc_id"]: r["kept"] for r in quality.classify(docs, model).collect()}
    clean = [kept[r["doc_id"]] for r in known if r["doc_id"] in fold and r["quality"] == 1 and r["toxic"] == 0]
    poor = [kept[r["doc_id"]] for r in known if r["doc_id"] in fold and r["quality"] == 0]
    assert np.mean(clean) > 0.95 and np.mean(poor) < 0.3


def site_logits(rows, evidence, prior, host_strength, path_strength):
    """Posterior log odds by the formulas, in plain Python."""
    hosts, paths = {}, {}
    for (_, h, p), e in zip(rows, evidence, strict=True):
        for table, key in ((hosts, h), (paths, (h, p))):
            n, s = table.get(key, (0, 0.0))
            table[key] = n + 1, s + e
    out = []
    for (_, h, p), e in zip(rows, evidence, strict=True):
        n, s = hosts[h]
        mean = (s + host_strength * prior) / (n + host_strength)
        n, s = paths[h, p]
        site = (s + path_strength * mean) / (n + path_strength)
        out.append(math.log(e / (1 - e)) + math.log(site / (1 - site)) - math.log(prior / (1 - prior)))
    return out


def test_site_posteriors_shrink(spark):
    rng = random.Random(6)
    rows = []
    for h in range(30):
        for p in range(rng.randrange(1, 4)):
            bad = rng.random() < 0.4
            rows += [(("junk " if rng.random() < (0.9 if bad else 0.05) else "fine ") * 3, f"h{h}", f"p{p}")
                     for _ in range(rng.choice([1, 2, 30]))]
    rows += [(None, None, None), ("", "h1", None), ("fine " * 50_000, "h1", "p0")]
    docs = spark.createDataFrame([(i, *r, 1.0) for i, r in enumerate(rows)],
                                 "doc_id long, text string, source string, lang string, evidence double")
    labels = spark.createDataFrame([(i, int("junk" not in (r[0] or "")), 0) for i, r in enumerate(rows)],
                                   "doc_id long, quality int, toxic int")
    out = quality.classify(docs, quality.train(docs, labels))
    assert out.columns == ["doc_id", "text", "source", "lang", "evidence", "site", "probability", "kept"]
    got = {r["doc_id"]: r for r in out.collect()}
    evidence = [got[i]["evidence"] for i in range(len(rows))]
    prior = sum(evidence) / len(evidence)
    assert len(got) == len(rows) and all(0 < r["site"] < 1 for r in got.values())
    assert all(r["kept"] == (r["probability"] >= 0.5) for r in got.values())
    few, many = (max(abs(r["site"] - prior) for r in got.values() if size[r["source"], r["lang"]] in some)
                 for size in [Counter((r["source"], r["lang"]) for r in got.values())] for some in ((1, 2), (30, 31)))
    assert few < many
    sites = site_logits(rows, evidence, prior, 1e12, 1e12)
    assert sites[0] == pytest.approx(math.log(evidence[0] / (1 - evidence[0])), abs=1e-6)
    assert quality.classify(docs.limit(0), quality.train(docs, labels.limit(0))).count() == 0


def test_sites_come_from_addresses(spark):
    """A page of a folder full of junk is judged by it, the same text elsewhere on the host by the host."""
    junk, fine = "junk !!! $$$ " * 4, "a fine and quiet sentence about rivers. " * 4
    urls = [("http://u@Good.org:80/news/{}", fine), ("https://mixed.org/ads/{}", junk), ("https://mixed.org/blog/{}", fine)]
    rows = [(u.format(i), t) for u, t in urls for i in range(40)]
    rows += [("https://mixed.org/ads/x", "some words"), ("http://good.org/news/x", "some words"), ("https://mixed.org/page", fine), (None, fine), ("mailto:a", fine)]
    docs = spark.createDataFrame([(i, u, t, "old") for i, (u, t) in enumerate(rows)], "doc_id long, url string, text string, Host string")
    sites = quality.with_site(docs)
    assert sites.columns == ["doc_id", "url", "text", "host", "path"]
    assert {(r["host"], r["path"]) for r in sites.collect()} == {
        ("good.org", "good.org/news"), ("mixed.org", "mixed.org/ads"), ("mixed.org", "mixed.org/blog"), ("mixed.org", None), (None, None)}
    labels = spark.createDataFrame([(i, int(t == fine), 0) for i, (_, t) in enumerate(rows) if i < 120], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classify(sites, quality.train(docs, labels), "host", "path").collect()}
    assert len(got) == len(rows) and got[120]["evidence"] == got[121]["evidence"]
    assert got[120]["site"] < 0.3 < got[121]["site"] and got[120]["probability"] < got[121]["probability"]
    assert got[40]["site"] == got[79]["site"] < got[122]["site"] < got[0]["site"]
