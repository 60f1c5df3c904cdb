import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from perkline.llm import suffix_dedup
from perkline.llm.text import as_bytes

SCHEMA = "doc_id long, text string, bucket string, kind int, data string"


def brute(rows):
    """Kept bytes and maximal removed spans of each document, windows judged in order of ids."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            window = data[p:p + 100]
            if window in seen:
                gone[p:p + 100] = True
            seen.add(window)
        turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out[i] = (len(data), bytes(np.frombuffer(data, np.uint8)[~gone]), list(zip(turns[::2], turns[1::2], strict=True)))
    return out


def corpus():
    rng = random.Random(4)

    def prose(n):
        return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 9))) for _ in range(n))

    passages = [prose(n) for n in (18, 25, 60, 200)]
    base = prose(300)
    texts = [base, base, base[:500] + "X" + base[500:], prose(10) + base[200:420] + prose(5), None, "", "short", "a" * 99,
             "a" * 100, "a" * 1000, "ab" * 400 + prose(30) + "ab" * 400]
    texts += [prose(rng.randrange(5, 80)) + rng.choice(passages) + prose(rng.randrange(0, 80)) for _ in range(60)]
    texts += [prose(30) + passages[3][k:k + 100] + prose(30) for k in range(0, 30, 3)]
    texts += [prose(30) + passages[3][k:k + 99] + prose(30) for k in range(0, 30, 3)]
    texts.append(prose(20_000))
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize(("batches", "hot"), [(1, 1 << 15), (4, 1 << 15), (8, 1 << 15), (3, 1)])
def test_equals_brute_force(spark, monkeypatch, batches, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(4)
    got = {r["doc_id"]: (r["n_bytes"], bytes(r["kept"]), [(s["start"], s["end"]) for s in r["spans"]])
           for r in suffix_dedup.remove_repeats(docs, batches).collect()}
    assert got == brute(rows)


def test_levels_merge_geometrically(spark):
    """Eight batches give levels like the digits of a binary number; what each batch repeats is found in any level."""
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(150))
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(400)) + passage for _ in range(24)]
    index, ranks, marked = suffix_dedup.SuffixIndex(64), [], set()
    for k in range(8):
        docs = spark.createDataFrame([(i, texts[i]) for i in range(3 * k, 3 * k + 3)], "d long, text string")
        found = index.add(docs)
        marked |= {r["d"] for r in suffix_dedup._explode(found, "mark", suffix_dedup.PLACE, "d long, h long, run long").collect()}
        ranks.append(sorted(index.levels))
    assert ranks == [[0], [1], [0, 1], [2], [0, 2], [1, 2], [0, 1, 2], [3]]
    assert marked == set(range(1, 24))


def test_edge_cases(spark):
    text = "word " * 60 + "end"
    rows = [(3, text), (3, text), (None, text), (None, None), (7, "x" + text)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    got = [(r["doc_id"], len(r["kept"]), r["n_bytes"]) for r in suffix_dedup.remove_repeats(docs).collect()]
    own = [g for g in got if g[0] is None]
    assert len(got) == 5 and sorted(g[1] for g in own)[0] == 0
    assert all(g[1] < 100 for g in got if g[0] == 3) and sum(g[0] == 3 for g in got) == 2
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_repeated_row_keeps_its_text(spark, monkeypatch):
    rng = random.Random(11)
    alone, shared, tail = (" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60)) for _ in range(3))
    rows = [(3, alone), (3, alone), (5, shared), (5, shared), (8, shared[150:] + tail), (8, shared[150:] + tail)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).repartition(4)
    for hot in (1 << 15, 1):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        got = sorted((r["doc_id"], bytes(r["kept"]).decode()) for r in suffix_dedup.remove_repeats(docs).collect())
        assert got == sorted([(3, alone), (3, alone), (5, shared), (5, shared), (8, tail), (8, tail)])


def mixed_ids():
    """Texts of which many share an id, or have none; some rows are there twice."""
    texts = [t for _, t in corpus() if t]
    rng = random.Random(7)
    rows = [(rng.choice([None, None, 1, 2, 2, 10 + k]), t) for k, t in enumerate(texts)]
    return rows + rng.sample(rows, 15) + [(None, None), (None, ""), (2, None)]


def brute_of_documents(spark, rows):
    """By (id, text): what brute force leaves; documents of an id in order of fingerprints."""
    low = -(1 << 63)
    prints = spark.createDataFrame([(i, t) for i, t in set(rows)], "i long, t string").selectExpr(
        "i", "t", "xxhash64(t, i is null) h").collect()
    order = sorted(prints, key=lambda r: (low if r["i"] is None else r["i"], r["h"]))
    left = brute([(k, r["t"]) for k, r in enumerate(order)])
    return {(r["i"], r["t"]): left[k] for k, r in enumerate(order)}


@pytest.mark.parametrize("hot", [1 << 15, 1])
def test_texts_of_one_id_or_none_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = mixed_ids()
    docs = spark.createDataFrame([(i, t, str(k), 1, "y") for k, (i, t) in enumerate(rows)], SCHEMA).repartition(4)
    want = brute_of_documents(spark, rows)
    got = [(r["doc_id"], r["n_bytes"], bytes(r["kept"]), [(s["start"], s["end"]) for s in r["spans"]])
           for r in suffix_dedup.remove_repeats(docs).collect()]
    assert sorted(got, key=str) == sorted(((row[0], *want[row]) for row in rows), key=str)
    cut = {int(r["bucket"]): r for r in suffix_dedup.cut_repeats(docs).collect()}
    assert len(cut) == len(rows) and cut[0].asDict().keys() == {*docs.columns, "cut"}
    for k, row in enumerate(rows):
        _, kept, spans = want[row]
        assert (cut[k]["doc_id"], cut[k]["text"], cut[k]["cut"]) == (
            row[0], kept.decode("utf-8", "ignore") if spans else row[1], bool(spans))


def test_runs_cover_all_windows_and_depend_on_content_only():
    rng = np.random.default_rng(2)
    shared = rng.integers(97, 101, 400).astype(np.uint8)
    raw = np.concatenate([rng.integers(97, 101, 333).astype(np.uint8), shared, rng.integers(97, 101, 90).astype(np.uint8)])
    one = suffix_dedup.Runs(raw, np.array([0, len(raw)]))
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(one.low, one.high, strict=True)])
    assert covered.tolist() == list(range(len(raw) - 99))
    two = suffix_dedup.Runs(shared, np.array([0, 400]))
    offset = {p + 333: a + 333 for lo, hi, a in zip(two.low, two.high, two.anchor, strict=True) for p in range(lo, hi + 1)}
    mine = {p: a for lo, hi, a in zip(one.low, one.high, one.anchor, strict=True) for p in range(lo, hi + 1)}
    assert all(mine[p] == a for p, a in offset.items())


@pytest.mark.parametrize("alphabet", [26, 2, 1])
def test_slices_of_a_text_have_its_runs(alphabet):
    raw = np.random.default_rng(3).integers(97, 97 + alphabet, 6000).astype(np.uint8)
    bounds = np.array([0, 50, 5600, 6000])
    for limit in (90, 257, 1000, 5549):
        low, high, name, number = [], [], [], []
        for a, b, runs in suffix_dedup.pieces(raw, bounds, limit):
            shift = bounds[a] + runs.shift
            low, high, name = [*low, *(runs.low + shift)], [*high, *(runs.high + shift)], [*name, *getattr(runs, "name", [])[:len(runs.low)]]
            number += runs.entries(np.arange(a, b))["o"].tolist()
        whole = suffix_dedup.Runs(raw, bounds)
        assert low == whole.low.tolist() and high == whole.high.tolist() and name == whole.name.tolist()
        assert number == whole.entries(np.arange(3))["o"].tolist()


def test_passages_beyond_64_mib_are_found():
    rng = np.random.default_rng(5)
    size = (1 << 26) + (1 << 20)
    long = rng.integers(97, 123, size).astype(np.uint8)
    passage = long[size - 5000:size - 1000].tobytes()
    texts = pa.array([long.tobytes().decode(), "start " + passage.decode() + " end"])
    zero = pa.array([0, 0], pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), zero, texts], names=["d", "h", "text"])
    names = [set(), set()]
    for out in suffix_dedup._arrays(4)(iter([batch.slice(0, 1), batch.slice(1, 1)])):
        for kind, data in zip(out["kind"].to_pylist(), out["data"].to_pylist(), strict=True):
            if kind == "new":
                rows = suffix_dedup.unpack(data, suffix_dedup.ENTRY)
                for d in (1, 2):
                    names[d - 1] |= set(rows["c"][rows["d"] == d].tolist())
    assert len(names[1]) > 60 and len(names[1] - names[0]) <= 12
    cut = suffix_dedup._without(long, None, [{"low": size - 4000, "high": size - 3901}])
    assert cut[1] == [{"start": size - 4000, "end": size - 3801}] and len(cut[0]) == size - 199


def test_levels_merge_as_a_binary_counter(spark):
    docs = spark.createDataFrame([(i, hashlib.sha256(str(i).encode()).hexdigest() * 5) for i in range(40)],
                                 "doc_id long, text string")
    index = suffix_dedup.SuffixIndex(4)
    ranks = []
    for k in range(4):
        index.add(docs.filter(f"doc_id % 4 = {k}"))
        ranks.append(sorted(index.levels))
    assert ranks == [[0], [1], [0, 1], [2]]
    entries = sum(len(suffix_dedup.unpack(bytes(r["data"]), suffix_dedup.ENTRY)) for r in index.levels[2].collect())
    raw, bounds = as_bytes(pa.array([r["text"] for r in docs.collect()]))
    made = suffix_dedup.Runs(raw, bounds).entries(np.arange(40))
    assert entries == len(set(zip(made["f"].tolist(), made["c"].tolist(), strict=True)))


def test_windows_resolved_in_slices_of_names_give_the_same_spans(monkeypatch):
    rng = np.random.default_rng(12)
    phrase = rng.integers(97, 123, 400, dtype=np.uint8).tobytes().decode()
    texts = [phrase[k:k + 240] + "".join(chr(c) for c in rng.integers(97, 123, 200)) + phrase[:130 + k] for k in range(0, 120, 7)]
    runs = [{"run": int(r), "hot": False} for r in range(40)]
    asked = pa.array([runs] * len(texts), pa.list_(pa.struct([("run", pa.int64()), ("hot", pa.bool_())])))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array([0] * len(texts), pa.int64()), pa.array(texts), asked],
        names=["d", "h", "text", "asked"])
    table = pa.Table.from_batches(list(suffix_dedup._contents(1)(iter([batch]))))

    def resolved(windows):
        monkeypatch.setattr(suffix_dedup, "WINDOWS", windows)
        return sorted(tuple(r.values()) for r in suffix_dedup._resolve((pa.scalar(0),), table).to_pylist())

    found = [{(d, p) for d, _, low, high in resolved(n) for p in range(low, high + 1)} for n in (1, 100, 1 << 18)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 100


def test_entries_are_dealt_to_the_buckets_that_occur():
    key = np.array([5, 2, 5, 900_000, 2])
    assert [(k, x.tolist()) for k, x in suffix_dedup._by_bucket(key)] == [(2, [1, 4]), (5, [0, 2]), (900_000, [3])]
    assert list(suffix_dedup._by_bucket(key[:0])) == []
