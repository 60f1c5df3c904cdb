import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from perkline.llm import lm, pieces
from perkline.llm.text import as_bytes
from perkline.session import application_folder

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def corpus():
    rng = random.Random(2)
    names = [f"w{i}" for i in range(300)]
    sentences = [" ".join(rng.choice(names) for _ in range(12)) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(sentences) for _ in range(rng.randrange(1, 12)))) for i in range(220)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "Ünique WORD w1"), (1004, "w2 " * 5000), (None, "w3 w4"), (5, rows[5][1])]
    return rows


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 2000, "frequent": 20}])
def test_base_scores_are_exact_and_the_model_learns(spark, options):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "a", 1.0, 2) for i, t in rows],
                                 "doc_id long, text string, score string, known double, levels int").repartition(3)
    got = lm.score_documents(docs, **options).collect()
    assert len(got) == len(rows)
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter()
    for (_, w), h in zip(tokens, held, strict=True):
        if not h:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for (i, w), h in zip(tokens, held, strict=True):
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        want[(i, h, len(w), sum(counts[x] > 0 for x in w), n, round(base, 6))] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                   for r in got) == want
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)
    own = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in own) > 0.7 * sum(r["base_score"] for r in own)
    assert lm.score_documents(docs.limit(0), **options).count() == 0


def test_passes_over_parts_of_the_filter_give_the_same_scores(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string").filter("doc_id < 100")
    one = {r["doc_id"]: r["score"] for r in lm.score_documents(docs).collect()}
    many = {r["doc_id"]: r["score"] for r in lm.score_documents(docs, broadcast_bytes=1000).collect()}
    assert one == pytest.approx(many)


def test_storage_does_not_grow_with_the_filter_against_what_is_broadcast(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")

    def stored():
        folder = Path(application_folder(spark).removeprefix("file:"))
        return sum(f.stat().st_size for f in folder.rglob("*.parquet"))

    sizes = [stored()]
    for most in (lm.BROADCAST_BYTES, 1000):
        assert lm.score_documents(docs, broadcast_bytes=most).count() == docs.count()
        sizes.append(stored())
    assert sizes[2] - sizes[1] < 1.2 * (sizes[1] - sizes[0])


def test_chunks_of_any_size_give_the_same_scores(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string").filter("doc_id < 1004")
    want = {r["doc_id"]: r for r in lm.score_documents(docs).collect()}
    assert lm.Plan(np.zeros(0), np.zeros(0), 256).chunk == lm.CHUNK < lm.Plan(np.zeros(0), np.zeros(0), 2048).chunk
    monkeypatch.setattr(lm, "CHUNK", 700)
    monkeypatch.setattr(lm, "CHUNK_BUCKETS", 1)
    monkeypatch.setattr(lm, "SCORE_TOKENS", 300)
    got = {r["doc_id"]: r for r in lm.score_documents(docs).collect()}
    assert got.keys() == want.keys()
    assert all(got[i][:5] == want[i][:5] and got[i][5:] == pytest.approx(want[i][5:]) for i in want if i != 5)  # twice


def test_filter_never_underestimates_and_seldom_errs():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    counts = rng.geometric(0.4, 20_000)
    data = lm.build_filter(keys, counts)
    found = lm.Filter(data, np.zeros(1, np.uint64), np.array([len(data) // 8], np.uint64), lm.Histories.of([]))
    levels = found.levels(keys, np.zeros(len(keys), np.int64))
    assert (levels >= lm.level_of(counts)).all()
    assert (levels == lm.level_of(counts)).mean() > 0.97
    others = found.levels(rng.integers(0, 2**63, 20_000).astype(np.uint64), np.zeros(20_000, np.int64))
    assert (others > 0).mean() < 0.03
    assert lm.level_of(np.array([1, 2, 3, 4, 5, 6])).tolist() == [1, 2, 3, 4, 4, 5]


def exact_model(docs):
    """Absolute discounting of counts rounded as the filter rounds them, by brute force."""
    pairs, singles = Counter(), Counter()
    for text in docs:
        w = [None, *text.encode().lower().split(), "end"]
        pairs.update(zip(w, w[1:], strict=False))
        singles.update(w[1:])
    ones, twos = (sum(c == k for c in pairs.values()) for k in (1, 2))
    discount = ones / (ones + 2 * twos)
    value = {p: float(lm.value_of(lm.level_of(np.array([c])))[0]) for p, c in pairs.items()}
    mass, kinds = Counter(), Counter()
    for (h, _), v in value.items():
        mass[h] += v
        kinds[h] += 1
    size = sum(singles.values()) + len(singles) + 1

    def chance(h, w):
        single = (singles[w] + 1) / size
        return (max(value.get((h, w), 0) - discount, 0) + discount * kinds[h] * single) / mass[h] if mass[h] else single
    return chance, singles


@pytest.mark.parametrize("size", [500, 1 << 20])
def test_scores_are_probabilities_and_equal_an_exact_model(spark, size):
    docs = [(i, t) for i, t in corpus() if t and i is not None and i < 100]
    rows = [(i, t, zlib.crc32(str(i).encode()) % 7 == 2) for i, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    model, found = lm.train(df, 20)
    chance, singles = exact_model([t for _, t, held in rows if not held])
    group = [g for part in lm.filter_groups(found, size) for g in part]
    part = lm._load(found, group, model.plan.buckets)
    vocabulary = sorted(w for w in singles if w != "end")
    sums, close = [], []
    for h in [*vocabulary[:40], b"never"]:
        texts = pa.array([f"{h.decode()} {w.decode()}" for w in [*vocabulary, b"unheard"]] + [h.decode()])
        text = lm.Sequence.of(*as_bytes(texts))
        second = model.chances(text, model.probe(text, part))[text.cuts[:-1] + 1]
        want = np.array([chance(h, w) for w in [*vocabulary, b"unheard", "end"]])
        true = np.abs(second / want - 1) < 1e-4
        assert (second >= want * (1 - 1e-4)).all() and true[-2]  # others are false members, never of an unknown word
        sums.append(np.where(true, second, want).sum())
        close += true.tolist()
    first = lm.Sequence.of(*as_bytes(pa.array([w.decode() for w in [*vocabulary, b"unheard"]] + [""])))
    opening = model.chances(first, model.probe(first, part))[first.cuts[:-1]]
    assert opening.sum() == pytest.approx(1, abs=0.02)
    assert sums == pytest.approx([1] * len(sums), abs=1e-4) and np.mean(close) > 0.97
    got = {r["doc_id"]: r["score"] for r in lm.score_documents(df.select("doc_id", "text"), frequent=20).collect()}
    exact = {}
    for i, t, _ in rows:
        w = [None, *t.encode().lower().split(), "end"]
        exact[i] = sum(math.log10(chance(a, b)) for a, b in zip(w, w[1:], strict=False))
    assert all(got[i] > exact[i] - 1e-3 for i in exact)  # a false member raises the score of a text, nothing lowers it
    assert all(got[i] < 0.9 * exact[i] for i in exact)
    assert sum(got.values()) == pytest.approx(sum(exact.values()), rel=0.01)


def test_error_rates_of_five_and_seven_probes():
    """Bits are set by block, so a few more probes gain little: the rates stand in the README."""
    rng = np.random.default_rng(3)
    keys, others = (rng.integers(0, 2**63, 200_000).astype(np.uint64) for _ in range(2))
    rates = {}
    for probes in (5, 7):
        blocks = np.uint64(-(-lm.BITS * len(keys) // 512))
        bits = np.zeros(int(blocks) * 512, bool)
        for name, held in (("in", keys), ("out", others)):
            base, prints = lm._block(held, 1, blocks) * np.uint64(512), lm.seeded(held, 1)
            places = [base + lm._bit(prints, k) for k in range(probes)]
            if name == "in":
                for place in places:
                    bits[place] = True
            else:
                rates[probes] = float(np.mean(np.logical_and.reduce([bits[p] for p in places])))
    assert rates[7] < rates[5] < 1.4 * rates[7] and rates[5] < 0.015, rates


def small_model():
    plain = {"▁": -4.0, "a": -5.0, "b": -5.0, "ab": -6.0, "abc": -7.5, "▁a": -4.5, "▁ab": -5.5, "bc": -6.0, "c": -6.0, "é": -7.0,
             "▁▁": -5.0, "éa": -7.0, "caf": -8.0, "café": -9.0}
    listed = [("<unk>", 0.0, pieces.UNKNOWN), ("<s>", 0.0, pieces.CONTROL)]
    listed += [(f"<0x{i:02X}>", 0.0, pieces.BYTE) for i in range(256)]
    return pieces.PieceModel.of(listed + [(p, s, pieces.NORMAL) for p, s in plain.items()]), plain


def best_score(text, plain, unknown):
    """Best sum of scores over all segmentations, by characters."""
    s = "▁" + text.replace(" ", "▁")
    best = [0.0] + [-math.inf] * len(s)
    for i in range(len(s)):
        own = s[i] in plain and text is not None
        for j in range(i + 1, len(s) + 1):
            if s[i:j] in plain:
                best[j] = max(best[j], best[i] + plain[s[i:j]])
        if not own:
            best[i + 1] = max(best[i + 1], best[i] + unknown)
    return best[-1]


def test_viterbi_equals_brute_force():
    model, plain = small_model()
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcéf x\n") for _ in range(rng.randrange(1, 30))) for _ in range(800)]
    raw, bounds = as_bytes(pa.array(texts))
    ids, cuts = model.encode(raw, bounds)
    scores = {i: plain.get(p) for i, p in enumerate(["", "", *[""] * 256, *plain])}
    for k, text in enumerate(texts):
        own, total, run = ids[cuts[k]:cuts[k + 1]].tolist(), 0.0, bytearray()
        for i in own:
            if 2 <= i < 258:
                run.append(i - 2)
                continue
            total += scores[i] + model.unknown * len(run.decode())
            run = bytearray()
        total += model.unknown * len(run.decode())
        assert total == pytest.approx(best_score(text, plain, model.unknown)), text
    alone = np.concatenate([model.encode(*as_bytes(pa.array([t])))[0] for t in texts])
    assert (alone == ids).all()


def test_round_trip_with_the_public_vocabulary(spark):
    model = pieces.PieceModel.load(VOCABULARY)
    rng = random.Random(1)
    texts = [None, "", " ", "   a  b ", "▁mark▁", "tab\tnew\nline\r\n", "日本語 emoji 🎉 ñandú", "x" * 5000, " ".join("word" for _ in range(9000)),
             "\u0000\u0001", "same", "same"]
    texts += ["".join(chr(rng.choice([32, 97, 98, 233, 0x4E00, 0x1F600, rng.randrange(1, 0xD000)])) for _ in range(60)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, "z", "n") for i, t in enumerate(texts)], "doc_id long, text string, token_ids string, lang string")
    got = pieces.encode_decode(docs, model).collect()
    assert got[0].__fields__ == ["doc_id", "text", "lang", "n_bytes", "n_tokens", "token_ids", "round_trip"]
    assert {r["doc_id"]: r["text"] for r in got} == {i: t or "" for i, t in enumerate(texts)}
    assert all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in got)
    assert all(r["n_tokens"] == 0 for r in got if r["doc_id"] < 2)
    assert pieces.encode_decode(docs.limit(0), model).count() == 0


def test_double_array_holds_the_vocabulary():
    model = pieces.PieceModel.load(VOCABULARY)
    trie, known = model.trie, {s: i for i, s in enumerate(model.surfaces) if s}
    for surface, i in list(known.items())[300::97]:
        state = 0
        for byte in surface:
            step = trie.base[state] + byte + 1
            assert trie.check[step] == state
            state = step
        assert model.surfaces[trie.value[state]] == surface, i
