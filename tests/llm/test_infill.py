import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from perkline.llm import infill

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n long, form string, output string, h1 string"


def brute(doc_id, text, unit="token", rate=50, spm=80):
    text = text or ""
    digits = hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i:8 * i + 8], 16) for i in range(4)]
    units = TOKEN.findall(text) if unit == "token" else list(text)
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return (doc_id, n, "plain", None, None, text)
    p, m, s = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, n)))
    if h[3] % 100 < spm:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def texts():
    rng = np.random.default_rng(4)
    alphabet = list("ab \n\t\x0b\x0c\ré€😀<PSM>") + ["\x85", "\xa0", "　", "\x1c"]
    out = ["".join(rng.choice(alphabet, int(rng.integers(0, 40)))) for _ in range(200)]
    out += [None, "", " ", "\n\n", "x", " x", "x ", "😀", "é́ ü", "a<P", "<S>", "y <M> z", "日本 語 " * 50_000, "word " * 400_000,
            "<", "<<P", "same same", "same same"]
    return out


@pytest.mark.parametrize("unit", ["token", "character"])
def test_equals_brute_force_and_restores(spark, unit):
    data = [(i, t) for i, t in enumerate(texts())] + [(None, "no id here"), (3, "an id again"), (3, "an id again")]
    rows = [(i, t, 9, "f", "o", "h") for i, t in data]
    made = infill.fill_in_middle(spark.createDataFrame(rows, SCHEMA).repartition(3), rate=90, unit=unit)
    got = made.withColumn("restored", infill.restored(F.col("output"), F.col("form"))).collect()
    want = [(*brute(i, t, unit, rate=90), t or "") for i, t in data]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_empty_table_and_other_types_of_ids(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert infill.fill_in_middle(empty).count() == 0
    named = spark.createDataFrame([("k1", "some words here")], "name string, body string")
    assert infill.fill_in_middle(named, id_col="name", text_col="body").first()["name"] == "k1"
    with pytest.raises(ValueError):
        infill.fill_in_middle(empty, unit="line")


def test_index_holds_exceptions_only():
    text = "plain é and 😀 and 語"
    raw = np.frombuffer(text.encode(), np.uint8)
    index = infill.ExceptionIndex(raw)
    assert len(index.at) == 3 and index.excess.tolist() == [0, 1, 4, 6]
    places = np.array([len(text[:i].encode()) for i in range(len(text) + 1)])
    assert index.points(places).tolist() == list(range(len(text) + 1))
    assert index.places(np.arange(len(text) + 1)).tolist() == places.tolist()
    assert len(infill.ExceptionIndex(np.frombuffer(b"ascii only", np.uint8)).at) == 0
