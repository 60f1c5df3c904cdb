"""Fill-in-the-middle transformation: texts cut into prefix, middle and suffix and written in another order.

Cuts are made on bytes and reported in code points. A sparse index of the multibyte characters converts between
the two: one entry for each of them, nothing for ASCII, whose spans are plain differences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from perkline.llm.text import as_bytes, chunks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


class ExceptionIndex:
    """Where bytes and code points of UTF-8 text part: positions and excess bytes of multibyte characters only."""

    def __init__(self, raw: np.ndarray):
        self.at = np.flatnonzero(raw >= 0xC0)
        lead = raw[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(excess)])
        self.point = self.at - self.excess[:-1]

    def points(self, place: np.ndarray) -> np.ndarray:
        """Code points before byte ``place``, which starts a character or ends the text."""
        return place - self.excess[np.searchsorted(self.at, place)]

    def places(self, point: np.ndarray) -> np.ndarray:
        """Byte at which code point ``point`` starts."""
        return point + self.excess[np.searchsorted(self.point, point)]


class Units:
    """The units texts may be cut between: ``count`` of each text, and the byte at which the first k of them end."""

    def __init__(self, raw: np.ndarray, bounds: np.ndarray, index: ExceptionIndex, kind: str):
        self.bounds, self.index, self.kind = bounds, index, kind
        if kind == "character":
            self.first = index.points(bounds)
            self.count = np.diff(self.first)
            return
        solid = ~_WHITE[raw]
        last = np.ones(len(raw), bool)
        last[:-1] = ~solid[1:]
        inner = bounds[(bounds > 0) & (bounds < len(raw))]
        last[inner - 1] = True
        self.ends = np.flatnonzero(solid & last) + 1
        self.first = np.searchsorted(self.ends, bounds, "right")
        filled = np.diff(bounds) > 0
        trailing = np.zeros(len(bounds) - 1, bool)
        trailing[filled] = ~solid[bounds[1:][filled] - 1]
        self.words = np.diff(self.first)
        self.count = self.words + trailing

    def place(self, k: np.ndarray) -> np.ndarray:
        """Bytes at which the first ``k`` units of each text end."""
        if self.kind == "character":
            return self.index.places(self.first[:-1] + k)
        place = np.where(k == 0, self.bounds[:-1], self.bounds[1:])
        inside = (k > 0) & (k <= self.words)
        place[inside] = self.ends[self.first[:-1][inside] + k[inside] - 1]
        return place


def _transform(kind: str, rate: int, spm_rate: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = as_bytes(batch.column("text"))
            draws = np.stack([batch.column(f"h{i}").to_numpy() for i in range(1, 5)])
            for a, b in chunks(bounds):
                yield _piece(batch.column("id")[a:b], raw[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a], draws[:, a:b])

    def _piece(ids: pa.Array, raw: np.ndarray, bounds: np.ndarray, draws: np.ndarray) -> pa.RecordBatch:
        index = ExceptionIndex(raw)
        units = Units(raw, bounds, index, kind)
        cuts = np.sort(draws[:2] % (units.count + 1), axis=0)
        low, high = units.place(cuts[0]), units.place(cuts[1])
        point = index.points(np.stack([bounds[:-1], low, high]))
        data = raw.tobytes()
        out, forms = [], []
        for i, (start, one, two, end) in enumerate(zip(bounds[:-1].tolist(), low.tolist(), high.tolist(), bounds[1:].tolist(),
                                                       strict=True)):
            marked = any(data.find(m, start, end) >= 0 for m in _MARKS)
            if start == end or marked or draws[2, i] % 100 >= rate:
                forms.append("plain")
                out.append(data[start:end])
                continue
            prefix, middle, suffix = (_MARKS[0] + data[start:one], _MARKS[2] + data[one:two], _MARKS[1] + data[two:end])
            spm = draws[3, i] % 100 < spm_rate
            forms.append("spm" if spm else "psm")
            out.append(suffix + prefix + middle if spm else prefix + suffix + middle)
        plain = np.array([f == "plain" for f in forms], bool)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(units.count, pa.int64()), pa.array(forms, pa.string()),
             pa.array(point[1] - point[0], pa.int64(), mask=plain), pa.array(point[2] - point[1], pa.int64(), mask=plain),
             pa.array(out, pa.binary()).view(pa.string())],
            names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def _draws(id_col: Column, seed: int) -> list[Column]:
    """Four numbers of a document: the leading groups of eight digits of a hash of the seed and its id."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, unit: str = "token",
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): each whole text, ``rate`` in 100 of them rearranged.

    A text has n units, tokens (white space with the word behind it, or trailing white space) or, with ``unit``
    "character", code points. Two draws of 0 to n, hashed from seed and id, say after how many units prefix and
    middle end. ``form`` is psm (``<P>``prefix``<S>``suffix``<M>``middle), spm (``<S>``suffix``<P>``prefix``<M>``middle;
    ``spm_rate`` in 100) or plain: texts that are not drawn, empty or hold a mark stay as they are, without lengths.

    Null texts count as empty; a null id is hashed as "null"; rows that repeat an id are cut by the same draws, each
    in its own text. A text of any length is cut whole, others in pieces of about a megabyte. An empty table gives
    an empty result; other columns are ignored, whatever their names.
    """
    if unit not in ("token", "character"):
        raise ValueError(f"unknown unit {unit!r}")
    draws = _draws(F.col(id_col), seed)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       *[h.alias(f"h{i}") for i, h in enumerate(draws, 1)])
    long, text = LongType(), StringType()
    schema = StructType([slim.schema["id"], StructField("n", long), StructField("form", text), StructField("prefix_chars", long),
                         StructField("middle_chars", long), StructField("output", text)])
    return slim.mapInArrow(_transform(unit, rate, spm_rate), schema).withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made of. Parts hold no mark and a mark's first character occurs in it once, so
    every mark found is one that was written."""
    def part(begins: str, ends: str) -> Column:
        return F.substring_index(F.substring_index(output, ends, 1), begins, -1)

    middle = F.substring_index(output, MIDDLE, -1)
    return (F.when(form == "psm", F.concat(part(PREFIX, SUFFIX), middle, part(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(part(PREFIX, MIDDLE), middle, part(SUFFIX, PREFIX)))
            .otherwise(output))
