"""Repeated passages: a logarithmic family of sparse suffix arrays over batches of documents.

The arrays hold sampled suffixes. In every window of ``length`` bytes the leftmost K-byte string of least
fingerprint is its anchor; equal windows have equal anchors at equal offsets. The consecutive windows that
share an anchor are a run, and a suffix array has one entry per run: the fingerprint that names the suffix's
leading block, the fingerprint of the run's bytes, and the place. Entries are ordered by these names (the
order of names serves equality as well as the alphabet's does) and cut into buckets by the first one.

Each batch of documents, in order of ids, gets its arrays. They are merge-scanned against the arrays of all
levels: an entry equal in both names repeats an earlier run as a whole; one equal in the first only repeats
at most a part of it, and its windows are compared one by one afterwards. Then the batch becomes level 0,
and as long as two levels are of equal rank they merge into one of the next rank, as a binary counter does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from perkline.llm.text import BASE, INVERSE, ODD, as_bytes, chunks, mix, powers, seeded
from perkline.session import stage_table

LENGTH = 100
ANCHOR = 24
BATCHES = 3
BUCKET_BYTES = 4 << 20
_PLACE = np.uint64((1 << 26) - 1)
_NO_ID = -(1 << 63)
#: A document is its id (d) and a key (h): the fingerprint of the text if the id has several texts, else 0.
DOC = [("d", "<i8"), ("h", "<i8")]
ENTRY = np.dtype([("f", "<u8"), ("c", "<u8"), *DOC, ("o", "<u4")])
PLACE = np.dtype([*DOC, ("o", "<u4")])
PART = np.dtype([*DOC, ("o", "<u4"), ("f", "<u8")])
RUN = np.dtype([("f", "<u8"), *DOC, ("p", "<u4"), ("n", "<u1")])
WINDOW = np.dtype([("f", "<u8"), ("w", "<u8"), *DOC, ("p", "<u4")])
SPAN = np.dtype([*DOC, ("p", "<u4"), ("q", "<u4")])
#: Bytes of text that are worked on at a time, and windows that are compared at a time.
CHUNK = 1 << 19
WINDOWS = 1 << 18
HOT = 1 << 15
_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(ODD))


class Runs:
    """The runs of some consecutive texts of less than 64 MiB together, in order of place.

    Of a slice of one text, ``shift`` and ``number`` say how many bytes and runs of the text lie before it.
    """

    shift = number = 0

    def __init__(self, raw: np.ndarray, bounds: np.ndarray, length: int = LENGTH) -> None:
        self.raw, self.bounds, self.length = raw[bounds[0]:bounds[-1]], bounds - bounds[0], length
        n, texts = len(self.raw), len(bounds) - 1
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODE[self.raw] * powers(BASE, max(n, 1))[:n], out=self.total[1:])
        self.back = powers(INVERSE, n + 1)
        windows = np.maximum(np.diff(self.bounds) - length + 1, 0)
        none = np.zeros(0, np.int64)
        self.low = self.high = self.anchor = self.text = none
        if not windows.any():
            self.first = np.zeros(texts + 1, np.int64)
            return
        grams = self.prints(np.arange(n - ANCHOR + 1), ANCHOR)
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        span, want = 1, length - ANCHOR + 1
        while 2 * span <= want:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < want:
            least = np.minimum(least[:span - want], least[want - span:])
        least = (least & _PLACE).astype(np.int64)
        text = np.repeat(np.arange(texts), windows)
        place = np.arange(len(text)) + np.repeat(self.bounds[:-1] - np.cumsum(windows) + windows, windows)
        anchor = least[place]
        new = np.ones(len(text), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        self.low, self.anchor, self.text = place[at], anchor[at], text[at]
        self.high = place[np.append(at[1:], len(text)) - 1]
        self.first = np.searchsorted(self.text, np.arange(texts + 1))
        self.name = seeded(grams[self.anchor], 11)

    def keep(self, low: int, high: int) -> None:
        """Leave only the runs that start in [low, high)."""
        a, b = np.searchsorted(self.low, (low, high))
        self.low, self.high, self.anchor, self.text = (x[a:b] for x in (self.low, self.high, self.anchor, self.text))
        self.first = np.searchsorted(self.text, np.arange(len(self.first)))
        if b > a:
            self.name = self.name[a:b]

    def prints(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Fingerprints of the strings of ``size`` bytes at some places."""
        return mix((self.total[at + size] - self.total[at]) * self.back[at])

    def entries(self, ids: np.ndarray, keys: np.ndarray | None = None) -> np.ndarray:
        out = np.zeros(len(self.low), ENTRY)
        if len(out):
            size = self.high - self.low + self.length
            out["f"] = self.name
            out["c"] = seeded(self.prints(self.low, size), 12) + seeded(
                ((self.anchor - self.low) * 1024 + size).astype(np.uint64), 13)
            out["d"], out["h"] = ids[self.text], 0 if keys is None else keys[self.text]
            out["o"] = np.arange(len(out)) - self.first[self.text] + self.number
        return out


def pieces(raw: np.ndarray, bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int, Runs]]:
    """Consecutive ranges of texts of at most ``limit`` bytes with their runs; a longer text comes in slices.

    A slice has the runs that start in its ``limit`` bytes. It is read from one byte before them, which tells
    whether its first window opens a run, up to a run and a window after them.
    """
    for a, b in chunks(bounds, limit):
        size = int(bounds[b] - bounds[a])
        if size <= limit:
            yield a, b, Runs(raw, bounds[a:b + 1])
            continue
        number = 0
        for at in range(0, size, limit):
            low, high = max(at - 1, 0), min(size, at + limit + 2 * LENGTH)
            runs = Runs(raw, bounds[a] + np.array([low, high]))
            runs.shift, runs.number = low, number
            runs.keep(at - low, at - low + limit)
            number += len(runs.low)
            yield a, b, runs


def pack(rows: np.ndarray) -> bytes:
    """Entries as byte planes, column by column, which compress well."""
    planes = (np.ascontiguousarray(rows[name]).view(np.uint8).reshape(len(rows), rows.dtype[name].itemsize)
              for name in rows.dtype.names)
    return b"".join(x.T.tobytes() for x in planes)


def unpack(data: bytes, kind: np.dtype) -> np.ndarray:
    n = len(data) // kind.itemsize
    out, at = np.zeros(n, kind), 0
    for name in kind.names:
        size = kind[name].itemsize
        planes = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n)
        out[name] = np.ascontiguousarray(planes.T).view(kind[name]).reshape(n)
        at += n * size
    return out


def _sorted(rows: np.ndarray) -> np.ndarray:
    return rows[np.lexsort((rows["o"], rows["h"], rows["d"], rows["c"], rows["f"]))]


def _starts(rows: np.ndarray, *names: str) -> np.ndarray:
    """Which entries of a sorted array open a new group of equal names."""
    new = np.ones(len(rows), bool)
    if len(rows):
        new[1:] = np.logical_or.reduce([rows[x][1:] != rows[x][:-1] for x in names])
    return new


def _repeats(rows: np.ndarray, new: np.ndarray, *place: str) -> np.ndarray:
    """Which entries of sorted groups lie elsewhere than the first one of their group; a row read twice does not."""
    if not len(rows):
        return new
    first = rows[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return np.logical_or.reduce([rows[x] != first[x] for x in place])


def _places(rows: np.ndarray, kind: np.dtype = PLACE) -> np.ndarray:
    out = np.zeros(len(rows), kind)
    for name in kind.names:
        out[name] = rows[name]
    return out


def _docs(batch: pa.RecordBatch) -> np.ndarray:
    """The documents of a batch, whose first columns are d and h."""
    out = np.zeros(batch.num_rows, DOC)
    out["d"], out["h"] = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    return out


def _row(bucket: int, kind: str, data: np.ndarray) -> dict:
    return {"bucket": bucket, "kind": kind, "data": pack(data)}


def _by_bucket(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The buckets that occur in ``key``, each with the places of its entries; the others cost nothing."""
    if not len(key):
        return
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    yield from ((int(key[a]), order[a:b]) for a, b in zip(at, np.append(at[1:], len(key)), strict=True))


_SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.string()), ("data", pa.binary())])


def _arrays(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Suffix arrays of some 4 MB of texts, one per bucket. Runs that repeat inside are marked at once."""
    def stored(parts: list[np.ndarray]) -> pa.RecordBatch:
        rows = _sorted(np.concatenate(parts))
        new = _starts(rows, "f", "c")
        again, rows = rows[_repeats(rows, new, "d", "h", "o")], rows[new]
        out = [_row(int(x["d"][0]) % buckets, "mark", _places(x)) for x in [again] if len(x)]
        key = (rows["f"] >> np.uint64(64 - _bits(buckets))).astype(np.int64)
        out += [_row(k, "new", rows[x]) for k, x in _by_bucket(key)]
        return pa.RecordBatch.from_pylist(out, _SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = as_bytes(batch.column(2))
            docs = _docs(batch)
            parts, size = [], 0
            for a, b, runs in pieces(raw, bounds, CHUNK):
                if parts and size + len(runs.raw) > 4 << 20:
                    yield stored(parts)
                    parts, size = [], 0
                parts.append(runs.entries(docs["d"][a:b], docs["h"][a:b]))
                size += len(runs.raw)
            if parts:
                yield stored(parts)
    return run


def _bits(buckets: int) -> int:
    return buckets.bit_length() - 1


def _scan(level: np.ndarray, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One merged pass over two sorted arrays: which entries of the batch the level has as a whole, which share only
    their first name with it, and which entries of the level such ones meet."""
    whole, part, met = np.zeros(len(batch), bool), np.zeros(len(batch), bool), np.zeros(len(level), bool)
    if not len(level) or not len(batch):
        return whole, part, met
    rows = np.concatenate([level, batch])
    fresh = np.arange(len(rows)) >= len(level)
    order = np.lexsort((fresh, rows["c"], rows["f"]))
    rows, fresh = rows[order], fresh[order]
    names, contents = _starts(rows, "f"), _starts(rows, "f", "c")
    name, content = np.cumsum(names) - 1, np.cumsum(contents) - 1
    again = fresh & ~fresh[np.flatnonzero(contents)][content]
    at = np.flatnonzero(names)
    mixed = np.logical_or.reduceat(~fresh, at) & np.logical_or.reduceat(fresh & ~again, at)
    shared = mixed[name]
    whole[order[again] - len(level)] = True
    part[order[fresh & ~again & shared] - len(level)] = True
    met[order[~fresh & shared]] = True
    return whole, part, met


def _merge(ranks: list[str]) -> Callable[[tuple, pa.Table], pa.Table]:
    """Scan a bucket of a batch against that bucket of all levels, and merge it with the ``ranks`` levels."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, out = key[0].as_py(), []
        found: dict[str, list[np.ndarray]] = {}
        for kind, data in zip(table["kind"].to_pylist(), table["data"].to_pylist(), strict=True):
            if kind == "mark":
                out.append({"bucket": bucket, "kind": kind, "data": data})
            else:
                found.setdefault(kind, []).append(unpack(data, ENTRY))
        if "new" in found:
            batch = _sorted(np.concatenate(found.pop("new")))
            first = _starts(batch, "f", "c")
            out.append(_row(bucket, "mark", _places(batch[_repeats(batch, first, "d", "h", "o")])))
            batch = batch[first]
        else:
            batch = np.zeros(0, ENTRY)
        partial = np.zeros(len(batch), bool)
        for arrays in found.values():
            level = np.concatenate(arrays)
            whole, part, met = _scan(level, batch)
            out.append(_row(bucket, "mark", _places(batch[whole])))
            out.append(_row(bucket, "part", _places(level[met], PART)))
            partial |= part
            batch, partial = batch[~whole], partial[~whole]
        new = _starts(batch, "f")
        group = np.cumsum(new) - 1
        partial |= np.bincount(group, minlength=1)[group] > 1 if len(batch) else False
        out.append(_row(bucket, "part", _places(batch[partial], PART)))
        merged = _sorted(np.concatenate([batch, *(x for rank in ranks for x in found.get(rank, []))]))
        out.append(_row(bucket, "level", merged))
        return pa.Table.from_pylist([x for x in out if x["data"]], _SCHEMA)
    return run


def _explode(data: DataFrame, kind: str, dtype: np.dtype, schema: str) -> DataFrame:
    """Stored blobs of a kind as rows; fields in order of ``dtype``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                rows = unpack(blob, dtype)
                for i in range(0, len(rows), 100_000):
                    part = rows[i:i + 100_000]
                    columns = [part[n].view(np.int64) if part.dtype[n] == np.uint64 else part[n].astype(np.int64)
                               for n in dtype.names]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=list(dtype.names))
    return data.filter(F.col("kind") == kind).select("data").mapInArrow(run, schema)


class SuffixIndex:
    """The family of levels. ``add`` takes batches in order of ids and tells what they repeat; all texts of an id
    belong in one batch."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.levels: dict[int, DataFrame] = {}

    def add(self, docs: DataFrame) -> DataFrame:
        """Index ``docs`` (d, h, text) or (d, text): rows (bucket, kind, data), stored, with the repeated places."""
        rank = 0
        while rank in self.levels:
            rank += 1
        if len(docs.columns) == 2:
            docs = docs.select(docs.columns[0], F.lit(0).cast("long").alias("h"), docs.columns[1])
        rows = docs.mapInArrow(_arrays(self.buckets), "bucket int, kind string, data binary")
        for other, level in self.levels.items():
            rows = rows.union(level.select("bucket", F.lit(f"level {other}").alias("kind"), "data"))
        ranks = [f"level {k}" for k in range(rank)]
        found = stage_table(rows.groupBy("bucket").applyInArrow(
            _merge(ranks), "bucket int, kind string, data binary"), "suffix_levels")
        self.levels = {k: v for k, v in self.levels.items() if k >= rank}
        self.levels[rank] = found.filter("kind = 'level'")
        return found


def _spans(rows: np.ndarray) -> np.ndarray:
    """Places (d, h, p) of windows as spans of consecutive ones."""
    rows = rows[np.lexsort((rows["p"], rows["h"], rows["d"]))]
    new = _starts(rows, "d", "h")
    new[1:] |= rows["p"][1:] > rows["p"][:-1] + 1
    at = np.flatnonzero(new)
    out = np.zeros(len(at), SPAN)
    for name in ("d", "h", "p"):
        out[name] = rows[name][at]
    out["q"] = rows["p"][np.append(at[1:], len(rows)) - 1] if len(at) else 0
    return out


def _first_windows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that repeat none of the others' earlier ones, and those that do."""
    rows = rows[np.lexsort((rows["p"], rows["h"], rows["d"], rows["w"], rows["f"]))]
    new = _starts(rows, "f", "w")
    return rows[new], rows[_repeats(rows, new, "d", "h", "p")]


def _explode_windows(name: np.ndarray, docs: np.ndarray, place: np.ndarray, prints: Callable, low: np.ndarray,
                     count: np.ndarray) -> np.ndarray:
    """All windows of some runs; ``prints`` gives fingerprints at places of the runs' bytes."""
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    rows = np.zeros(len(step), WINDOW)
    rows["f"], rows["d"], rows["h"] = (np.repeat(x, count) for x in (name, docs["d"], docs["h"]))
    rows["w"], rows["p"] = prints(np.repeat(low, count) + step), np.repeat(place, count) + step
    return rows


def _contents(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes of the runs to be compared, by bucket of their names; of hot names the single windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = as_bytes(batch.column(2))
            docs, asked = _docs(batch), batch.column(3)
            for a, b, runs in pieces(raw, bounds, CHUNK):
                own = asked.slice(a, b - a)
                text = np.repeat(np.arange(b - a), own.value_lengths().to_numpy())
                wanted = runs.first[text] + own.flatten().field("run").to_numpy() - runs.number
                valid = (wanted >= runs.first[text]) & (wanted < runs.first[text + 1])
                wanted, hot = wanted[valid], own.flatten().field("hot").to_numpy(zero_copy_only=False)[valid]
                out = []
                name = runs.name[wanted] if len(wanted) else np.zeros(0, np.uint64)
                low, text = runs.low[wanted], runs.text[wanted]
                count = runs.high[wanted] - low + 1
                place = low - runs.bounds[text] + runs.shift
                at = np.flatnonzero(hot)
                if len(at):
                    first, again = _first_windows(_explode_windows(
                        name[at], docs[a:b][text[at]], place[at], lambda x, r=runs: r.prints(x, LENGTH), low[at], count[at]))
                    out.append(_row(int(docs["d"][a]) % buckets, "again", _spans(again)))
                    key = (seeded(first["w"], 21) >> np.uint64(64 - _bits(buckets))).astype(np.int64)
                    out += [_row(k, "windows", first[x]) for k, x in _by_bucket(key)]
                at = np.flatnonzero(~hot)
                for k, x in _by_bucket((name[at] >> np.uint64(64 - _bits(buckets))).astype(np.int64)):
                    x = at[x]
                    rows = np.zeros(len(x), RUN)
                    rows["f"], rows["p"], rows["n"] = name[x], place[x], count[x]
                    rows["d"], rows["h"] = docs["d"][a:b][text[x]], docs["h"][a:b][text[x]]
                    size = count[x] + LENGTH - 1
                    inside = np.arange(size.sum()) + np.repeat(low[x] - np.cumsum(size) + size, size)
                    out.append({"bucket": k, "kind": "runs",
                                "data": len(x).to_bytes(4, "little") + pack(rows) + runs.raw[inside].tobytes()})
                yield pa.RecordBatch.from_pylist([x for x in out if x["data"]], _SCHEMA)
    return run


def _slices(parts: list[np.ndarray]) -> Iterator[tuple[np.uint64, np.uint64]]:
    """Ranges of names, ends included, of about ``WINDOWS`` windows each; one name stays in one range."""
    name = np.concatenate([rows["f"] for rows in parts])
    count = np.concatenate([rows["n"] for rows in parts]).astype(np.int64)
    order = np.argsort(name, kind="stable")
    name, total = name[order], np.cumsum(count[order])
    at = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
    part = (total[at] - count[order][at]) // WINDOWS
    opens = at[np.flatnonzero(np.append(True, part[1:] != part[:-1]))]
    yield from zip(name[opens], name[np.append(opens[1:], len(name)) - 1], strict=True)


def _resolve(key: tuple, table: pa.Table) -> pa.Table:
    """Windows of a bucket that start earlier elsewhere, as spans (d, h, low, high).

    Equal windows have equal names, so the names are taken in slices and only the windows of a slice are spelt out.
    """
    again, single, parts, texts = [], [], [], []
    for kind, data in zip(table["kind"], table["data"], strict=True):
        kind, data = kind.as_py(), data.as_py()
        if kind == "again":
            again.append(unpack(data, SPAN))
        elif kind == "windows":
            single.append(unpack(data, WINDOW))
        else:
            end = 4 + int.from_bytes(data[:4], "little") * RUN.itemsize
            parts.append(unpack(data[4:end], RUN))
            texts.append(np.frombuffer(data, np.uint8, offset=end))
    if single:
        again.append(_spans(_first_windows(np.concatenate(single))[1]))
        del single
    starts = []
    for rows in parts:
        size = rows["n"].astype(np.int64) + LENGTH - 1
        starts.append(np.cumsum(size) - size)
    for first, last in _slices(parts) if parts else ():
        windows = []
        for rows, start, raw in zip(parts, starts, texts, strict=True):
            mine = np.flatnonzero((rows["f"] >= first) & (rows["f"] <= last))
            if len(mine):
                own = rows[mine]
                count = own["n"].astype(np.int64)
                size = count + LENGTH - 1
                low = np.cumsum(size) - size
                inside = np.arange(size.sum()) + np.repeat(start[mine] - low, size)
                bytes_of = Runs(raw[inside], np.array([0, len(inside)]), len(inside) + 1)
                windows.append(_explode_windows(
                    own["f"], own, own["p"], lambda x, r=bytes_of: r.prints(x, LENGTH), low, count))
        again.append(_spans(_first_windows(np.concatenate(windows))[1]))
    found = np.concatenate(again)
    return pa.table({"d": pa.array(found["d"]), "h": pa.array(found["h"]), "low": pa.array(found["p"].astype(np.int64)),
                     "high": pa.array(found["q"].astype(np.int64))})


def _without(text: np.ndarray, own: list | None, at: list | None) -> tuple[bytes, list[dict]]:
    """A text without its marked runs and windows, and the maximal removed spans."""
    if not own and not at:
        return text.tobytes(), []
    none = np.zeros(0, np.int64)
    low, high = [none], [none]
    if own:
        own = np.unique(np.asarray(own))
        for _, _, runs in pieces(text, np.array([0, len(text)]), CHUNK):
            mine = own[(own >= runs.number) & (own < runs.number + len(runs.low))] - runs.number
            low.append(runs.low[mine] + runs.shift)
            high.append(runs.high[mine] + runs.shift + LENGTH)
    if at:
        at = np.array([(x["low"], x["high"]) for x in at])
        at = at[at[:, 1] + LENGTH <= len(text)]
        low.append(at[:, 0])
        high.append(at[:, 1] + LENGTH)
    low, high = np.concatenate(low), np.concatenate(high)
    if not len(low):
        return text.tobytes(), []
    order = np.argsort(low)
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.flatnonzero(np.append(True, low[1:] > high[:-1]))
    start, end = low[new], high[np.append(new[1:], len(high)) - 1]
    left = b"".join(text[x:y].tobytes() for x, y in zip(np.append(0, end), np.append(start, len(text)), strict=True))
    return left, [{"start": int(x), "end": int(y)} for x, y in zip(start, end, strict=True)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove marked runs and windows from the texts, some of them at a time."""
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        raw, bounds = as_bytes(batch.column(1))
        for a, b in chunks(bounds, 2 * CHUNK):
            marks, places = (batch.column(k).slice(a, b - a).to_pylist() for k in (2, 3))
            left = [_without(raw[bounds[a + i]:bounds[a + i + 1]], own, at)
                    for i, (own, at) in enumerate(zip(marks, places, strict=True))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(np.diff(bounds[a:b + 1])),
                 pa.array([x for x, _ in left], pa.binary()), pa.array([x for _, x in left], spans)],
                names=["rest", "n_bytes", "kept", "spans"])


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without marked runs and windows, and whether anything went; a character that a cut has parted goes."""
    for batch in batches:
        raw, bounds = as_bytes(batch.column(1))
        for a, b in chunks(bounds, 2 * CHUNK):
            text = batch.column(1).slice(a, b - a)
            marks, places = (batch.column(k).slice(a, b - a).to_pylist() for k in (2, 3))
            left = [_without(raw[bounds[a + i]:bounds[a + i + 1]], own, at) if own or at else (b"", [])
                    for i, (own, at) in enumerate(zip(marks, places, strict=True))]
            cut = pa.array([bool(spans) for _, spans in left], pa.bool_())
            new = pa.array([x.decode("utf-8", "ignore") for x, _ in left], text.type)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pc.if_else(cut, new, text), cut], names=["rest", "text", "cut"])


def _marked(docs: DataFrame, batches: int, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` as (rest, text, runs, places): the other columns, and which runs and windows go."""
    number, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    doc, fingerprint = F.coalesce(number, F.lit(_NO_ID)), F.xxhash64(text, number.isNull())
    # per id: most ids have one text, and their documents need no key
    ids = stage_table(docs.groupBy(doc.alias("d")).agg(
        F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("size"),
        (F.min(fingerprint) != F.max(fingerprint)).alias("several")), "ids")
    several = stage_table(ids.filter("several").select(F.col("d").alias("_d")), "several")
    base = docs.select(
        doc.alias("d"), fingerprint.alias("h"), text.alias("text"),
        F.struct(*(c for c in docs.columns if c != text_col)).alias("rest"))
    base = base.join(several, F.col("d") == F.col("_d"), "left").withColumn(
        "h", F.when(F.col("_d").isNotNull(), F.col("h")).otherwise(F.lit(0).cast("long"))).drop("_d")
    shares = [k / batches for k in range(1, batches)]
    known = ids.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("size"),
        F.percentile_approx("d", shares or [0.5], 10_000).alias("cuts")).first()
    buckets = max(64, 1 << (known["size"] // BUCKET_BYTES).bit_length())
    cuts = sorted(set(known["cuts"] or [])) if shares else []
    index, found = SuffixIndex(buckets), None
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = base.select("d", "h", "text")
        if low is not None:
            part = part.filter(F.col("d") > low)
        if high is not None:
            part = part.filter(F.col("d") <= high)
        rows = index.add(part).filter("kind <> 'level'")
        found = rows if found is None else found.union(rows)
    marks = _explode(found, "mark", PLACE, "d long, h long, run long").groupBy("d", "h").agg(
        F.collect_set("run").alias("runs"))
    parts = _explode(found, "part", PART, "d long, h long, run long, name long")
    hot = stage_table(parts.groupBy("name").count().filter(F.col("count") > HOT).select(
        "name", F.lit(True).alias("hot")), "hot")
    asked = parts.join(hot, "name", "left").groupBy("d", "h").agg(F.collect_set(
        F.struct("run", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("asked"))
    contents = base.join(asked, ["d", "h"]).select("d", "h", "text", "asked").mapInArrow(
        _contents(buckets), "bucket int, kind string, data binary")
    places = contents.groupBy("bucket").applyInArrow(_resolve, "d long, h long, low long, high long").groupBy(
        "d", "h").agg(F.collect_set(F.struct("low", "high")).alias("places"))
    return base.join(marks, ["d", "h"], "left").join(places, ["d", "h"], "left").select(
        "rest", "text", "runs", "places")


def remove_repeats(docs: DataFrame, batches: int = BATCHES, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Texts without repeated passages: (doc_id, n_bytes long, kept binary, spans array of [start, end)).

    A byte goes if it lies in a string of 100 bytes that also starts earlier: in a document of smaller id, or
    earlier in the same one; overlaps count, and strings are judged on the input. Matches never cross
    documents. Texts are UTF-8 bytes; a cut may part a character, so ``kept`` is binary.

    Null or empty texts give empty bytes, and texts under 100 bytes stay whole. Null ids count as the
    smallest id and come back as null. A document is an id with a text: equal rows are the same document read
    again, get equal results and don't repeat each other; different texts of one id, null or not, are
    documents in the order of their fingerprints. An empty table gives an empty result; other columns
    are ignored. Strings are compared by fingerprints of 96 bits or more, texts of one id by 64.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _marked(rows, batches, "doc_id", "text").mapInArrow(
        _cut, "rest struct<doc_id:long>, n_bytes long, kept binary, spans array<struct<start:long,end:long>>"
    ).select("rest.doc_id", "n_bytes", "kept", "spans")


def cut_repeats(docs: DataFrame, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with all columns, their texts cut as by ``remove_repeats``, and ``cut``: whether anything
    went. A character that a cut has parted goes."""
    rows = _marked(docs, batches, id_col, text_col)
    kind = StructType().add("rest", rows.schema["rest"].dataType).add("text", "string").add("cut", "boolean")
    return rows.mapInArrow(_cut_texts, kind).select("rest.*", F.col("text").alias(text_col), "cut").select(
        *docs.columns, "cut")
