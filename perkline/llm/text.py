"""Words of whole texts as numpy arrays: one pass over the bytes of an Arrow batch.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased. Words are
represented by 64-bit fingerprints, so all later steps are array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
ODD = 0x9E3779B97F4A7C15
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Word bytes of another kind: letters, digits and all bytes beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit integers (public constants of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    return mix(x + np.uint64((seed * ODD) & 0xFFFFFFFFFFFFFFFF))


_CASE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(ODD))
_BYTE_CODE = _CASE_CODE[_LOWER]
BASE = np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


_TABLES: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base``; the longest table so far is kept by the worker."""
    table = _TABLES.get(int(base))
    if table is None or len(table) < n:
        table = np.full(max(n, 1 << 16), base, np.uint64)
        table[0] = 1
        table = _TABLES[int(base)] = np.cumprod(table, dtype=np.uint64)
    return table[:n]


@dataclass
class Words:
    """The words of some texts: text i has the words first[i] up to first[i + 1]."""

    prints: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the bounds of each text (length n + 1); null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    bounds = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]] if len(bounds) else raw, bounds - bounds[0]


def chunks(bounds: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of at most ``limit`` bytes together, or one longer text."""
    low, n = 0, len(bounds) - 1
    while low < n:
        high = int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1
        high = min(n, max(high, low + 1))
        yield low, high
        low = high


def fingerprints(raw: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Fingerprints of some strings raw[low:high], with their case."""
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_CASE_CODE[raw] * powers(BASE, max(len(raw), 1))[:len(raw)], out=total[1:])
    prints = (total[high] - total[low]) * powers(INVERSE, len(raw) + 1)[low]
    return mix(prints + (high - low).astype(np.uint64) * np.uint64(ODD))


def words(raw: np.ndarray, bounds: np.ndarray, inside: np.ndarray | None = None) -> Words:
    """Fingerprints of the words of consecutive texts; words never cross texts.

    ``inside`` flags the bytes words are made of, by default all that aren't white space.
    """
    raw, bounds = raw[bounds[0]:bounds[-1]], bounds - bounds[0]
    n = len(raw)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64), none, none)
    solid = ~_WHITE[raw] if inside is None else inside[raw]
    opens = np.empty(n + 1, bool)
    opens[0] = True
    opens[1:] = True
    opens[1:n] = ~solid[:-1]
    opens[bounds] = True
    start = np.flatnonzero(solid & opens[:n])
    end = np.flatnonzero(solid & (opens[1:] | np.append(~solid[1:], True))) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_CODE[raw] * powers(BASE, n), out=total[1:])
    prints = (total[end] - total[start]) * powers(INVERSE, n)[start]
    prints = mix(prints + (end - start).astype(np.uint64) * np.uint64(ODD))
    return Words(prints, np.searchsorted(start, bounds), start, end)


def shingles(found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``width`` words of each text, sorted per text, and their bounds.

    A text of fewer words has its whole sequence as one shingle, one without words has none.
    """
    prints, first, counts = found.prints, found.first, found.counts
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    n = len(prints)
    whole = np.zeros(max(n, 1), np.uint64)
    for k in range(width):
        if n > k:
            whole[:n - k] = mix(whole[:n - k] * np.uint64(ODD) + prints[k:])
    pieces, bounds = [], np.zeros(len(counts) + 1, np.int64)
    for i, (size, count) in enumerate(zip(sizes.tolist(), counts.tolist(), strict=True)):
        if count >= width:
            own = np.unique(whole[first[i]:first[i] + size])
        elif count:
            own = np.full(1, count, np.uint64)
            for k in range(first[i], first[i] + count):
                own = mix(own * np.uint64(ODD) + prints[k:k + 1])
        else:
            own = np.zeros(0, np.uint64)
        pieces.append(own)
        bounds[i + 1] = bounds[i] + len(own)
    return np.concatenate(pieces) if pieces else np.zeros(0, np.uint64), bounds
