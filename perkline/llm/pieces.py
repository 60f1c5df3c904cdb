"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie, with byte fallback."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from perkline.llm.text import as_bytes, chunks, fingerprints

#: Fixed values of the format: piece types of a model file, and what an uncovered character costs.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
UNKNOWN_PENALTY = 10.0
MARK = "▁".encode()
CHUNK = 1 << 20
FEW = 12


class DoubleArray:
    """Trie in two arrays: state s has the successor base[s] + code if check there names s."""

    def __init__(self, keys: dict[bytes, int]) -> None:
        children: list[dict[int, int]] = [{}]
        ends = {}
        for key, value in keys.items():
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                node = children[node][byte]
            ends[node] = value
        size = 4 * len(children) + 4096
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.value = np.full(size, -1, np.int32)
        free = np.ones(size, bool)
        free[0] = False
        hints = [0] * 257
        queue = [(0, 0)]
        for node, state in queue:
            self.value[state] = ends.get(node, -1)
            codes = sorted(children[node])
            if not codes:
                continue
            at = hints[len(codes)]
            while True:  # the first place from the hint on where all successors fit
                width = min(1024, size - 257 - at)
                fits = np.logical_and.reduce([free[at + c + 1:at + c + 1 + width] for c in codes])
                if fits.any():
                    at += int(np.argmax(fits))
                    break
                at += width
            hints[len(codes)] = at
            self.base[state] = at
            for c in codes:
                free[at + c + 1] = False
                self.check[at + c + 1] = state
                queue.append((children[node][c], at + c + 1))


@dataclass
class PieceModel:
    """Pieces with scores, their trie, and what each id decodes to. The whitespace mark is a blank here."""

    trie: DoubleArray
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown: float
    surfaces: list[bytes]
    splits: bool

    @classmethod
    def of(cls, pieces: list[tuple[str, float, int]]) -> PieceModel:
        """From (piece, score, type) in order of ids."""
        keys, surfaces, byte_ids = {}, [], np.full(256, -1, np.int32)
        for i, (piece, _, kind) in enumerate(pieces):
            surface = b""
            if kind in (NORMAL, USER_DEFINED):
                surface = piece.encode().replace(MARK, b" ")
                keys[surface] = i
            elif kind == BYTE:
                code = int(piece[3:5], 16)
                byte_ids[code], surface = i, bytes([code])
            surfaces.append(surface)
        if (byte_ids < 0).any():
            raise ValueError("the vocabulary has no piece for some byte")
        least = min((s for _, s, k in pieces if k == NORMAL), default=0.0)
        return cls(DoubleArray(keys), np.array([s for _, s, _ in pieces]), byte_ids, least - UNKNOWN_PENALTY, surfaces,
                   not any(b" " in key.lstrip(b" ") for key in keys))

    @classmethod
    def load(cls, path: str) -> PieceModel:
        """Pieces of a model file on the driver; only the vocabulary is taken from it."""
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        kinds = [(model.is_byte, BYTE), (model.is_control, CONTROL), (model.is_unknown, UNKNOWN)]
        return cls.of([
            (model.id_to_piece(i), model.get_score(i), next((k for test, k in kinds if test(i)), NORMAL))
            for i in range(model.get_piece_size())])

    def _char_size(self, lead: np.ndarray) -> np.ndarray:
        return np.where(lead < 0xC0, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))

    def viterbi(self, text: np.ndarray) -> np.ndarray:
        """Ids of one segment (bytes): the best sum of scores; of equal ones the longer last piece."""
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        codes, n = text.tolist(), len(text)
        best, back = [-np.inf] * (n + 1), [(-1, -1)] * (n + 1)
        best[0] = 0.0
        sizes = self._char_size(text).tolist()
        for i in range(n):
            here = best[i]
            if here == -np.inf:
                continue
            single, state, size = False, 0, min(sizes[i], n - i)
            for j in range(i, n):
                step = int(base[state]) + codes[j] + 1
                if check[step] != state:
                    break
                state = step
                piece = int(value[state])
                if piece >= 0:
                    single |= j + 1 - i == size
                    score = here + self.scores[piece]
                    if score > best[j + 1]:
                        best[j + 1], back[j + 1] = score, (i, piece)
            if not single and here + self.unknown > best[i + size]:
                best[i + size], back[i + size] = here + self.unknown, (i, -1)
        out, at = [], n
        while at:
            low, piece = back[at]
            out += [piece] if piece >= 0 else [int(self.byte_ids[c]) for c in reversed(codes[low:at])]
            at = low
        return np.array(out[::-1], np.int32)

    def viterbi_block(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for many segments of one length (rows of bytes): ids row by row, and their counts."""
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        rows, n = texts.shape
        codes = np.ascontiguousarray(texts.T).astype(np.int32) + 1
        best = np.full((n + 1, rows), -np.inf)
        best[0] = 0.0
        start, chosen = np.zeros((n + 1, rows), np.int32), np.full((n + 1, rows), -1, np.int32)
        for i in range(n):
            live = np.flatnonzero(best[i] > -np.inf)
            if not len(live):
                continue
            size = np.minimum(self._char_size(codes[i, live] - 1), n - i)
            single = np.zeros(len(live), bool)
            who, state = np.arange(len(live)), np.zeros(len(live), np.int32)
            for j in range(i, n):
                step = base[state] + codes[j, live[who]]
                stay = check[step] == state
                who, state = who[stay], step[stay]
                if not len(who):
                    break
                piece = value[state]
                ends = piece >= 0
                hit, piece = who[ends], piece[ends]
                single[hit[size[hit] == j + 1 - i]] = True
                row = live[hit]
                score = best[i, row] + self.scores[piece]
                more = score > best[j + 1, row]
                row = row[more]
                best[j + 1, row], start[j + 1, row], chosen[j + 1, row] = score[more], i, piece[more]
            for width in np.unique(size[~single]):
                row = live[~single & (size == width)]
                score = best[i, row] + self.unknown
                more = score > best[i + width, row]
                row = row[more]
                best[i + width, row], start[i + width, row], chosen[i + width, row] = score[more], i, -1
        ids = np.full((rows, n), -1, np.int32)
        at = np.full(rows, n)
        while (live := np.flatnonzero(at)).size:
            end = at[live]
            low, piece = start[end, live], chosen[end, live]
            whole = piece >= 0
            ids[live[whole], end[whole] - 1] = piece[whole]
            for k in range(4):
                part = ~whole & (low + k < end)
                place = low[part] + k
                ids[live[part], place] = self.byte_ids[texts[live[part], place]]
            at[live] = low
        used = ids >= 0
        return ids[used], used.sum(axis=1)

    def encode(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts and their bounds. Equal segments are segmented once."""
        raw, bounds = raw[bounds[0]:bounds[-1]], bounds - bounds[0]
        full = np.diff(bounds) > 0
        raw = np.insert(raw, bounds[:-1][full], 32)
        bounds = bounds + np.concatenate([[0], np.cumsum(full)])
        opens = np.zeros(len(raw), bool)
        if self.splits and len(raw):
            blank = raw == 32
            opens = blank.copy()
            opens[1:] &= ~blank[:-1]
        opens[bounds[:-1][full]] = True
        low = np.flatnonzero(opens)
        high = np.append(low[1:], len(raw)) if len(low) else low
        prints = fingerprints(raw, low, high)
        _, sample, kind = np.unique(prints, return_index=True, return_inverse=True)
        sizes = (high - low)[sample]
        order = np.argsort(sizes, kind="stable")
        cuts = np.flatnonzero(np.diff(sizes[order])) + 1
        ids: list[np.ndarray] = []
        counts = np.zeros(len(sample), np.int64)
        for group in np.split(order, cuts) if len(order) else []:
            first, size = low[sample[group]], int(sizes[group[0]])
            if len(group) < FEW or size > 512:
                found = [self.viterbi(raw[a:a + size]) for a in first.tolist()]
                ids += found
                counts[group] = [len(x) for x in found]
            else:
                rows, n = self.viterbi_block(raw[first[:, None] + np.arange(size)])
                ids.append(rows)
                counts[group] = n
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        place = np.zeros(len(sample), np.int64)
        place[order] = np.cumsum(counts[order]) - counts[order]
        n = counts[kind]
        out = flat[np.arange(n.sum()) + np.repeat(place[kind] - np.cumsum(n) + n, n)]
        ends = np.concatenate([[0], np.cumsum(n)])
        return out, ends[np.searchsorted(low, bounds)]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of consecutive id sequences and their bounds: marks become blanks, the first one goes."""
        sizes = np.array([len(s) for s in self.surfaces])
        start = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(self.surfaces), np.uint8)
        n = sizes[ids]
        raw = flat[np.arange(n.sum()) + np.repeat(start[ids] - np.cumsum(n) + n, n)]
        ends = np.concatenate([[0], np.cumsum(n)])[bounds]
        full = np.diff(ends) > 0
        lead = ends[:-1][full]
        lead = lead[raw[lead] == 32]
        drop = np.zeros(len(raw), bool)
        drop[lead] = True
        return raw[~drop], ends - np.concatenate([[0], np.cumsum(drop)])[ends]


def _code(model: PieceModel, text_at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = as_bytes(batch.column(text_at))
            for a, b in chunks(bounds, CHUNK):
                ids, cuts = model.encode(raw, bounds[a:b + 1])
                back, ends = model.decode(ids, cuts)
                size = bounds[a:b + 1] - bounds[a]
                whole = np.diff(ends) == np.diff(size)
                if whole.all():
                    differs = np.concatenate([[0], np.cumsum(back != raw[bounds[a]:bounds[b]])])[size]
                    whole &= np.diff(differs) == 0
                buffer = pa.py_buffer(np.ascontiguousarray(back).tobytes())
                decoded = pa.LargeStringArray.from_buffers(b - a, pa.py_buffer(ends.astype(np.int64).tobytes()), buffer)
                kept = [c.slice(a, b - a) for i, c in enumerate(batch.columns) if i != text_at]
                names = [n for i, n in enumerate(batch.schema.names) if i != text_at]
                yield pa.RecordBatch.from_arrays(
                    [*kept, decoded.cast(pa.string()), pa.array(np.diff(size)), pa.array(np.diff(cuts)),
                     pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids)), pa.array(whole)],
                    names=[*names, batch.schema.names[text_at], "n_bytes", "n_tokens", "token_ids", "round_trip"])
    return run


def encode_decode(docs: DataFrame, model: PieceModel, text_col: str = "text") -> DataFrame:
    """``docs`` with (n_bytes, n_tokens long, token_ids array of int, round_trip boolean), one row each.

    A text gets a leading mark, blanks become marks, and each stretch from a run of marks on is segmented into
    the pieces of the best sum of scores (no piece has a mark after another character; for a vocabulary that
    has, whole texts are segmented). A character without a piece of its own may be written as its bytes.
    ``text_col`` comes back as the decoded ids, and ``round_trip`` tells whether that is the input. A literal
    mark character is written as bytes, so every UTF-8 text comes back whole.

    Null and empty texts have no tokens and decode to the empty text; repeated rows are encoded each and
    alike. An empty table gives an empty result; columns named like the results are replaced. The model is a
    bounded vocabulary and goes along with the tasks.
    """
    own = ("n_bytes", "n_tokens", "token_ids", "round_trip")
    kept = [c for c in docs.columns if c.lower() not in own]
    base = docs.select(*[c for c in kept if c != text_col], text_col)
    base = base.withColumn(text_col, base[text_col].cast("string"))
    fields = [*base.schema.fields[:-1], StructField(text_col, StringType())]
    added = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()),
             StructField("token_ids", ArrayType(IntegerType())), StructField("round_trip", BooleanType())]
    out = base.mapInArrow(_code(model, len(base.columns) - 1), StructType([*fields, *added]))
    return out.select(*kept, *own)
