"""Language-model scores: quantised bigram counts in a log-frequency Bloom filter, absolute discounting.

Texts are cut into chunks of numbered words, which are stored once. Counting and scoring agree on buckets: the
bigrams of a word go to the word's bucket, those of a few very frequent words are spread by both words. A bucket
task has all counts of its bigrams, so it makes the bucket's part of the filter, probes it for all bigrams that
the chunks have there, and answers each chunk with their levels and with the exact statistics of its rarer words.
A chunk's answers are put together with its words, which gives the scores: no task holds more than one bucket's
filter, and texts are cut into words once (those of a sample twice), whatever the size of the whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkline.llm.text import ODD, as_bytes, chunks, mix, seeded, words
from perkline.session import stage_table

FREQUENT = 1 << 18
HOT_SHARE = 1 / 4096
SAMPLE = 16_384
CHUNK = 2 << 20
#: A chunk of texts is so many times that at most, once for each so many buckets.
CHUNK_GROWTH, CHUNK_BUCKETS = 2, 256
SCORE_TOKENS = 1 << 16
BUCKET_BYTES = 6 << 20
BITS = 10
PROBES = 5
#: The probes of a level in the groups after which the failed keys are dropped.
DROPS = ((0,), (1, 2), (3, 4))
SLICE = 1 << 14
BROADCAST_BYTES = 192 << 20
#: Bytes of a frequent word with its statistics, as every task has them.
FREQUENT_BYTES = 32
START, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_LOW = np.uint64((1 << 40) - 1)
#: Lower ends of the quantised counts: the integers from 2 to the power j/2 on, for each j.
STEPS = np.unique(np.ceil(2 ** (np.arange(0, 124) / 2)).astype(np.int64))
VALUES = np.sqrt(STEPS * np.append(STEPS[1:] - 1.0, STEPS[-1]))


def level_of(count: np.ndarray) -> np.ndarray:
    return np.searchsorted(STEPS, count, "right")


def value_of(level: np.ndarray) -> np.ndarray:
    """Geometric middle of the counts of a level, 0 for level 0."""
    return np.concatenate([[0.0], VALUES])[level]


def bigram_key(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One name for a history (64 bits) and the 40 bits of a word that bigrams are told apart by."""
    return mix(history + (word & _LOW) * np.uint64(ODD))


def top(x: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket that the leading bits name; ``buckets`` is a power of two."""
    return (x >> np.uint64(64 - (buckets.bit_length() - 1))).astype(np.int64) if buckets > 1 else np.zeros(len(x), np.int64)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of any number types as byte planes behind a header of their sizes, compressed."""
    out = [len(columns).to_bytes(1, "little")]
    for c in columns:
        c = np.ascontiguousarray(c)
        out.append(c.dtype.str[1:].encode() + len(c).to_bytes(8, "little"))
        out.append(c.view(np.uint8).reshape(len(c), c.dtype.itemsize).T.tobytes())
    data = b"".join(out)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    data = pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    out, at = [], 1
    for _ in range(data[0]):
        kind, n = np.dtype("<" + data[at:at + 2].decode()), int.from_bytes(data[at + 2:at + 10], "little")
        planes = np.frombuffer(data, np.uint8, n * kind.itemsize, at + 10).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += 10 + n * kind.itemsize
    return out


def _block(key: np.ndarray, level: int, blocks: np.ndarray) -> np.ndarray:
    """The block of 512 bits that holds a key's bits of four levels in a row."""
    return ((seeded(key, 500 + (level - 1) // 4) >> np.uint64(32)) * blocks) >> np.uint64(32)


def _bit(prints: np.ndarray, k: int) -> np.ndarray:
    """The k-th of the bits in its block that a fingerprint names."""
    return (prints >> np.uint64(9 * k)) & np.uint64(511)


def build_filter(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log-frequency Bloom filter: a key of level q is a member with each of the levels 1 to q. Words of 64 bits.

    All bits of a member lie in one block, so a probe touches one line of memory.
    """
    levels = level_of(counts)
    blocks = np.uint64(max(-(-int(BITS * levels.sum()) // 512), 1))
    bits = np.zeros(int(blocks) * 512, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = keys[levels >= level]
        base = _block(own, level, blocks) * np.uint64(512)
        prints = seeded(own, level)
        for k in range(PROBES):
            bits[base + _bit(prints, k)] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


HISTORY = np.dtype([("name", "<u8"), ("count", "<u4"), ("kinds", "<u4"), ("mass", "<f4")])


@dataclass
class Histories:
    """Words in order, each with its count, the kinds of its followers, and the sum of its followers' counts as the
    filter has them, quantised: what a history's probabilities are shares of."""

    name: np.ndarray
    count: np.ndarray
    kinds: np.ndarray
    mass: np.ndarray

    @classmethod
    def of(cls, parts: list[bytes]) -> Histories:
        rows = [np.frombuffer(p, HISTORY) for p in parts]
        return cls(*(np.concatenate([np.zeros(0, HISTORY[c]), *(r[c] for r in rows)]) for c in HISTORY.names))

    def of_words(self, names: np.ndarray) -> np.ndarray:
        """Count, kinds and mass (3 x names), 0 for words that are no history."""
        out = np.zeros((3, len(names)), np.float32)
        at = _find(self.name, names)
        there = np.flatnonzero(at < len(self.name))
        for row, column in enumerate((self.count, self.kinds, self.mass)):
            out[row, there] = column[at[there]]
        return out


@dataclass
class Filter:
    """Filters of some buckets in one array: bucket b has ``blocks[b]`` blocks from word ``start[b]`` on; and the
    histories of these buckets."""

    data: np.ndarray
    start: np.ndarray
    blocks: np.ndarray
    histories: Histories

    def levels(self, key: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """The level of each key: membership is probed level by level until it fails.

        Four levels share a block. Keys go in slices whose blocks stay in the processor's cache from probe to probe.
        """
        out = np.zeros(len(key), np.uint8)
        live = np.flatnonzero(self.blocks[bucket] > 0)
        for first in range(1, len(STEPS) + 1, 4):
            if not len(live):
                break
            passed = np.concatenate([
                self._four(key[part], bucket[part], first) for part in np.split(live, range(SLICE, len(live), SLICE))])
            out[live] += passed
            live = live[passed == 4]
        return out

    def _four(self, key: np.ndarray, bucket: np.ndarray, first: int) -> np.ndarray:
        """How many of four levels in a row the keys are members with, until one fails."""
        out = np.zeros(len(key), np.uint8)
        base = (self.start[bucket] + _block(key, first, self.blocks[bucket]) * np.uint64(8)).astype(np.int64)
        live = np.arange(len(key))
        for level in range(first, first + 4):
            left, place = seeded(key, level), base
            for together in DROPS:
                hit = np.uint64(1)
                for k in together:
                    bit = _bit(left, k)
                    word = np.take(self.data, place + (bit >> np.uint64(6)).view(np.int64))
                    hit = hit & (word >> (bit & np.uint64(63)))
                kept = np.flatnonzero(hit.view(np.int64))
                if len(kept) < len(left):
                    left, place, live, key, base = left[kept], place[kept], live[kept], key[kept], base[kept]
            if not len(live):
                break
            out[live] += 1
        return out


@dataclass
class Plan:
    """What all tasks know: candidates with their exact counts later, very frequent histories, buckets."""

    frequent: np.ndarray
    hot: np.ndarray
    buckets: int

    @property
    def chunk(self) -> int:
        """Bytes of text in a chunk. As each chunk has a message for each bucket, it is larger where these are many."""
        return CHUNK * min(max(self.buckets // CHUNK_BUCKETS, 1), CHUNK_GROWTH)

    def history_bucket(self, history: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hot = _inside(self.hot, history)
        return np.where(hot, top(bigram_key(history, word), self.buckets), top(history, self.buckets)), hot


def _find(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Places of x in a sorted table, or len(table)."""
    at = np.searchsorted(table, x)
    at[at == len(table)] = 0
    return np.where(table[at] == x, at, len(table)) if len(table) else np.zeros(len(x), np.int64)


def _inside(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return _find(table, x) < len(table)


def _tokens(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of consecutive texts with their ends, and how many each text has."""
    found = words(raw, bounds)
    return np.insert(found.prints, found.first[1:], END), found.counts + 1


@dataclass
class Sequence:
    """Tokens of some texts as places in a list of distinct names."""

    cuts: np.ndarray
    names: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, raw: np.ndarray, bounds: np.ndarray) -> Sequence:
        parts = [_tokens(raw, bounds[a:b + 1]) for a, b in chunks(bounds, CHUNK)]
        tokens, sizes = (np.concatenate([p[k] for p in parts]) for k in range(2))
        del parts
        return cls(np.append(0, np.cumsum(sizes)), *np.unique(tokens, return_inverse=True))

    def part(self, a: int, b: int) -> Sequence:
        """The texts a up to b."""
        return Sequence(self.cuts[a:b + 1] - self.cuts[a], self.names, self.place[self.cuts[a]:self.cuts[b]])

    @property
    def tokens(self) -> np.ndarray:
        return self.names[self.place]

    @property
    def history(self) -> np.ndarray:
        """What stands before each token."""
        out = np.empty(len(self.place), np.uint64)
        out[1:] = self.tokens[:-1]
        out[self.cuts[:-1]] = START
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """History and word of the distinct bigrams, in order of these names, and the place of each token's bigram."""
        start = np.searchsorted(self.names, START)
        names = np.insert(self.names, start, START)
        place = self.place + (self.place >= start)
        pair = np.empty(len(place), np.int64)
        pair[1:] = place[:-1]
        pair[self.cuts[:-1]] = start
        pair *= len(names)
        pair += place
        del place
        order = np.argsort(pair)
        pair = pair[order]
        new = np.append(True, pair[1:] != pair[:-1])
        own = np.empty(len(pair), np.int32)
        own[order] = np.cumsum(new, dtype=np.int32) - 1
        del order
        pair = pair[new]
        return names[pair // len(names)], names[pair % len(names)], own


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, bounds = as_bytes(batch.column(0))
        for a, b in chunks(bounds, CHUNK):
            word, count = np.unique(words(raw, bounds[a:b + 1]).prints, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(count)], names=["word", "n"])


_SCHEMA = pa.schema([("bucket", pa.int64()), ("kind", pa.string()), ("data", pa.binary())])


def _pack_names(plan: Plan, names: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names in order, whose places among the frequent words are ``at``: these words as steps from place to place, and the others."""
    known = at < len(plan.frequent)
    own = at[known]
    own[1:] -= own[:-1].copy()
    return own.astype(np.uint32), names[~known]


def _unpack_names(plan: Plan, steps: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.sort(np.append(plan.frequent[np.cumsum(steps, dtype=np.int64)], others))


def _cut(plan: Plan) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Chunks of texts, each with a number of its own: distinct names, and the tokens as places among these."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        for batch in batches:
            raw, bounds = as_bytes(batch.column(1))
            ids = batch.column(0)
            there, ids = (x.to_numpy(zero_copy_only=False) for x in (ids.is_valid(), ids.fill_null(0)))
            held = batch.column(2).to_numpy(zero_copy_only=False)
            for a, b in chunks(bounds, plan.chunk):
                text = Sequence.of(raw, bounds[a:b + 1])
                yield pa.RecordBatch.from_pylist([{"bucket": chunk, "kind": "texts", "data": pack(
                    *_pack_names(plan, text.names, _find(plan.frequent, text.names)), text.place.astype(np.uint32),
                    np.diff(text.cuts).astype(np.uint32), ids[a:b].astype(np.int64), there[a:b], held[a:b].astype(bool))}], _SCHEMA)
                chunk += 1
    return run


def _chunk(plan: Plan, data: bytes) -> tuple[Sequence, np.ndarray, np.ndarray, np.ndarray]:
    """The texts of a chunk, their ids, which of these are not null, and which texts are held out."""
    steps, others, place, sizes, ids, there, held = unpack(data)
    cuts = np.append(0, np.cumsum(sizes, dtype=np.int64))
    return Sequence(cuts, _unpack_names(plan, steps, others), place.astype(np.int32)), ids, there, held


def _count(plan: Plan) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Bigrams of the chunks by bucket, each with its count in the training texts; those of other texts only have 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                text, _, _, held = _chunk(plan, data.as_py())
                before, after, own = text.pairs()
                count = np.bincount(own[np.repeat(~held, np.diff(text.cuts))], minlength=len(before)).astype(np.uint32)
                bucket, _ = plan.history_bucket(before, after)
                order = np.argsort(bucket, kind="stable")
                bucket, before, low, count = bucket[order], before[order], after[order] & _LOW, count[order]
                changes = np.append(True, bucket[1:] != bucket[:-1])
                heads = np.flatnonzero(changes | np.append(True, before[1:] != before[:-1]))
                runs = np.diff(np.append(heads, len(before))).astype(np.uint32)
                names, low, high = before[heads], low.astype(np.uint32), (low >> np.uint64(32)).astype(np.uint8)
                at, number, out = _find(plan.frequent, names), np.array([chunk]), []
                first = np.flatnonzero(changes)
                ends = np.append(first, len(before))
                of_heads = np.searchsorted(heads, ends)
                for k, a, b, x, y in zip(*(z.tolist() for z in (
                        bucket[first], ends[:-1], ends[1:], of_heads[:-1], of_heads[1:])), strict=True):
                    out.append({"bucket": k, "kind": "bigrams", "data": pack(
                        number, *_pack_names(plan, names[x:y], at[x:y]), runs[x:y], low[a:b], high[a:b], count[a:b])})
                yield pa.RecordBatch.from_pylist(out, _SCHEMA)
    return run


def _merge(plan: Plan) -> Callable[[tuple, pa.Table], pa.Table]:
    """A bucket's exact counts: its part of the filter, answers to the chunks, and statistics."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        parts, asked, out = [], [], []
        for data in table["data"]:
            chunk, steps, others, runs, low, high, count = unpack(data.as_py())
            h = _unpack_names(plan, steps, others)
            asked.append((int(chunk[0]), runs))
            parts.append((np.repeat(h, runs), low | (high.astype(np.uint64) << np.uint64(32)), count))
        history, low, count = (np.concatenate([p[k] for p in parts]) for k in range(3))
        parts.clear()
        names, owner = np.unique(history, return_inverse=True)
        del history
        order = np.lexsort((low, owner))
        number, low, count = owner[order], low[order], count[order].astype(np.int64)
        new = np.ones(len(low), bool)
        new[1:] = (number[1:] != number[:-1]) | (low[1:] != low[:-1])
        at = np.flatnonzero(new)
        place = np.empty(len(order), np.int32)
        place[order] = np.cumsum(new, dtype=np.int32) - 1
        del order, new
        count, number, low = np.add.reduceat(count, at), number[at], low[at]
        keys = mix(names[number] + low * np.uint64(ODD))
        seen = np.flatnonzero(count)
        learnt, own = count[seen], number[seen]
        total = np.bincount(own, learnt, minlength=len(names)).astype(np.int64)
        kinds = np.bincount(own, minlength=len(names))
        mass = np.bincount(own, value_of(level_of(learnt)), minlength=len(names))
        bits = build_filter(keys[seen], learnt)
        found = Filter(bits, np.zeros(1, np.uint64), np.array([len(bits) // 8], np.uint64), Histories.of([]))
        levels = found.levels(keys, np.zeros(len(keys), np.int64))[place]
        hot, frequent = _inside(plan.hot, names), _inside(plan.frequent, names)
        rows = np.zeros(len(names), HISTORY)
        for column, values in zip(HISTORY.names, (names, total, kinds, mass), strict=True):
            rows[column] = values
        first, rare = 0, ~hot & ~frequent
        for chunk, runs in asked:
            ends = first + np.cumsum(runs, dtype=np.int64)
            heads = owner[ends - runs]
            known = rows[heads[rare[heads]]]
            out.append({"bucket": chunk, "kind": "answers", "data": pack(
                np.array([bucket]), levels[first:int(ends[-1])], known["count"], known["kinds"], known["mass"])})
            first = int(ends[-1])
        once = total > 0
        out += [{"bucket": bucket, "kind": "filter", "data": bits.tobytes()},
                {"bucket": bucket, "kind": "histories", "data": rows[once & ~hot].tobytes()}]
        for kind, x in (("hot", once & hot), ("frequent", once & frequent & ~hot)):
            out.append({"bucket": bucket, "kind": kind, "data": pack(names[x], total[x], kinds[x], mass[x])})
        out.append({"bucket": bucket, "kind": "sums", "data": pack(np.array(
            [total[~hot].sum(), (once & ~hot).sum(), (learnt == 1).sum(), (learnt == 2).sum()], np.int64))})
        pa.default_memory_pool().release_unused()  # the buffers of the bucket before
        return pa.Table.from_pylist(out, _SCHEMA)
    return run


@dataclass
class Model:
    """Statistics of the training tokens; exact counts, kinds of followers and masses of the frequent words, and of the
    hot histories."""

    plan: Plan
    counts: np.ndarray
    kinds: np.ndarray
    mass: np.ndarray
    hot_counts: np.ndarray
    hot_kinds: np.ndarray
    hot_mass: np.ndarray
    tokens: int
    distinct: int
    ends: int
    discount: float

    def of_words(self, names: np.ndarray, rare: list[np.ndarray]) -> np.ndarray:
        """Count, kinds and mass (3 x names), of the rarer words as their buckets have answered; the end has its count."""
        at = _find(self.plan.frequent, names)
        end = names == END
        out = np.zeros((3, len(names)))
        for row, known, answer in zip(out, (self.counts, self.kinds, self.mass), rare, strict=True):
            row[:] = np.append(known, 0)[at]
            row[(at == len(self.plan.frequent)) & ~end] = answer
        out[0, end] = self.ends
        return out

    def probe(self, text: Sequence, part: Filter) -> np.ndarray:
        """What the filters at hand know of each token (4 x tokens): the count of its bigram, and its own count, kinds of
        followers and mass as a history. For texts that the buckets have not answered."""
        place = text.place
        hot = _inside(self.plan.hot, text.names)
        known = np.ones(len(place), bool)
        known[1:] = hot[place[:-1]]
        known[text.cuts[:-1]] = True
        key = bigram_key(text.history, text.tokens)
        bucket = np.where(known, top(key, self.plan.buckets), top(text.history, self.plan.buckets))
        pairs = value_of(part.levels(key, bucket)).astype(np.float32)
        return np.vstack([pairs[None], part.histories.of_words(text.names)[:, place]])

    def chances(self, text: Sequence, found: np.ndarray) -> np.ndarray:
        """P(token | history) of each token, with absolute discounting of quantised counts.

        Every follower gives up the discount, and what all of them give up goes to the single words. A history's
        mass is the sum of its followers' quantised counts, so its probabilities sum to 1; single words' are exact
        counts plus 1, and one more for all unknown words.
        """
        place, n = text.place, len(text.place)
        at = _find(self.plan.hot, text.names)[place]
        own = at < len(self.plan.hot)
        count, kinds, mass = (np.where(own, np.append(exact, 0)[at], part.astype(np.float64)) for exact, part in zip(
            (self.hot_counts, self.hot_kinds, self.hot_mass), found[1:], strict=True))
        count[text.cuts[1:] - 1] = self.ends
        single = (count + 1) / float(self.tokens + self.distinct + 1)
        start = _find(self.plan.hot, np.array([START]))[0]
        follow, whole = np.empty(n), np.empty(n)
        follow[1:], whole[1:] = kinds[:-1], mass[:-1]
        follow[text.cuts[:-1]], whole[text.cuts[:-1]] = (np.append(x, 0)[start] for x in (self.hot_kinds, self.hot_mass))
        known = whole > 0
        # a bigram is no more frequent than its words, which unmasks some false members, all of unknown words among them
        before = np.empty(n)
        before[1:], before[text.cuts[:-1]] = np.where(own, np.append(self.hot_counts, 0)[at], found[1])[:-1], np.inf
        most = value_of(level_of(np.minimum(np.minimum(count, before), float(1 << 61)).astype(np.int64)))
        seen = np.maximum(np.minimum(found[0].astype(np.float64), most) - self.discount, 0)
        return np.where(known, (seen + self.discount * follow * single) / np.where(known, whole, 1), single)

    def score(self, text: Sequence, found: np.ndarray) -> np.ndarray:
        """Sum of log10 P(token | history) of each text."""
        if not len(text.place):
            return np.zeros(0)
        # a false member may lend a rare history's follower more than the history has
        return np.add.reduceat(np.log10(np.minimum(self.chances(text, found), 1.0)), text.cuts[:-1])


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scores(model: Model) -> Callable[[tuple, pa.Table], pa.Table]:
    """Scores of the texts of a chunk from the answers of all buckets to it."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        answers = []
        for kind, data in zip(table["kind"].to_pylist(), table["data"], strict=True):
            if kind == "texts":
                text, ids, there, held = _chunk(model.plan, data.as_py())
            else:
                answers.append(unpack(data.as_py()))
        answers.sort(key=lambda x: int(x[0][0]))
        answered, *rare = (np.concatenate([x[k] for x in answers]) for k in range(1, 5))
        before, after, own = text.pairs()
        bucket, _ = model.plan.history_bucket(before, after)
        levels = np.empty(len(before), np.uint8)
        levels[np.argsort(bucket, kind="stable")] = answered
        pairs, of_words = value_of(levels).astype(np.float32), model.of_words(text.names, rare)
        count, first, sizes = of_words[0], text.cuts[:-1], np.diff(text.cuts)
        of_words = of_words.astype(np.float32)
        scores = []
        for a, b in chunks(text.cuts, SCORE_TOKENS):
            part = text.part(a, b)
            scores.append(model.score(part, np.vstack([pairs[own[text.cuts[a]:text.cuts[b]]][None], of_words[:, part.place]])))
        known = np.add.reduceat((count > 0).astype(np.int64)[text.place], first)
        logs = np.add.reduceat(np.log10(count + 1.0)[text.place], first)
        return pa.table([
            pa.array(ids, mask=~there), pa.array(held), pa.array(sizes), pa.array(known),
            pa.array(np.full(len(ids), model.tokens, np.int64)),
            pa.array(logs - float(np.log10(model.tokens + model.distinct + 1)) * sizes), pa.array(np.concatenate(scores))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def held_out(doc_id: Column, fold: int = 2, folds: int = 7) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def train(docs: DataFrame, frequent: int = FREQUENT, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[Model, DataFrame]:
    """Count the training rows of ``docs`` (doc_id, text, held_out): the model, and the stored chunks and bucket results."""
    known = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size"),
                     F.count_if(~F.col("held_out")).alias("ends")).first()
    parts = max(1, known["n"] // SAMPLE)
    sample = docs.filter(~F.col("held_out") & (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(parts)) == 0))
    often = sample.select("text").mapInArrow(_sample_counts, "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    word, seen = often["word"].to_numpy().astype(np.int64).view(np.uint64), often["n"].to_numpy()
    hot = word[seen >= HOT_SHARE * seen.sum()]  # the first of them
    plan = Plan(np.sort(word[:max(len(hot), broadcast_bytes // FREQUENT_BYTES)]), np.sort(np.append(hot, START)),
                1 << max(2, int(known["size"] // BUCKET_BYTES).bit_length()))
    fields = "bucket long, kind string, data binary"
    texts = stage_table(docs.select("doc_id", "text", "held_out").mapInArrow(_cut(plan), fields), "chunks")
    found = stage_table(texts.mapInArrow(_count(plan), fields).groupBy("bucket").applyInArrow(_merge(plan), fields), "bigrams")
    counts, kinds, hot_counts, hot_kinds = (np.zeros(len(x), np.int64) for x in (plan.frequent, plan.frequent, plan.hot, plan.hot))
    mass, hot_mass = np.zeros(len(plan.frequent), HISTORY["mass"]), np.zeros(len(plan.hot))
    sums = np.zeros(4, np.int64)
    for row in found.filter("kind in ('hot', 'frequent', 'sums')").toLocalIterator():
        data = unpack(row["data"])
        if row["kind"] == "sums":
            sums += data[0]
        elif row["kind"] == "frequent":
            at = _find(plan.frequent, data[0])
            counts[at], kinds[at], mass[at] = data[1:]
        else:
            at = _find(plan.hot, data[0])
            hot_counts[at] += data[1]
            hot_kinds[at] += data[2]
            hot_mass[at] += data[3]
    own = plan.hot != START
    counts[_find(plan.frequent, plan.hot[own])] = hot_counts[own]
    ends = known["ends"]
    model = Model(plan, counts, kinds, mass, hot_counts, hot_kinds, hot_mass, int(sums[0] + hot_counts[own].sum() + ends),
                  int(sums[1] + (hot_counts[own] > 0).sum() + (ends > 0)), ends,
                  float(sums[2] / (sums[2] + 2 * sums[3])) if sums[2] else 0.5)
    return model, found.unionByName(texts)


def filter_groups(found: DataFrame, most: int) -> list[list[tuple[int, int]]]:
    """Buckets with the bytes of their filters, in groups of at most ``most`` bytes."""
    sizes = sorted((r["bucket"], r["n"]) for r in found.filter("kind in ('filter', 'histories')").groupBy("bucket").agg(
        F.sum(F.octet_length("data")).alias("n")).collect())
    groups: list[list[tuple[int, int]]] = [[]]
    size = 0
    for bucket, n in sizes:
        if groups[-1] and size + n > most:
            groups.append([])
            size = 0
        groups[-1].append((bucket, n))
        size += n
    return groups


def _load(found: DataFrame, group: list[tuple[int, int]], buckets: int) -> Filter:
    start, blocks = np.zeros(buckets, np.uint64), np.zeros(buckets, np.uint64)
    parts, at, histories = [], 0, []
    low, high = min((b for b, _ in group), default=0), max((b for b, _ in group), default=-1)  # a group is a range of buckets
    rows = found.filter(F.col("kind").isin("filter", "histories") & F.col("bucket").between(low, high)).select("bucket", "kind", "data")
    for row in rows.toLocalIterator():
        if row["kind"] == "histories":
            histories.append((row["bucket"], row["data"]))
            continue
        part = np.frombuffer(row["data"], np.uint64)
        start[row["bucket"]], blocks[row["bucket"]] = at, len(part) // 8
        parts.append(part)
        at += len(part)
    # buckets are ranges of names, and in each the names are in order
    return Filter(np.concatenate(parts) if parts else np.zeros(1, np.uint64), start, blocks,
                  Histories.of([x for _, x in sorted(histories, key=lambda h: h[0])]))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    broadcast_bytes: int = BROADCAST_BYTES, frequent: int = FREQUENT) -> DataFrame:
    """Scores of all documents: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    The model learns from the rows whose crc32 of the id, as text, leaves no 2 modulo 7. Tokens are the words
    and one end. ``base_score`` sums log10((c + 1) / (N + V + 1)) over exact counts. ``score`` is the bigram
    model's log10 probability: absolute discounting of the quantised counts of the filter, backed off to
    single words. Probabilities are shares of the history's quantised mass and sum to 1, but for false members (about
    1 in 50 probes), which lend an unseen bigram the least count.

    All bigrams are counted and held, none is pruned. The filter is about ten bits an entry, so it grows with
    the corpus; it stays in its buckets, which answer the chunks of texts, so work and storage are in proportion to
    the corpus. Words in the ``frequent`` most frequent of a sample have their statistics in a table that every
    task gets, of at most ``broadcast_bytes`` beside the very frequent ones; those of the others come from their
    buckets, which changes no result.

    Null and empty texts are one end. Null ids are no held-out rows. Rows that repeat an id and text are counted
    each and scored alike. With nothing to learn from, all counts are 0. An empty table gives an empty result;
    other columns are ignored.
    """
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        held_out(F.col(id_col).cast("long")).alias("held_out"))
    model, found = train(base, frequent, broadcast_bytes)
    return found.filter("kind in ('answers', 'texts')").groupBy("bucket").applyInArrow(_scores(model), _SCORES)
