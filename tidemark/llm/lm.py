"""Language-model scoring by online logistic context mixing.

The text (A-Z lowered, words joined by single spaces, one end byte) is coded byte
by byte as a path of binary decisions in a Huffman tree of the byte before, which
needs about three decisions a byte instead of eight. For every decision, several
predictors, each with counts for a context (three bytes, four bytes, and the
whole word so far), give a log-odds that it is 1. A gated mixer adds them with weights
chosen by how much the two most telling contexts have been seen, and an adaptive
probability map refines the sum. Weights and maps start from fixed values in each
text and are learned online while it is read to its end, after every ``STEP`` bytes, so a score is
a probability of the text and doesn't depend on how texts are dealt to tasks.

What the corpus teaches are the trees and the predictors' counts, both of all training
texts. Every context with how often which byte comes after it is a row of a Spark table. Every task
holds the most frequent contexts, ``HELD_CONTEXTS`` at most; of the others, texts ask for
those that occur in them. Texts are dealt by hash to shards of about ``SHARD_BYTES``,
each shard's answers come by a join in packs, and a task streams through a shard, first the
answers, then the texts. Shards grow in number with the corpus, not in size; nothing but the
trees and the counts of frequent words and contexts passes through the driver.

What goes from byte to byte (counting, asking, answering, scoring) is in lm.java and runs
in Spark's JVM. ``ShardCounts`` and :func:`score` here are the same in numpy, text by text
in memory: what lm.java is held against.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SpanHash, give_back, map_arrow, mix64, quoted, shared_table, slices, without, word_spans
from tidemark.llm.jvm import java_task, map_java

END = 10  # closes a text; no word holds it
#: Bytes before the first, so that contexts don't reach into another text.
LEAD = 4
#: Contexts, by how many bytes before they hold (0: the word so far, all of it).
CONTEXTS = (3, 4, 0)
#: Text of a shard, whose rarer contexts a worker holds at a time.
SHARD_BYTES = 16 << 20
#: (Context, pair of bytes) whose counts every task holds, at most; rarer contexts are joined.
HELD_CONTEXTS = 1 << 21
#: Counts that are gathered before they are summed, and those whose odds are made at once.
HELD_COUNTS, COUNTS_TOGETHER = 1_000_000, 100_000
#: Keys that are looked up in a table at once.
LOOKED_UP = 1 << 17
#: Bytes between two updates of the weights.
STEP = 8
#: Bytes whose decisions are laid out at once.
CHUNK = 50_000
#: Mixer: first weight of each predictor, learning rate; refinement: largest log-odds, buckets, learning rate, share.
FIRST_WEIGHTS, RATE = (0.3, 0.4, 0.4), 0.007
#: The predictors whose contexts choose a decision's weights.
GATES = (CONTEXTS.index(0), 0)
LIMIT, BUCKETS, MAP_RATE, MAP_SHARE = np.float32(8), 24, np.float32(0.03), np.float32(0.3)
#: No chance is below this or above one less it.
LEAST_CHANCE = np.float32(1 / 4096)
#: Words whose counts every task holds, at most; rarer ones are joined.
FREQUENT_WORDS = 1 << 20
HELD_OUT_OF, HELD_OUT = 7, 2
#: Bytes of words in streams, where one space is between two.
IN_WORD = np.ones(256, bool)
IN_WORD[[32, END]] = False

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def streams(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Word streams of the texts, all of them end to end (each led by ``LEAD`` end
    bytes), and the n+1 offsets. Null is empty."""
    own = [b" ".join(t.translate(_LOWER).split()) + b"\n" for t in texts.cast(pa.large_binary()).fill_null(b"").to_pylist()]
    data = np.frombuffer(b"".join(bytes([END]) * LEAD + s for s in own), np.uint8)
    return own, data, np.concatenate([[0], np.cumsum([len(s) + LEAD for s in own], dtype=np.int64)])


def coded_places(offsets: np.ndarray) -> np.ndarray:
    """Places of all bytes that are coded: those after each text's lead."""
    lengths = np.diff(offsets) - LEAD
    ends = np.cumsum(lengths)
    return np.repeat(offsets[:-1] + LEAD - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Trees:
    """A Huffman tree of the next byte for each byte: for a pair of bytes, the
    nodes passed and the turns taken."""

    def __init__(self, pairs: np.ndarray):
        begin, nodes, turns, used = [], [], [], 0
        for before in range(256):
            heap: list[tuple] = [(int(n) * 256 + 1, b, b) for b, n in enumerate(pairs[before])]  # unseen bytes have a code too
            heapq.heapify(heap)
            number = 256
            while len(heap) > 1:
                x, y = heapq.heappop(heap), heapq.heappop(heap)
                heapq.heappush(heap, (x[0] + y[0], number, (number - 256, x[2], y[2])))
                number += 1
            paths: list[tuple[list[int], list[int]]] = [([], [])] * 256
            stack: list[tuple] = [(heap[0][2], [], [])]
            while stack:
                at, path, turn = stack.pop()
                if isinstance(at, int):
                    paths[at] = (path, turn)
                else:
                    stack += [(at[1], [*path, before * 255 + at[0]], [*turn, 0]), (at[2], [*path, before * 255 + at[0]], [*turn, 1])]
            for path, turn in paths:
                begin.append(used)
                nodes += path
                turns += turn
                used += len(path)
        self.begin = np.array([*begin, used], np.int64)
        self.spread, self.turns = mix64(np.array(nodes, np.uint64) + np.uint64(1)), np.array(turns, np.int8)


class ContextTable:
    """Log-odds of a 1 and how often seen (0: not, 1: up to four times, 2: more) of
    each (context, node) of a shard, by 64-bit key: its highest bits choose a
    bucket of about one key, its 32 lowest are compared."""

    def __init__(self, keys: np.ndarray, odds: np.ndarray, level: np.ndarray):
        self._lay([_in_order(keys, odds, level)])

    @classmethod
    def of_parts(cls, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> ContextTable:
        """``parts``: keys in order, their log-odds and how often seen; no key comes twice."""
        table = cls.__new__(cls)
        table._lay(parts)
        return table

    def _lay(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        n = sum(len(keys) for keys, _, _ in parts)
        bits = max(1, n.bit_length())
        high = min(4, bits)  # the parts are merged range by range of the keys, so that little is held twice
        self.shift = np.uint64(64 - bits)
        self.first = np.zeros((1 << bits) + 1, np.uint32 if n < 1 << 32 else np.int64)
        self.check, self.odds, self.level = np.empty(n, np.uint32), np.zeros(n + 1, np.float32), np.zeros(n + 1, np.int8)  # the last: not seen
        limits, width = np.arange(1, 1 << high, dtype=np.uint64) << np.uint64(64 - high), 1 << (bits - high)
        cuts = [[0, *np.searchsorted(keys, limits).tolist(), len(keys)] for keys, _, _ in parts]
        begin = 0
        for r in range(1 << high if n else 0):
            keys, odds, level = (np.concatenate([part[k][cut[r] : cut[r + 1]] for part, cut in zip(parts, cuts)]) for k in range(3))
            order, end = np.argsort(keys, kind="stable"), begin + len(keys)
            self.check[begin:end], self.odds[begin:end], self.level[begin:end] = keys.take(order), odds.take(order), level.take(order)
            in_bucket = np.bincount((keys >> self.shift).astype(np.int64) - r * width, minlength=width)
            self.first[r * width + 1 : (r + 1) * width + 1] = begin + np.cumsum(in_bucket)
            begin = end

    def __getstate__(self) -> tuple:
        """Packed, for a broadcast's copy on each executor's disk."""
        sizes = np.diff(self.first)
        arrays = (sizes.astype(np.uint8) if sizes.max(initial=0) < 256 else sizes, self.check, self.odds, self.level)
        return self.shift, self.first.dtype, [(a.dtype, a.nbytes, pa.compress(a.tobytes(), "zstd", asbytes=True)) for a in arrays]

    def __setstate__(self, state: tuple) -> None:
        self.shift, kind, packed = state
        sizes, self.check, self.odds, self.level = (np.frombuffer(pa.decompress(raw, size, "zstd"), dtype) for dtype, size, raw in packed)
        self.first = np.zeros(len(sizes) + 1, kind)
        np.cumsum(sizes, dtype=kind, out=self.first[1:])

    def values(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        odds, level = np.empty(len(keys), np.float32), np.empty(len(keys), np.int8)
        for a in range(0, len(keys), LOOKED_UP):
            found = self._found(keys[a : a + LOOKED_UP])
            odds[a : a + LOOKED_UP], level[a : a + LOOKED_UP] = self.odds.take(found), self.level.take(found)
        return odds, level

    def _found(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is; the last place if it is not in the table."""
        if not len(self.check):
            return np.zeros(len(keys), np.int64)
        bucket = (keys >> self.shift).astype(np.int64)
        at = self.first.take(bucket)
        bucket += 1
        end, low = self.first.take(bucket), keys.astype(np.uint32)
        hit = self.check.take(at, mode="clip") == low
        hit &= at < end
        found = np.where(hit, at, len(self.check))
        at += 1
        left = np.flatnonzero(~hit & (at < end))  # most are first in their buckets
        at, end, low = at.take(left), end.take(left), low.take(left)
        while len(left):
            hit = self.check.take(at) == low
            found[left[hit]] = at[hit]
            at += 1
            go = np.flatnonzero(~hit & (at < end))
            left, at, end, low = left.take(go), at.take(go), end.take(go), low.take(go)
        return found


def _distinct(context: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (context, pair of bytes), and for each given one its number among them."""
    keys = pa.array(mix64(context ^ mix64(pair.astype(np.uint64) + np.uint64(1)))).dictionary_encode()
    which = keys.indices.to_numpy().astype(np.int64)
    contexts, pairs = np.empty(len(keys.dictionary), np.uint64), np.empty(len(keys.dictionary), np.int64)
    contexts[which], pairs[which] = context, pair
    return contexts, pairs, which


def _spread_out(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``begin``, ``begin`` + 1, ... (``count`` of them) of each, end to end."""
    ends = np.cumsum(count)
    return np.repeat(begin - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def _node_keys(contexts: np.ndarray, pairs: np.ndarray, trees: Trees) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of (context, node) on the paths of pairs, the nodes' places, and how many each pair has."""
    count = trees.begin.take(pairs + 1) - trees.begin.take(pairs)
    path = _spread_out(trees.begin.take(pairs), count)
    return mix64(np.repeat(contexts, count) ^ trees.spread.take(path)), path, count


def _looked_up(contexts: np.ndarray, pairs: np.ndarray, trees: Trees, table: ContextTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the values of each (context, pair) begin, and the values, some pairs at a time."""
    count = trees.begin.take(pairs + 1) - trees.begin.take(pairs)
    ends = np.append(0, np.cumsum(count))
    odds, level = np.empty(ends[-1], np.float32), np.empty(ends[-1], np.int8)
    for a in range(0, len(pairs), CHUNK):
        keys, _, _ = _node_keys(contexts[a : a + CHUNK], pairs[a : a + CHUNK], trees)
        place = slice(ends[a], ends[a] + len(keys))
        odds[place], level[place] = table.values(keys)
    return ends[:-1].astype(np.int32 if ends[-1] < 1 << 31 else np.int64), odds, level


class Words:
    """The distinct words of streams: their keys, where one of each is, how often it
    occurs (``n``) and how often as a text's last word (``n_last``)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.hashes = data, SpanHash(data)
        self.begin, self.end, self.rows = word_spans(data, offsets, IN_WORD)
        found = pa.array(self.hashes.spans(self.begin, self.end)).dictionary_encode()
        self.keys, self.which = found.dictionary.to_numpy(), found.indices.to_numpy().astype(np.int64)  # which word each one is
        at = np.empty(len(self.keys), np.int64)
        at[self.which] = np.arange(len(self.which))
        self.starts, self.ends = self.begin.take(at), self.end.take(at)
        self.n = np.bincount(self.which, minlength=len(at))
        self.n_last = np.bincount(self.which.take(self.rows[1:][self.rows[1:] > self.rows[:-1]] - 1), minlength=len(at))

    def steps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _word_steps(self.data, self.starts, self.ends, self.hashes)


def _word_steps(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: SpanHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word and each of its bytes: the context of the byte after it, the byte's place, and the word's number."""
    word = np.repeat(np.arange(len(starts)), ends - starts)
    at = _spread_out(starts, ends - starts)
    return _hashed(CONTEXTS.index(0), hashes.spans(starts.take(word), at + 1) + (data.take(at).astype(np.uint64) + np.uint64(1)) * _ODD), at, word


def _first_context(before: np.ndarray) -> np.ndarray:
    """The context of a word's first byte, by the byte before."""
    return _hashed(CONTEXTS.index(0), (before.astype(np.uint64) + np.uint64(1)) * _ODD)


def _gram_contexts(grams: np.ndarray) -> dict[int, np.ndarray]:
    """Contexts of the byte orders, by predictor, of runs of ``LEAD`` bytes and one."""
    return {k: _hashed(k, (grams >> np.uint64(8)) & np.uint64((1 << (8 * order)) - 1)) for k, order in enumerate(CONTEXTS) if order}


class Decisions:
    """The binary decisions of a run of streams."""

    def __init__(self, data: np.ndarray, places: np.ndarray, trees: Trees, table: ContextTable, words: Words):
        pair = _pairs(data, places)
        self.first = trees.begin.take(pair)
        self.count = trees.begin.take(pair + 1) - self.first
        self.trees = trees
        grams = pa.array(_grams(data, places)).dictionary_encode()
        distinct, which, laid = grams.dictionary.to_numpy(), grams.indices.to_numpy(), {}
        for k, order in enumerate(CONTEXTS):
            if order:  # each run of a context and its byte is looked up once
                runs = pa.array(distinct & np.uint64((1 << (8 * order + 8)) - 1)).dictionary_encode()
                own = runs.dictionary.to_numpy()
                laid[k] = _gram_contexts(own)[k], (own & np.uint64(0xFFFF)).astype(np.int64), runs.indices.to_numpy().take(which)
        laid[CONTEXTS.index(0)] = self._by_word(data, places, words)
        self.found = []  # of each predictor: where a byte's values begin, log-odds, how often seen
        for k in range(len(CONTEXTS)):
            contexts, pairs, which = laid.pop(k)
            begin, odds, level = _looked_up(contexts, pairs, trees, table)
            self.found.append((begin.take(which), odds, level))

    def _by_word(self, data: np.ndarray, places: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Contexts of the word so far and pairs, without repeats, and which of them each
        place has: a word's bytes but the first, then its end, by a space or the text's
        end; after these the first bytes of words."""
        contexts, at, word = words.steps()
        length = words.ends - words.starts
        last = np.cumsum(length) - 1
        after = data.take(np.minimum(at + 1, len(data) - 1)).astype(np.int64)
        after[last] = 32
        before = data.take(at).astype(np.int64)
        starts = np.repeat([32, END], 256)
        contexts = np.concatenate([contexts, contexts.take(last), _first_context(starts)])
        pairs = np.concatenate([before * 256 + after, before.take(last) * 256 + END, starts * 256 + np.tile(np.arange(256), 2)])
        number = len(at) + len(last) + np.where(data.take(places - 1) == END, 256, 0) + data.take(places)  # as if all were first bytes
        of_place = np.full(len(data) + 1, -1, np.int64)  # a last word may end with the data
        mine = length.take(words.which)
        of_place[_spread_out(words.begin + 1, mine)] = _spread_out((last + 1 - length).take(words.which), mine)
        closing = data.take(np.minimum(words.end, len(data) - 1)) != 32
        of_place[words.end[closing]] = len(at) + words.which[closing]
        inside = of_place.take(places)
        contexts, pairs, which = _distinct(contexts, pairs)  # words that begin alike share what they begin with
        return contexts, pairs, which.take(np.where(inside < 0, number, inside))

    def chunks(self) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
        """Of every decision: the number of its byte among the coded ones, the turn, and each
        predictor's log-odds and how often it was seen (only of those that open the gates)."""
        for begin in range(0, len(self.count), CHUNK):
            part = slice(begin, begin + CHUNK)
            count = self.count[part]
            byte = np.repeat(np.arange(len(count)), count)
            nth = np.arange(len(byte)) - np.repeat(np.cumsum(count) - count, count)  # of its byte's decisions
            values = []
            for k, (at, odds, level) in enumerate(self.found):
                places = np.repeat(at[part], count) + nth
                values.append((odds.take(places), level.take(places) if k in GATES else None))
            yield byte + begin, self.trees.turns.take(self.first[part].take(byte) + nth), values


def _pairs(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    return data.take(places - 1).astype(np.int64) * 256 + data.take(places)


def _hashed(predictor: int, context: np.ndarray) -> np.ndarray:
    return mix64(context * _ODD + np.uint64(predictor + 1))


def _grams(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The ``LEAD`` bytes before each place and the place's own, which is lowest."""
    wide = data.astype(np.uint64)
    grams = wide.copy()
    for back in range(1, min(LEAD, len(data) - 1) + 1):
        grams[back:] |= wide[: len(wide) - back] << np.uint64(8 * back)
    return grams.take(places)


def _contexts(data: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
    """Each predictor's context at each place as a 64-bit hash: of the bytes before,
    or of the word so far (since the last space or lead) and the byte before."""
    by_order = _gram_contexts(_grams(data, places))
    ends = (data == 32) | (data == END)
    begin = np.maximum.accumulate(np.where(ends, np.arange(len(data)), -1)) + 1  # after the last separator up to here
    word = SpanHash(data).spans(begin.take(places - 1), places) + (data.take(places - 1).astype(np.uint64) + np.uint64(1)) * _ODD
    return [by_order[k] if order else _hashed(k, word) for k, order in enumerate(CONTEXTS)]


def _first_map() -> tuple[np.float32, np.ndarray]:
    """Buckets of the refinement per unit of log-odds, and their first chances."""
    scale = np.float32((BUCKETS - 0.01) / (2 * LIMIT))
    centre = (np.arange(BUCKETS) + 0.5) / scale - LIMIT
    return scale, (1 / (1 + np.exp(-centre))).astype(np.float32)


def score(own: list[bytes], data: np.ndarray, offsets: np.ndarray, trees: Trees, table: ContextTable, words: Words | None = None) -> np.ndarray:
    """Log10 probability of each stream. The query scores by ``Mixer`` in lm.java, which tests hold against this."""
    lengths = np.diff(offsets) - LEAD
    row = np.repeat(np.arange(len(lengths)), lengths)
    within = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    step = within // STEP
    order = np.argsort(step.astype(np.uint16) if step.max(initial=0) < 1 << 16 else step, kind="stable")  # all first bytes of the texts, then all second ones, ...
    row, step = row.take(order), step.take(order)
    laid = Decisions(data, coded_places(offsets).take(order), trees, table, words or Words(data, offsets))
    lanes, decisions, end = len(lengths), int(laid.count.sum()), 0
    lane_gates, lane_map = row * 9, row * BUCKETS
    at, base = np.empty(decisions, np.int32), np.empty(decisions, np.int32)  # lanes are at most as many as the bytes of a slice
    turn, inputs = np.empty(decisions, np.int8), np.empty((len(CONTEXTS), decisions), np.float32)
    for owner, turns, values in laid.chunks():
        begin, end = end, end + len(owner)
        gate = values[GATES[0]][1] * np.int8(3) + values[GATES[1]][1]  # how well the word so far and the shortest context are known
        at[begin:end], base[begin:end], turn[begin:end] = lane_gates.take(owner) + gate, lane_map.take(owner), turns
        for column, (odds, _) in zip(inputs, values):
            column[begin:end] = odds
    laid.found.clear()
    give_back()
    weights = np.repeat(np.array(FIRST_WEIGHTS, np.float32)[:, None], lanes * 9, 1)
    scale, first_map = _first_map()
    refine = np.tile(first_map, lanes)
    chance = np.empty(len(turn), np.float32)  # of a 1; in the end that of the turn that was taken
    ends, begin, end = np.cumsum(np.bincount(step, weights=laid.count).astype(np.int64)).tolist(), 0, 0
    for a, b in zip([0, *ends], ends):
        if b > end:  # few decisions a step where texts are few: their columns are widened for many steps at once
            begin, end = a, max(b, ends[bisect_right(ends, a + CHUNK) - 1])
            gates, lowest, turns = at[begin:end].astype(np.int64), base[begin:end].astype(np.int64), turn[begin:end].astype(np.float32)
        x, i, y, mixed = inputs[:, a:b], gates[a - begin : b - begin], turns[a - begin : b - begin], chance[a:b]
        parts = weights.take(i, 1)
        parts *= x
        total = parts[0]
        for part in parts[1:]:
            total += part
        np.minimum(np.maximum(total, -LIMIT, out=total), LIMIT, out=total)
        p = 1 / (1 + np.exp(-total))
        total += LIMIT
        total *= scale
        bucket = total.astype(np.int64)
        bucket += lowest[a - begin : b - begin]
        refined = refine.take(bucket)
        np.subtract(refined, p, out=mixed)
        mixed *= MAP_SHARE
        mixed += p
        np.subtract(y, p, out=p)
        p *= np.float32(RATE)
        np.multiply(x, p, out=parts)
        for w, change in zip(weights, parts):
            np.add.at(w, i, change)
        np.subtract(y, refined, out=refined)
        refined *= MAP_RATE
        np.add.at(refine, bucket, refined)
        np.minimum(np.maximum(refine, 0, out=refine), 1, out=refine)  # many decisions of a step may be in one bucket
    np.minimum(np.maximum(chance, LEAST_CHANCE, out=chance), 1 - LEAST_CHANCE, out=chance)
    np.abs(np.subtract(1 - turn, chance, out=chance), out=chance)
    del at, base, turn, inputs, gates, lowest, turns, x, i, y
    cost = np.add.reduceat(np.log(chance, out=chance), np.cumsum(laid.count) - laid.count, dtype=float) / np.log(10)  # of each byte
    return np.bincount(row, weights=cost, minlength=len(lengths))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_OF == HELD_OUT


def _tally(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys and the sums of their counts (without any: how often they occur)."""
    found = pa.array(keys).dictionary_encode()
    which, size = found.indices.to_numpy(), len(found.dictionary)
    return (found.dictionary.to_numpy(), *[np.bincount(which, weights=n, minlength=size).astype(np.int64) for n in counts or (None,)])


#: Packs of keys, by the highest bits of these.
RANGED, RANGE_BITS = "range int, pack binary", 14


def _by_range(rows: DataFrame) -> DataFrame:
    return rows.repartition("range").sortWithinPartitions("range")


def corpus_counts(train: DataFrame) -> DataFrame:
    """``kind``, ``key``, ``n`` and ``steps``: how often each pair of bytes (kind 0), each word (kind 1), each
    context of bytes (kind 2) and of the word so far (kind 3) occurs in column 0 of ``train``, and before which
    byte a context how often (n * 65536 + pair of bytes). The key of a word or context is a 64-bit hash."""
    spark = train.sparkSession
    counted = map_java(train.select(F.col(quoted(train.columns[0])).cast("binary")), java_task(spark, "count"), RANGED)
    summed = map_java(_by_range(counted), java_task(spark, "sum"), "kind int, key long, n long, steps array<long>")
    return shared_table(summed, "lm-counts", drop_shuffles=True)


class ShardCounts:
    """How often each (context, pair of bytes) occurs in texts, or in what was counted of them."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting, self.least = 0, HELD_COUNTS

    def add(self, texts: pa.Array) -> None:
        _, data, offsets = streams(texts)
        grams, n = _tally(_grams(data, coded_places(offsets)))
        self.add_grams(grams, n)
        self.add_pairs(*_tally((grams & np.uint64(0xFFFF)).astype(np.int64), n))
        words = Words(data, offsets)
        self.add_words(data, words.starts, words.ends, words.n, words.n_last)

    def add_grams(self, grams: np.ndarray, n: np.ndarray) -> None:
        for contexts in _gram_contexts(grams).values():
            self.hold(contexts, (grams & np.uint64(0xFFFF)).astype(np.int64), n)

    def add_pairs(self, pairs: np.ndarray, n: np.ndarray) -> None:
        """Of pairs of bytes, those whose second is the first of a word (or ends a text without words)."""
        first = np.flatnonzero((pairs >> 8 == 32) | (pairs >> 8 == END))
        self.hold(_first_context(pairs[first] >> 8), pairs[first], n[first])

    def add_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: np.ndarray, last: np.ndarray) -> None:
        contexts, at, word = _word_steps(data, starts, ends, SpanHash(data))
        closing = np.cumsum(ends - starts) - 1
        inner = np.ones(len(at), bool)
        inner[closing] = False
        before = data.take(at).astype(np.int64) * 256
        self.hold(contexts[inner], before[inner] + data.take(at[inner] + 1), n.take(word[inner]))
        for byte, times in ((32, n - last), (END, last)):
            some = times > 0
            self.hold(contexts[closing[some]], before[closing[some]] + byte, times[some])

    def hold(self, contexts: np.ndarray, pairs: np.ndarray, n: np.ndarray) -> None:
        if len(n):
            self.held.append((contexts, pairs, n))
            self.waiting += len(n)
        if self.waiting > self.least:
            self._sum()

    def _sum(self) -> None:
        context, pair, n = map(np.concatenate, zip(*self.held))
        contexts, pairs, which = _distinct(context, pair)
        self.held = [(contexts, pairs, np.bincount(which, weights=n, minlength=len(pairs)).astype(np.int64))]
        self.waiting, self.least = 0, max(HELD_COUNTS, len(pairs))

    def sums(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.held:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._sum()
        return self.held.pop()

    def table(self, trees: Trees) -> ContextTable:
        return ContextTable(*_node_odds(*self.sums(), trees))


def _node_odds(contexts: np.ndarray, pairs: np.ndarray, n: np.ndarray, trees: Trees) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each (context, node): key, log-odds of a 1 and how often seen (1 or 2, see ``ContextTable``)."""
    keys, path, counts = _node_keys(contexts, pairs, trees)
    n, turn = np.repeat(n, counts), trees.turns.take(path)
    found = pa.array(keys.view(np.int64)).dictionary_encode()
    which, size = found.indices.to_numpy(), len(found.dictionary)
    zeros, ones = (np.bincount(which, weights=n * (turn == t), minlength=size) for t in (0, 1))
    odds = np.log((ones + 0.4) / (zeros + 0.4)).astype(np.float32)
    return found.dictionary.to_numpy().view(np.uint64), odds, np.minimum(2, (zeros + ones + 3) // 4).astype(np.int8)


def _in_order(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys)
    return (keys.take(order), *[c.take(order) for c in columns])


def _held_packs(contexts: DataFrame) -> list[bytes]:
    """Some of :func:`context_counts` in packs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = batch.column(1)
            sizes = steps.value_lengths().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([_pack(batch.column(0).to_numpy(), sizes, steps.flatten().to_numpy())], pa.binary())], names=["counts"])

    often = contexts.orderBy(F.desc("total"), "context")  # those that are looked up most lie side by side
    return map_arrow(often.select("context", "steps"), run, "counts binary").toArrow()["counts"].to_pylist()


def context_counts(counts: DataFrame) -> DataFrame:
    """``context``, ``by_bytes`` (1: a context of bytes, 0: of a word so far), ``total`` and ``steps`` of :func:`corpus_counts`."""
    return counts.where("kind >= 2").select(F.col("key").alias("context"), (F.col("kind") == 2).cast("int").alias("by_bytes"), F.col("n").alias("total"), "steps")


@dataclass(frozen=True)
class LanguageModel:
    trees: Trees
    held: list[bytes]  # the frequent contexts, in packs
    rare: DataFrame  # the other contexts: context, steps
    rare_bytes: bool  # contexts of bytes are among them
    shards: int
    counts: DataFrame  # of words: key, n
    tokens: int  # with the end of each text
    types: int
    texts: int
    frequent: tuple[np.ndarray, np.ndarray]  # keys in order and counts of the most frequent words


def _shard(df: DataFrame, shards: int) -> Column:
    """A row's shard by all its columns: copies of a text with ids of their own are spread."""
    return F.pmod(F.xxhash64(*[F.col(quoted(c)).cast("string") for c in df.columns]), F.lit(shards))


def _step_of(n: str) -> Column:
    return F.floor(F.log2(n) * 8)


def _least_step(counted: list, most: int) -> int | None:
    """The least step down to which ``counted`` (``step``, ``size``) comes to ``most`` at most."""
    least, held = None, 0
    for r in sorted(counted, key=lambda r: -r["step"]):
        held += r["size"]
        if held > most:
            break
        least = r["step"]
    return least


def fit(train: DataFrame, text: str = "text") -> LanguageModel:
    """Learn from the texts of ``train``, all of them: every text is scored by the counts of the whole corpus."""
    body = F.col(quoted(text)).cast("string").alias("text")
    counts = corpus_counts(train.select(body))
    pairs = np.zeros(1 << 16, np.int64)
    for r in counts.where("kind = 0").collect():  # 65,536 at most
        pairs[r["key"]] = r["n"]
    words = counts.where("kind = 1").select("key", "n")
    total, types = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    texts = int(pairs.reshape(256, 256)[:, END].sum())
    # the least count that at most FREQUENT_WORDS words have, from how many words there are in each eighth of a power of two
    least = _least_step(words.groupBy(_step_of("n").alias("step")).agg(F.count(F.lit(1)).alias("size")).collect(), FREQUENT_WORDS)
    chosen = words.where(_step_of("n") >= least if least is not None else F.lit(False)).toArrow()
    keys, n = chosen["key"].to_numpy(), chosen["n"].to_numpy()
    order = np.argsort(keys)
    trees = Trees(pairs.reshape(256, 256))
    contexts = context_counts(counts)
    sizes = contexts.groupBy("by_bytes", _step_of("total").alias("step")).agg(F.sum(F.size("steps")).alias("size")).collect()
    by_bytes = sum(r["size"] for r in sizes if r["by_bytes"])
    all_bytes = by_bytes <= HELD_CONTEXTS // 2  # then no text needs to ask for them
    least = _least_step([r for r in sizes if not (all_bytes and r["by_bytes"])], HELD_CONTEXTS - all_bytes * by_bytes)
    held = (_step_of("total") >= least if least is not None else F.lit(False)) | ((F.col("by_bytes") == 1) & F.lit(all_bytes))
    held |= F.col("context").isin(_first_context(np.array([32, END])).view(np.int64).tolist())  # two contexts that every text has
    shards, cores = -(-int(pairs.sum()) // SHARD_BYTES) or 1, train.sparkSession.sparkContext.defaultParallelism
    if shards > 1:  # shards take long and about as long as each other: the last round of tasks is a full one
        shards = -(-shards // cores) * cores
    return LanguageModel(trees, _held_packs(contexts.where(held)), contexts.where(~held).select("context", "steps"), not all_bytes, shards, words,
                         int(total) + texts, int(types) + (texts > 0), texts, (keys[order], n[order]))


def _blob(model: LanguageModel) -> bytes:
    """What lm.java's ``Held`` reads: trees, the mixer's first values, frequent words, packs of frequent contexts."""
    scale, first_map = _first_map()
    mixer = np.array([*FIRST_WEIGHTS, RATE, LIMIT, scale, MAP_SHARE, LEAST_CHANCE, MAP_RATE], np.float32)
    keys, n = model.frequent
    size = lambda array: len(array).to_bytes(8, "little")
    sized = (model.trees.begin.astype(np.int32), model.trees.turns, mixer, first_map)
    parts = [part for array in sized for part in (size(array), array.tobytes())]
    parts += [np.array([STEP, model.texts, len(keys)], np.int64).tobytes(), keys.astype(np.int64).tobytes(), n.astype(np.int64).tobytes()]
    return b"".join(parts + [part for pack in model.held for part in (size(pack), pack)])


def _told(texts: DataFrame, model: LanguageModel, task: JavaObject) -> DataFrame:
    """``shard`` and ``counts``: the contexts that are not held by all and occur in the ``texts`` (shard, binary) of
    a shard, many a row."""
    asked = map_java(texts, task.another("ask", model.rare_bytes, model.shards), RANGED)
    known = model.rare.select(F.shiftrightunsigned("context", 64 - RANGE_BITS).cast("int").alias("range"), F.lit(None).cast("binary").alias("pack"), "context", "steps")
    rows = asked.select("*", F.lit(None).cast("long").alias("context"), F.lit(None).cast(known.schema["steps"].dataType).alias("steps")).unionByName(known)
    return map_java(_by_range(rows), task.another("tell", False, model.shards), "shard long, counts binary")


def _short(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Numbers as a byte each, and those of 255 or more in full."""
    return np.minimum(numbers, 255).astype(np.uint8).tobytes(), numbers[numbers >= 255].astype(np.int64).tobytes()


def _pack(contexts: np.ndarray, sizes: np.ndarray, steps: np.ndarray) -> bytes:
    """Contexts as their differences (small where they come in order), all highest bytes first, then all second ones, ..."""
    (short_sizes, long_sizes), (short_n, long_n) = _short(sizes), _short(steps >> 16)
    apart = np.diff(contexts.view(np.uint64), prepend=np.uint64(0)).astype(">u8").view(np.uint8).reshape(-1, 8).T
    raw = b"".join([np.array([len(sizes), len(steps)], np.int64).tobytes(), long_sizes, long_n, apart.tobytes(), (steps & 0xFFFF).astype(np.uint16).tobytes(), short_sizes, short_n])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _open(pack: pa.Buffer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, pairs and counts of a pack, as ``Pack`` in lm.java reads it."""
    raw = pa.decompress(pack.slice(8), int.from_bytes(pack.slice(0, 8).to_pybytes(), "little"), "zstd")
    rows, steps = np.frombuffer(raw, np.int64, 2).tolist()
    short = np.frombuffer(raw, np.uint8, offset=len(raw) - rows - steps).astype(np.int64)
    short[short == 255] = np.frombuffer(raw, np.int64, int((short == 255).sum()), 16)  # of the sizes, then of the counts
    pairs = np.frombuffer(raw[len(raw) - rows - 3 * steps :], np.uint16, steps).astype(np.int64)
    apart = np.frombuffer(raw, np.uint8, 8 * rows, len(raw) - 9 * rows - 3 * steps).reshape(8, rows)
    contexts = np.cumsum(np.ascontiguousarray(apart.T).view(">u8").ravel().astype(np.uint64))
    return np.repeat(contexts, short[:rows]), pairs, short[rows:]


def _opened(packs: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Contexts, pairs and counts, of packs of ``COUNTS_TOGETHER`` or one pack more."""
    waiting, size = [], 0
    for pack in map(pa.BinaryScalar.as_buffer, packs):
        waiting.append(_open(pack))
        size += len(waiting[-1][2])
        if size >= COUNTS_TOGETHER:
            yield tuple(map(np.concatenate, zip(*waiting)))
            waiting, size = [], 0
    if waiting:
        yield tuple(map(np.concatenate, zip(*waiting)))


SCORED = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("log_counts", T.DoubleType()),
                       T.StructField("bytes", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("rare", T.ArrayType(T.LongType(), False))])


def _packed(texts: DataFrame) -> DataFrame:
    """``shard``, ``size`` (bytes of the text), ``body`` (the text, compressed for the shuffle by
    itself, so that rows stay rows; null and empty: empty) and ``kept`` of ``shard``, ``text`` and ``kept``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                own = part.column(1).cast(pa.large_binary()).fill_null(b"")
                bodies = [pa.compress(t.as_buffer(), "zstd", asbytes=True) for t in own]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([t.as_buffer().size for t in own], pa.int32()), pa.array(bodies, pa.binary()), part.column(2)],
                                                 names=["shard", "size", "body", "kept"])

    schema = T.StructType([texts.schema["shard"], T.StructField("size", T.IntegerType()), T.StructField("body", T.BinaryType()), texts.schema["kept"]])
    return map_arrow(texts, run, schema)


def _runs(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Begin and end of runs of ``sizes`` that come to ``limit`` at most, or are one row."""
    ends, begin = np.cumsum(sizes, dtype=np.int64), 0
    while begin < len(sizes):
        before = ends[begin] - sizes[begin]
        end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield begin, end
        begin = end


def _unpacked_texts(sizes: np.ndarray, bodies: pa.Array) -> pa.Array:
    return pa.array([pa.decompress(b.as_buffer(), n, "zstd", asbytes=True) for n, b in zip(sizes.tolist(), bodies)], pa.large_binary())


def score_texts(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Every row of ``docs`` (without the text) with ``n_tokens`` (words and the
    end), ``n_known`` (tokens that the model has seen), ``base_score`` (log10
    probability by word counts, one added), ``score`` (by the mixed contexts) and
    ``bits_per_byte``.

    A null text counts as empty: its only token is the end. Rows are scored one by
    one by the counts of the whole corpus; a model of no text gives even odds. Input
    columns named like a result column are replaced."""
    results = ["n_tokens", "n_known", "base_score", "score", "bits_per_byte", *SCORED.names, "row_key"]
    keep = [c for c in without(docs, results) if c != text]
    task = java_task(docs.sparkSession, "score", _blob(model))
    plain = [f"c{i}" for i in range(len(keep))]
    schema = T.StructType([T.StructField(p, docs.schema[c].dataType) for p, c in zip(plain, keep)] + list(SCORED.fields))
    kept = F.struct(F.lit(0).alias("none")) if not keep else F.struct(*[F.col(quoted(c)).alias(p) for p, c in zip(plain, keep)])
    body, shard = F.col(quoted(text)).cast("string").alias("text"), _shard(docs, model.shards).alias("shard")
    rows = _packed(docs.select(shard, body, kept.alias("kept")))
    told = _told(docs.select(shard, body.cast("binary")), model, task).select(
        "shard", F.lit(-1).alias("size"), F.col("counts").alias("body"), F.lit(None).cast(rows.schema["kept"].dataType).alias("kept"))
    dealt = told.unionByName(rows).repartitionById(model.shards, F.col("shard").cast("int"))
    dealt = dealt.sortWithinPartitions("shard", "size")  # answers first
    # the row key is stored with the rows, so it stays what it is if a task runs again
    scored = shared_table(map_java(dealt, task, schema).withColumn("row_key", F.monotonically_increasing_id()), "lm-scored", drop_shuffles=True)
    found = (scored.select("row_key", F.explode("rare").alias("key")).join(model.counts, "key")
             .groupBy("row_key").agg(F.count(F.lit(1)).alias("more_known"), F.sum(F.log10(F.col("n") + 1.0)).alias("more_log")))
    total = float(model.tokens + model.types + 1)
    return scored.drop("rare").join(found, "row_key", "left").select(
        *[F.col(p).alias(c) for p, c in zip(plain, keep)], "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("log_counts") + F.coalesce("more_log", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(total))).alias("base_score"),
        "score", (F.col("score") / (F.col("bytes") * float(-np.log10(2)))).alias("bits_per_byte"))
