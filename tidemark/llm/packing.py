"""Best-fit decreasing packing of tokenised documents into fixed-length sequences.

Documents longer than a sequence are cut into full pieces and a rest; nothing
else is cut. Pieces of one length are interchangeable, so best-fit decreasing
needs only how many pieces of each length there are: at most one count per
length reaches the driver. There, lengths are taken in falling order, and a
segment tree over remaining capacities finds the tightest one that some open
sequence still has in logarithmic time. All sequences with that remaining
capacity are filled in one step, which gives what placing piece by piece would
give. The plan, ranges of pieces of a length to ranges of sequences, is joined
back on the length; each piece takes its place by its rank among its equals.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import KEPT, NOT_SPACE, SpanHash, flat, map_arrow, quoted, shared_table, slices, without, word_spans
from tidemark.llm.numbering import numbered

SEQUENCE_TOKENS = 2048
END_ID = 0
#: Words a Python worker remembers with their ids before it starts afresh, and runs of them.
MEMO_WORDS, MEMO_RUNS = 1_000_000, 100_000
#: Bytes with A-Z lowered.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: Pieces that one task ranks.
RANKED_TOGETHER = 100_000

PIECES = T.StructType([
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
])
PLAN = "length long, first_rank long, end_rank long, first_sequence long, per_sequence long, base long"


class WordTokenizer:
    """Ids of texts by a ``tokenizers`` tokenizer that lower-cases and treats white
    space as a separator only: words are encoded once and remembered.

    Words of plain letters, digits and punctuation are put together from their
    runs of one class, which are the tokenizer's own pre-tokens; all others (with
    apostrophes, special tokens or other scripts) are encoded as they stand."""

    _odd = re.compile(r"[^\na-z0-9ªµºß-öø-ÿ!-&(-/:-@\[-`{-~]|<\|")
    _run = re.compile(r"[a-zªµºß-öø-ÿ]+|[0-9]|\n|[^a-z0-9ªµºß-öø-ÿ\n]+")

    def __init__(self, json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_str(json)
        self.runs_only = Tokenizer.from_str(json)  # for runs: normalised and split already
        self.runs_only.normalizer = normalizers.Sequence([])
        self.runs_only.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = self.whole.model.end_of_word_suffix  # the last token of a run has it, no other has
        if not suffix:
            raise ValueError("a vocabulary with word ends is needed")
        self.closes = np.zeros(self.whole.get_vocab_size(), bool)
        self.closes[[i for token, i in self.whole.get_vocab().items() if token.endswith(suffix)]] = True
        self._clear()

    def _clear(self) -> None:
        self._clear_runs()
        self.words, self.word_ids = Numbers(), _Ragged([])  # words by their 64-bit hash

    def _clear_runs(self) -> None:
        self.runs, self.run_ids = {"\n": 0}, _Ragged([0])

    def _learn_runs(self, runs: list[str]) -> None:
        for i in range(0, len(runs), 8192):
            some = runs[i : i + 8192]
            lines = [" ".join(some[j : j + 64]) for j in range(0, len(some), 64)]
            got = self.runs_only.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.array([i for e in got for i in e.ids], np.int32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            self.runs.update(zip(some, range(len(self.runs), len(self.runs) + len(some))))
            self.run_ids.add(ids, np.diff(ends, prepend=0))

    def _learn(self, words: list[bytes], hashes: np.ndarray) -> None:
        text = b"\n".join(words).decode() + "\n"
        odd = {text[text.rfind("\n", 0, m.start()) + 1 : text.find("\n", m.start())] for m in self._odd.finditer(text)}
        if odd:
            spelt = text.split("\n")[:-1]
            is_odd = np.fromiter(map(odd.__contains__, spelt), bool, len(spelt))
            encoded = [e.ids for e in self.whole.encode_batch([w for w in spelt if w in odd], add_special_tokens=False)]
            self._remember(hashes[is_odd], np.array([i for ids in encoded for i in ids], np.int32), [len(ids) for ids in encoded])
            text, hashes = "".join([w + "\n" for w in spelt if w not in odd]), hashes[~is_odd]
        if len(hashes):
            runs = self._run.findall(text)
            if len(self.runs) > MEMO_RUNS:
                self._clear_runs()
            self._learn_runs(list(set(runs).difference(self.runs)))
            at = np.fromiter(map(self.runs.__getitem__, runs), np.int64, len(runs))
            counted = np.where(at == 0, 0, self.run_ids.lengths(at))
            ends = np.cumsum(counted)[at == 0]
            self._remember(hashes, self.run_ids.gather(at[at != 0]), np.diff(ends, prepend=0))

    def _remember(self, hashes: np.ndarray, ids: np.ndarray, lengths) -> None:
        self.words.add(hashes)
        self.word_ids.add(ids, lengths)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, each followed by ``END_ID``, and the
        n+1 offsets."""
        if len(self.words) > MEMO_WORDS:
            self._clear()
        data, offsets = flat(texts)
        if b"<|" not in data.tobytes():  # special tokens are matched before lower-casing
            data = LOWER[data]
        starts, ends, rows = word_spans(data, offsets, NOT_SPACE)
        found = pa.array(SpanHash(data).spans(starts, ends)).dictionary_encode()
        keys, which = found.dictionary.to_numpy(), found.indices.to_numpy().astype(np.int64)
        at = self.words.of(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            some = np.empty(len(keys), np.int64)
            some[which] = np.arange(len(which))  # one of the places of each word
            raw, begin, end = data.tobytes(), starts[some[new]].tolist(), ends[some[new]].tolist()
            self._learn([raw[a:b] for a, b in zip(begin, end)], keys[new])
            at[new] = self.words.of(keys[new])
        return self.word_ids.gather_ended(np.insert(at[which], rows[1:], -1), END_ID)


class Numbers:
    """Distinct 64-bit hashes, numbered as they come, in 24 to 48 bytes each (every worker
    has a memo of its own). A hash lies at the place of its lowest bits or at the first
    free one after it; half of the places stay free."""

    def __init__(self):
        self.used, self.keys, self.number = 0, np.zeros(1 << 10, np.uint64), np.full(1 << 10, -1, np.int32)

    def __len__(self) -> int:
        return self.used

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64(len(self.keys) - 1)).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        place, out, left = self._places(keys), np.full(len(keys), -1, np.int64), np.arange(len(keys))
        while len(left):
            number = self.number.take(place)
            hit = (number >= 0) & (self.keys.take(place) == keys.take(left))
            out[left[hit]] = number[hit]
            on = (number >= 0) & ~hit
            left, place = left[on], (place[on] + 1) & (len(self.keys) - 1)
        return out

    def add(self, keys: np.ndarray) -> None:
        """Number keys that have none; no key comes twice."""
        if 2 * (self.used + len(keys)) > len(self.keys):
            taken = self.number >= 0
            old, number, size = self.keys[taken], self.number[taken], 1 << (2 * (self.used + len(keys))).bit_length()
            self.keys, self.number = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
            self._put(old, number)
        self._put(keys, np.arange(self.used, self.used + len(keys), dtype=np.int32))
        self.used += len(keys)

    def _put(self, keys: np.ndarray, number: np.ndarray) -> None:
        place = self._places(keys)
        while len(keys):
            free = np.flatnonzero(self.number.take(place) < 0)
            self.number[place[free]] = number[free]  # of several keys at a place, the last has it
            lost = self.number.take(place) != number
            self.keys[place[~lost]] = keys[~lost]
            keys, number, place = keys[lost], number[lost], (place[lost] + 1) & (len(self.keys) - 1)


class _Ragged:
    """Lists of ids end to end, in a buffer that grows by doubling."""

    def __init__(self, first: list[int]):
        self.pool, self.used = np.array(first, np.int32), len(first)
        self.ends = [np.arange(len(first) + 1)]

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(self.used + len(ids), np.int32)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.ends.append(self.used + np.cumsum(lengths))
        self.used += len(ids)

    def _all_ends(self) -> np.ndarray:
        if len(self.ends) > 1:
            self.ends = [np.concatenate(self.ends)]
        return self.ends[0]

    def lengths(self, at: np.ndarray) -> np.ndarray:
        ends = self._all_ends()
        return ends[at + 1] - ends[at]

    def gather(self, at: np.ndarray) -> np.ndarray:
        lengths = self.lengths(at)
        ends = np.cumsum(lengths)
        return self.pool[np.repeat(self._all_ends()[at] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]

    def gather_ended(self, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Lists ``at``, where -1 stands for ``end_id``, and the offset after each -1."""
        last = at < 0
        lengths = np.ones(len(at), np.int64)
        lengths[~last] = self.lengths(at[~last])
        ends = np.cumsum(lengths)
        ids = np.empty(ends[-1] if len(ends) else 0, np.int32)
        closing = ends[last] - 1
        inside = np.ones(len(ids), bool)
        inside[closing] = False
        ids[inside] = self.gather(at[~last])
        ids[closing] = end_id
        return ids, np.concatenate([[0], closing + 1])


def _tokenizer(json: str) -> WordTokenizer:
    """This worker's tokenizer, kept with its memo for the packing tasks that follow."""
    key, kept = zlib.crc32(json.encode()), KEPT.setdefault("tokenizer", {})
    if key not in kept:
        kept.clear()
        kept[key] = WordTokenizer(json)
    return kept[key]


def token_pieces(docs: DataFrame, tokenizer_path: str, text: str = "text", size: int = SEQUENCE_TOKENS,
                 with_ids: bool = False) -> DataFrame:
    """A row per piece: the columns of ``docs`` but the text, ``piece`` (from 0),
    ``start`` and ``length`` in the document's ids, ``ids_crc32`` of the ids as
    little-endian unsigned 32-bit numbers, and ``ids`` if asked for."""
    schema = T.StructType(PIECES.fields + ([T.StructField("ids", T.ArrayType(T.IntegerType(), False))] if with_ids else []))
    keep = [c for c in without(docs, [*schema.names, "ids", "sequence_id", "offset"]) if c != text]
    with open(tokenizer_path, encoding="utf-8") as file:
        json = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file: a few MB, whatever the data

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(json.value)
        for batch in batches:
            for part in slices(batch, len(keep)):
                ids, offsets = tokenizer.encode(part.column(len(keep)))
                count = -(-np.diff(offsets) // size)
                row = np.repeat(np.arange(len(count)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * size
                begin = offsets[row] + start
                end = np.minimum(begin + size, offsets[row + 1])
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
                cols = [part.column(i).take(pa.array(row)) for i in range(len(keep))]
                cols += [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(end - begin, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(ids)), pa.int32()), pa.array(ids, pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=keep + schema.names)

    out = T.StructType([docs.schema[c] for c in keep] + list(schema.fields))
    return map_arrow(docs.select(*[F.col(quoted(c)) for c in keep], F.col(quoted(text)).cast("string").alias("__text")), run, out, keeps="tokenizer")


class Capacities:
    """Segment tree over remaining capacities 0..size: which ones some open
    sequence has."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.tree = [False] * (2 * self.width)

    def put(self, capacity: int, present: bool) -> None:
        i = self.width + capacity
        self.tree[i] = present
        while i > 1:
            i //= 2
            self.tree[i] = self.tree[2 * i] or self.tree[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest capacity present that is at least ``least``."""
        i = self.width + least
        if not self.tree[i]:
            while i > 1 and (i % 2 or not self.tree[i + 1]):
                i //= 2
            if i == 1:
                return None
            i += 1
            while i < self.width:
                i = 2 * i if self.tree[2 * i] else 2 * i + 1
        return i - self.width


def best_fit_plan(counts: dict[int, int], size: int = SEQUENCE_TOKENS) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``counts`` pieces of each length.

    Rows of (length, first rank, end rank, first sequence, pieces per sequence,
    offset of the first): the piece of rank r goes to sequence first +
    (r - first rank) // per, at offset + (r - first rank) % per * length."""
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # remaining capacity: runs of (first sequence, how many)
    tree, plan, sequences = Capacities(size), [], 0

    def leave(capacity: int, first: int, n: int) -> None:
        if n and capacity:
            runs[capacity].append((first, n))
            tree.put(capacity, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity = size
                first, n = sequences, -(-left // (size // length))
                sequences += n
            else:
                first, n = runs[capacity].pop()
                if not runs[capacity]:
                    tree.put(capacity, False)
            per = capacity // length
            full, rest = min(n, left // per), 0
            if full < n and left > full * per:
                rest = left - full * per  # the last of them takes fewer
            taken = full * per + rest
            plan.append((length, rank, rank + taken, first, per, size - capacity))
            leave(capacity - per * length, first, full)
            if rest:
                leave(capacity - rest * length, first + full, 1)
            used = full + (rest > 0)
            leave(capacity, first + used, n - used)
            rank, left = rank + taken, left - taken
    return plan


def pack(pieces: DataFrame, order: list[str], size: int = SEQUENCE_TOKENS) -> DataFrame:
    """``pieces`` (a stored table with ``length``) with ``sequence_id`` and
    ``offset``. ``order``: columns that rank pieces of a length; rows equal in
    all of them are interchangeable, and ranked in parts if they are many."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = pieces.sparkSession.createDataFrame(best_fit_plan(counts, size), PLAN)
    buckets = 8 + max(counts.values(), default=0) // RANKED_TOGETHER
    # Twice the mean is left room for, so that only buckets of repeated rows are dealt to parts.
    ranked = numbered(pieces, ["length"], F.pmod(F.xxhash64(*order), F.lit(buckets)), [F.col(c) for c in order], 2 * RANKED_TOGETHER, "__rank")
    place = F.col("__rank") - F.col("first_rank")
    on = [ranked["length"] == plan["length"], ranked["__rank"] >= plan["first_rank"], ranked["__rank"] < plan["end_rank"]]
    return (ranked.join(F.broadcast(plan), on)  # the plan is bounded by the lengths and capacities, not by the data
            .select(*[ranked[quoted(c)] for c in pieces.columns],
                    (F.col("first_sequence") + F.floor(place / F.col("per_sequence"))).cast("long").alias("sequence_id"),
                    (F.col("base") + place % F.col("per_sequence") * ranked["length"]).cast("long").alias("offset")))


def pack_documents(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
                   size: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """Tokenise and pack: a row per piece with its place.

    A null or empty text is the end id alone. Repeated rows are packed as often
    as they occur. An empty table gives an empty result. Input columns named like
    a result column are replaced; the text column is left out."""
    pieces = shared_table(token_pieces(docs, tokenizer_path, text, size, with_ids), "token-pieces")
    return pack(pieces, [quoted(doc_id), "piece", "ids_crc32"], size)
