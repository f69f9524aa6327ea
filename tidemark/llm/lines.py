"""Line dedup that can be taken back: sharded cuckoo filters over exact counts.

A line's key is the line without white space at both ends, A-Z lowered, as a
128-bit digest. The counts table says in how many documents a key is; inserting
documents adds to it and deleting them subtracts, so both are exact and undo
each other. Keys held by ``min_docs`` documents or more are in the cuckoo filter of
their shard (the first bits of the digest); a key enters its filter when its count
reaches the threshold and leaves when it falls below, which a Bloom filter could
not do. Shards are added as keys grow, so a filter has a bounded size.

A line whose key its filter doesn't hold stays, without asking the counts. What
the filter holds by mistake is found among the exact counts and excepted, so the
filters decide nothing wrongly.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_arrow, mix64, quoted, shared_table, slices, without

#: Keys of a shard's filter, at most, when shards are dealt out.
SHARD_KEYS = 1 << 18
#: Slots of a bucket, the share of slots that a new filter fills at most, moves before it counts as full.
SLOTS, LOAD, MOVES = 4, 0.7, 500
#: Keys that a task counts before it sends them.
HELD_KEYS = 200_000
#: Most bytes of filters, and of exceptions, that tasks are given whole; beyond, lines go to the shards.
BROADCAST_BYTES = 32 << 20
#: Parts that a shard's lines are dealt to.
SALTS = 16

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = b" \t\n\x0b\x0c\r"
COUNTS = "key binary, docs long"
FILTERS = "shard long, filter binary"


def line_keys(text: str | None) -> list[bytes]:
    """The key of each line, before it is digested."""
    return [line.strip(_SPACE) for line in (text or "").encode().translate(_LOWER).split(b"\n")]


def digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def _digests(text: str | None, min_chars: int) -> set[bytes]:
    return {digest(k) for k in set(line_keys(text)) if _long_enough(k, min_chars)}


def _words(digests: list[bytes]) -> np.ndarray:
    """Each digest as two 64-bit numbers."""
    return np.frombuffer(b"".join(digests), ">u8").astype(np.uint64).reshape(-1, 2)


def shard_of(words: np.ndarray, shards: int) -> np.ndarray:
    """The first bits of the digest; ``shards`` is a power of two."""
    return (words[:, 0] >> np.uint64(32)).astype(np.int64) // ((1 << 32) // shards)


def shard_column(key: Column, shards: int) -> Column:
    first = F.conv(F.substring(F.hex(key), 1, 8), 16, 10).cast("long")
    return F.floor(first / F.lit((1 << 32) // shards)).cast("long")


class Cuckoo:
    """A cuckoo filter: 16-bit marks in buckets of four slots; a key's mark is in one of two buckets."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def for_keys(cls, n: int) -> Cuckoo:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, n) / (SLOTS * LOAD)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def loaded(cls, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def _places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return places(words, np.uint64(len(self.table) - 1))

    def holds(self, words: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(words)
        return ((self.table[one] == mark[:, None]) | (self.table[two] == mark[:, None])).any(axis=1)

    def add(self, words: np.ndarray) -> bool:
        """False if there was no room; the filter is then to be built anew, larger."""
        mark, one, two = self._places(words)
        left = np.arange(len(mark))
        for at in (one, two):  # as many as fit into free slots, bucket by bucket
            left = left[np.argsort(at[left], kind="stable")]
            begins = np.flatnonzero(np.diff(at[left], prepend=-1))
            rank = np.arange(len(left)) - np.repeat(begins, np.diff(np.append(begins, len(left))))
            used = self.table[at[left]] != 0
            fits = rank < SLOTS - used.sum(axis=1)
            slot = np.argsort(used[fits], axis=1, kind="stable")[np.arange(fits.sum()), rank[fits]]
            self.table[at[left[fits]], slot] = mark[left[fits]]
            left = left[~fits]
        return all(self._push(int(mark[i]), int(two[i]), seed=int(i)) for i in left)

    def _push(self, mark: int, at: int, seed: int) -> bool:
        """Put ``mark`` into a full bucket; what it throws out moves to its other bucket."""
        for move in range(MOVES):
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = mark
                return True
            slot = (seed + move) % SLOTS
            mark, self.table[at, slot] = int(self.table[at, slot]), mark
            at ^= int(mix64(np.array([mark], np.uint64))[0]) & (len(self.table) - 1)
        return False

    def remove(self, words: np.ndarray) -> None:
        """Take out keys that were added."""
        for mark, one, two in zip(*self._places(words)):
            at = one if (self.table[one] == mark).any() else two
            self.table[at, np.flatnonzero(self.table[at] == mark)[0]] = 0


def places(words: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mark and the two buckets of each key; ``last`` is the number of the filter's last bucket."""
    mark = (words[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
    mark[mark == 0] = 1  # 0 is a free slot
    one = (words[:, 1] >> np.uint64(16)) & last
    two = one ^ (mix64(mark.astype(np.uint64)) & last)
    return mark, one.astype(np.int64), two.astype(np.int64)


@dataclass(frozen=True)
class LineIndex:
    """What is known of the lines of the inserted documents."""

    counts: DataFrame  # key, docs: in how many documents; every key that is in one
    filters: DataFrame  # shard, filter: the keys that are in min_docs or more
    shards: int
    min_docs: int


def empty_index(spark: SparkSession, min_docs: int = 10) -> LineIndex:
    return LineIndex(spark.createDataFrame([], COUNTS), spark.createDataFrame([], FILTERS), 1, min_docs)


def line_counts(docs: DataFrame, text: str = "text", min_chars: int = 1) -> DataFrame:
    """``key`` and ``docs``, the number of rows of ``docs`` with a line of that key; keys
    of fewer than ``min_chars`` code points are left out."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            for part in slices(batch, 0):
                for text in part.column(0).to_pylist():
                    for key in _digests(text, min_chars):
                        held[key] = held.get(key, 0) + 1
                if len(held) > HELD_KEYS:
                    yield _counted(held)
                    held = {}
        yield _counted(held)

    sent = docs.select(F.col(quoted(text)).cast("string").alias("text"))
    return map_arrow(sent, count, COUNTS).groupBy("key").agg(F.sum("docs").alias("docs"))


def _counted(held: dict[bytes, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["key", "docs"])


def insert(index: LineIndex, docs: DataFrame, text: str = "text", min_chars: int = 1) -> LineIndex:
    """The index with every row of ``docs`` added as one more document."""
    return _changed(index, line_counts(docs, text, min_chars), 1)


def delete(index: LineIndex, docs: DataFrame, text: str = "text", min_chars: int = 1) -> LineIndex:
    """The index without the rows of ``docs``, which must have been inserted; afterwards
    it is what it was before that."""
    return _changed(index, line_counts(docs, text, min_chars), -1)


def _changed(index: LineIndex, changes: DataFrame, sign: int) -> LineIndex:
    before = index.counts.select("key", F.col("docs").alias("before"), F.lit(0).cast("long").alias("more"))
    more = changes.select("key", F.lit(0).cast("long").alias("before"), (F.col("docs") * sign).alias("more"))
    merged = before.unionByName(more).groupBy("key").agg(F.sum("before").alias("before"), F.sum("more").alias("more"))
    merged = shared_table(merged.select("key", "before", (F.col("before") + F.col("more")).alias("docs")), "line-counts")
    least, n = merged.agg(F.min("docs"), F.count_if(F.col("docs") >= index.min_docs)).first()
    if least is not None and least < 0:
        raise ValueError("a document to delete was not inserted")
    counts = merged.where("docs > 0").select("key", "docs")
    frequent = counts.where(F.col("docs") >= index.min_docs).select("key")
    shards = index.shards
    while n > shards * SHARD_KEYS:
        shards *= 2
    if shards != index.shards:
        filters = build_filters(frequent, shards)
    else:
        crossed = merged.where((F.col("before") >= index.min_docs) != (F.col("docs") >= index.min_docs))
        filters = update_filters(index.filters, crossed.select("key", (F.col("docs") >= index.min_docs).alias("added")), frequent, shards)
    return LineIndex(counts, filters, shards, index.min_docs)


def _by_shard(rows: DataFrame, order: list[str], run, schema: str) -> DataFrame:
    return map_arrow(rows.repartition("shard").sortWithinPartitions("shard", *order), run, schema)


def _shard_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    rows = (row for batch in batches for row in batch.to_pylist())
    for shard, run in groupby(rows, key=lambda r: r["shard"]):
        yield shard, list(run)


def _filter_rows(rows: list[tuple[int, bytes | None]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows], pa.int64()), pa.array([f for _, f in rows], pa.binary())], names=["shard", "filter"])


def build_filters(keys: DataFrame, shards: int) -> DataFrame:
    """The filters of the distinct ``key``s, one a shard."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, run in _shard_runs(batches):
            words, room = _words([r["key"] for r in run]), len(run)
            made = Cuckoo.for_keys(room)
            while not made.add(words):
                room *= 2
                made = Cuckoo.for_keys(room)
            yield _filter_rows([(shard, made.table.tobytes())])

    return shared_table(_by_shard(keys.select(shard_column(F.col("key"), shards).alias("shard"), "key"), ["key"], build, FILTERS), "line-filters")


def update_filters(filters: DataFrame, changes: DataFrame, frequent: DataFrame, shards: int) -> DataFrame:
    """``filters`` with the ``key``s of ``changes`` put in (``added``) or taken out; a
    filter that has no room for them is built anew from the ``frequent`` keys."""

    def update(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, run in _shard_runs(batches):
            old = next((r["filter"] for r in run if r["filter"] is not None), None)
            gone, new = ([r["key"] for r in run if r["added"] is flag] for flag in (False, True))
            made = Cuckoo.for_keys(len(new)) if old is None else Cuckoo.loaded(old)
            if gone:
                made.remove(_words(gone))
            if not new or made.add(_words(new)):
                yield _filter_rows([(shard, made.table.tobytes())])
            else:
                yield _filter_rows([(shard, None)])

    rows = filters.select("shard", "filter", F.lit(None).cast("binary").alias("key"), F.lit(None).cast("boolean").alias("added")).unionByName(
        changes.select(shard_column(F.col("key"), shards).alias("shard"), F.lit(None).cast("binary").alias("filter"), "key", "added"))
    updated = shared_table(_by_shard(rows, ["key"], update, FILTERS), "line-filters")
    full = [r["shard"] for r in updated.where("filter IS NULL").select("shard").collect()]  # shards, a few numbers
    if not full:
        return updated
    anew = build_filters(frequent.where(shard_column(F.col("key"), shards).isin(full)), shards)
    return shared_table(updated.where("filter IS NOT NULL").unionByName(anew), "line-filters")


class Filters:
    """All shards' filters end to end, for lookups of many keys at once."""

    def __init__(self, rows: list[tuple[int, bytes]], shards: int):
        self.shards = shards
        self.first, self.last = np.zeros(shards, np.int64), np.zeros(shards, np.uint64)
        tables, at = [np.zeros((1, SLOTS), np.uint16)], 1  # bucket 0: of a shard without a filter
        for shard, data in rows:
            table = np.frombuffer(data, np.uint16).reshape(-1, SLOTS)
            self.first[shard], self.last[shard] = at, len(table) - 1
            tables.append(table)
            at += len(table)
        self.table = np.concatenate(tables)

    def holds(self, words: np.ndarray) -> np.ndarray:
        shard = shard_of(words, self.shards)
        mark, one, two = places(words, self.last[shard])
        first = self.first[shard]
        return ((self.table[first + one] == mark[:, None]) | (self.table[first + two] == mark[:, None])).any(axis=1)


KEPT = T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])


def drop_lines(docs: DataFrame, index: LineIndex, text: str = "text", min_chars: int = 1, known: bool = False,
               broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with each text without the lines whose keys are in ``min_docs`` inserted
    documents or more (other lines, joined by line feeds), ``n_lines`` (before) and ``n_dropped``.

    ``docs`` need not be inserted; ``known`` says that they are, which saves a pass over
    them. A null or empty text is one empty line, and stays empty. Every row is a
    document, repeated ids and texts alike. Keys of fewer than ``min_chars`` code points
    never go. Input columns named like a result column are replaced.

    Filters and exceptions are given to all tasks if they have at most
    ``broadcast_bytes``; else the lines are sent to the shards. The result is the same."""
    names = without(docs, KEPT.names)
    if text not in names:
        raise ValueError(f"the text column may not be named {text}")
    plain = docs.select(*[F.col(quoted(c)) for c in names]).toDF(*[f"c{i}" for i in range(len(names))])  # no name is taken
    return _dropped(plain, index, f"c{names.index(text)}", min_chars, known, broadcast_bytes).toDF(*names, *KEPT.names)


def _dropped(docs: DataFrame, index: LineIndex, text: str, min_chars: int, known: bool, broadcast_bytes: int) -> DataFrame:
    spark = docs.sparkSession
    size = index.filters.agg(F.coalesce(F.sum(F.octet_length("filter")), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        filters = Filters([(r["shard"], bytes(r["filter"])) for r in index.filters.collect()], index.shards)  # of checked size
        shared = spark.sparkContext.broadcast(filters)
        keys = index.counts.where(F.col("docs") < index.min_docs).select("key") if known else \
            line_counts(docs, text, min_chars).select("key").join(index.counts.where(F.col("docs") >= index.min_docs), "key", "left_anti")

        def mistaken(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = shared.value.holds(_words(batch.column(0).to_pylist())) if batch.num_rows else np.zeros(0, bool)
                yield batch.filter(pa.array(found))

        wrong = shared_table(map_arrow(keys, mistaken, "key binary"), "line-exceptions")
        if wrong.count() * 16 <= broadcast_bytes:
            exceptions = spark.sparkContext.broadcast(frozenset(bytes(r["key"]) for r in wrong.collect()))  # of checked size
            return _kept(docs, text, min_chars, lambda: (shared.value, exceptions.value))
    return _drop_by_shard(docs, index, text, min_chars)


def _kept(docs: DataFrame, text: str, min_chars: int, known) -> DataFrame:
    """``docs`` without lines that ``known``'s filters hold, but for its exceptions; or, where
    it is None, without the digests of the column ``dropped``."""
    names = [c for c in docs.columns if c != "dropped"]
    at = names.index(text)
    schema = T.StructType([*(T.StructField(c, T.StringType()) if c == text else docs.schema[c] for c in names), *KEPT.fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, exceptions = known() if known else (None, None)
        for batch in batches:
            for part in slices(batch, at):
                texts = part.column(at).to_pylist()
                keys = [line_keys(t) for t in texts]
                digests = [[digest(k) if _long_enough(k, min_chars) else None for k in own] for own in keys]
                asked = [d for own in digests for d in own if d]
                if filters is not None:
                    held = filters.holds(_words(asked)) if asked else []
                    gone = {d for d, h in zip(asked, held) if h} - exceptions
                    sets = [gone] * len(texts)
                else:
                    sets = [set(map(bytes, s or ())) for s in part.column(len(names)).to_pylist()]
                out, dropped = [], []
                for t, own, gone in zip(texts, digests, sets):
                    lines = (t or "").split("\n")
                    left = [line for line, d in zip(lines, own) if d not in gone]
                    out.append("\n".join(left))
                    dropped.append(len(lines) - len(left))
                columns = [pa.array(out, pa.string()) if i == at else part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([len(o) for o in digests], pa.int64()), pa.array(dropped, pa.int64())], names=schema.names)

    sent = docs.select(*[F.col(c).cast("string").alias(c) if c == text else F.col(c) for c in names], *([] if known else ["dropped"]))
    return map_arrow(sent, run, schema)


def _drop_by_shard(docs: DataFrame, index: LineIndex, text: str, min_chars: int) -> DataFrame:
    """The way beyond what tasks can be given: every distinct (document, key) goes to its
    shard, in ``SALTS`` parts so that a frequent line is spread, and passes by the
    filter there; what passes is looked up in the counts."""
    stored = shared_table(docs.withColumn("row", F.monotonically_increasing_id()), "line-docs")  # numbers stay if a task runs again
    shards = index.shards

    def occurrences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                rows, keys = [], []
                for row, own in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = _digests(own, min_chars)
                    rows += [row] * len(found)
                    keys += found
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(keys, pa.binary())], names=["row", "key"])

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, current = None, None  # the filter of a shard comes before its lines, in each part
        for batch in batches:
            numbers = batch.column(0).to_numpy() * SALTS + batch.column(1).to_numpy()
            for begin, end in _runs(numbers):
                part = batch.slice(begin, end - begin)
                if numbers[begin] != group:
                    group, current = numbers[begin], None
                first = part.column(2)[0].as_py()
                if first is not None:
                    current, part = Cuckoo.loaded(first), part.slice(1)
                if current is not None and part.num_rows:
                    held = current.holds(_words(part.column(4).to_pylist()))
                    yield pa.RecordBatch.from_arrays([part.column(3).filter(pa.array(held)), part.column(4).filter(pa.array(held))], names=["row", "key"])

    salt = F.pmod(F.xxhash64("row"), F.lit(SALTS))
    sent = stored.select("row", F.col(text).cast("string").alias("text"))
    lines = map_arrow(sent, occurrences, "row long, key binary")
    every_salt = F.explode(F.array(*[F.lit(s).cast("long") for s in range(SALTS)])).alias("salt")
    rows = index.filters.select("shard", every_salt, "filter", F.lit(None).cast("long").alias("row"), F.lit(None).cast("binary").alias("key"))
    rows = rows.unionByName(lines.select(shard_column(F.col("key"), shards).alias("shard"), salt.alias("salt"), F.lit(None).cast("binary").alias("filter"), "row", "key"))
    grouped = rows.repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("row").asc_nulls_first()).select("shard", "salt", "filter", "row", "key")
    maybe = map_arrow(grouped, probe, "row long, key binary")
    frequent = index.counts.where(F.col("docs") >= index.min_docs).select("key", every_salt)
    sure = maybe.withColumn("salt", salt).join(frequent, ["key", "salt"], "left_semi")
    per_row = sure.groupBy("row").agg(F.collect_list("key").alias("dropped"))  # at most a document's lines
    return _kept(stored.join(per_row, "row", "left").select(*docs.columns, "dropped"), text, min_chars, None)


def _runs(numbers: np.ndarray) -> Iterator[tuple[int, int]]:
    ends = np.append(np.flatnonzero(np.diff(numbers)) + 1, len(numbers))
    begin = 0
    for end in ends.tolist():
        if end > begin:
            yield begin, end
        begin = end


def dedup_lines(docs: DataFrame, min_docs: int = 10, text: str = "text", min_chars: int = 1) -> DataFrame:
    """``docs`` without the lines that ``min_docs`` of them or more have."""
    index = insert(empty_index(docs.sparkSession, min_docs), docs, text, min_chars)
    return drop_lines(docs, index, text, min_chars, known=True)


def brute_force(texts: list[str | None], min_docs: int, inserted: list[str | None] | None = None) -> list[tuple[int, int, str]]:
    """Lines, lines dropped and text kept, from counts in memory (for tests)."""
    import re
    from collections import Counter

    def key(line: str) -> str:
        line = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    seen = Counter(k for t in (texts if inserted is None else inserted) for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        left = [x for x in lines if not key(x) or seen[key(x)] < min_docs]
        out.append((len(lines), len(lines) - len(left), "\n".join(left)))
    return out
