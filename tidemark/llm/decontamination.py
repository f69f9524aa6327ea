"""Benchmark decontamination: one Aho-Corasick automaton over the word windows
of all benchmark items, run once over each document's normalised text.

Normalised text is the words (letters, digits and all non-ASCII, A-Z lowered)
joined by single spaces; positions found in it are mapped to words and from
there to bytes and characters of the original. The automaton is built in each
task from the windows of a block of items (long ones in overlapping pieces); a
block holds at most ``max_block_bytes`` of item text, so what the driver fetches
and broadcasts has a fixed bound. Where the items need more blocks, they are
fetched one by one and the documents pass them one after another.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ALNUM, map_arrow, map_texts, quoted, shared_table, without, word_spans

WINDOW = 10
#: Text of items whose windows one automaton holds: up to some 400 MB of it in a worker.
MAX_BLOCK_BYTES = 1 << 20
#: Words of a piece of a long item.
PIECE_WORDS = 20_000
#: Bytes to the normalised text: A-Z lowered, what is in no word to a space.
NORMAL = bytes((b + 32 if 65 <= b <= 90 else b) if ALNUM[b] else 32 for b in range(256))

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_words", T.ArrayType(T.LongType(), False)),
    T.StructField("hit_starts", T.ArrayType(T.LongType(), False)),
    T.StructField("hit_ends", T.ArrayType(T.LongType(), False)),
    T.StructField("items", T.ArrayType(T.StringType(), False)),
])


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def item_windows(items: Iterable[tuple[str, str | None]], n: int) -> dict[str, tuple[int, list[str]]]:
    """Window text (a space on both sides) to its number of words and the items
    that hold it. Bytes are kept one to a character."""
    found: dict[str, tuple[int, list[str]]] = {}
    for item, text in items:
        words = normal_words((text or "").encode())
        for i in range(max(1, len(words) - n + 1) if words else 0):
            window = words[i : i + n]
            held = found.setdefault(b" ".join([b"", *window, b""]).decode("latin-1"), (len(window), []))[1]
            if not held or held[-1] != item:
                held.append(item)
    return found


def _scanner(items: list[tuple[str, str | None]], n: int):
    found = item_windows(items, n)
    automaton = ahocorasick.Automaton()
    for window, value in found.items():
        automaton.add_word(window, value)
    if found:
        automaton.make_automaton()

    def scan(texts: pa.Array) -> dict:
        out: dict[str, list] = {name: [] for name in HITS.names}
        for raw in texts.cast(pa.large_binary()).fill_null(b"").to_pylist():
            words = raw.translate(NORMAL).split()
            hits: list[tuple[int, tuple[int, list[str]]]] = []
            if found and words:
                line = b" ".join([b"", *words, b""])
                hits = list(automaton.iter(line.decode("latin-1")))
            hit_words, items_here, at = [], set(), []
            if hits:
                spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
                after = np.searchsorted(spaces, [end for end, _ in hits]).tolist()  # the word after the window
                hit_words = _covered([(end - size, end) for end, (_, (size, _)) in zip(after, hits)])
                for _, (_, held) in hits:
                    items_here.update(held)
                data = np.frombuffer(raw, np.uint8)
                starts, ends, _ = word_spans(data, np.array([0, len(data)]), ALNUM)
                at = _code_points(raw, [int(p) for w in hit_words for p in (starts[w], ends[w])])
            for name, value in zip(HITS.names, (len(words), hit_words, at[0::2], at[1::2], sorted(items_here))):
                out[name].append(value)
        return out

    return scan


def _covered(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(spans):
        out.extend(range(max(a, out[-1] + 1 if out else 0), b))
    return out


def _code_points(raw: bytes, places: list[int]) -> list[int]:
    """Rising byte places as code points."""
    out, point, before = [], 0, 0
    for p in places:
        point += len(raw[before:p].decode())
        before = p
        out.append(point)
    return out


def item_pieces(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """``item``, ``words``: the distinct items as normalised text, long ones in pieces of
    ``PIECE_WORDS`` words that overlap by ``window`` - 1, so that no window is lost."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, texts = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = normal_words(text.encode())
                for begin in range(0, max(1, len(words) - window + 1), PIECE_WORDS) if words else ():
                    items.append(item)
                    texts.append(b" ".join(words[begin : begin + PIECE_WORDS + window - 1]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(texts, pa.string())], names=["item", "words"])

    rows = benchmark.select(F.col(quoted(item_id)).cast("string").alias("item"), F.col(quoted(text)).cast("string").alias("text"))
    return map_arrow(rows.where("item IS NOT NULL AND text IS NOT NULL").distinct(), run, "item string, words string")


def item_blocks(benchmark: DataFrame, item_id: str, text: str, window: int, max_block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The items' pieces in blocks of at most ``max_block_bytes`` (one part of the hash
    range at least), each fetched when it is asked for. One empty block if there are none."""
    pieces = shared_table(item_pieces(benchmark, item_id, text, window), "benchmark-pieces")
    size = F.octet_length("words") + F.octet_length("item")
    total = pieces.agg(F.sum(size)).first()[0] or 0
    parts = 1 if total <= max_block_bytes else -(-total * 64 // max_block_bytes)
    part = F.pmod(F.xxhash64("item", "words"), F.lit(parts))
    held = {r["part"]: r["bytes"] for r in pieces.groupBy(part.alias("part")).agg(F.sum(size).alias("bytes")).collect()}  # 64 numbers a block
    begin = 0
    while begin < parts:
        end, size = begin + 1, held.get(begin, 0)
        while end < parts and size + held.get(end, 0) <= max_block_bytes:
            size += held.get(end, 0)
            end += 1
        yield [(r["item"], r["words"]) for r in pieces.where(part.between(begin, end - 1)).collect()]
        begin = end


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", window: int = WINDOW, max_block_bytes: int = MAX_BLOCK_BYTES) -> DataFrame:
    """Every row of ``docs`` with what the benchmark shares with it: ``n_words``,
    ``hit_words`` (word numbers from 0), ``hit_starts``/``hit_ends`` (code points
    of each hit word in the original text) and ``items`` (sorted as strings).

    A window is ``window`` consecutive words of an item; an item of fewer words
    is one window, one of none has none. Null texts and items have no words;
    items without an id are left out, repeated items count once. Windows shared
    by items name them all. An empty benchmark hits nothing. Input columns named
    like a result column are replaced."""
    keep = without(docs, HITS.names)
    if text not in keep:
        raise ValueError(f"the text column may not be named {text}")
    names = [f"c{i}" for i in range(len(keep))]
    out = docs.select(*[F.col(quoted(c)) for c in keep]).toDF(*names)
    for b, block in enumerate(item_blocks(benchmark, item_id, item_text, window, max_block_bytes)):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        now = F.struct(*HITS.names)
        if b:  # the blocks before have left their hits
            out = shared_table(out, f"hits-{b}")
            now = F.struct(F.col("n_words"), *[F.array_sort(F.array_union(f"hits.{c}", c)).alias(c) for c in HITS.names[1:]])
        found = map_texts(out, names[keep.index(text)], [*names, "hits"] if b else names, HITS, lambda shared=shared: _scanner(shared.value, window))
        out = found.select(*names, now.alias("hits"))
    return out.select(*names, "hits.*").toDF(*keep, *HITS.names)


def items_digest(items):
    """SHA-256 of the items, comma-joined."""
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that hold no benchmark window, unchanged."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    hits = benchmark_hits(plain, benchmark, f"c{docs.columns.index(text)}", **options)
    return hits.where(F.size("hit_words") == 0).select(*plain.columns).toDF(*docs.columns)


def brute_force(text: str | None, items: list[tuple[str, str | None]], n: int = WINDOW) -> tuple[int, set[int], set[str]]:
    """Word count, hit words and items by comparing every window (for tests)."""
    words, hit, held = normal_words((text or "").encode()), set(), set()
    for item, body in items:
        theirs = normal_words((body or "").encode())
        size = min(n, len(theirs))
        wanted = {tuple(theirs[i : i + size]) for i in range(len(theirs) - size + 1)} if theirs else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in wanted:
                hit.update(range(i, i + size))
                held.add(item)
    return len(words), hit, held

