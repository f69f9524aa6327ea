"""Fill-in-the-middle: a text is cut into prefix, middle and suffix, and put out in
an order in which the middle comes last.

Texts are worked on as UTF-8 bytes. A sparse index records only the characters of
several bytes, by where they begin and how many bytes they have added so far; a
place in bytes becomes one in code points, and the other way round, by one binary
search in it. Between two such characters, and in plain ASCII altogether, places
differ by a constant. The index holds all texts of a run of rows, so one search
converts the cuts of all of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import flat, map_arrow, quoted, slices, without

#: Marks before the three parts. A text that holds one of them is left as it is.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Bytes beyond the first of a character, by its first byte.
_EXCESS = np.zeros(256, np.uint8)
_EXCESS[0xC0:0xE0], _EXCESS[0xE0:0xF0], _EXCESS[0xF0:0xF8] = 1, 2, 3


class ExceptionIndex:
    """Where the characters of several bytes begin in UTF-8 ``data``, and by how many
    bytes the characters before each have exceeded one byte a character."""

    def __init__(self, data: np.ndarray):
        self.begin = np.flatnonzero(data >= 0xC0)
        self.excess = np.concatenate([[0], np.cumsum(_EXCESS[data[self.begin]], dtype=np.int64)])

    def to_points(self, places: np.ndarray) -> np.ndarray:
        """Code points before each place, a byte number at a character's start (or the end)."""
        return places - self.excess[np.searchsorted(self.begin, places)]

    def to_bytes(self, points: np.ndarray) -> np.ndarray:
        """Bytes before each code point."""
        return points + self.excess[np.searchsorted(self.begin - self.excess[:-1], points)]


class Lines:
    """Units that end after a line feed (the last one may lack it)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, index: ExceptionIndex):
        self.feeds = np.flatnonzero(data == 10)
        self.start, self.end = offsets[:-1], offsets[1:]
        self.first = np.searchsorted(self.feeds, self.start)
        self.ended = np.searchsorted(self.feeds, self.end) - self.first  # lines that a line feed ends
        closed = self.end > self.start
        closed[closed] = data[self.end[closed] - 1] == 10
        self.n = self.ended + ((self.end > self.start) & ~closed)

    def cut(self, units: np.ndarray) -> np.ndarray:
        """The byte after so many units of each text."""
        at = np.where(units == 0, self.start, self.end)
        inner = (units > 0) & (units <= self.ended)
        at[inner] = self.feeds[(self.first + units - 1)[inner]] + 1
        return at


class Characters:
    """Code points as units."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, index: ExceptionIndex):
        self.index, points = index, index.to_points(offsets)
        self.start, self.n = points[:-1], np.diff(points)

    def cut(self, units: np.ndarray) -> np.ndarray:
        return self.index.to_bytes(self.start + units)


UNITS = {"line": Lines, "character": Characters}
RESULTS = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()), T.StructField("prefix_bytes", T.LongType()), T.StructField("middle_bytes", T.LongType()),
    T.StructField("output", T.StringType())])


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 for a document: the first 8-digit groups of the hex
    SHA-256 of ``seed:doc_id`` (a null id is the empty string)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", unit: str = "line", seed: int = 7,
                   percent: int = 100, suffix_first_percent: int = 50) -> DataFrame:
    """Every row of ``docs`` (without the text) with ``n`` (units of the text: lines or
    characters), ``form``, the lengths of prefix and middle in code points and in bytes
    (null if plain), and ``output``.

    Two draws by the document's id choose the cuts among the n + 1 places between
    units, a third whether the text is cut at all (``percent``), a fourth the form:
    ``psm`` (prefix, suffix, middle) or, in ``suffix_first_percent`` of all cases, ``spm``.
    A text stays ``plain`` if it is empty or null (then the output is empty) or holds a
    mark. Rows are treated one by one, repeated rows alike; a null id draws as an empty
    one. Input columns named like a result column are replaced."""
    taken = {n.lower() for n in (*RESULTS.names, text)}
    keep = [c for c in without(docs, RESULTS.names) if c.lower() not in taken]
    schema = T.StructType([docs.schema[c] for c in keep] + list(RESULTS.fields))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(keep)
        for batch in batches:
            for part in slices(batch, k):
                data, offsets = flat(part.column(k))
                h = [np.array(part.column(k + 1 + i), np.int64) for i in range(4)]
                columns = _forms(data, offsets, h)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(k)), *columns], names=schema.names)

    def _forms(data: np.ndarray, offsets: np.ndarray, h: list[np.ndarray]) -> list[pa.Array]:
        index = ExceptionIndex(data)
        units = UNITS[unit](data, offsets, index)
        one, two = h[0] % (units.n + 1), h[1] % (units.n + 1)
        p, m = units.cut(np.minimum(one, two)), units.cut(np.maximum(one, two))
        start, cut_points = offsets[:-1], index.to_points(np.concatenate([offsets[:-1], p, m])).reshape(3, -1)
        form, output = [], []
        for i, (a, b, c, d) in enumerate(zip(start, p, m, offsets[1:])):
            raw = data[a:d].tobytes()
            if not raw or h[2][i] % 100 >= percent or any(mark.encode() in raw for mark in MARKS):
                form.append("plain")
                output.append(raw)
                continue
            form.append("spm" if h[3][i] % 100 < suffix_first_percent else "psm")
            parts = {PREFIX: raw[: b - a], MIDDLE: raw[b - a : c - a], SUFFIX: raw[c - a :]}
            order = (SUFFIX, PREFIX, MIDDLE) if form[-1] == "spm" else (PREFIX, SUFFIX, MIDDLE)
            output.append(b"".join(mark.encode() + parts[mark] for mark in order))
        plain = np.array([f == "plain" for f in form], bool)
        lengths = (cut_points[1] - cut_points[0], cut_points[2] - cut_points[1], p - start, m - p)
        return [pa.array(units.n, pa.int64()), pa.array(form, pa.string()), *(pa.array(x, pa.int64(), mask=plain) for x in lengths),
                pa.array(output, pa.binary()).cast(pa.string())]

    sent = docs.select(*[F.col(quoted(c)) for c in keep], F.col(quoted(text)).cast("string").alias("__text"),
                       *[h.alias(f"__h{i}") for i, h in enumerate(draws(F.col(quoted(doc_id)), seed))])
    return map_arrow(sent, run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of."""
    part = F.split(output, "<[PSM]>", -1)
    first, second, middle = (F.get(part, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)


def brute_force(doc_id, text: str | None, seed: int = 7) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, lengths and output of one text cut by lines, on code points (for tests)."""
    import hashlib
    import re

    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    low, high = sorted(x % (len(lines) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(lines[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= 100:
        return len(lines), "plain", None, None, text
    if h[3] % 100 < 50:
        return len(lines), "spm", len(prefix), len(middle), SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return len(lines), "psm", len(prefix), len(middle), PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
