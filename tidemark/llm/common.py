"""Helpers shared by the operators: intermediate tables and Arrow batch access."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

#: Bytes of text that a task works on at a time.
SLICE_BYTES = 500_000
#: What a Python worker keeps from task to task, by name; a task drops all but what it names itself.
KEPT: dict[str, dict] = {}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package's code, once per application, as an
    installed library would (Spark serves the archive from the driver)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def map_arrow(df: DataFrame, run: Callable, schema: T.StructType | str, keeps: str | None = None) -> DataFrame:
    """``df.mapInArrow`` with this package importable on the executors. Workers serve many
    tasks of many operators: a task starts without what others kept (but ``keeps``) and
    gives its memory back when it ends."""
    ship(df.sparkSession)
    return df.mapInArrow(_tidied(run, keeps), schema)


def _tidied(run: Callable, keeps: str | None) -> Callable:
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in KEPT.keys() - {keeps}:
            del KEPT[name]
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def give_back() -> None:
    """Return freed memory to the system, and shorten the tables of hash powers."""
    SpanHash.shorten()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps its own counsel
        pass


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark removes the shuffle files of a DataFrame's action when it ends, not when the driver's garbage is collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_table(df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back: lineage ends
    there, and a lost executor does not cause a recomputation. ``drop_shuffles``: what
    was shuffled for it, which nothing reads again, leaves the disks at once."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, None)
    if drop_shuffles:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if drop_shuffles:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of ``df`` that do not clash (ignoring case) with ``names``: a
    result column replaces an input column of the same name."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ascii_lower(col):
    """Lower-case A-Z only (``lower`` folds all of Unicode)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the n+1 offsets; null is empty."""
    arr = texts.cast(pa.large_binary()).fill_null(b"")
    _, offs, data = arr.buffers()
    offsets = np.frombuffer(offs, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    if data is None or not len(arr):
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of text (one row at
    least), so that memory follows the longest text, not the batch."""
    if not batch.num_rows:
        return
    _, offsets = flat(batch.column(text))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def map_texts(docs: DataFrame, text: str, keep: list[str], results: T.StructType,
              make: Callable[[], Callable[[pa.Array], dict]]) -> DataFrame:
    """``docs[keep]`` with the columns that ``make()(texts)`` returns for each
    run of rows. ``make`` runs once per task; no row leaves its partition."""
    schema = T.StructType([docs.schema[c] for c in keep] + list(results.fields))
    names, arrow = [f.name for f in results.fields], _arrow_types(results)
    sent = keep if text in keep else [*keep, text]
    at = sent.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in slices(batch, at):
                got = fn(part.column(at))
                cols = [part.column(i) for i in range(len(keep))]
                cols += [got[n] if isinstance(got[n], pa.Array) else pa.array(got[n], t) for n, t in zip(names, arrow)]
                yield pa.RecordBatch.from_arrays(cols, names=keep + names)

    return map_arrow(docs.select(*[F.col(quoted(c)) for c in sent]), run, schema)


def _arrow_types(schema: T.StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in schema.fields]


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    out = np.zeros(len(offsets) - 1, np.int64)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, offsets[:-1][full], dtype=np.int64)
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class SpanHash:
    """64-bit polynomial hashes of byte spans of one buffer, from prefix sums.

    Equal spans hash equally in every process. ``fold`` lower-cases A-Z."""

    _R = 0x9E3779B97F4A7C15 | 1
    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray, fold: bool = False):
        table = np.arange(256, dtype=np.uint64)
        if fold:
            table[65:91] = table[97:123]
        table = mix64((table + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
        self._grow(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * self._powers[: len(data)], out=self.prefix[1:])

    @classmethod
    def shorten(cls) -> None:
        if len(cls._powers) > 1 << 20:
            cls._powers, cls._inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    @classmethod
    def _grow(cls, n: int) -> None:
        if len(cls._powers) < n:
            size = 1 << (n - 1).bit_length()
            inverse = pow(cls._R, -1, 1 << 64)
            cls._powers = np.multiply.accumulate(np.append(np.uint64(1), np.full(size - 1, cls._R, np.uint64)))
            cls._inverse = np.multiply.accumulate(np.append(np.uint64(1), np.full(size - 1, inverse, np.uint64)))

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.prefix[end] - self.prefix[start]) * self._inverse[start] + (end - start).astype(np.uint64))


#: Byte classes of the two word patterns: `[^\x20\x09-\x0D]+` and `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing A-Z).
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the n+1 word offsets of the rows."""
    inside = kind[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    first = offsets[:-1][offsets[1:] > offsets[:-1]]  # a word never crosses rows
    start[first] = inside[first]
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    end[last] = inside[last]
    at = np.flatnonzero(start)
    return at, np.flatnonzero(end) + 1, np.searchsorted(at, offsets)


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` consecutive word hashes (len - n + 1 of them)."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for j in range(n):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += words[j : j + len(out)]
    return mix64(out)
