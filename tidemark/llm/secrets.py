"""Secret scan: fixed patterns, and two character Markov models compared by
log-likelihood ratio, one of random strings and one of ordinary identifiers.

The models are first-order chains over letters, digits and a few signs. They
are trained on labelled samples taken from the whole corpus: what the patterns
match is labelled random, all other long runs of these characters are labelled
ordinary. Transition counts are summed on the executors; at most 2 x 70 x 70
sums reach the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import flat, map_arrow, map_texts, quoted, slices, without
from tidemark.llm.infill import ExceptionIndex

#: The kinds in order, their patterns, the least length of what counts.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Characters of the chains; a run of at least ``RUN_LENGTH`` is a candidate.
ALPHABET = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
RUN_LENGTH = 16
SIGNS = 62  # the codes of +/_=- and above
EDGE = len(ALPHABET)  # before the first and after the last character
#: Least log-likelihood ratio (in nats) of a run taken for random, in all and per character.
LEAST_RATIO, LEAST_PER_CHARACTER = 20.0, 2.5

_CODE = np.full(256, -1, np.int64)
_CODE[list(ALPHABET)] = np.arange(len(ALPHABET))
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True

SPAN = T.StructType([T.StructField("kind", T.StringType(), False), T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)])
FOUND = T.StructType([T.StructField("spans", T.ArrayType(SPAN, False))])


def _runs(inside: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of at least ``least`` true bytes; a run ends with its text."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    edge[0] = edge[-1] = True
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    long = (end - start >= least) & inside[start] if len(inside) else np.zeros(len(start), bool)
    return start[long], end[long]


def base_spans(raw: bytes, hexes: Iterable[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kind number) in code points, by start and kind. ``hexes``:
    the runs of hexadecimal digits, in code points."""
    found: list[tuple[int, int, int]] = []
    lower = raw.lower()
    text: str | None = None
    if any(k in lower for k in KEYWORDS):
        text = raw.decode()
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if b"AKIA" in raw:
        text = raw.decode() if text is None else text
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(a, b, 2) for a, b in hexes]
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def scan(texts: pa.Array, remains: bool = False) -> Iterator[tuple[bytes, list[tuple[int, int, int]], list[tuple[int, int, np.ndarray]]]]:
    """For each text its bytes, its base spans, and the candidate runs that no
    base span touches: code points and character codes. With ``remains`` also
    what base spans leave of the other runs, of any length."""
    data, offsets = flat(texts)
    raw = data.tobytes()
    codes = _CODE[data]
    hex_at, hex_end = _runs(_HEX[data], offsets, HEX_LENGTH)
    run_at, run_end = _runs(codes >= 0, offsets, RUN_LENGTH)
    hex_rows, run_rows = np.searchsorted(hex_at, offsets), np.searchsorted(run_at, offsets)
    index = ExceptionIndex(data)
    begins, hex_points, run_points = index.to_points(offsets), index.to_points(hex_at), index.to_points(run_at)
    for r, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
        body = raw[a:b]
        own = slice(hex_rows[r], hex_rows[r + 1])
        starts = hex_points[own] - begins[r]
        base = base_spans(body, zip(starts.tolist(), (starts + hex_end[own] - hex_at[own]).tolist()))
        runs, near, ahead = [], [], 0
        own = slice(run_rows[r], run_rows[r + 1])
        for s, e, start in zip(run_at[own].tolist(), run_end[own].tolist(), (run_points[own] - begins[r]).tolist()):
            end = start + e - s  # the characters of a run are ASCII
            # both go by their starts: spans that reach into this run, and those that begin in it
            near = [x for x in near if x[1] > start]
            while ahead < len(base) and base[ahead][0] < end:
                if base[ahead][1] > start:
                    near.append(base[ahead][:2])
                ahead += 1
            if not near:
                runs.append((start, end, codes[s:e]))
            elif remains:
                at = start
                for x, y in [*near, (end, end)]:
                    if at < x:
                        runs.append((at, x, codes[s + at - start : s + x - start]))
                    at = max(at, y)
        yield body, base, runs


@dataclass(frozen=True)
class RandomnessModel:
    """``ratio[a][b]``: log-likelihood ratio, random against ordinary, of b after a."""

    ratio: tuple[tuple[float, ...], ...]

    @classmethod
    def fit(cls, counts: np.ndarray) -> RandomnessModel:
        """From transition counts [class, from, to] (0 ordinary, 1 random). Each row
        is smoothed towards the class's character frequencies, these towards equal
        ones. A random string may be over any alphabet, so the chain of random
        strings is an even mixture of the sample's and of equal chances."""
        chains = []
        for table in counts.astype(float):
            overall = (table.sum(0) + 1) / (table.sum() + len(table))
            smooth = table + 5 * overall
            chains.append(smooth / smooth.sum(1, keepdims=True))
        ordinary, sample = chains
        return cls(tuple(map(tuple, (np.log(sample / 2 + 0.5 / len(sample)) - np.log(ordinary)).tolist())))

    def table(self) -> np.ndarray:
        return np.array(self.ratio)


def _steps(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([[EDGE], codes]), np.concatenate([codes, [EDGE]])


def fit_randomness(docs: DataFrame, text: str = "text") -> RandomnessModel:
    """Train both chains on all of ``docs``. Without documents
    both give equal chances and nothing is found beyond the patterns."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, EDGE + 1, EDGE + 1), np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                for body, base, runs in scan(part.column(0)):
                    for _, _, codes in runs:
                        np.add.at(counts[0], _steps(codes), 1)
                    whole = body.decode() if base else ""
                    for start, end, kind in base:
                        value = whole[start:end]
                        if kind == 0:
                            value = ASSIGN.match(value)[2]
                        codes = _CODE[np.frombuffer(value.encode(), np.uint8)]
                        np.add.at(counts[1], _steps(codes[codes >= 0]), 1)
        kind, a, b = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (kind, a, b, counts[kind, a, b])], names=["kind", "a", "b", "n"])

    rows = map_arrow(docs.select(F.col(quoted(text)).cast("string")), count, "kind long, a long, b long, n long")
    counts = np.zeros((2, EDGE + 1, EDGE + 1), np.int64)
    for r in rows.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect():
        counts[r["kind"], r["a"], r["b"]] = r["n"]
    return RandomnessModel.fit(counts)


def maximal_segments(weights: list[float]) -> list[tuple[int, int]]:
    """Starts and ends of the segment of the largest sum, of the largest ones on
    both sides of it, and so on (Ruzzo and Tompa, one pass)."""
    found: list[tuple[int, int, float, float, int]] = []  # start, end, sums up to them, the next one before that begins at a lower sum
    total = 0.0
    for i, w in enumerate(weights):
        before, total = total, total + w
        if w <= 0:
            continue
        start, left, j = i, before, len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append((start, i + 1, left, total, j))
                break
            start, _, left, _, above = found[j]
            del found[j:]
            j = above
    return [(a, b) for a, b, *_ in found]


def random_parts(codes: np.ndarray, ratio: np.ndarray) -> list[tuple[int, int]]:
    """Random parts of a run: all of it, or else those between signs where
    the ratios exceed ``LEAST_PER_CHARACTER`` most, scored as runs of their own."""

    def taken(part: np.ndarray) -> bool:
        score = float(ratio[_steps(part)].sum())
        return score >= LEAST_RATIO and score >= LEAST_PER_CHARACTER * len(part)

    if taken(codes):
        return [(0, len(codes))]
    sign = codes >= SIGNS
    if not sign.any():
        return []
    weights = ratio[_steps(codes)][:-1] - LEAST_PER_CHARACTER
    at = np.flatnonzero(np.concatenate([[True], sign[1:] | sign[:-1]]))  # every sign is a piece
    sums = np.add.reduceat(weights, at)
    if not (sums > 0).any():
        return []
    ends, parts = [*at.tolist(), len(codes)], []
    for a, b in maximal_segments(sums.tolist()):
        start, end = ends[a], ends[b]
        while start < end and sign[start]:
            start += 1
        while start < end and sign[end - 1]:
            end -= 1
        if end - start >= RUN_LENGTH and taken(codes[start:end]):
            parts.append((start, end))
    return parts


def _finder(model: RandomnessModel):
    ratio = model.table()

    def find(texts: pa.Array) -> dict:
        out = []
        for _, base, runs in scan(texts, remains=True):
            spans = list(base)
            for start, _, codes in runs:
                spans += [(start + a, start + b, 3) for a, b in random_parts(codes, ratio)]
            out.append([{"kind": KINDS[k], "start": s, "end": e} for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1]))])
        return {"spans": out}

    return find


def secret_spans(docs: DataFrame, model: RandomnessModel, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``spans``, the secrets in it by start and kind
    (code points, end exclusive). A null or empty text has none. Spans of
    different kinds may overlap, those of the models overlap no other. An input
    column named ``spans`` is replaced."""
    return map_texts(docs, text, without(docs, FOUND.names), FOUND, lambda: _finder(model))


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: RandomnessModel, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each run of overlapping spans of the text replaced by ``mark``."""
    at = docs.columns.index(text)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    shown = T.StructType([T.StructField("shown", T.StringType())])

    def make():
        find = _finder(model)

        def run(texts: pa.Array) -> dict:
            return {"shown": [_without_spans(t, s, mark) for t, s in zip(texts.to_pylist(), find(texts)["spans"])]}

        return run

    out = map_texts(plain, f"c{at}", plain.columns, shown, make)
    return out.select(*[F.col("shown").alias(c) if i == at else F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def _without_spans(text: str | None, spans: list[dict], mark: str) -> str | None:
    if not spans:
        return text
    out, done = [], 0
    for span in spans:
        if span["start"] >= done:
            out += [text[done : span["start"]], mark]
        done = max(done, span["end"])
    return "".join([*out, text[done:]])


def brute_force(text: str | None) -> list[tuple[int, int, int]]:
    """The base spans by plain regular expressions (for tests)."""
    text = text or ""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[0], s[2]))
