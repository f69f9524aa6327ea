"""Quality rules: per-text counts, and a linear-chain CRF that labels each line
content or boilerplate; the share of words in content lines decides retention.

The CRF has binary line features and a transition weight for each pair of
labels. It is trained by maximum likelihood on a bounded sample of labelled
documents: stretches of their lines, which carry the document's label, are joined
in pairs of a good and a bad one, so that it learns where labels change. Viterbi's
algorithm decodes.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import NOT_SPACE, SpanHash, flat, map_texts, mix64, per_row, quoted, windows, without, word_spans

REPEAT_WINDOW = 8
MIN_WORDS = 20
#: Labelled documents of each class that the CRF is trained on, at most.
SAMPLE_PER_CLASS = 1000
#: Stretches of a sample document, at most, and their lines: evenly spread over longer documents.
STRETCHES, STRETCH_LINES = 4, 50
#: Least share of words in content lines of a document that is kept.
CONTENT_SHARE = 0.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _LETTER, _DIGIT, _BANG = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = True
_DIGIT[48:58] = True
_BANG[list(b"!?")] = True
_NOT_FIRST = np.arange(256) & 0xC0 == 0x80  # UTF-8 bytes after a character's first

FEATURES = [
    "always", "blank", "words_1_2", "words_3_5", "words_over_20", "symbols_5", "symbols_30", "upper_30", "upper_70", "digits_10", "digits_30",
    "bangs_30", "repeated_30", "repeated_70", "stutter_20", "duplicate", "sentence_end", "long_words", "short_words",
]

COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])
STRETCH_LISTS = T.StructType([T.StructField("stretches", T.ArrayType(T.ArrayType(T.LongType(), False), False))])
VERDICT = T.StructType(COUNTS.fields + [T.StructField("base_failed", T.BooleanType()), T.StructField("content_share", T.DoubleType()), T.StructField("kept", T.BooleanType())])


def _repeats(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether its row has it again, and whether an earlier place has it."""
    again, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    order = np.argsort(keys ^ mix64(rows.astype(np.uint64) + np.uint64(1)), kind="stable")
    same = (keys[order][1:] == keys[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    later[order[1:][same]] = True
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return again, later


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts for each text, and features for each line of all texts.

    Equal windows and lines are recognised by 64-bit hashes."""
    data, offsets = flat(texts)
    starts, ends, rows = word_spans(data, offsets, NOT_SPACE)
    n_words = np.diff(rows)
    row_of_word = np.repeat(np.arange(len(n_words)), n_words)
    hashes = SpanHash(data)
    words = hashes.spans(starts, ends)

    # words in repeated windows: +1 where a repeated window begins, -1 behind it
    window = windows(words, REPEAT_WINDOW)
    inside = np.flatnonzero(row_of_word[: len(window)] == row_of_word[REPEAT_WINDOW - 1 :]) if len(window) else np.zeros(0, np.int64)
    again, _ = _repeats(window[inside], row_of_word[inside])
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, inside[again], 1)
    np.add.at(change, inside[again] + REPEAT_WINDOW, -1)
    repeated = np.cumsum(change)[:-1] > 0

    # lines: a line ends at a line feed or at the end of its text
    feeds = np.flatnonzero(data == 10)
    feed_rows = np.searchsorted(offsets, feeds, side="right") - 1
    lines = np.bincount(feed_rows, minlength=len(n_words)) + 1
    row_of_line = np.repeat(np.arange(len(n_words)), lines)
    last = np.cumsum(lines) - 1
    line_start = _line_starts(offsets, feeds, lines)
    line_end = np.append(line_start[1:] - 1, 0)
    line_end[last] = offsets[1:]
    first_word = np.searchsorted(starts, line_start)
    line_words = np.searchsorted(starts, line_end) - first_word
    has_word = line_words > 0
    _, later = _repeats(hashes.spans(line_start, line_end)[has_word], row_of_line[has_word])
    duplicate = np.zeros(len(line_start), bool)
    duplicate[has_word] = later

    def line_sum(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[line_end] - total[line_start]

    def word_sum(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[first_word + line_words] - total[first_word]

    stutter = np.zeros(len(words), bool)
    stutter[1:] = words[1:] == words[:-1]
    characters = ~_NOT_FIRST[data] & NOT_SPACE[data]
    chars, symbols, letters = line_sum(characters), line_sum(_SYMBOL[data]), line_sum(_LETTER[data])
    upper, digits, bangs = line_sum(_UPPER[data]), line_sum(_DIGIT[data]), line_sum(_BANG[data])
    closes = np.zeros(len(line_start), bool)
    closes[has_word] = np.isin(data[ends[(first_word + line_words)[has_word] - 1] - 1], list(b".!?:;\"'"))
    n = np.maximum(line_words, 1)
    tests = [
        np.ones(len(n), bool), ~has_word, has_word & (line_words <= 2), (line_words >= 3) & (line_words <= 5), line_words > 20,
        symbols * 20 > chars, symbols * 10 > chars * 3, upper * 10 > letters * 3, upper * 10 > letters * 7, digits * 10 > chars, digits * 10 > chars * 3,
        bangs * 10 > n * 3, word_sum(repeated) * 10 > n * 3, word_sum(repeated) * 10 > n * 7, word_sum(stutter) * 5 > n, duplicate, closes,
        chars > n * 12, has_word & (chars < n * 3),
    ]
    bits = np.zeros(len(n), np.int64)
    for i, test in enumerate(tests):
        bits |= test.astype(np.int64) << i
    return {
        "n_words": n_words, "word_chars": per_row(characters, offsets), "n_symbols": per_row(_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(row_of_line[duplicate], minlength=len(n_words)).astype(np.int64),
        "n_repeat_words": per_row(repeated, rows), "lines": np.concatenate([[0], np.cumsum(lines)]), "line_bits": bits, "line_words": line_words,
    }


def _line_starts(offsets: np.ndarray, feeds: np.ndarray, lines: np.ndarray) -> np.ndarray:
    first = np.concatenate([[0], np.cumsum(lines)[:-1]])
    out = np.zeros(int(lines.sum()), np.int64)
    is_first = np.zeros(len(out), bool)
    is_first[first] = True
    out[first] = offsets[:-1]
    out[~is_first] = feeds + 1
    return out


@dataclass(frozen=True)
class LineModel:
    """A linear-chain CRF of two labels, 0 content and 1 boilerplate.

    ``weights``: of each feature, for label 1 against 0. ``moves[a][b]``: of b
    after a."""

    weights: tuple[float, ...]
    moves: tuple[tuple[float, float], tuple[float, float]]

    def scores(self, bits: np.ndarray) -> np.ndarray:
        on = (bits[:, None] >> np.arange(len(self.weights))) & 1
        return on @ np.array(self.weights)

    def viterbi(self, scores: list[float]) -> list[int]:
        """The best labels of a line sequence; of equal ones, content."""
        (a00, a01), (a10, a11) = self.moves
        content = boilerplate = 0.0
        back: list[tuple[int, int]] = []
        for i, s in enumerate(scores):
            if i:
                to0, to1 = content + a00 < boilerplate + a10, content + a01 < boilerplate + a11
                back.append((to0, to1))
                content, boilerplate = (boilerplate + a10 if to0 else content + a00), (boilerplate + a11 if to1 else content + a01)
            boilerplate += s
        labels = [int(boilerplate > content)] if scores else []
        for step in reversed(back):
            labels.append(int(step[labels[-1]]))
        return labels[::-1]


#: Used where the sample lacks a class: every line is content.
ALL_CONTENT = LineModel((-1.0,) + (0.0,) * (len(FEATURES) - 1), ((0.0, 0.0), (0.0, 0.0)))


class Chains:
    """Labelled line sequences side by side, the longest first, for training.

    ``sequences``: the feature bits of a sequence's lines and their labels. Each
    sequence counts the same, whatever its length."""

    def __init__(self, sequences: list[tuple[list[int], list[int]]]):
        sequences = sorted((s for s in sequences if s[0]), key=lambda s: (-len(s[0]), s))
        self.lengths = np.array([len(bits) for bits, _ in sequences])
        self.share = 1 / len(sequences) / self.lengths
        steps = int(self.lengths[0])
        self.alive = [int(np.searchsorted(-self.lengths, -t)) for t in range(steps)]  # sequences longer than t
        bits, self.labels = np.zeros((2, steps, len(sequences)), np.int64)
        for i, (line_bits, labels) in enumerate(sequences):
            bits[: len(line_bits), i], self.labels[: len(labels), i] = line_bits, labels
        self.features = [((bits[t, :n, None] >> np.arange(len(FEATURES))) & 1).astype(float) for t, n in enumerate(self.alive)]

    def gradient(self, weights: np.ndarray, moves: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood of the labels, and its derivatives."""
        alive, share, steps = self.alive, self.share, len(self.alive)
        scores = [np.stack([np.zeros(n), f @ weights], 1) for n, f in zip(alive, self.features)]
        forward = [scores[0]]
        for t in range(1, steps):
            before = forward[-1][: alive[t]]
            forward.append(np.logaddexp(before[:, 0, None] + moves[0], before[:, 1, None] + moves[1]) + scores[t])
        total = np.zeros(len(share))
        for t in range(steps):
            done = slice(alive[t + 1] if t + 1 < steps else 0, alive[t])
            total[done] = np.logaddexp(forward[t][done, 0], forward[t][done, 1])
        backward = np.zeros((len(share), 2))
        value, grad_w, grad_m = -float(total @ share), np.zeros(len(weights)), np.zeros((2, 2))
        for t in range(steps - 1, -1, -1):
            n = alive[t]
            y = self.labels[t, :n]
            p1 = np.exp(forward[t][:, 1] + backward[:n, 1] - total[:n])
            grad_w += ((y - p1) * share[:n]) @ self.features[t]
            value += float((scores[t][np.arange(n), y]) @ share[:n])
            if t:
                before = self.labels[t - 1, :n]
                ahead = scores[t] + backward[:n]
                pair = np.exp(forward[t - 1][:n, :, None] + moves + ahead[:, None, :] - total[:n, None, None])
                truth = np.zeros((n, 2, 2))
                truth[np.arange(n), before, y] = 1
                value += float(moves[before, y] @ share[:n])
                grad_m += ((truth - pair) * share[:n, None, None]).sum(0)
                backward[:n] = np.logaddexp(moves[:, 0] + ahead[:, 0, None], moves[:, 1] + ahead[:, 1, None])
        return value, grad_w, grad_m


def train(sequences: list[tuple[list[int], list[int]]], rounds: int = 120, rate: float = 1.0, decay: float = 1e-3) -> LineModel:
    """Maximum likelihood by gradient ascent, all ``Chains`` side by side."""
    if len({y for _, labels in sequences for y in labels}) < 2:
        return ALL_CONTENT
    chains = Chains(sequences)
    weights, moves = np.zeros(len(FEATURES)), np.zeros((2, 2))
    speed_w, speed_m = np.full(len(FEATURES), 1e-8), np.full((2, 2), 1e-8)
    for _ in range(rounds):
        _, grad_w, grad_m = chains.gradient(weights, moves)
        grad_w, grad_m = grad_w - decay * weights, grad_m - decay * moves
        speed_w, speed_m = speed_w + grad_w**2, speed_m + grad_m**2
        weights, moves = weights + rate * grad_w / np.sqrt(speed_w), moves + rate * grad_m / np.sqrt(speed_m)
    return LineModel(tuple(weights.tolist()), tuple(map(tuple, moves.tolist())))


def joined_stretches(content: list[list[int]], boilerplate: list[list[int]]) -> list[tuple[list[int], list[int]]]:
    """Sequences of a content and a boilerplate stretch each, in either order, so that labels
    change within a sequence; the class of fewer stretches is gone through again."""
    def dealt(stretches: list[list[int]]) -> list[list[int]]:
        return sorted((s for s in stretches if s), key=lambda s: (zlib.crc32(repr(s).encode()), s))

    content, boilerplate, out = dealt(content), dealt(boilerplate), []
    if not content or not boilerplate:
        return [(s, [y] * len(s)) for y, some in ((0, content), (1, boilerplate)) for s in some]
    for i in range(max(len(content), len(boilerplate))):
        pair = [(content[i % len(content)], 0), (boilerplate[i % len(boilerplate)], 1)]
        first, second = pair[:: 1 if i % 2 else -1]
        out.append((first[0] + second[0], [first[1]] * len(first[0]) + [second[1]] * len(second[0])))
    return out


def stretches_of(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 sample_per_class: int = SAMPLE_PER_CLASS) -> tuple[list[list[int]], list[list[int]]]:
    """Feature bits of stretches of lines of good documents, and of bad ones: of the
    ``sample_per_class`` labelled documents of each class whose ids hash lowest, at most
    ``STRETCHES`` of ``STRETCH_LINES`` lines each. Documents with both labels or none are left out."""
    seen = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
            .agg(F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = high AND low IN (0, 1)"))
    chosen = None
    for value in (0, 1):
        some = seen.where(F.col("low") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    # at most 2 x sample_per_class ids: small enough for every executor
    named = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).cast("string").alias("text"))
    sample = named.join(F.broadcast(chosen.select("doc_id", F.col("low").alias("quality"))), "doc_id")
    # repeated ids are one document's rows: the first STRETCHES by content, so that the bound holds for any table
    found = map_texts(sample, "text", ["doc_id", "quality"], STRETCH_LISTS, lambda: _stretch_lists).select("doc_id", "quality", F.explode("stretches").alias("s"))
    found = found.groupBy("doc_id", "quality").agg(F.slice(F.array_sort(F.collect_set("s")), 1, STRETCHES).alias("s")).select("quality", F.explode("s").alias("s")).collect()
    return [list(r["s"]) for r in found if r["quality"] == 1], [list(r["s"]) for r in found if r["quality"] == 0]


def fit_line_model(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   sample_per_class: int = SAMPLE_PER_CLASS) -> LineModel:
    """Train on joined stretches of labelled documents (``stretches_of``)."""
    return train(joined_stretches(*stretches_of(docs, labels, doc_id, text, sample_per_class)))


def _stretch_lists(texts: pa.Array) -> dict:
    got, out = measure(texts), []
    for a, b in zip(got["lines"].tolist(), got["lines"][1:].tolist()):
        last = max(a, b - STRETCH_LINES)
        begins = range(a, b, STRETCH_LINES) if b - a <= STRETCHES * STRETCH_LINES else np.linspace(a, last, STRETCHES).astype(int).tolist()
        out.append([got["line_bits"][i : min(i + STRETCH_LINES, b)].tolist() for i in begins])
    return {"stretches": out}


def _judge(model: LineModel, content_share: float):
    def judge(texts: pa.Array) -> dict:
        got = measure(texts)
        scores, words = model.scores(got["line_bits"]).tolist(), got["line_words"]
        ends = got["lines"].tolist()
        boilerplate = np.array([y for a, b in zip(ends, ends[1:]) for y in model.viterbi(scores[a:b])], bool)
        n, repeat = got["n_words"], got["n_repeat_words"]
        share = per_row(np.where(boilerplate, 0, words), got["lines"]) / np.maximum(n, 1)
        failed = (n < MIN_WORDS) | (100 * repeat > 30 * n)
        return {f.name: got[f.name] for f in COUNTS.fields} | {"base_failed": failed, "content_share": share, "kept": ~failed & (share >= content_share)}

    return judge


def quality_verdicts(docs: DataFrame, model: LineModel, text: str = "text", content_share: float = CONTENT_SHARE) -> DataFrame:
    """Every row of ``docs`` with its counts, ``base_failed``, ``content_share``
    and ``kept``. A null text counts as empty: no words, so it fails. Rows are
    judged one by one, repeated rows alike. Input columns named like a result
    column are replaced."""
    return map_texts(docs, text, without(docs, VERDICT.names), VERDICT, lambda: _judge(model, content_share))


def keep_good(docs: DataFrame, model: LineModel, text: str = "text", content_share: float = CONTENT_SHARE) -> DataFrame:
    """The documents that are kept, unchanged."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    judged = quality_verdicts(plain, model, f"c{docs.columns.index(text)}", content_share)
    return judged.where("kept").select(*plain.columns).toDF(*docs.columns)


def brute_force(text: str | None) -> dict[str, int]:
    """The counts by plain Python (for tests)."""
    text = text or ""
    words = [w for w in text.encode().split()]
    where: dict[tuple, list[int]] = {}
    for i in range(len(words) - REPEAT_WINDOW + 1):
        where.setdefault(tuple(words[i : i + REPEAT_WINDOW]), []).append(i)
    hit = {i + j for at in where.values() if len(at) > 1 for i in at for j in range(REPEAT_WINDOW)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return {"n_words": len(words), "word_chars": sum(len(w.decode()) for w in words), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit)}
