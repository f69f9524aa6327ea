"""Minimax contiguous partition of documents into shards (DataFrame functions only).

Documents with equal texts form one atomic group. Groups are ordered by the
MD5 of their text (giants, see ``giants``, after all others), and the smallest
shard capacity is binary-searched: a capacity is feasible if a greedy pass, which cuts where the next group would
overflow, needs no more than the wanted number of shards.

The greedy pass does not need every group on the driver. It works on *knots*,
totals per digest prefix: at most 65,536 rows. Knots taken as indivisible give
a feasible capacity, knots taken as divisible a lower bound; only prefixes that
a cut can fall into between the two are refined by further digest digits, until
the cuts lie between single groups and the capacity is exact. What reaches the
driver is bounded by the digits taken, whatever the number of documents.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, shared_table, without
from tidemark.llm.numbering import numbered

FIRST_DIGITS = 4
MORE_DIGITS = 2
#: Buckets of a shard in which slots are numbered side by side.
SLOT_DIGITS = 3
#: Rows of a bucket that one task numbers; more (of one id, or of none) are numbered in parts.
SLOTS_TOGETHER = 1_000_000
#: Sorts after every digest.
AFTER_ALL = "g"


def greedy_cuts(ends: list[int], single: list[bool], capacity: int, shards: int, whole: bool) -> list[int] | None:
    """Positions (in bytes from the start) where each shard ends if it takes as
    much as fits in turn. ``ends``: running totals of the knots. A knot of one
    group (``single``) is never cut; one of several is cut only if ``whole`` is
    false. None if the capacity is infeasible."""
    cuts, base, total = [], 0, ends[-1] if ends else 0
    for _ in range(shards):
        want = base + capacity
        if want >= total:
            return cuts + [total] * (shards - len(cuts))
        i = bisect_right(ends, want)
        at = ends[i - 1] if i else 0
        if not whole and not single[i]:
            at = want
        if at <= base:
            return None
        cuts.append(at)
        base = at
    return None


def smallest_capacity(ends: list[int], single: list[bool], shards: int, whole: bool = True) -> int:
    """Binary search over capacities with the greedy check."""
    low, high = (-(-ends[-1] // shards), ends[-1]) if ends else (0, 0)
    while low < high:
        mid = (low + high) // 2
        if greedy_cuts(ends, single, mid, shards, whole) is None:
            low = mid + 1
        else:
            high = mid
    return low


def _open_knots(ends: list[int], single: list[bool], shards: int) -> list[int]:
    """Knots of several groups in which a greedy cut at the smallest capacity may
    fall: between the cuts of whole knots at the lower bound and those of
    divisible knots at the feasible capacity."""
    low, high = (smallest_capacity(ends, single, shards, whole) for whole in (False, True))
    sizes = [e - b for b, e in zip([0, *ends], ends)]
    large = [i for i, n in enumerate(sizes) if n > low and not single[i]]
    if large:
        return large  # at most one a shard; they hide how the others fall
    least, most = [], greedy_cuts(ends, single, high, shards, False)
    base = 0
    for _ in range(shards - 1):
        i = bisect_right(ends, base + low)
        base = ends[i - 1] if i else 0
        least.append(base)
    found: set[int] = set()
    for a, b in zip(least, most):
        found.update(range(bisect_right(ends, a), min(len(ends), bisect_right(ends, b) + 1)))
    return [i for i in sorted(found) if not single[i]]


def giants(largest: list[tuple[str, int]], total: int, shards: int) -> list[str]:
    """Groups over the mean of the shards that are left: each gets a shard of its
    own, so that it doesn't set the capacity of the others. ``largest``: the
    largest groups, at least as many as shards, in falling size."""
    found: list[str] = []
    for digest, size in largest[: shards - 1]:
        if size * (shards - len(found)) <= total:
            break
        found.append(digest)
        total -= size
    return found


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[list[str], list[str]]:
    """The digests of the giant groups (one shard each, the last ones) and the
    digests at which the shards 1.. of the other groups begin.

    ``groups``: a row per document with ``digest`` (MD5 in hex) and ``size``."""
    by_text = groups.groupBy("digest").agg(F.sum("size").alias("size"))
    top = by_text.orderBy(F.desc("size"), "digest").limit(shards).collect()
    if not top:
        return [], []
    total = groups.agg(F.sum("size")).first()[0]
    alone = giants([(r["digest"], r["size"]) for r in top], total, shards)
    rest, shards = groups.where(~F.col("digest").isin(alone)) if alone else groups, shards - len(alone)

    def totals(rows: DataFrame, digits: int) -> list[tuple[str, int, bool]]:
        got = (rows.groupBy(F.substring("digest", 1, digits).alias("prefix"))
               .agg(F.sum("size").alias("size"), F.min("digest").alias("low"), F.max("digest").alias("high")).collect())
        return [(r["prefix"], r["size"], r["low"] == r["high"]) for r in got]

    knots = sorted(totals(rest, FIRST_DIGITS))
    while True:
        ends, single = list(accumulate(n for _, n, _ in knots)), [one for *_, one in knots]
        unsure = {knots[i][0] for i in _open_knots(ends, single, shards)} if knots else set()
        if not unsure:
            break
        finer = totals(rest.where(_in_prefixes(unsure)), max(map(len, unsure)) + MORE_DIGITS)
        knots = sorted([k for k in knots if k[0] not in unsure] + finer)
    cuts = greedy_cuts(ends, single, smallest_capacity(ends, single, shards), shards, True) or []
    begins = {0: knots[0][0]} | {e: k[0] for e, k in zip(ends, knots[1:])} if knots else {}
    return alone, [begins.get(c, AFTER_ALL) for c in cuts[:-1]]


def _in_prefixes(prefixes: set[str]) -> Column:
    by: dict[int, list[str]] = {}
    for p in prefixes:
        by.setdefault(len(p), []).append(p)
    test = F.lit(False)
    for n, some in by.items():
        test = test | F.substring("digest", 1, n).isin(some)
    return test


def shard_documents(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` (without the text) with ``size``, ``text_crc32``,
    ``shard`` and ``slot``.

    Size is the UTF-8 length plus one; a null text counts as empty and shares the
    group of empty texts. Equal texts (repeated rows too) stay in one shard; a
    group over the mean of the shards that are left has a shard of its own. With
    fewer groups than shards, some shards stay empty. Slots are gapless from 0 in each shard, in
    the order of a hash of the id, which spreads any group over the numbering
    buckets; rows without an id, or of one id, are spread too if they are many. An empty table gives an empty result. Input columns named like a
    result column are replaced."""
    results = ["size", "text_crc32", "shard", "slot", "digest", "bucket"]
    keep = [c for c in without(docs, results) if c != text]
    body = F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))
    narrow = shared_table(docs.select(
        *[F.col(quoted(c)) for c in keep],
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.md5(body.cast("binary")).alias("digest"),
        F.substring(F.md5(F.coalesce(F.col(quoted(doc_id)).cast("string"), F.lit("")).cast("binary")), 1, SLOT_DIGITS).alias("bucket"),
    ), "shard-sizes")
    alone, starts = minimax_cuts(narrow, shards)
    shard = sum((F.when(F.col("digest") >= start, 1).otherwise(0) for start in starts), F.lit(0))
    for k, digest in enumerate(alone):
        shard = F.when(F.col("digest") == digest, shards - len(alone) + k).otherwise(shard)
    placed = narrow.withColumn("shard", shard.cast("int"))
    order = [F.col(quoted(doc_id)).asc_nulls_first(), F.col("digest")]
    return (numbered(placed, ["shard"], F.col("bucket"), order, SLOTS_TOGETHER, "slot")
            .select(*[F.col(quoted(c)) for c in keep], "size", "text_crc32", "shard", "slot"))
