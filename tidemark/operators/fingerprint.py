"""Fingerprints of row multisets, and comparison by a tree of them.

A set of rows has a fingerprint that doesn't depend on their order: how many there
are, and the sums of two independent 64-bit hashes of them. Sums add up, so a table's
fingerprint is that of its parts together. Two tables are compared part by part, a part
being a range of a hash, and only the parts that differ are cut finer; what is left at
the last level is compared row by row. Equal tables cost one scan each and a
comparison of a few hundred numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts that a part is cut into, and levels of the tree.
FANOUT, LEVELS = 256, 2
_SUMS = ("n", "first", "second")


def null_safe(cols: Sequence[str]) -> list[Column]:
    """Each column with its NULL-ness beside it, so that NULL and a sentinel never collide."""
    return [F.struct(F.col(c).isNull(), F.col(c)) for c in cols]


def row_hash(cols: Sequence[str]) -> Column:
    return F.xxhash64(*null_safe(cols))


def fingerprint(first: str = "_h1", second: str = "_h2") -> list[Column]:
    """Aggregates: rows, and the sums of two hash columns (as decimals, which don't wrap)."""
    return [F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(a) for c, a in ((first, "first"), (second, "second"))]]


def hashed(df: DataFrame, part_by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``df`` with ``_part`` (a non-negative hash of ``part_by``) and two hashes of ``cols``."""
    return df.withColumns({"_part": F.shiftrightunsigned(F.xxhash64(F.lit(7), *null_safe(part_by)), 1),
                           "_h1": row_hash(cols), "_h2": F.xxhash64(F.lit(1), *null_safe(cols))})


def _parts(df: DataFrame, level: int, fanout: int) -> Column:
    return F.pmod(F.col("_part"), F.lit(fanout ** level))


def unequal_parts(a: DataFrame, b: DataFrame, level: int, fanout: int) -> DataFrame:
    """``part``: the parts of a level whose fingerprints differ between two ``hashed`` tables."""
    sides = [df.groupBy(_parts(df, level, fanout).alias("part")).agg(*fingerprint()) for df in (a, b)]
    return (sides[0].unionByName(sides[1]).groupBy("part", *_SUMS).agg(F.count(F.lit(1)).alias("sides"))
            .where("sides = 1").select("part").distinct())


def _within(df: DataFrame, parts: list[int], level: int, fanout: int) -> DataFrame:
    return df.where(_parts(df, level, fanout).isin(parts))


def differing(a: DataFrame, b: DataFrame, part_by: Sequence[str], cols: Sequence[str], fanout: int = FANOUT,
              levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """What of ``a`` and of ``b`` lies in parts that differ. ``part_by`` must agree for rows
    that are to be compared with each other (their key).

    Level by level, at most ``fanout`` ** ``level`` numbers of parts that differ come to the
    driver; where more than ``fanout`` of a level do, the tables differ all over, going on
    would not leave out much, and the rows of those parts are returned."""
    x, y = hashed(a, part_by, cols), hashed(b, part_by, cols)
    for level in range(1, levels + 1):
        found = sorted(r["part"] for r in unequal_parts(x, y, level, fanout).limit(fanout * 16 + 1).collect())
        if len(found) > fanout * 16:
            break
        x, y = _within(x, found, level, fanout), _within(y, found, level, fanout)
        if not found or (level == 1 and len(found) > fanout // 2):
            break
    dropped = ["_part", "_h1", "_h2"]
    return x.drop(*dropped), y.drop(*dropped)
