"""Even splits of a source read, from a summary of the split column's values.

Strides between the least and the greatest id give ranges of very different sizes when
ids are skewed. Here the ranges come from quantiles: every landing leaves a KLL sketch of
its split column (a few kB, whatever its rows, gathered during the bronze write),
sketches of all landings merge, and the next read is cut at the merged quantiles. The
ranges only shape tasks: they cover every value, nulls included, once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch: ranks are off by about 0.1 % of the rows.
SKETCH_K = 4096


def sketch_of(column: str) -> Column:
    """Aggregate: the sketch of an integer column (nulls are left out; null if there is nothing else)."""
    return F.kll_sketch_agg_bigint(F.col(column).cast("long"), SKETCH_K)


def merged(sketches: DataFrame, column: str = "sketch") -> DataFrame:
    """One row: the sketch of everything that ``sketches`` have seen."""
    return sketches.where(F.col(column).isNotNull()).agg(F.kll_merge_agg_bigint(column, SKETCH_K).alias(column))


def split_points(sketch: DataFrame, ranges: int, column: str = "sketch") -> list[int]:
    """At most ``ranges`` - 1 rising values, each the least of its range; fewer where one
    value fills more than a range, none for an empty sketch."""
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    held = sketch.where(F.kll_sketch_get_n_bigint(column) > 0)
    row = held.select(F.kll_sketch_get_quantile_bigint(F.col(column), shares).alias("points")).first() if ranges > 1 else None
    return sorted(set(row["points"])) if row else []


def range_number(column: str, points: Sequence[int]) -> Column:
    """The number of a value's range, from 0; nulls are in the first."""
    c = F.col(column)
    return sum((F.when(c >= F.lit(p), 1).otherwise(0) for p in points), F.lit(0))


def range_predicates(column: str, points: Sequence[int]) -> list[str]:
    """The ranges as conditions for a source, one a partition (integers only, no text from outside)."""
    if not points:
        return ["1 = 1"]
    ps = [int(p) for p in points]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(ps, ps[1:])]
    return [f"({column} < {ps[0]} OR {column} IS NULL)", *inner, f"{column} >= {ps[-1]}"]


def range_sizes(df: DataFrame, column: str, points: Sequence[int]) -> DataFrame:
    """``range``, ``rows``: how many rows of ``df`` each range holds."""
    return df.groupBy(range_number(column, points).alias("range")).agg(F.count(F.lit(1)).alias("rows"))


def evenness(sizes: DataFrame, ranges: int, most: float = 1.2) -> DataFrame:
    """One row: non-empty ranges, rows, and whether the largest holds at most ``most`` times
    the mean of ``ranges``."""
    return sizes.agg(F.count(F.lit(1)).alias("ranges"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                     (F.max("rows") * ranges <= F.sum("rows") * most).alias("even"))
