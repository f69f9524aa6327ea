"""Source versus bronze: count-level drift and row-level differences.

Counts: per target, the number of distinct keys in scope at the source and
in bronze (the same scope filter on both sides, and the full logical key),
the drift fraction, and a flag above the threshold. An empty source with
rows in bronze is flagged in its own column. Every target is one aggregate;
the targets are unioned into one result instead of a driver loop of counts.

Rows: a full outer join on the (null-safe) key of the source snapshot with the newest
bronze version, comparing a 64-bit hash of the non-key columns, in those key ranges
whose fingerprints differ. ``hashed_latest``
hashes before the dedup, so only keys, order columns and hashes are shuffled. Result: ``missing`` (in the
source, not in bronze), ``extra`` (in bronze only) and ``changed``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import drift_fraction, ntz
from tidemark.operators.changelog import latest_per_key
from tidemark.operators.fingerprint import differing, row_hash


@dataclass(frozen=True)
class Target:
    name: str
    source: DataFrame | None
    bronze: DataFrame
    keys: tuple[str, ...]
    scope: F.Column | None = None  # applied to both sides
    # Counted elsewhere (at a JDBC source, pushed down): then ``source`` is not read.
    source_count: int | None = None


def _key_counts(t: Target) -> DataFrame:
    """Distinct in-scope keys on both sides in one aggregate: the two sides are
    tagged and unioned, de-duplicated per (key, side) with a map-side partial
    step, then counted per side."""
    brz = t.bronze.filter(t.scope) if t.scope is not None else t.bronze
    if t.source_count is not None:
        return brz.select(*t.keys).distinct().agg(F.count(F.lit(1)).alias("bronze_count")).select(
            F.lit(t.name).alias("table"), F.lit(int(t.source_count)).cast("long").alias("source_count"),
            "bronze_count")
    src = t.source.filter(t.scope) if t.scope is not None else t.source
    both = (src.select(*t.keys, F.lit(1).alias("_side"))
            .unionByName(brz.select(*t.keys, F.lit(2).alias("_side"))))
    return both.distinct().agg(
        F.count_if(F.col("_side") == 1).alias("source_count"),
        F.count_if(F.col("_side") == 2).alias("bronze_count"),
    ).select(F.lit(t.name).alias("table"), "source_count", "bronze_count")


def reconcile_counts(targets: Sequence[Target], threshold: float = 0.005,
                     checked_at: datetime | None = None) -> DataFrame:
    out = None
    for t in targets:
        part = _key_counts(t)
        out = part if out is None else out.unionByName(part)
    drift = drift_fraction("source_count", "bronze_count")
    res = out.select(
        "table", "source_count", "bronze_count",
        drift.alias("drift_pct"),
        F.when(drift > threshold, 1).otherwise(0).alias("flagged"),
        F.when((F.col("source_count") == 0) & (F.col("bronze_count") > 0), 1).otherwise(0).alias("empty_source"),
    )
    if checked_at is not None:
        res = res.withColumn("checked_at", ntz(checked_at))
    return res


def append_log(result: DataFrame, path: str) -> str:
    """Append a reconciliation result (one row per target) to the log table (all of it:
    ``sources.bronze.read_appended``); returns the folder of the rows just written."""
    from tidemark.sources.bronze import append_rows

    return append_rows(result, path)


def raise_on_drift(result: DataFrame, threshold: float = 0.005) -> None:
    """Fail the job after the result is logged (the result has one row per target)."""
    bad = [r["table"] for r in result.filter((F.col("flagged") == 1) | (F.col("empty_source") == 1))
           .select("table").collect()]
    if bad:
        raise ValueError(f"reconciliation drift above {threshold:.2%} in: {', '.join(bad)}")


def reconcile_rows(source: DataFrame, bronze_latest: DataFrame, keys: Sequence[str],
                   compare: Sequence[str] | None = None) -> DataFrame:
    """Key-level differences between a source snapshot and bronze's newest state.

    Fingerprints of key ranges are compared first (``operators.fingerprint``); only rows of
    ranges that differ are joined, on null-safe keys."""
    cols = list(compare) if compare is not None else [c for c in source.columns if c not in keys]
    s, b = differing(source.select(*dict.fromkeys([*keys, *cols])), bronze_latest.select(*dict.fromkeys([*keys, *cols])), keys, [*keys, *cols])
    s = s.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)], row_hash(cols).alias("_hs"), F.lit(True).alias("_in_s"))
    b = b.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)], row_hash(cols).alias("_hb"), F.lit(True).alias("_in_b"))
    j = s.join(b, [F.col(f"_s{i}").eqNullSafe(F.col(f"_b{i}")) for i in range(len(keys))], "full_outer")
    status = (F.when(F.col("_in_b").isNull(), F.lit("missing"))
              .when(F.col("_in_s").isNull(), F.lit("extra"))
              .when(F.col("_hs") != F.col("_hb"), F.lit("changed")))
    return j.select(*[F.coalesce(f"_s{i}", f"_b{i}").alias(k) for i, k in enumerate(keys)], status.alias("status")).filter(F.col("status").isNotNull())


def hashed_latest(log: DataFrame, keys: Sequence[str], order: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Newest version per key as (key, hash of ``compare``): rows become eight bytes before
    the dedup, so only key, order and hash cross the shuffle."""
    narrow = log.select(*dict.fromkeys([*keys, *order]), row_hash(compare).alias("row_hash"))
    return latest_per_key(narrow, keys, order).select(*keys, "row_hash")


def reconcile_hashes(source: DataFrame, bronze_latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`reconcile_rows` over two sides that :func:`hashed_latest` gave."""
    return reconcile_rows(source, bronze_latest, keys, ["row_hash"])


def rerun_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows present on one side only (duplicates counted), with a side marker.
    Empty when a re-run reproduced the table exactly: then fingerprints say so, and no row
    is compared; else only rows of the parts that differ are."""
    cols = before.columns
    x, y = differing(before, after.select(*cols), cols, cols)
    b = x.exceptAll(y).withColumn("side", F.lit("before_only"))
    a = y.exceptAll(x).withColumn("side", F.lit("after_only"))
    return b.unionByName(a)
