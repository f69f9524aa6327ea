"""Change-log operators: latest version per key, upsert, retention, overlap.

A change log holds many versions per key; readers take the newest one. All of
these are declarative DataFrame plans: the dedup is a ``row_number`` window
with a ``= 1`` filter, which Catalyst turns into a partial (map-side) plus a
final ``WindowGroupLimit``. The partial limit keeps at most one row per key
per input partition before the shuffle, so a key holding a third of all
versions ships one row per map task, not a third of the table.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import MIN_RETENTION_HOURS
from tidemark.functions.expressions import ntz

_RN = "__version_rank"


def _order_desc(order: Sequence[str]) -> list[Column]:
    # DESC puts NULLs last: a version without a timestamp never wins over one with it.
    return [F.col(c).desc_nulls_last() for c in order]


def version_rank(keys: Sequence[str], order: Sequence[str]) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*_order_desc(order)))


def latest_per_key(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest version of every key; ``order`` columns are all descending.

    Pass a total order (end with a unique sequence) to make the choice
    deterministic when timestamps tie.
    """
    return log.withColumn(_RN, version_rank(keys, order)).filter(F.col(_RN) == 1).drop(_RN)


def pivot_latest(
    log: DataFrame,
    key: str,
    type_col: str,
    value_col: str,
    names: dict[int, str],
    order: Sequence[str],
) -> DataFrame:
    """Long to wide: one row per ``key``; column ``names[t]`` = newest value of type ``t``.

    One aggregation instead of a dedup window followed by a pivot: for each
    type the value of the newest version is ``max_by(value, (order...))``
    restricted to that type. The aggregate has a map-side partial step, so a
    key with a long history is reduced before the shuffle, and the plan needs
    one exchange on ``key`` instead of two. Keys whose rows carry none of the
    listed types still get a row (all NULL), as with the window form.
    """
    ordering = F.struct(*[F.col(c) for c in order])
    aggs = [
        F.max_by(F.when(F.col(type_col) == t, F.col(value_col)),
                 F.when(F.col(type_col) == t, ordering)).alias(name)
        for t, name in names.items()
    ]
    return log.groupBy(key).agg(*aggs)


def upsert_latest(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """MERGE without a transactional table: matched keys replaced, new keys inserted.

    With ``order`` the updates are first reduced to their newest version per
    key, so the result keeps one row per key. Without it, updates must have
    unique keys, as a MERGE requires: ``check_unique`` fails on a repeated key
    (one grouped count with a partial step; only one offender reaches the driver).
    """
    if order is not None:
        updates = latest_per_key(updates, keys, order)
    elif check_unique:
        assert_unique(updates, keys)
    theirs = updates.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    # null-safe: an update of a null key replaces the null-key row
    kept = target.join(theirs, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)], "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a key repeats (one aggregate; only the first offender reaches the driver)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key in upsert batch: {dup[0].asDict()}")


def prune_superseded(
    log: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ts_col: str,
    as_of: datetime,
    retention_hours: int = MIN_RETENTION_HOURS,
) -> DataFrame:
    """Retention for a change log: keep each key's newest version, plus every
    version newer than ``as_of - retention``. Refuses a retention shorter than
    one week, the floor that protects long-running readers.

    No step ranks all versions of a key (a key with a third of the log would
    sort in one task): the newest version comes from the group-limited dedup,
    and recent rows are kept by a plain filter. When ``ts_col`` leads the
    order, a key with a recent version has its newest version among the
    recent rows, so only the old rows need a dedup, and only for keys without
    a recent row.
    """
    if retention_hours < MIN_RETENTION_HOURS:
        raise ValueError(f"retention {retention_hours} h is below the {MIN_RETENTION_HOURS} h minimum")
    cutoff = ntz(as_of - timedelta(hours=retention_hours))
    recent_cond = F.col(ts_col) >= cutoff
    recent = log.filter(recent_cond)
    if order and order[0] == ts_col:
        old = log.filter(~recent_cond | F.col(ts_col).isNull())
        recent_keys = recent.select(*keys).distinct()
        newest_old = latest_per_key(old, keys, order).join(recent_keys, on=list(keys), how="left_anti")
        return recent.unionByName(newest_old)
    newest = latest_per_key(log, keys, order)
    # The newest versions, then the recent rows of other versions (rows that agree in key and
    # order are one version).
    version = list(dict.fromkeys([*keys, *order]))
    theirs = newest.filter(recent_cond).select(*[F.col(c).alias(f"_n{i}") for i, c in enumerate(version)])
    same = [recent[c].eqNullSafe(theirs[f"_n{i}"]) for i, c in enumerate(version)]
    return newest.unionByName(recent.join(theirs, same, "left_anti"))


def overlap_batch(log: DataFrame, ts_col: str, watermark: datetime, lag_minutes: int = 15) -> DataFrame:
    """Rows strictly above ``watermark - lag``: the re-read window of one run."""
    lo = watermark - timedelta(minutes=lag_minutes)
    return log.filter(F.col(ts_col) > ntz(lo))


def batch_stats(batch: DataFrame, ts_col: str) -> DataFrame:
    """Row count and newest watermark value of a batch, in one aggregate."""
    return batch.agg(F.count(F.lit(1)).alias("row_count"), F.max(ts_col).alias("batch_max"))


def distinct_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of distinct keys (NULL keys count as one key, as in a GROUP BY)."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("distinct_keys"))


def key_bitmaps(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """The distinct values of an integer ``key`` as bitmaps of 32,768 values each: ``bucket``,
    ``bitmap`` (and ``by``). Built with a partial step, so a key with many versions is one
    bit before the shuffle. Exact, and mergeable: a landing's bitmaps are made once."""
    k = F.col(key).cast("long")
    return (df.where(k.isNotNull()).groupBy(*by, F.bitmap_bucket_number(k).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias("bitmap")))


def distinct_keys_of(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``distinct_keys`` over any number of :func:`key_bitmaps`, landings' or tables' (null keys are not counted)."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("distinct_keys"))
