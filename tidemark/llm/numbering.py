"""Gapless numbers for the rows of each key, without one task for a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(rows: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[Column], most: int, name: str) -> DataFrame:
    """``rows`` (a stored table) with ``name``: numbers from 0, gapless for each value of ``keys``
    (not null), bucket by bucket and by ``order`` inside. A bucket of more than ``most``
    rows (a null id, rows repeated over and over) is dealt to parts of about ``most`` by
    the places of its rows in the table, and numbered part by part; so one task numbers
    about ``most`` rows, whatever is in them. Input columns may have any names but ``name``."""
    taken = {c.lower() for c in rows.columns}
    at, row, part, parts, inside, before, n = (f"_{c}_" + "_" * max(map(len, taken)) for c in ("at", "row", "part", "parts", "in", "before", "n"))
    by = [*keys, at]
    laid = rows.withColumns({at: bucket, row: F.xxhash64(F.monotonically_increasing_id())})
    # At most one bucket in ``most`` rows is listed, and at most all buckets.
    large = laid.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / most).alias(parts)).where(F.col(parts) > 1)
    dealt = laid.join(F.broadcast(large), by, "left").withColumn(part, F.coalesce(F.pmod(F.col(row), F.col(parts)), F.lit(0)))
    counts = dealt.groupBy(*by, part).agg(F.count(F.lit(1)).alias(n))
    sums = counts.select(*by, part, (F.sum(n).over(Window.partitionBy(*keys).orderBy(at, part)) - F.col(n)).alias(before))
    placed = dealt.withColumn(inside, F.row_number().over(Window.partitionBy(*by, part).orderBy(*order)))
    return (placed.join(sums, [*by, part])
            .select(*[placed["`" + c.replace("`", "``") + "`"] for c in rows.columns], (F.col(before) + F.col(inside) - 1).cast("long").alias(name)))
