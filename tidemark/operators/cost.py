"""Extraction cost: rows a full-window reload reads versus rows above the lagged watermark.

One pass over the change log with two conditional counts; the ratio is the
transferable measure (rows cross the network, seconds on a laptop do not).
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import ntz, safe_rate


def extraction_cost(log: DataFrame, date_col: str, ts_col: str, as_of: datetime, watermark: datetime,
                    lag_minutes: int = 15, months: int = 3, scope: F.Column | None = None) -> DataFrame:
    """One row: rows with ``date_col`` in the last ``months`` before ``as_of`` (a full-window
    reload), rows with ``ts_col`` above ``watermark - lag`` (the incremental pull), and
    their ratio (six decimals, half-up; NULL when the full window is empty)."""
    full = F.col(date_col) >= (ntz(as_of) - F.make_ym_interval(F.lit(0), F.lit(months)))
    inc = F.col(ts_col) > ntz(watermark - timedelta(minutes=lag_minutes))
    if scope is not None:
        full, inc = full & scope, inc & scope
    counts = log.filter(full | inc).agg(F.count_if(full).alias("full_rows"), F.count_if(inc).alias("incremental_rows"))
    return counts.select("full_rows", "incremental_rows",
                         safe_rate("incremental_rows", "full_rows", 6).alias("ratio"))
