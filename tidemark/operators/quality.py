"""Declared data checks, run as few passes as possible.

Column checks of one table (``not_null``, ``accepted_values``,
``accepted_range``) and its first key check share one pass: a grouped count
on the key (map-side partial step, so a hot key is counted inside each map
task before the shuffle) that carries the column-check counts along. Each
further key check is one more grouped count.

Conventions: NULL fails only ``not_null``; it passes ranges, value lists and
single-column uniqueness; a composite key treats NULLs as equal.
Result rows: ``(model, check, column, failures, status)``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import ntz

RESULT_COLS = ["model", "check", "column", "failures", "status"]


@dataclass(frozen=True)
class Check:
    kind: str  # not_null | unique | accepted_values | accepted_range | unique_combination
    columns: tuple[str, ...]
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def not_null(col: str) -> Check:
    return Check("not_null", (col,))


def unique(col: str) -> Check:
    return Check("unique", (col,))


def accepted_values(col: str, values) -> Check:
    return Check("accepted_values", (col,), tuple(values))


def accepted_range(col: str, min_value=None, max_value=None) -> Check:
    return Check("accepted_range", (col,), min_value=min_value, max_value=max_value)


def unique_combination(*cols: str) -> Check:
    return Check("unique_combination", tuple(cols))


def _failing(check: Check) -> F.Column:
    c = F.col(check.columns[0])
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return ~c.isin(*check.values)  # NULL -> NULL -> not counted
    if check.kind == "accepted_range":
        cond = None
        if check.min_value is not None:
            cond = c < F.lit(check.min_value)
        if check.max_value is not None:
            hi = c > F.lit(check.max_value)
            cond = hi if cond is None else (cond | hi)
        return cond if cond is not None else F.lit(False)
    raise ValueError(check.kind)


def _status(failures: F.Column) -> F.Column:
    return F.when(failures == 0, F.lit("pass")).otherwise(F.lit("fail"))


def run_checks(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """All checks of one table in as few passes as possible.

    Column checks and the first key check share one pass: rows are grouped by
    that key (partial aggregation before the shuffle) with per-group failure
    counts, then one small global aggregate adds them up and counts the
    repeated keys. Further key checks cost one grouped count each. A table
    without key checks needs a single global aggregate.
    """
    col_checks = [c for c in checks if c.kind in ("not_null", "accepted_values", "accepted_range")]
    key_checks = [c for c in checks if c.kind in ("unique", "unique_combination")]
    rows: list[F.Column] = []
    parts: list[DataFrame] = []

    def row(c: Check, value: F.Column) -> F.Column:
        return F.struct(F.lit(c.kind).alias("check"), F.lit(c.label).alias("column"),
                        value.cast("long").alias("failures"))

    def repeated(c: Check) -> F.Column:
        cond = F.col("_n") > 1
        if c.kind == "unique":  # a NULL key passes single-column uniqueness
            cond = cond & F.col(c.columns[0]).isNotNull()
        return F.count_if(cond)

    first = key_checks[0] if key_checks else None
    if first is not None:
        grouped = df.groupBy(*first.columns).agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.count_if(_failing(c)).alias(f"c{i}") for i, c in enumerate(col_checks)])
        totals = grouped.agg(repeated(first).alias("k0"),
                             *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(col_checks))])
        rows = [row(c, F.coalesce(F.col(f"c{i}"), F.lit(0))) for i, c in enumerate(col_checks)]
        rows.append(row(first, F.col("k0")))
        parts.append(totals.select(F.explode(F.array(*rows)).alias("r")))
    elif col_checks:
        totals = df.agg(*[F.count_if(_failing(c)).alias(f"c{i}") for i, c in enumerate(col_checks)])
        rows = [row(c, F.col(f"c{i}")) for i, c in enumerate(col_checks)]
        parts.append(totals.select(F.explode(F.array(*rows)).alias("r")))
    for c in key_checks[1:]:
        counts = df.groupBy(*c.columns).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(counts.agg(repeated(c).alias("k")).select(F.explode(F.array(row(c, F.col("k")))).alias("r")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(model).alias("model"), "r.check", "r.column", "r.failures",
                      _status(F.col("r.failures")).alias("status"))


def run_suite(tables: dict[str, tuple[DataFrame, Sequence[Check]]]) -> DataFrame:
    """Every model's checks in one result table."""
    out = None
    for model, (df, checks) in tables.items():
        r = run_checks(df, model, checks)
        out = r if out is None else out.unionByName(r)
    return out


def failed(results: DataFrame) -> list[str]:
    """Driver-side verdict: names of failing checks (the result has one row per check)."""
    return [f"{r.model}.{r.check}({r.column})" for r in results.filter(F.col("status") != "pass").collect()]


def freshness(df: DataFrame, loaded_at: str, as_of: datetime, group_cols: Sequence[str] = (),
              warn_hours: float = 26, error_hours: float = 48) -> DataFrame:
    """Age of the newest row against ``as_of``: ``pass`` / ``warn`` / ``error``."""
    g = df.groupBy(*group_cols) if group_cols else df.groupBy()
    m = g.agg(F.max(loaded_at).alias("max_loaded_at"))
    # Exact integer arithmetic on zone-less timestamps: no session zone, no DST.
    age_us = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), ntz(as_of))
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(age_us > F.lit(int(error_hours * 3_600_000_000)), F.lit("error"))
              .when(age_us > F.lit(int(warn_hours * 3_600_000_000)), F.lit("warn"))
              .otherwise(F.lit("pass")))
    return m.select(*group_cols, "max_loaded_at",
                    F.timestamp_diff("SECOND", F.col("max_loaded_at"), ntz(as_of)).alias("age_seconds"),
                    status.alias("status"))
