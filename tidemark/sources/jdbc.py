"""Incremental source reads: typed predicates, partitioned JDBC, pushed counts.

The watermark is a typed ``timestamp_ntz`` literal in a DataFrame filter and
the scope is a typed ``IN`` list; Spark pushes both to the source
(``PushedFilters: [GreaterThan(update_date, ...), In(client_id, ...)]``), so
there is no SQL text to inject into. The same functions work on any
DataFrame source (parquet in the tests, JDBC in production).
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import SourceSpec
from tidemark.functions.expressions import ntz
from tidemark.operators.splits import range_predicates

_WATERMARK_RE = re.compile(r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}")


def validate_watermark(text: str) -> str:
    """Accept only ``YYYY-MM-DD HH:MM:SS`` that is also a real time.

    ``fullmatch`` (not ``$``, which admits a trailing newline) and a parse, so
    ``9999-99-99 99:99:99`` is rejected too.
    """
    if not isinstance(text, str) or not _WATERMARK_RE.fullmatch(text):
        raise ValueError(f"refusing malformed watermark: {text!r}")
    try:
        datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
    except ValueError as exc:
        raise ValueError(f"refusing malformed watermark: {text!r}") from exc
    return text


def watermark_guard_col(text_col) -> "F.Column":
    """Column form of :func:`validate_watermark` (1 = accepted)."""
    c = F.col(text_col) if isinstance(text_col, str) else text_col
    ok = (
        (F.length(c) == 19)
        & c.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
        & (F.substring(c, 1, 4) != "0000")  # year 0 parses in Spark's calendar, not in Python's
        & F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()
    )
    return F.when(ok, F.lit(1)).otherwise(F.lit(0))


def scope_filter(spec: SourceSpec) -> "F.Column | None":
    """The spec's typed scope: an ``IN`` list, an excluded value, or None."""
    cond = None
    if spec.scope_column and spec.scope_values:
        cond = F.col(spec.scope_column).isin(*spec.scope_values)
    if spec.exclude_column:
        out = F.col(spec.exclude_column) != F.lit(spec.exclude_value)
        cond = out if cond is None else cond & out
    return cond


def scope_sql(spec: SourceSpec) -> list[str]:
    """The same for a query at the source: integers, and a quoted value."""
    out = []
    if spec.scope_column and spec.scope_values:
        out.append(f"{spec.scope_column} IN ({', '.join(str(int(v)) for v in spec.scope_values)})")
    if spec.exclude_column:
        value = str(spec.exclude_value).replace("'", "''")
        out.append(f"{spec.exclude_column} <> '{value}'")
    return out


def count_in_scope(source: DataFrame, spec: SourceSpec) -> DataFrame:
    """One row, ``source_count``: the rows of ``source`` in the spec's scope."""
    scope = scope_filter(spec)
    return (source if scope is None else source.filter(scope)).agg(F.count(F.lit(1)).alias("source_count"))


def pulled(spec: SourceSpec) -> SourceSpec:
    """The spec as the pull sees it."""
    return spec if spec.exclude_when_pulled else replace(spec, exclude_column=None)


def incremental_filter(spec: SourceSpec, watermark: datetime) -> "F.Column":
    """``watermark_column > watermark`` AND the typed scope list."""
    cond = F.col(spec.watermark_column) > ntz(watermark)
    scope = scope_filter(pulled(spec))
    return cond if scope is None else cond & scope


def incremental_pull(source: DataFrame, spec: SourceSpec, watermark: datetime) -> DataFrame:
    """Rows changed after ``watermark`` (strictly), in scope, projected to the spec's columns
    (plus the sequence column, when the spec names one)."""
    cols = list(spec.columns) + ([spec.sequence_column] if spec.sequence_column else [])
    return source.filter(incremental_filter(spec, watermark)).select(*cols)


def full_reload_pull(source: DataFrame, spec: SourceSpec, date_col: str, as_of: datetime, months: int = 3) -> DataFrame:
    """The full-window read the incremental pull replaces: ``date_col >= as_of - months``, in scope."""
    cond = F.col(date_col) >= (ntz(as_of) - F.make_ym_interval(F.lit(0), F.lit(months)))
    scope = scope_filter(pulled(spec))
    return source.filter(cond if scope is None else cond & scope).select(*spec.columns)


def partition_bounds(batch: DataFrame, column: str) -> DataFrame:
    """MIN/MAX of the split column inside the window (one row). Bounds only shape strides."""
    return batch.agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(F.lit(1)).alias("rows"))


# ---- JDBC ------------------------------------------------------------------

@dataclass(frozen=True)
class JdbcConnection:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    fetchsize: int = 10000

    @staticmethod
    def from_env(prefix: str = "TIDEMARK_JDBC_") -> "JdbcConnection":
        """URL, user, password and driver from environment variables only."""
        url = os.environ.get(prefix + "URL")
        if not url:
            raise KeyError(f"{prefix}URL is unset")
        return JdbcConnection(url, os.environ.get(prefix + "USER"), os.environ.get(prefix + "PASSWORD"),
                              os.environ.get(prefix + "DRIVER"))

    def options(self) -> dict[str, str]:
        o = {"url": self.url, "fetchsize": str(self.fetchsize)}
        for k in ("user", "password", "driver"):
            v = getattr(self, k)
            if v:
                o[k] = v
        return o


# Zone-less source times (DATETIME2) are read as ``timestamp_ntz``: filters against
# zone-less literals are then pushed as is, whatever the session zone.
READ_OPTIONS = {"preferTimestampNTZ": "true"}


def jdbc_reader_options(conn: JdbcConnection, table: str, bounds: tuple | None = None,
                        partition_column: str | None = None, num_partitions: int = 8) -> dict[str, str]:
    """Options of one JDBC read; split over ``num_partitions`` connections when the
    bounds are known and not degenerate, one connection otherwise."""
    o = conn.options() | READ_OPTIONS | {"dbtable": table}
    if partition_column and bounds and bounds[0] is not None and bounds[1] is not None and bounds[0] != bounds[1]:
        o |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(num_partitions),
        }
    return o


def read_jdbc_table(spark: SparkSession, conn: JdbcConnection, table: str, **extra) -> DataFrame:
    return spark.read.format("jdbc").options(**(conn.options() | READ_OPTIONS | {"dbtable": table} | extra)).load()


def source_bounds(spark: SparkSession, conn: JdbcConnection, spec: SourceSpec, watermark: datetime) -> tuple:
    """MIN/MAX of the split column in the window, computed *at the source*.

    The V1 JDBC reader does not push aggregates, so the bound query goes as
    a derived table; only one row comes back.
    """
    col = spec.partition_column
    where = f"{spec.watermark_column} > '{validate_watermark(watermark.strftime('%Y-%m-%d %H:%M:%S'))}'"
    where = " AND ".join([where, *scope_sql(pulled(spec))])
    q = f"(SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {spec.source_table} WHERE {where}) q"
    row = read_jdbc_table(spark, conn, q).collect()[0]
    return row[0], row[1]


def read_jdbc_incremental(spark: SparkSession, conn: JdbcConnection, spec: SourceSpec,
                          watermark: datetime) -> DataFrame:
    """Partitioned incremental pull: bounds at the source, then a split read
    whose watermark and scope are DataFrame filters pushed by Spark."""
    bounds = source_bounds(spark, conn, spec, watermark) if spec.partition_column else None
    opts = jdbc_reader_options(conn, spec.source_table, bounds, spec.partition_column, spec.num_partitions)
    src = spark.read.format("jdbc").options(**opts).load()
    return incremental_pull(src, spec, watermark)


def read_jdbc_even(spark: SparkSession, conn: JdbcConnection, spec: SourceSpec, watermark: datetime,
                   points: Sequence[int]) -> DataFrame:
    """The incremental pull in ranges of even size: one query per range of the split column,
    cut at ``points`` (``operators.splits``); watermark and scope are pushed as in the plain read."""
    props = {k: v for k, v in (conn.options() | READ_OPTIONS).items() if k != "url"}
    src = spark.read.jdbc(conn.url, spec.source_table, predicates=range_predicates(spec.partition_column, points), properties=props)
    return incremental_pull(src, spec, watermark)


def source_count(spark: SparkSession, conn: JdbcConnection, table_with_filter: str) -> int:
    """Row count computed at the source (a derived ``COUNT(*)`` table, one row back)."""
    return int(read_jdbc_table(spark, conn, f"(SELECT COUNT(*) AS cnt FROM {table_with_filter}) q").collect()[0][0])


def write_jdbc(df: DataFrame, conn: JdbcConnection, table: str, batchsize: int = 10000) -> None:
    df.write.format("jdbc").options(**(conn.options() | {"dbtable": table, "batchsize": str(batchsize)})).mode(
        "append").save()


def source_key_count(spark: SparkSession, conn: JdbcConnection, spec: SourceSpec) -> int:
    """Distinct in-scope keys, counted *at the source* (one row back), for reconciliation."""
    return source_count(spark, conn, key_count_table(spec))


def key_count_table(spec: SourceSpec) -> str:
    """The derived table that :func:`source_key_count` counts."""
    scope = scope_sql(spec)
    where = f" WHERE {' AND '.join(scope)}" if scope else ""
    return f"(SELECT DISTINCT {', '.join(spec.key)} FROM {spec.source_table}{where}) k"
