"""The control log: one appended row per run and source, never updated in place.

The current watermark of a source is ``max(last_watermark)`` over its rows, so
it can only move forward, and four ingests running at once never contend for
one row (each appends its own file). The latest status is the status of the
newest row. Old runs are folded to one row per table and kept in a history table.
"""

from __future__ import annotations

import logging
from datetime import datetime, timedelta
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.config import SEED_WATERMARK
from tidemark.functions.expressions import failure_status, lagged_watermark, ntz, watermark_text
from tidemark.schemas import CONTROL_SCHEMA
from tidemark.sources import bronze

log = logging.getLogger(__name__)


def read_control(spark: SparkSession, path: str) -> DataFrame:
    return bronze.read_appended(spark, path, CONTROL_SCHEMA)


#: Runs that lie in the log one by one before they are folded.
FOLD_RUNS = 256
HISTORY_SCHEMA = StructType([*CONTROL_SCHEMA.fields, StructField("run", StringType(), True)])


def _named(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the log with ``run``, the append they came with."""
    run = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("run")
    return bronze.read_appended(spark, path, CONTROL_SCHEMA).select("*", run)


def fold_control(spark: SparkSession, path: str) -> int:
    """Fold the log: one row per table for all runs so far, which then move to a table of
    their own (``{path}_history``). Returns how many appends were removed.

    The log's newest state is a maximum, so a run that is counted in a folded row and still
    lies beside it changes nothing: runs are removed one fold after they were folded, so
    that whoever listed the log before can go on reading, and a fold that dies half-way is
    made good by the next. Reading the log costs the runs since the fold before last,
    however many there have ever been."""
    if not bronze.exists(spark, path):
        return 0
    names = bronze.folder_names(spark, path)
    known = bronze.read_appended(spark, f"{path}_history", HISTORY_SCHEMA).select("run").distinct()
    there = spark.createDataFrame([(n,) for n in names], "run string")
    earlier = [r["run"] for r in there.join(known, "run", "left_semi").collect()]  # folded before; names in the folder only
    rows = _named(spark, path).where(F.col("run").startswith("run-"))
    bronze.append_rows(rows.join(known, "run", "left_anti"), f"{path}_history")
    folded = current_watermark(read_control(spark, path)).select(*CONTROL_SCHEMA.names)
    bronze.append_rows(folded, path, prefix="fold")
    gone = [n for n in names if n.startswith("fold-")] + [n for n in earlier if n.startswith("run-")]
    bronze.remove_folders(spark, path, gone)
    return len(gone)


def fold_if_long(spark: SparkSession, path: str, most: int = FOLD_RUNS) -> int:
    """Fold a log of more than ``most`` appends."""
    return fold_control(spark, path) if bronze.exists(spark, path) and len(bronze.folder_names(spark, path)) > most else 0


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Every run's row: those folded away, and those that the log still holds."""
    history = bronze.read_appended(spark, f"{path}_history", HISTORY_SCHEMA)
    if not bronze.exists(spark, path):
        return history.drop("run")
    rows = _named(spark, path).where(F.col("run").startswith("run-"))
    return history.unionByName(rows.join(history.select("run").distinct(), "run", "left_anti")).drop("run")


def append_control(spark: SparkSession, path: str, rows: Iterable[tuple]) -> None:
    """One run's rows as their own commit (parallel ingests never share a folder)."""
    bronze.append_rows(spark.createDataFrame(list(rows), CONTROL_SCHEMA), path)


def seed_rows(tables: DataFrame, as_of: datetime, watermark: datetime = SEED_WATERMARK) -> DataFrame:
    """Seed rows ``initialized`` at ``watermark`` for a DataFrame of ``table_name``s."""
    return tables.select(
        F.col("table_name").cast("string"),
        ntz(watermark).alias("last_watermark"),
        F.lit(0).cast("long").alias("rows_processed"),
        ntz(as_of).alias("updated_at"),
        F.lit("initialized").alias("run_status"),
    )


def seed_control(spark: SparkSession, path: str, tables: list[str], as_of: datetime) -> bool:
    """Create the log with one seed row per table, only if absent. Returns True if created."""
    if bronze.exists(spark, path):
        return False
    bronze.append_rows(seed_rows(spark.createDataFrame([(t,) for t in tables], "table_name string"), as_of), path)
    return True


def current_watermark(control: DataFrame) -> DataFrame:
    """Per table: forward-only watermark, and rows / status / time of the newest run."""
    newest = F.struct("updated_at", "last_watermark")
    return control.groupBy("table_name").agg(
        F.max("last_watermark").alias("last_watermark"),
        F.max_by("rows_processed", newest).alias("rows_processed"),
        F.max("updated_at").alias("updated_at"),
        F.max_by("run_status", newest).alias("run_status"),
    )


def watermark_history(control: DataFrame) -> DataFrame:
    """Every run with the watermark in force after it (running max per table; of one
    time's runs, the lower watermark first)."""
    return running_max(control, ["updated_at", "last_watermark", "rows_processed", "run_status"]).select(
        "table_name", "updated_at", "rows_processed", "run_status",
        F.col("last_watermark").alias("recorded_watermark"),
        F.greatest("last_watermark", "before").alias("effective_watermark"),
    )


def running_max(runs: DataFrame, order: list[str], days: int = 30) -> DataFrame:
    """``runs`` with ``before``, the highest ``last_watermark`` of the table's earlier runs.

    In two levels, so that no task holds all runs of a table: the highest of the earlier
    runs of a run's own ``days``-day block, and that of all blocks before, from one row
    per block."""
    block = F.floor(F.datediff(F.to_date(F.col(order[0])), F.lit("1970-01-01").cast("date")) / days).alias("_block")
    blocked = runs.select("*", block)
    own = Window.partitionBy("table_name", "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("table_name").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (blocked.groupBy("table_name", "_block").agg(F.max("last_watermark").alias("_top"))
              .select("table_name", "_block", F.max("_top").over(earlier).alias("_blocks_before")))
    return (blocked.withColumn("_own", F.max("last_watermark").over(own)).join(blocks, ["table_name", "_block"])
            .withColumn("before", F.greatest("_own", "_blocks_before")).drop("_block", "_own", "_blocks_before"))


def watermark_with_lag(current: DataFrame, lag_minutes: int) -> DataFrame:
    """Per table: the read watermark, rewound by the lag, floored at the seed, as text."""
    return current.select(
        "table_name",
        watermark_text(lagged_watermark("last_watermark", lag_minutes)).alias("read_from"),
    )


def _current_value(spark: SparkSession, path: str, table_name: str) -> datetime:
    row = (read_control(spark, path).filter(F.col("table_name") == table_name)
           .agg(F.max("last_watermark").alias("wm")).collect()[0])
    return row["wm"] or SEED_WATERMARK


def get_watermark(spark: SparkSession, path: str, table_name: str, lag_minutes: int = 0) -> str:
    """Stored watermark of one table as ``YYYY-MM-DD HH:MM:SS``; the seed if unknown."""
    wm = _current_value(spark, path, table_name)
    if lag_minutes:
        wm = max(wm - timedelta(minutes=lag_minutes), SEED_WATERMARK)
    return wm.replace(microsecond=0).strftime("%Y-%m-%d %H:%M:%S")


def update_watermark(spark: SparkSession, path: str, table_name: str, batch_max: datetime | None,
                     row_count: int, now: datetime, status: str = "success") -> datetime:
    """Record a run. An empty batch records ``success`` at the old watermark (so a
    previous failure does not linger); a batch older than the watermark holds it.
    """
    current = _current_value(spark, path, table_name)
    if not row_count or batch_max is None:
        new, rows = current, 0
    else:
        if batch_max < current:
            log.warning("%s: batch max %s is older than the watermark %s; watermark held", table_name,
                        batch_max, current)
        new, rows = max(batch_max, current), int(row_count)
    append_control(spark, path, [(table_name, new, rows, now, status)])
    return new


def mark_failed(spark: SparkSession, path: str, table_name: str, error_msg: str, now: datetime) -> None:
    """Record a failure; the watermark stays; an unknown table gets the seed."""
    current = _current_value(spark, path, table_name)
    append_control(spark, path, [(table_name, current, 0, now, f"failed: {str(error_msg)[:200]}")])


def failure_rows(runs: DataFrame, msg_col: str, now: datetime) -> DataFrame:
    """Column form of :func:`mark_failed` for a table of (table_name, last_watermark, message)."""
    return runs.select(
        "table_name",
        F.coalesce("last_watermark", ntz(SEED_WATERMARK)).alias("last_watermark"),
        F.lit(0).cast("long").alias("rows_processed"),
        ntz(now).alias("updated_at"),
        failure_status(msg_col).alias("run_status"),
    )
