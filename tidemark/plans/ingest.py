"""Ingest one source into its bronze change log and advance the control log.

Order of steps: read watermark (rewound by the overlap lag) -> incremental
pull -> stamp -> append, gathering count and max watermark during the write
-> register -> advance. On error the failure is recorded and the *original*
error re-raised, even when recording fails too.

A crash between the append and the control row re-reads the batch on the
next run; the dedup in staging absorbs the repeat.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import SourceSpec
from tidemark.functions.expressions import ntz
from tidemark.operators.splits import sketch_of
from tidemark.plans import control
from tidemark.schemas import BRONZE_SCHEMAS
from tidemark.sources import bronze
from tidemark.sources.jdbc import incremental_pull

SourceReader = Callable[[SourceSpec, datetime], DataFrame]


def stamp(batch: DataFrame, now: datetime, seq_cols: list[str], sequence_column: str | None = None,
          batch_id: str = "") -> DataFrame:
    """Ingest stamps as literals (stable across task retries), plus ``ingest_seq``,
    which orders versions totally when ``update_date`` and ``ingest_ts`` tie: the
    source's own sequence when there is one, else a hash of the row."""
    seq = F.col(sequence_column).cast("long") if sequence_column else F.xxhash64(*seq_cols)
    return batch.withColumns({
        "ingest_ts": ntz(now),
        "ingest_date": F.lit(now.date()),
        "ingest_seq": seq,
        "ingest_batch": F.lit(batch_id),
    })


def ingest_source(spark: SparkSession, spec: SourceSpec, read: SourceReader, base: str, now: datetime,
                  register_database: str | None = None) -> int:
    """Pull one incremental batch into ``{base}/bronze/{table}`` and advance the watermark."""
    control_path = f"{base}/control/watermarks"
    bronze_path = f"{base}/bronze/{spec.table_name}"
    try:
        text = control.get_watermark(spark, control_path, spec.table_name, lag_minutes=spec.lag_minutes)
        watermark = datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
        batch_id = uuid.uuid4().hex
        batch = stamp(read(spec, watermark), now, list(spec.columns), spec.sequence_column, batch_id)
        if spec.table_name in BRONZE_SCHEMAS:
            batch = batch.select(*[F.col(f.name).cast(f.dataType) for f in BRONZE_SCHEMAS[spec.table_name].fields])
        gathered = {"batch_max": F.max(spec.watermark_column)}
        if spec.partition_column:
            gathered["sketch"] = sketch_of(spec.partition_column)
        stats = bronze.append_batch(batch, bronze_path, gathered, max_records_per_file=spec.max_records_per_file)
        rows = int(stats["row_count"])
        bronze.record_landing(spark, base, spec.table_name, batch_id, rows, now, stats.get("sketch"))
        if register_database and rows:
            bronze.register_table(spark, register_database, spec.table_name, bronze_path, landed=(now.date(), batch_id))
        control.update_watermark(spark, control_path, spec.table_name, stats["batch_max"], rows, now)
        return rows
    except Exception as exc:
        try:
            control.mark_failed(spark, control_path, spec.table_name, str(exc), now)
        except Exception as record_exc:  # keep the original error in front
            raise exc from record_exc
        raise


def ingest_all(spark: SparkSession, specs, read: SourceReader, base: str, now: datetime,
               parallel: bool = True, register_database: str | None = None) -> dict[str, int]:
    """Ingest every source; returns rows landed per table.

    Sources run as concurrent Spark jobs from driver threads: each appends
    only its own bronze files and its own control rows, so they never
    contend. The first failure is raised after all sources finished (each
    failure is recorded in the control log by ``ingest_source``).
    """
    specs = list(specs)
    if not parallel or len(specs) < 2:
        return {s.table_name: ingest_source(spark, s, read, base, now, register_database) for s in specs}
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(specs), thread_name_prefix="ingest") as pool:
        futures = {s.table_name: pool.submit(ingest_source, spark, s, read, base, now, register_database) for s in specs}
    errors = [f.exception() for f in futures.values() if f.exception() is not None]
    if errors:
        raise errors[0]
    return {name: f.result() for name, f in futures.items()}


def dataframe_reader(sources: dict[str, DataFrame]) -> SourceReader:
    """A reader over DataFrames standing in for source tables (parquet, JDBC, ...)."""
    def read(spec: SourceSpec, watermark: datetime) -> DataFrame:
        return incremental_pull(sources[spec.table_name], spec, watermark)
    return read


def seed_for(specs, base: str, spark: SparkSession, now: datetime) -> None:
    """Control seed rows and empty typed bronze tables (first batch may be empty); a long
    control log is folded."""
    control.fold_if_long(spark, f"{base}/control/watermarks")
    control.seed_control(spark, f"{base}/control/watermarks", [s.table_name for s in specs],
                         now - timedelta(days=1))
    for s in specs:
        if s.table_name in BRONZE_SCHEMAS:
            bronze.ensure_empty_table(spark, f"{base}/bronze/{s.table_name}", BRONZE_SCHEMAS[s.table_name])


__all__ = ["ingest_source", "ingest_all", "dataframe_reader", "seed_for", "stamp"]
