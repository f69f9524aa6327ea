"""Keep a latest-state table up to date by tailing a bronze change log.

``readStream`` over the bronze folder with ``trigger(availableNow=True)``
processes every file that landed since the last run, then stops: the stream
checkpoint is the "what have I read" state, so a crashed run resumes where
it stopped. Each micro-batch is merged into the state with the change-log
rule (newest version per key wins, whichever side it is on, so late or
replayed files cannot move a key backwards) and published as a new version;
readers switch only when the pointer row is written.

Each state version is a Spark bucketed table (``bucketBy(n, keys)``). The merge
reads the state with its bucket partitioning, so only the micro-batch, which
is deduplicated and stored once, is shuffled: keys already in the state are
resolved by a left join that keeps the state's partitioning (and is written
back one file per bucket without another exchange); keys new to the state are
shuffled into their buckets and appended. The bucket count is kept in the
version's pointer and read back from there. Where another count is wanted (the
caller's, or the one that the state's bytes ask for), that merge deals the
whole state out anew.

With the state maintained, the reports can read one row per key instead of
deduplicating the whole history on every run.
"""

from __future__ import annotations

import hashlib
from datetime import datetime
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.changelog import latest_per_key
from tidemark.session import scratch_path
from tidemark.sources import bronze

STATE_DB = "tidemark_state"


# Bytes of a bucket of the state, and the fewest buckets.
BUCKET_BYTES, LEAST_BUCKETS = 256 << 20, 8


def wanted_buckets(state_bytes: int, stored: int | None) -> int:
    """Buckets for a state of that size: a power of two, and the stored count while it is
    within a factor of four of that."""
    fit = LEAST_BUCKETS
    while fit * BUCKET_BYTES < state_bytes:
        fit *= 2
    return stored if stored and fit <= 4 * stored and stored <= 4 * fit else fit


# ---- bucketed state ------------------------------------------------------------

def _table(path: str) -> str:
    return f"{STATE_DB}.s_{hashlib.sha1(path.encode()).hexdigest()[:16]}"


def _ensure_db(spark: SparkSession) -> None:
    """The catalog database of the state entries, located in the shared checkpoint folder
    (its tables are external, so nothing is written there but the folder itself)."""
    from tidemark.session import ensure_checkpoint_dir

    if not spark.catalog.databaseExists(STATE_DB):
        loc = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{STATE_DB}.db"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {STATE_DB} LOCATION '{loc}'")


def bucketed_table(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int) -> str:
    """Catalog entry (bucket spec included) for a state version folder; files carry
    their bucket id, so a new session can re-register an existing folder."""
    name = _table(path)
    _ensure_db(spark)
    if not spark.catalog.tableExists(name):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        cols = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING PARQUET CLUSTERED BY ({cols}) SORTED BY ({cols}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def _write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, mode: str) -> None:
    _ensure_db(df.sparkSession)
    (df.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet")
     .saveAsTable(_table(path)))


def merge_bucketed(state: DataFrame | None, latest: DataFrame, keys: Sequence[str], order: Sequence[str],
                   path: str, buckets: int) -> None:
    """Write the merged state to ``path`` as a bucketed table, shuffling only the batch
    (``latest``: its newest version per key, stored).

    The joins use plain equality on the key, which the bucket layout of the
    state satisfies. (A NULL-safe equality would be planned on derived keys and
    shuffle the state.) Rows with a NULL key, which a source primary key does
    not produce, take a small separate path: newest version among the state's
    and the batch's NULL-key rows.
    """
    if state is None:
        _write_bucketed(latest.repartition(buckets, *keys), path, keys, buckets, "errorifexists")
        return
    cols = state.columns
    latest = latest.select(*cols)
    has_null = None
    for k in keys:
        c = F.col(k).isNull()
        has_null = c if has_null is None else (has_null | c)
    null_rows = latest_per_key(state.filter(has_null).unionByName(latest.filter(has_null)), keys, order)
    latest = latest.filter(~has_null)
    keyed_state = state.filter(~has_null)  # a filter keeps the bucketed scan's partitioning

    b = latest.select(*[F.col(c).alias(f"__b_{c}") for c in cols], F.lit(True).alias("__b_present"))
    on = [keyed_state[k] == b[f"__b_{k}"] for k in keys]
    joined = keyed_state.join(b, on, "left")
    theirs = F.struct(*[F.col(f"__b_{c}").alias(c) for c in order])
    ours = F.struct(*[F.col(c).alias(c) for c in order])
    newer = F.col("__b_present").isNotNull() & (theirs > ours)
    kept = joined.select(*[F.when(newer, F.col(f"__b_{c}")).otherwise(F.col(c)).alias(c) for c in cols])
    _write_bucketed(kept, path, keys, buckets, "errorifexists")
    fresh = latest.join(keyed_state.select(*keys), list(keys), "left_anti").select(*cols).unionByName(null_rows)
    _write_bucketed(fresh.repartition(buckets, *keys), path, keys, buckets, "append")


def read_state(spark: SparkSession, state_base: str, name: str, schema: StructType | None = None,
               keys: Sequence[str] = ()) -> DataFrame | None:
    """The state in force: with its bucketing, of the stored count, if ``schema`` and ``keys``
    are given."""
    cur = bronze.newest_pointer(spark, state_base, name)
    if cur is None:
        return None
    if cur["buckets"] and schema is not None:
        return spark.table(bucketed_table(spark, cur["path"], schema, keys, cur["buckets"]))
    return spark.read.parquet(cur["path"])


def tail_latest_state(spark: SparkSession, bronze_path: str, schema: StructType, state_base: str, name: str,
                      keys: Sequence[str], order: Sequence[str], checkpoint: str,
                      now: datetime | None = None, buckets: int | None = None) -> int:
    """Run the tail until the folder is drained; returns the number of micro-batches.
    ``buckets``: None for as many as the state's bytes ask for."""
    seen = {"batches": 0}
    state_schema = StructType([f for f in schema.fields if f.name not in bronze.BRONZE_PARTITIONS])

    def merge(batch_df: DataFrame, batch_id: int) -> None:
        when = now or datetime.now()
        newest = scratch_path(spark, f"state-batch-{name}")
        latest_per_key(batch_df.drop(*bronze.BRONZE_PARTITIONS), keys, order).write.parquet(newest)
        latest = spark.read.schema(state_schema).parquet(newest)
        cur = bronze.newest_pointer(spark, state_base, name)
        stored = cur["buckets"] if cur else None
        held = bronze.folder_bytes(spark, cur["path"] if cur else newest)
        count = buckets or wanted_buckets(held, stored)
        if stored == count:
            state = read_state(spark, state_base, name, state_schema, keys)
            write = lambda path: merge_bucketed(state, latest, keys, order, path, count)
        else:  # none yet, or of another count: dealt out anew
            rows = latest if cur is None else latest_per_key(
                read_state(spark, state_base, name).unionByName(latest), keys, order)
            write = lambda path: merge_bucketed(None, rows, keys, order, path, count)
        new_path = bronze.publish_mart(spark, None, state_base, name, when, write=write, buckets=count)
        # The catalog entries only serve the merge's bucketed read; they are external
        # tables, so dropping them keeps the files and leaves the catalog clean.
        for p in ([cur["path"]] if cur else []) + [new_path]:
            spark.sql(f"DROP TABLE IF EXISTS {_table(p)}")
        seen["batches"] += 1

    q = (spark.readStream.schema(schema).parquet(bronze_path)
         .writeStream.foreachBatch(merge)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return seen["batches"]
