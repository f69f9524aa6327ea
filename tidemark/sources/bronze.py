"""Bronze change-log tables and published marts on plain parquet.

* Bronze is append-only and partitioned by ``ingest_date`` and landing; a batch's row
  count and maximum watermark are observed during its write.
* Small logs (control rows, pointers, check and reconciliation results) are
  appended one sub-folder per append: every append is its own commit, so
  parallel jobs never share a temporary folder.
* A mart is never overwritten in place: each build goes to a new version
  directory and a pointer row is appended afterwards. Readers take the
  newest published version, so a reader never sees a half-written mart and
  a crash before the pointer leaves the previous version in force.
* Maintenance publishes compacted bronze the same way; ``current_bronze``
  reads the compacted base plus the live rows landed after it.
"""

from __future__ import annotations

import re
import uuid
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import BRONZE_SCHEMAS

#: Bronze folders: the landing's day, then its id.
BRONZE_PARTITIONS = ("ingest_date", "ingest_batch")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` from the file system's content summary (no Spark job)."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove_folders(spark: SparkSession, path: str, names: list[str]) -> None:
    for name in names:
        fs, p = _fs(spark, f"{path}/{name}")
        fs.delete(p, True)


def append_rows(df: DataFrame, path: str, mode: str = "errorifexists", prefix: str = "run") -> str:
    """Append a small table of rows as its own sub-folder of ``path``.

    Every append is an independent commit: concurrent writers never share a
    temporary folder (appending into one folder from parallel jobs does), and
    a failed append leaves no partial rows behind.
    """
    sub = f"{path.rstrip('/')}/{prefix}-{datetime.now(timezone.utc):%Y%m%d%H%M%S}-{uuid.uuid4().hex[:12]}"
    df.coalesce(1).write.mode(mode).parquet(sub)
    return sub


def read_appended(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows appended with :func:`append_rows` (an empty table if none)."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def ensure_empty_table(spark: SparkSession, path: str, schema: StructType,
                       partition_by: tuple[str, ...] = BRONZE_PARTITIONS) -> None:
    """Create an empty typed table so readers resolve it before the first batch lands."""
    if exists(spark, path):
        return
    w = spark.createDataFrame([], schema).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_batch(batch: DataFrame, path: str, stats_cols: dict[str, "F.Column"] | None = None,
                 partition_by: tuple[str, ...] = BRONZE_PARTITIONS, max_records_per_file: int | None = None) -> dict:
    """Append one batch and return its statistics, gathered during the write.

    The statistics (row count, max watermark, ...) come from an
    ``Observation`` on the write itself, so the batch is read from the source
    exactly once, without caching it.
    """
    obs = Observation("batch_stats")
    metrics = {"row_count": F.count(F.lit(1))} | (stats_cols or {})
    observed = batch.observe(obs, *[c.alias(n) for n, c in metrics.items()])
    w = observed.write.mode("append").partitionBy(*[c for c in partition_by if c in batch.columns])
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))  # caps file size of a large batch
    w.parquet(path)
    return obs.get


def read_bronze(spark: SparkSession, path: str, table_name: str | None = None, merge_schema: bool = False) -> DataFrame:
    """A bronze folder. ``merge_schema`` takes the columns of all its files (a source that grew
    columns) instead of the declared ones."""
    if merge_schema:
        return spark.read.option("mergeSchema", "true").parquet(path)
    schema = BRONZE_SCHEMAS.get(table_name) if table_name else None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def register_table(spark: SparkSession, database: str, table_name: str, path: str,
                   partitioned: bool = True, database_location: str | None = None,
                   landed: tuple[date, str] | None = None) -> None:
    """Expose a bronze path as ``database.table_name`` in the session catalog (an external
    table; the database is created if missing, at ``database_location`` when given).

    ``landed`` is the day and id of a landing: a table that exists already gets just this
    partition, without a listing of all folders."""
    name = f"`{database}`.`{table_name}`"
    if landed and spark.catalog.databaseExists(database) and spark.catalog.tableExists(f"{database}.{table_name}"):
        day, batch = landed
        if re.fullmatch(r"[0-9A-Za-z_-]+", batch) is None:
            raise ValueError(f"not a landing id: {batch!r}")
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (ingest_date=DATE'{day:%Y-%m-%d}', ingest_batch='{batch}')")
        return
    loc = f" LOCATION '{database_location}'" if database_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")
    schema = read_bronze(spark, path, table_name).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    columns = [c for c in BRONZE_PARTITIONS if partitioned and c in schema.fieldNames()]
    part = f" PARTITIONED BY ({', '.join(columns)})" if columns else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING PARQUET{part} LOCATION '{path}'")
    if part:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


# ---- versioned marts ---------------------------------------------------------

# ``buckets``: for a bucketed state, its bucket count. ``id`` orders publishers that race for one
# version number.
_POINTER_SCHEMA = "mart string, version long, path string, published_at timestamp_ntz, buckets int, id string"


def newest_pointer(spark: SparkSession, base: str, mart: str):
    ptr = f"{base}/_pointers"
    if not exists(spark, ptr):
        return None
    return (read_appended(spark, ptr, _POINTER_SCHEMA).filter(F.col("mart") == mart)
            .agg(F.max_by(F.struct("version", "path", "buckets"),
                          F.struct("version", "published_at", "id")).alias("v")).collect()[0]["v"])


def published_version(spark: SparkSession, base: str, mart: str) -> tuple[int, str] | None:
    row = newest_pointer(spark, base, mart)
    return (row["version"], row["path"]) if row else None


def publish_mart(spark: SparkSession, df: DataFrame | None, base: str, mart: str, now: datetime,
                 write=None, buckets: int | None = None) -> str:
    """Write version N+1 of ``mart`` (``df``, or whatever ``write(path)`` writes) and then
    publish it with a pointer row."""
    cur = published_version(spark, base, mart)
    version = (cur[0] if cur else 0) + 1
    # A unique folder: a run that died after writing but before publishing leaves
    # an unreferenced folder behind, which never blocks the retry.
    path = f"{base}/{mart}/v={version}-{uuid.uuid4().hex[:8]}"
    if write is not None:
        write(path)
    else:
        df.write.mode("errorifexists").parquet(path)
    append_rows(spark.createDataFrame([(mart, version, path, now, buckets, uuid.uuid4().hex)],
                                      _POINTER_SCHEMA), f"{base}/_pointers")
    return path


def expire_versions(spark: SparkSession, base: str, mart: str, now: datetime, retention_hours: int = 168) -> list[str]:
    """Delete version folders of ``mart`` that were superseded more than ``retention_hours`` (a
    week at least) before ``now``; returns them. A version's age counts from the publication
    of the next one, however old the version itself is, so whoever opened it while it was
    in force can go on reading. Folders that were never published go by their write time."""
    if retention_hours < 168:
        raise ValueError(f"retention {retention_hours} h is below the 168 h minimum")
    fs, folder = _fs(spark, f"{base}/{mart}")
    there = {s.getPath().getName(): s for s in (fs.listStatus(folder) if fs.exists(folder) else []) if s.getPath().getName().startswith("v=")}
    if published_version(spark, base, mart) is None or not there:
        return []
    name = F.element_at(F.split("path", "/"), -1)
    order = Window.partitionBy("mart").orderBy("version", "published_at", "id")  # one row a publication
    pointers = (read_appended(spark, f"{base}/_pointers", _POINTER_SCHEMA).where(F.col("mart") == mart)
                .select(name.alias("name"), F.lead("published_at").over(order).alias("superseded"), F.lead("version").over(order).alias("next")))
    since = {r["name"]: r for r in pointers.where(F.col("name").isin(list(there))).collect()}
    # File times are instants; ``now`` is a zone-less run time, taken as UTC.
    limit = now - timedelta(hours=retention_hours)
    gone = []
    for version, status in there.items():
        row = since.get(version)
        if row is None:
            old = status.getModificationTime() < limit.replace(tzinfo=timezone.utc).timestamp() * 1000
        else:
            old = row["next"] is not None and row["superseded"] < limit
        if old:
            fs.delete(status.getPath(), True)
            gone.append(version)
    return gone


def read_mart(spark: SparkSession, base: str, mart: str) -> DataFrame:
    cur = published_version(spark, base, mart)
    if cur is None:
        raise FileNotFoundError(f"mart {mart} has no published version under {base}")
    return spark.read.parquet(cur[1])


# ---- compacted bronze: published base + live tail ---------------------------------

def current_bronze(spark: SparkSession, base: str, table_name: str) -> DataFrame:
    """The whole change log of ``table_name``: the newest compacted version (if any) plus
    the landings that have come since, whatever their run time. The tail is a filter on the
    partition column ``ingest_batch``, so only those landings' folders are read."""
    live = read_bronze(spark, f"{base}/bronze/{table_name}", table_name)
    row = newest_pointer(spark, f"{base}/bronze_compacted", table_name)
    if row is None:
        return live
    tail = live.filter(F.col("ingest_batch").isin(tail_landings(spark, base, table_name)))
    compacted = spark.read.schema(BRONZE_SCHEMAS[table_name]).parquet(row["path"]) \
        if table_name in BRONZE_SCHEMAS else spark.read.parquet(row["path"])
    return compacted.unionByName(tail)


_LANDING_SCHEMA = "table_name string, ingest_batch string, rows long, landed_at timestamp_ntz, sketch binary"


def record_landing(spark: SparkSession, base: str, table_name: str, batch_id: str, rows: int, now: datetime,
                   sketch: bytes | None = None) -> None:
    """Note that a landing is complete: maintenance takes only these into the base. ``sketch``
    sums up its split column, for even splits of the next read."""
    append_rows(spark.createDataFrame([(table_name, batch_id, rows, now, sketch)], _LANDING_SCHEMA), f"{base}/control/landings")


def landing_log(spark: SparkSession, base: str, table_name: str) -> DataFrame:
    """Complete landings with rows: ``ingest_batch``, ``rows``, ``landed_at``, ``sketch``."""
    log = read_appended(spark, f"{base}/control/landings", _LANDING_SCHEMA)
    return log.filter((F.col("table_name") == table_name) & (F.col("rows") > 0)).drop("table_name")


def landed_split_points(spark: SparkSession, base: str, table_name: str, ranges: int) -> list[int]:
    """Where to cut the next read of the source into even ranges, by all that has landed."""
    from tidemark.operators import splits

    return splits.split_points(splits.merged(landing_log(spark, base, table_name).select("sketch")), ranges)


_COVERED_SCHEMA = "table_name string, version long, ingest_batch string"


def tail_landings(spark: SparkSession, base: str, table_name: str) -> list[str]:
    """Ids of the complete landings that the compacted base in force doesn't hold: those since
    the last maintenance, however many there have ever been. Rows of a landing that was not
    completed are read again by the next run."""
    row = newest_pointer(spark, f"{base}/bronze_compacted", table_name)
    log = landing_log(spark, base, table_name).select("ingest_batch")
    if row is not None:
        held = read_appended(spark, f"{base}/control/covered", _COVERED_SCHEMA)
        held = held.where((F.col("table_name") == table_name) & (F.col("version") <= row["version"]))
        log = log.join(held.select("ingest_batch"), "ingest_batch", "left_anti")
    return sorted(r["ingest_batch"] for r in log.distinct().collect())


def publish_base(spark: SparkSession, base: str, table_name: str, now: datetime, write, landed: list[str]) -> str:
    """Publish a compacted base that holds what the one before held, and the ``landed`` tail.
    Its landings are noted under its version before it is in force; readers go by the
    version in force, so a run that dies in between changes nothing for them."""
    cur = published_version(spark, f"{base}/bronze_compacted", table_name)
    version = (cur[0] if cur else 0) + 1
    if landed:
        append_rows(spark.createDataFrame([(table_name, version, b) for b in landed], _COVERED_SCHEMA), f"{base}/control/covered")
    return publish_mart(spark, None, f"{base}/bronze_compacted", table_name, now, write=write)


def current_bronze_bytes(spark: SparkSession, base: str, table_name: str) -> int:
    """Bytes of the compacted base in force plus those of the landings since."""
    row = newest_pointer(spark, f"{base}/bronze_compacted", table_name)
    live = f"{base}/bronze/{table_name}"
    if row is None:
        return folder_bytes(spark, live)
    fs, _ = _fs(spark, live)
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = [s for b in tail_landings(spark, base, table_name) for s in fs.globStatus(to_path(f"{live}/ingest_date=*/ingest_batch={b}")) or []]
    return folder_bytes(spark, row["path"]) + sum(int(fs.getContentSummary(s.getPath()).getLength()) for s in found)
