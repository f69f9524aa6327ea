"""The recurring jobs, composed from the library's steps.

``run_daily``: ingest every source (in parallel) -> build both reports from
bronze -> publish them as new versions -> run the declared checks on the
published tables and the bronze keys (staging too, on request), and the
freshness of every source, and store the results -> fail on a failing check
or a source older than the error threshold.

``run_reconciliation``: per source, distinct in-scope keys at the source
versus in bronze -> append to the reconciliation log -> fail on drift.

``run_maintenance``: per source, drop superseded versions past the
retention, Z-order the rest into right-sized files and publish it as the
new compacted base; readers see base + live tail.

Scheduling and retries stay with whatever runs these functions.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import DPD_BANDS, NO_DPD_LABEL, ReportConfig, SourceSpec
from tidemark.functions.expressions import ntz
from tidemark.operators import marts, quality as dq, reconcile, staging
from tidemark.plans import ingest
from tidemark.session import scratch_path
from tidemark.sources import bronze
from tidemark.sources.jdbc import scope_filter

PENETRATION = "mart_penetration_by_dpd_band"
PHONE = "mart_phone_quality"


def report_checks() -> dict[str, list[dq.Check]]:
    """The checks declared on the two reports."""
    bands = [b[2] for b in DPD_BANDS] + [NO_DPD_LABEL]
    return {
        PENETRATION: [
            dq.accepted_range("penetration_rate", 0, 1), dq.not_null("quantidade"), dq.accepted_range("sem_ac", 0),
            dq.not_null("dpd_faixa"), dq.accepted_values("dpd_faixa", bands),
            dq.not_null("paid"), dq.accepted_range("paid", 0), dq.not_null("ptp"), dq.accepted_range("ptp", 0),
            dq.not_null("cc"), dq.accepted_range("cc", 0),
            dq.unique_combination("client_id", "provider", "dpd_faixa")],
        PHONE: [
            dq.accepted_range("pct_failed", 0, 1), dq.accepted_range("pct_answered", 0, 1),
            dq.accepted_values("is_cleanup_candidate", [0, 1]),
            dq.unique_combination("client_id", "case_id", "telecom_id")],
    }


@dataclass
class DailyResult:
    rows_landed: dict[str, int]
    published: dict[str, str]
    failed_checks: list[str] = field(default_factory=list)
    stale_sources: list[str] = field(default_factory=list)


def source_freshness(spark: SparkSession, specs: Sequence[SourceSpec], base: str, now: datetime) -> DataFrame:
    """Newest ``ingest_ts`` of every bronze table against ``now`` (26 h warn, 48 h error)."""
    out = None
    for spec in specs:
        f = dq.freshness(newest_landings(spark, base, spec.table_name), "ingest_ts", now).select(
            F.lit(spec.table_name).alias("table_name"), "*")
        out = f if out is None else out.unionByName(f)
    return out


def newest_landings(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The rows of the newest landing day, which the landing log names: a partition filter, no
    look at other days' files. An ingest stamp and its day are of one run time, so the
    newest stamp is among them."""
    newest = bronze.landing_log(spark, base, table).agg(F.max("landed_at")).first()[0]
    live = bronze.read_bronze(spark, f"{base}/bronze/{table}", table)
    return live.filter(F.col("ingest_date") == F.lit(newest.date())) if newest else bronze.current_bronze(spark, base, table)


def stage(logs: dict[str, DataFrame], cfg: ReportConfig) -> dict[str, DataFrame]:
    """The four staging views, each deduplicated once and stored in the shared folder:
    reports and checks read these instead of deduplicating history again."""
    views = {"stg_cases": staging.stg_cases(logs["cases"], cfg),
             "stg_case_attributes": staging.stg_case_attributes(logs["case_attributes"], cfg),
             "stg_dialer": staging.stg_dialer(logs["dialer"], cfg),
             "stg_contacts": staging.stg_contacts(logs["contacts"], cfg)}
    return stored_together(views)


def stored_together(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Each stored once, as concurrent Spark jobs from driver threads."""
    with ThreadPoolExecutor(max_workers=max(1, len(frames)), thread_name_prefix="store") as pool:
        return dict(zip(frames, pool.map(lambda item: stored_once(item[1], item[0]), frames.items())))


def stored_once(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reports_from_staged(staged: dict[str, DataFrame], cfg: ReportConfig) -> dict[str, DataFrame]:
    return {
        PENETRATION: marts.penetration_from_staged(staged["stg_cases"], staged["stg_case_attributes"],
                                                   staged["stg_dialer"], staged["stg_contacts"], cfg),
        PHONE: marts.mart_phone_quality(staged["stg_dialer"], cfg),
    }


def build_reports(spark: SparkSession, base: str, cfg: ReportConfig) -> dict[str, DataFrame]:
    """Both reports from the bronze change logs under ``base``."""
    return reports_from_staged(stage({t: bronze.current_bronze(spark, base, t) for t in TABLES}, cfg), cfg)


TABLES = ("cases", "case_attributes", "dialer", "contacts")


def refresh_states(spark: SparkSession, specs: Sequence[SourceSpec], base: str, cfg: ReportConfig, now: datetime,
                   buckets: int | None = None) -> dict[str, DataFrame]:
    """Bring every latest-state table up to date with an availableNow tail of its bronze
    folder (the stream checkpoint remembers what was merged), then return the states."""
    from tidemark.schemas import BRONZE_SCHEMAS
    from tidemark.streaming.latest_state import tail_latest_state

    for spec in specs:
        t = spec.table_name
        tail_latest_state(spark, f"{base}/bronze/{t}", BRONZE_SCHEMAS[t], f"{base}/state", t, list(spec.key),
                          list(cfg.version_order), f"{base}/control/stream-{t}", now, buckets=buckets)
    return {spec.table_name: bronze.read_mart(spark, f"{base}/state", spec.table_name) for spec in specs}


def build_reports_from_state(states: dict[str, DataFrame], cfg: ReportConfig) -> dict[str, DataFrame]:
    """Both reports over latest-state tables: no history dedup at report time."""
    calls = staging.dialer_view(states["dialer"], cfg)
    return {
        PENETRATION: marts.penetration_from_staged(
            staging.cases_view(states["cases"], cfg), staging.attributes_view(states["case_attributes"], cfg),
            calls, staging.contacts_view(states["contacts"], cfg), cfg),
        PHONE: marts.mart_phone_quality(calls, cfg),
    }


def staging_checks() -> dict[str, list[dq.Check]]:
    """The checks declared on the four staging views."""
    return {
        "stg_cases": [dq.unique("case_id"), dq.not_null("case_id"), dq.not_null("client_id")],
        "stg_case_attributes": [dq.unique("case_id"), dq.not_null("case_id")],
        "stg_dialer": [dq.unique("uniqueid"), dq.not_null("uniqueid"), dq.not_null("case_id")],
        "stg_contacts": [dq.unique("contact_id"), dq.not_null("contact_id"), dq.not_null("case_id")],
    }


def run_daily(spark: SparkSession, specs: Sequence[SourceSpec], read: ingest.SourceReader, base: str,
              now: datetime, cfg: ReportConfig | None = None, fail_on_checks: bool = True,
              check_staging: bool = False, state_buckets: int | None = None,
              register_database: str | None = None) -> DailyResult:
    """The daily run. With ``state_buckets`` (0: as many as the state's bytes ask for), the
    reports are built from bucketed latest-state tables refreshed after the ingest (no
    history dedup at report time); without it, from the change logs, each deduplicated
    once. The report date is the run's, unless ``cfg`` names one. With
    ``register_database``, each bronze table is registered there after it has landed."""
    cfg = cfg or ReportConfig()
    cfg = cfg if cfg.as_of else replace(cfg, as_of=now.date())
    ingest.seed_for(specs, base, spark, now)
    rows = ingest.ingest_all(spark, specs, read, base, now, register_database=register_database)
    from_state = state_buckets is not None and {s.table_name for s in specs} >= set(TABLES)
    staged: dict[str, DataFrame] = {}
    if check_staging or not from_state:
        staged = stage({t: bronze.current_bronze(spark, base, t) for t in TABLES}, cfg)
    if from_state:
        reports = build_reports_from_state(refresh_states(spark, specs, base, cfg, now, state_buckets or None), cfg)
    else:
        reports = reports_from_staged(staged, cfg)
    published = {name: bronze.publish_mart(spark, df, f"{base}/marts", name, now) for name, df in reports.items()}
    checks = {name: (spark.read.parquet(path), report_checks()[name]) for name, path in published.items()}
    # Source keys are never NULL. Earlier landings were checked when they landed, so the newest
    # landing day is read, not all history.
    for spec in specs:
        checks[f"bronze.{spec.table_name}"] = (newest_landings(spark, base, spec.table_name),
                                               [dq.not_null(k) for k in spec.key])
    if check_staging:
        checks |= {name: (staged[name], declared) for name, declared in staging_checks().items()}
    # The verdict is read from the very rows this run stored, never looked up by time.
    results = dq.run_suite(checks).withColumn("checked_at", ntz(now))
    stored = bronze.append_rows(results, f"{base}/control/check_results")
    failed = dq.failed(spark.read.schema(results.schema).parquet(stored))
    fresh = source_freshness(spark, specs, base, now).withColumn("checked_at", ntz(now))
    stored = bronze.append_rows(fresh, f"{base}/control/freshness_results")
    stale = [f"{r.table_name}:{r.status}" for r in
             spark.read.schema(fresh.schema).parquet(stored).filter(F.col("status") != "pass").collect()]
    if fail_on_checks and (failed or any(x.endswith(":error") for x in stale)):
        raise ValueError(f"failing checks: {', '.join(failed + stale)}")
    return DailyResult(rows, published, failed, stale)


def run_reconciliation(spark: SparkSession, specs: Sequence[SourceSpec],
                       source_of: Callable[[SourceSpec], DataFrame] | None, base: str, now: datetime,
                       threshold: float = 0.005, fail_on_drift: bool = True,
                       source_counts: Callable[[SourceSpec], int] | None = None) -> DataFrame:
    """Distinct in-scope keys, source versus bronze, per source; logged, then raised on drift.

    ``source_counts`` (for example ``jdbc.source_key_count``) counts at the source, so
    no source row is shipped; otherwise ``source_of`` gives the source as a DataFrame.
    """
    targets = []
    for spec in specs:
        scope = scope_filter(spec)
        b = bronze.current_bronze(spark, base, spec.table_name)
        if source_counts is not None:
            targets.append(reconcile.Target(spec.table_name, None, b, spec.key, scope, source_counts(spec)))
        else:
            targets.append(reconcile.Target(spec.table_name, source_of(spec), b, spec.key, scope))
    result = reconcile.reconcile_counts(targets, threshold, checked_at=now)
    stored = reconcile.append_log(result, f"{base}/control/reconciliation_log")
    logged = spark.read.schema(result.schema).parquet(stored)
    if fail_on_drift:
        reconcile.raise_on_drift(logged, threshold)
    return logged


def run_maintenance(spark: SparkSession, specs: Sequence[SourceSpec], base: str, now: datetime,
                    cfg: ReportConfig = ReportConfig(), retention_hours: int = 168,
                    target_file_bytes: int = 256 << 20, bits: int | None = None) -> DataFrame:
    """Weekly housekeeping per source: superseded versions older than the retention are
    dropped, the rest is Z-ordered into files of about ``target_file_bytes`` and published
    as the new compacted base. Live bronze files are left in place; readers use
    ``bronze.current_bronze`` (compacted base + live tail). Returns a report.

    Which landings a base holds is a table of their ids. Only complete landings are taken,
    and whatever lands while this runs, or later with an earlier run time, stays in the tail.
    The pruned history is computed once and stored; key bounds, range sampling and the
    clustered write read it from there. Versions of the base and of the reports that were
    superseded longer ago than the retention are deleted.
    """
    from tidemark.operators import changelog, layout

    rows = []
    for spec in specs:
        t = spec.table_name
        landed = bronze.tail_landings(spark, base, t)
        held = bronze.published_version(spark, f"{base}/bronze_compacted", t)
        if not landed and held is None:
            continue
        snapshot = bronze.current_bronze(spark, base, t)
        if held is None:  # incomplete landings are not taken
            snapshot = snapshot.filter(F.col("ingest_batch").isin(landed))
        size = bronze.current_bronze_bytes(spark, base, t)
        before = snapshot.count()
        kept = stored_once(changelog.prune_superseded(snapshot, list(spec.key), list(cfg.version_order), "ingest_ts",
                                                      now, retention_hours), f"pruned-{t}")
        n_files = max(1, math.ceil(size / target_file_bytes))
        clustered = layout.cluster(kept, list(spec.zorder), n_files, bits) if spec.zorder else kept
        path = bronze.publish_base(spark, base, t, now, lambda p, df=clustered: df.write.mode("errorifexists").parquet(p), landed)
        after = spark.read.parquet(path).count()
        rows.append((t, int(before), int(after), path))
        bronze.expire_versions(spark, f"{base}/bronze_compacted", t, now, retention_hours)
    for mart in (PENETRATION, PHONE):
        bronze.expire_versions(spark, f"{base}/marts", mart, now, retention_hours)
    return spark.createDataFrame(rows, "table string, rows_before long, rows_after long, path string")
