"""Catalogue: declared data checks, freshness and reconciliation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import changelog, marts, reconcile, staging
from tidemark.operators import quality as dq
from tidemark.plans import jobs
from tidemark.plans.catalog.common import CFG, _KEYS, _scope, query
from tidemark.sources import fixtures as fx


# ---- data quality --------------------------------------------------------------

# Declared checks per model (plain data; the oracle reads the same list).
DQ_DECLARATIONS: dict[str, list] = {
    "bronze.cases": [dq.not_null("case_id")],
    "bronze.case_attributes": [dq.not_null("case_id")],
    "bronze.dialer": [dq.not_null("uniqueid")],
    "bronze.contacts": [dq.not_null("contact_id")],
    **jobs.staging_checks(),
    **jobs.report_checks(),
    # Inputs that do fail: repeated customers per order, missing attribute values.
    "orders": [dq.unique("o_custkey"), dq.not_null("o_custkey")],
    "latest_attribute": [dq.not_null("case_attribute_value")],
}


def _dq_frames(spark, d, wanted):
    """Model -> thunk building its DataFrame. The staging views that the ``wanted`` models need
    are deduplicated once, stored in the shared folder side by side and read from there by
    their own checks and by the reports."""
    memo: dict = {}

    def once(name, build):
        if name not in memo:
            memo[name] = build()
        return memo[name]

    def log(t):
        return once(f"log.{t}", lambda: fx.LOGS[t](spark, d))

    builds = {"stg_cases": (staging.stg_cases, "cases"), "stg_case_attributes": (staging.stg_case_attributes, "case_attributes"),
              "stg_dialer": (staging.stg_dialer, "dialer"), "stg_contacts": (staging.stg_contacts, "contacts")}
    # what the wanted models are built from, stored together
    needed = [s for s in builds if s in wanted or "mart_penetration_by_dpd_band" in wanted or (s == "stg_dialer" and "mart_phone_quality" in wanted)]
    memo |= jobs.stored_together({s: builds[s][0](log(builds[s][1]), CFG) for s in needed})

    def stg(name):
        return memo[name]

    return {
        "bronze.cases": lambda: log("cases"),
        "bronze.case_attributes": lambda: log("case_attributes"),
        "bronze.dialer": lambda: log("dialer"),
        "bronze.contacts": lambda: log("contacts"),
        "stg_cases": lambda: stg("stg_cases"),
        "stg_case_attributes": lambda: stg("stg_case_attributes"),
        "stg_dialer": lambda: stg("stg_dialer"),
        "stg_contacts": lambda: stg("stg_contacts"),
        "mart_penetration_by_dpd_band": lambda: marts.penetration_from_staged(
            stg("stg_cases"), stg("stg_case_attributes"), stg("stg_dialer"), stg("stg_contacts"), CFG),
        "mart_phone_quality": lambda: marts.mart_phone_quality(stg("stg_dialer"), CFG),
        "orders": lambda: fx.table(spark, d, "orders"),
        "latest_attribute": lambda: staging.latest_attribute(log("case_attributes"), CFG),
    }


def _dq_kind(spark, d, kinds=None):
    """The declared checks of the given kinds (all when ``kinds`` is None), one result table."""
    chosen = {m: [c for c in checks if kinds is None or c.kind in kinds] for m, checks in DQ_DECLARATIONS.items()}
    chosen = {m: checks for m, checks in chosen.items() if checks}
    frames = _dq_frames(spark, d, chosen.keys())
    return dq.run_suite({m: (frames[m](), checks) for m, checks in chosen.items()})


@query
def dq_not_null(spark, d):
    return _dq_kind(spark, d, {"not_null"})


@query
def dq_unique(spark, d):
    return _dq_kind(spark, d, {"unique"})


@query
def dq_accepted_values(spark, d):
    return _dq_kind(spark, d, {"accepted_values"})


@query
def dq_accepted_range(spark, d):
    return _dq_kind(spark, d, {"accepted_range"})


@query
def dq_unique_combination(spark, d):
    return _dq_kind(spark, d, {"unique_combination"})


@query
def dq_report(spark, d):
    """Every declared check in one result, one pass per table."""
    return _dq_kind(spark, d)


FRESHNESS_AS_OF = datetime(2024, 2, 1, 0, 0, 0)


@query
def dq_freshness(spark, d):
    """Newest update of each of the four tables, and newest event per type, against the
    as-of: pass / warn / error."""
    parts = [dq.freshness(log(spark, d), "update_date", FRESHNESS_AS_OF).select(F.lit(t).alias("table_name"), "*")
             for t, log in fx.LOGS.items()]
    parts.append(dq.freshness(fx.table(spark, d, "events"), "ts", FRESHNESS_AS_OF, ["event_type"])
                 .withColumnRenamed("event_type", "table_name"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- reconciliation --------------------------------------------------------------

def _bronze_sim(log):
    """Bronze as it drifted: rows whose sequence is a multiple of 97 never landed,
    rows whose sequence is a multiple of 89 landed twice."""
    kept = log.filter(F.col("ingest_seq") % 97 != 0)
    return kept.unionByName(log.filter(F.col("ingest_seq") % 89 == 0))


_ORDER2 = ["update_date", "ingest_seq"]


@query
def reconcile_counts(spark, d):
    """J7 + H2: distinct in-scope keys, source snapshot versus drifted bronze, per table."""
    targets = []
    for name, fn in fx.LOGS.items():
        log = fn(spark, d)
        snapshot = changelog.latest_per_key(log, list(_KEYS[name]), _ORDER2)
        targets.append(reconcile.Target(name, snapshot, _bronze_sim(log), _KEYS[name], _scope(name)))
    return reconcile.reconcile_counts(targets, threshold=0.005)


_DIALER_SRC = ["uniqueid", "case_id", "client_id", "telecom_id", "phone_number", "disposition_code", "call_date",
               "update_date"]


@query
def reconcile_rows(spark, d):
    """Missing / extra / changed calls between the scoped source snapshot and bronze."""
    log = fx.dialer_log(spark, d)
    compared = [c for c in _DIALER_SRC if c != "uniqueid"]
    # The scope column is compared too, so it stays beside the hash until the scope is applied.
    scoped = log.withColumn("in_scope", F.coalesce(_scope("dialer"), F.lit(False)))
    source = (changelog.latest_per_key(scoped.select("uniqueid", *_ORDER2, "in_scope", reconcile.row_hash(compared).alias("row_hash")),
                                       ["uniqueid"], _ORDER2).filter("in_scope").select("uniqueid", "row_hash"))
    drifted = _bronze_sim(log).withColumn(
        "phone_number",
        F.when(F.col("ingest_seq") % 89 == 0, F.concat(F.col("phone_number"), F.lit("9"))).otherwise(
            F.col("phone_number")))
    return reconcile.reconcile_hashes(source, reconcile.hashed_latest(drifted, ["uniqueid"], _ORDER2, compared), ["uniqueid"])
