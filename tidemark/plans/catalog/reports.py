"""Catalogue: change-log dedup, staging views, report parts and both reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.expressions import band, safe_rate, try_int, window_bounds_col
from tidemark.operators import changelog, marts, staging
from tidemark.plans.catalog.common import (
    CFG, _SRC_CONTACT_COLS, _active, _stg_attrs, _stg_cases, _stg_contacts, _stg_dialer, query,
)
from tidemark.sources import fixtures as fx


# ---- F: change log ---------------------------------------------------------

@query
def latest_per_key(spark, d):
    """newest version per contact in the contact change log."""
    log = fx.contacts_log(spark, d)
    return changelog.latest_per_key(log, ["contact_id"], CFG.version_order).select(*_SRC_CONTACT_COLS)


@query
def latest_attribute(spark, d):
    """newest version per (case, attribute type), before the pivot."""
    return staging.latest_attribute(fx.attributes_log(spark, d), CFG)


# ---- B/C/E: staging --------------------------------------------------------

@query
def stg_cases(spark, d):
    return _stg_cases(spark, d)


@query
def stg_case_attributes(spark, d):
    return _stg_attrs(spark, d)


@query
def stg_dialer(spark, d):
    return _stg_dialer(spark, d)


@query
def stg_contacts(spark, d):
    return _stg_contacts(spark, d)


# ---- C/D/E: mart parts ------------------------------------------------------

@query
def active_cases(spark, d):
    return _active(spark, d)


@query
def dpd_band(spark, d):
    """C5 + C6 over every case's newest DPD text."""
    a = _stg_attrs(spark, d)
    days = try_int("dpd")
    return a.select("case_id", "dpd", days.alias("dpd_days"), band(days).alias("dpd_faixa"))


@query
def calls_in_window(spark, d):
    return marts.calls_in_window(_stg_dialer(spark, d), CFG)


@query
def contacts_in_window(spark, d):
    return marts.contacts_in_window(_stg_contacts(spark, d), CFG)


@query
def dialed_cases(spark, d):
    return marts.dialed_cases(_stg_dialer(spark, d), CFG)


@query
def contact_stats(spark, d):
    return marts.contact_stats(_stg_contacts(spark, d), _active(spark, d), CFG)


@query
def contact_stats_distinct(spark, d):
    """E3 in its literal join-then-distinct form (checks the rewrite)."""
    return marts.contact_stats(_stg_contacts(spark, d), _active(spark, d), CFG, distinct=True)


@query
def contact_scope(spark, d):
    return marts.contact_scope(_stg_contacts(spark, d), _active(spark, d))


@query
def dialed_coverage(spark, d):
    return marts.dialed_coverage(_active(spark, d), marts.dialed_cases(_stg_dialer(spark, d), CFG))


@query
def mart_penetration(spark, d):
    return marts.mart_penetration(fx.cases_log(spark, d), fx.attributes_log(spark, d),
                                  fx.dialer_log(spark, d), fx.contacts_log(spark, d), CFG)


@query
def telecom_metrics(spark, d):
    return marts.telecom_metrics(_stg_dialer(spark, d), CFG)


@query
def mart_phone_quality(spark, d):
    return marts.mart_phone_quality(_stg_dialer(spark, d), CFG)


@query
def mart_phone_quality_prefiltered(spark, d):
    """The window filter placed below the dedup (exact when a call's date never changes)."""
    lo, hi = marts.bounds(CFG)
    calls = staging.stg_dialer(fx.dialer_log(spark, d), CFG, assume_immutable_call_date=True, window=(lo, hi))
    return marts.mart_phone_quality(calls, CFG)


@query
def cleanup_candidates(spark, d):
    """Phone-mart rows flagged for cleanup."""
    return mart_phone_quality(spark, d).filter(F.col("is_cleanup_candidate") == 1)


@query
def safe_rate_by_telecom(spark, d):
    """C7 over whole-history call groups: failed and answered shares per client x telecom."""
    g = _stg_dialer(spark, d).groupBy("client_id", "telecom_id").agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("is_failed").cast("long").alias("failed"),
        F.sum("is_answered").cast("long").alias("answered"),
    )
    return g.select("client_id", "telecom_id", "calls", "failed", "answered",
                    safe_rate("failed", "calls").alias("pct_failed"),
                    safe_rate("answered", "failed").alias("answered_per_failed"))


@query
def window_bounds(spark, d):
    """C10 for every day that has events, as the as-of date."""
    days = fx.table(spark, d, "events").select(F.to_date("ts").alias("as_of")).distinct()
    lo, hi = window_bounds_col("as_of", CFG.window_months_back)
    return days.select("as_of", lo.alias("inicio_mes"), hi.alias("fim_mes"))
