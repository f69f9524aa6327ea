"""Staging: newest state per key, then scope filters and derived columns.

Scope filters run *after* the dedup. Filtering first would resurrect an
older in-scope version of a key whose newest version is out of scope (a
closed case, a call moved to another client).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import ReportConfig
from tidemark.functions.expressions import flag
from tidemark.operators.changelog import latest_per_key, pivot_latest


def _order(log: DataFrame, cfg: ReportConfig) -> list[str]:
    return [c for c in cfg.version_order if c in log.columns]


def stg_cases(log: DataFrame, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    return cases_view(latest_per_key(log, ["case_id"], _order(log, cfg)), cfg)


def cases_view(latest: DataFrame, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    """Scope over cases that are already one row per ``case_id``."""
    return latest.filter(
        (F.col("case_statute_id") == cfg.active_case_statute_id)
        & F.col("client_id").isin(*cfg.client_ids)
    ).select(
        "case_id", "client_id", "ref_number", "debtor_id", "original_capital",
        "actual_capital", "case_statute_id", "update_date",
    )


def stg_case_attributes(log: DataFrame, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    """One row per case with the newest provider and DPD text."""
    return pivot_latest(
        log, "case_id", "case_attribute_type_id", "case_attribute_value",
        {cfg.attr_type_provider: "provider", cfg.attr_type_dpd: "dpd"},
        _order(log, cfg),
    )


def attributes_view(latest: DataFrame, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    """Pivot of attributes that are already one row per ``(case_id, type)``: a plain
    conditional ``max`` per type, no ordering needed."""
    t, v = F.col("case_attribute_type_id"), F.col("case_attribute_value")
    return latest.groupBy("case_id").agg(
        F.max(F.when(t == cfg.attr_type_provider, v)).alias("provider"),
        F.max(F.when(t == cfg.attr_type_dpd, v)).alias("dpd"),
    )


def latest_attribute(log: DataFrame, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    """Newest version per ``(case_id, case_attribute_type_id)`` (before any pivot)."""
    return latest_per_key(log, ["case_id", "case_attribute_type_id"], _order(log, cfg)).select(
        "case_id", "case_attribute_type_id", "case_attribute_value", "update_date"
    )


def stg_dialer(log: DataFrame, cfg: ReportConfig = ReportConfig(), assume_immutable_call_date: bool = False,
               window: tuple | None = None) -> DataFrame:
    """Newest version per call, scoped to the clients, with disposition flags.

    ``assume_immutable_call_date`` with ``window=(lo, hi)`` filters the log
    on ``call_date`` *below* the dedup: exact only when a call's date never
    changes between versions, so it is off by default.
    """
    if assume_immutable_call_date and window is not None:
        from tidemark.functions.expressions import in_window
        log = log.filter(in_window("call_date", *window))
    return dialer_view(latest_per_key(log, ["uniqueid"], _order(log, cfg)), cfg)


def calls_scope(cfg: ReportConfig) -> Column:
    return F.col("client_id").isin(*cfg.client_ids)


def dialer_view(latest: DataFrame, cfg: ReportConfig = ReportConfig(), extra: tuple[str, ...] = ()) -> DataFrame:
    """Scope and flags over calls that are already one row per ``uniqueid`` (the
    dedup output, or a maintained latest-state table); ``extra`` columns pass through."""
    return latest.filter(calls_scope(cfg)).select(
        "uniqueid", "case_id", "client_id", "telecom_id", "phone_number", "disposition_code",
        "call_date",
        F.to_date("call_date").alias("call_date_only"),
        flag(F.col("disposition_code") == cfg.disposition_answered).alias("is_answered"),
        flag(F.col("disposition_code") == cfg.disposition_failed).alias("is_failed"),
        flag(F.col("disposition_code") == cfg.disposition_no_answer).alias("is_no_answer"),
        *extra,
    )


def stg_contacts(log: DataFrame, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    """Newest version per contact, without system-generated ones.

    ``insert_user <> 'auto_dialer'`` is three-valued: a NULL user is dropped too.
    """
    return contacts_view(latest_per_key(log, ["contact_id"], _order(log, cfg)), cfg)


def contacts_scope(cfg: ReportConfig) -> Column:
    return F.col("insert_user") != cfg.system_contact_user


def contacts_view(latest: DataFrame, cfg: ReportConfig = ReportConfig(), extra: tuple[str, ...] = ()) -> DataFrame:
    """System-contact filter over contacts that are already one row per ``contact_id``."""
    return latest.filter(contacts_scope(cfg)).select(
        "contact_id", "case_id", "status_type_id", "target_type_id", "contact_date",
        F.to_date("contact_date").alias("contact_date_only"),
        "insert_user", "update_date", *extra,
    )
