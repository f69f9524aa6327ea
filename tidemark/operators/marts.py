"""The two reports: penetration by client x provider x DPD band, and phone quality.

Shape of the penetration plan: every per-case input (active cases, calls per
case, contact counts per case) is *aggregated to one row per case before any
join*. The aggregates have map-side partial steps, so a case holding a third
of all calls is reduced inside each map task, and the joins that follow are
1:1 on ``case_id`` (no fan-out, no hot join key). All three sides come out of
their shuffles hash-partitioned on ``case_id``, so the joins add no exchange.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import NO_PROVIDER_LABEL, ReportConfig
from tidemark.functions.expressions import band, cleanup_flag, in_window, safe_rate, try_int, window_bounds


def bounds(cfg: ReportConfig) -> tuple[date, date]:
    return window_bounds(cfg.report_date(), cfg.window_months_back)


def active_cases(cases_stg: DataFrame, attrs_stg: DataFrame, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    """Active in-scope cases with provider (defaulted), DPD days and DPD band."""
    joined = cases_stg.select("case_id", "client_id").join(
        attrs_stg.select("case_id", "provider", "dpd"), on="case_id", how="left"
    )
    dpd_days = try_int("dpd")
    return joined.select(
        "case_id",
        "client_id",
        F.coalesce(F.col("provider"), F.lit(NO_PROVIDER_LABEL)).alias("provider"),
        dpd_days.alias("dpd_days"),
        band(dpd_days).alias("dpd_faixa"),
    )


def calls_in_window(calls_stg: DataFrame, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    lo, hi = bounds(cfg)
    return calls_stg.filter(in_window("call_date", lo, hi))


def contacts_in_window(contacts_stg: DataFrame, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    lo, hi = bounds(cfg)
    return contacts_stg.filter(in_window("contact_date", lo, hi))


def dialed_cases(calls_stg: DataFrame, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    """Calls per case inside the window."""
    return calls_in_window(calls_stg, cfg).groupBy("case_id").agg(F.count(F.lit(1)).alias("total_calls"))


def _contact_counts(contacts: DataFrame, cfg: ReportConfig, distinct: bool) -> DataFrame:
    paid = F.col("status_type_id") == cfg.status_paid
    ptp = F.col("status_type_id").isin(*cfg.status_ptp)
    cc = F.col("target_type_id").isin(*cfg.target_right_party)
    if distinct:
        # The literal form: three independent distinct counts (Expand x3 in the plan).
        cid = F.col("contact_id")
        aggs = [F.count_distinct(F.when(c, cid)).alias(n) for c, n in
                ((paid, "paid_count"), (ptp, "ptp_count"), (cc, "cc_count"))]
    else:
        # stg_contacts is unique on contact_id, so a distinct count of the ids
        # meeting a condition is a plain conditional count of non-NULL ids.
        has_id = F.col("contact_id").isNotNull()
        aggs = [F.count_if(c & has_id).alias(n) for c, n in
                ((paid, "paid_count"), (ptp, "ptp_count"), (cc, "cc_count"))]
    return contacts.groupBy("case_id").agg(*aggs)


def contact_stats(contacts_stg: DataFrame, active: DataFrame, cfg: ReportConfig = ReportConfig(),
                  distinct: bool = False) -> DataFrame:
    """Paid / PTP / right-party counts per active case inside the window.

    Default form aggregates first and then keeps active cases with a
    semi-join of one row per case, so no contact row crosses a join and a hot
    case cannot skew it. ``distinct=True`` is the literal join-then-distinct form.
    """
    inwin = contacts_in_window(contacts_stg, cfg)
    if distinct:
        scoped = inwin.join(active.select("case_id"), on="case_id", how="inner")
        return _contact_counts(scoped, cfg, distinct=True)
    per_case = _contact_counts(inwin, cfg, distinct=False)
    return per_case.join(active.select("case_id"), on="case_id", how="left_semi")


def scoped_to(df: DataFrame, active: DataFrame, key: str = "case_id") -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``active`` (unique on the right: a semi-join,
    so no row of ``df`` is repeated and only ``active``'s keys cross the join)."""
    return df.join(active.select(key), on=key, how="left_semi")


def contact_scope(contacts_stg: DataFrame, active: DataFrame) -> DataFrame:
    """Contacts of active cases."""
    return scoped_to(contacts_stg, active, "case_id")


def dialed_coverage(active: DataFrame, dialed: DataFrame) -> DataFrame:
    """Active cases with their call count; ``dialed`` is 1 when the case had a call."""
    d = dialed.select("case_id", "total_calls", F.lit(1).alias("dialed"))
    return active.join(d, on="case_id", how="left").select(
        "case_id", "client_id", "provider", "dpd_faixa",
        F.coalesce("dialed", F.lit(0)).alias("dialed"),
        F.coalesce("total_calls", F.lit(0)).cast("long").alias("total_calls"),
    )


def mart_penetration(cases_log: DataFrame, attributes_log: DataFrame, dialer_log: DataFrame,
                     contacts_log: DataFrame, cfg: ReportConfig = ReportConfig(),
                     calls_stg: DataFrame | None = None) -> DataFrame:
    from tidemark.operators.staging import stg_case_attributes, stg_cases, stg_contacts, stg_dialer

    calls = calls_stg if calls_stg is not None else stg_dialer(dialer_log, cfg)
    return penetration_from_staged(stg_cases(cases_log, cfg), stg_case_attributes(attributes_log, cfg), calls,
                                   stg_contacts(contacts_log, cfg), cfg)


def penetration_from_staged(cases_stg: DataFrame, attrs_stg: DataFrame, calls_stg: DataFrame,
                            contacts_stg: DataFrame, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    """The penetration report from staged inputs (dedup views or latest-state tables)."""
    active = active_cases(cases_stg, attrs_stg, cfg)
    dialed = dialed_cases(calls_stg, cfg).withColumn("dialed_case", F.col("case_id"))
    # No scope join here: the left join from ``active`` below keeps only
    # active cases, which is exactly the scope the contact counts need.
    counts = _contact_counts(contacts_in_window(contacts_stg, cfg), cfg, distinct=False)
    return penetration_rollup(active, dialed, counts)


def penetration_rollup(active: DataFrame, dialed: DataFrame, counts: DataFrame) -> DataFrame:
    j = active.join(dialed, on="case_id", how="left").join(counts, on="case_id", how="left")
    quantidade = F.count("case_id")
    acionado = F.count("dialed_case")
    zero = F.lit(0)
    return j.groupBy("client_id", "provider", "dpd_faixa").agg(
        quantidade.alias("quantidade"),
        acionado.alias("acionado"),
        (quantidade - acionado).alias("sem_ac"),
        safe_rate(acionado, quantidade).alias("penetration_rate"),
        F.sum(F.coalesce("total_calls", zero)).cast("long").alias("total_calls"),
        F.sum(F.coalesce("paid_count", zero)).cast("long").alias("paid"),
        F.sum(F.coalesce("ptp_count", zero)).cast("long").alias("ptp"),
        F.sum(F.coalesce("cc_count", zero)).cast("long").alias("cc"),
    )


def telecom_metrics(calls_stg: DataFrame, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    return calls_in_window(calls_stg, cfg).groupBy("client_id", "case_id", "telecom_id").agg(
        F.max("phone_number").alias("phone_number"),
        F.count(F.lit(1)).alias("total_calls"),
        F.sum("is_answered").cast("long").alias("answered_calls"),
        F.sum("is_failed").cast("long").alias("failed_calls"),
        F.sum("is_no_answer").cast("long").alias("no_answer_calls"),
    )


def mart_phone_quality(calls_stg: DataFrame, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    m = telecom_metrics(calls_stg, cfg)
    return m.select(
        "client_id", "case_id", "telecom_id", "phone_number", "total_calls",
        "answered_calls", "failed_calls", "no_answer_calls",
        safe_rate("failed_calls", "total_calls").alias("pct_failed"),
        safe_rate("answered_calls", "total_calls").alias("pct_answered"),
        cleanup_flag("total_calls", "failed_calls", cfg.cleanup_min_total_calls,
                     cfg.cleanup_min_failed_calls).alias("is_cleanup_candidate"),
    )
