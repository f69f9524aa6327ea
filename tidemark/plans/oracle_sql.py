"""Independent SQL (DuckDB dialect) for every query in the catalogue.

Each statement restates the operator the plain way (dedup window, then
pivot; join, then distinct counts), so it checks the Spark-side rewrites
rather than repeating them. Dialect notes: DuckDB ``try_cast`` accepts
``'12.5'`` as an int (Spark does not), so casts are guarded by a pattern;
``sum`` returns HUGEINT and is cast to BIGINT; rates are computed with exact
integer half-up rounding; a double goes to DECIMAL through its shortest text
form, because DuckDB's direct cast scales in floating point first
(103973.08499999999 became .09 where Spark gives .08).
"""

from __future__ import annotations

from datetime import date

from tidemark.config import DPD_BANDS, NO_DPD_LABEL, NO_PROVIDER_LABEL, ReportConfig

CFG = ReportConfig(as_of=date(2024, 2, 15))
WIN_LO, WIN_HI = "DATE '2023-12-01'", "DATE '2024-03-01'"


def ints(xs) -> str:
    return ", ".join(str(int(x)) for x in xs)


def rate(num: str, den: str, scale: int = 4) -> str:
    """Half-up ``round(num / den, scale)`` in exact integer arithmetic, NULL when den = 0."""
    m = 10 ** scale
    return (f"CASE WHEN ({den}) = 0 THEN NULL ELSE "
            f"CAST(((2 * {m} * ({num}) + ({den})) // (2 * ({den}))) AS DOUBLE) / CAST({m} AS DOUBLE) END")


def band_sql(col: str) -> str:
    parts = []
    for lo, hi, label in DPD_BANDS:
        cond = f"{col} BETWEEN {lo} AND {hi}" if hi is not None else f"{col} > {lo - 1}"
        parts.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(parts) + f" ELSE '{NO_DPD_LABEL}' END"


def int_or_null(col: str) -> str:
    return f"CASE WHEN regexp_full_match({col}, '\\s*[+-]?\\d+\\s*') THEN TRY_CAST({col} AS INTEGER) END"


CASES_LOG = """
SELECT o_custkey AS case_id,
       CAST(101 + o_custkey % 4 AS INTEGER) AS client_id,
       'REF-' || CAST(o_custkey AS VARCHAR) AS ref_number,
       o_custkey * 7 % 250000 AS debtor_id,
       CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(18,2)) AS original_capital,
       CAST(CAST(o_totalprice * 0.75 AS VARCHAR) AS DECIMAL(18,2)) AS actual_capital,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS case_statute_id,
       o_orderdate AS update_date,
       o_orderkey AS ingest_seq
FROM orders"""

ATTRIBUTES_LOG = """
SELECT o_custkey AS case_id, CAST(11 AS INTEGER) AS case_attribute_type_id,
       CASE WHEN o_custkey % 20 = 0 THEN NULL ELSE 'Provider ' || substring(o_orderpriority, 1, 1) END
         AS case_attribute_value,
       o_orderdate AS update_date, o_orderkey AS ingest_seq
FROM orders
UNION ALL
SELECT o_custkey, CAST(12 AS INTEGER),
       CASE WHEN o_orderkey % 33 = 0 THEN NULL
            WHEN o_orderkey % 50 = 1 THEN 'n/a'
            ELSE CAST((o_orderkey * 37) % 500 - 20 AS VARCHAR) END,
       o_orderdate, o_orderkey
FROM orders"""

DIALER_LOG = """
SELECT 'call-' || CAST(event_id AS VARCHAR) AS uniqueid,
       user_id AS case_id,
       CAST(101 + user_id % 4 AS INTEGER) AS client_id,
       CAST(event_id % 4 AS INTEGER) AS telecom_id,
       '+5511' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS phone_number,
       CAST(CASE WHEN event_type IN ('view', 'purchase') THEN 201
                 WHEN event_type = 'click' THEN 202
                 WHEN event_type IN ('error', 'signup') THEN 203 END AS INTEGER) AS disposition_code,
       ts - to_days(CAST((event_id % 6) * 30 AS INTEGER)) AS call_date,
       ts AS update_date,
       event_id AS ingest_seq
FROM events"""

CONTACTS_LOG = """
SELECT l_orderkey * 8 + l_linenumber AS contact_id,
       l_partkey AS case_id,
       CAST(1 + CAST(l_quantity AS BIGINT) % 6 AS INTEGER) AS status_type_id,
       CAST(1 + l_linenumber % 4 AS INTEGER) AS target_type_id,
       TIMESTAMP '2024-01-31 00:00:00' - to_days(CAST((l_orderkey * 7 + l_partkey) % 180 AS INTEGER)) AS contact_date,
       CASE WHEN l_returnflag = 'A' THEN 'auto_dialer'
            ELSE 'operator_' || CAST(l_suppkey % 25 AS VARCHAR) END AS insert_user,
       l_shipdate AS update_date,
       l_suppkey * 1000000 + l_partkey AS ingest_seq
FROM lineitem"""

ORDER = "update_date DESC NULLS LAST, ingest_seq DESC NULLS LAST"

STG_CASES = f"""
SELECT case_id, client_id, ref_number, debtor_id, original_capital, actual_capital, case_statute_id, update_date
FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY {ORDER}) AS rn FROM cases_log) d
WHERE rn = 1 AND case_statute_id = {CFG.active_case_statute_id} AND client_id IN ({ints(CFG.client_ids)})"""

LATEST_ATTRIBUTE = f"""
SELECT case_id, case_attribute_type_id, case_attribute_value, update_date
FROM (SELECT *, row_number() OVER (PARTITION BY case_id, case_attribute_type_id ORDER BY {ORDER}) AS rn
      FROM attributes_log) d
WHERE rn = 1"""

STG_CASE_ATTRIBUTES = f"""
SELECT case_id,
       max(CASE WHEN case_attribute_type_id = {CFG.attr_type_provider} THEN case_attribute_value END) AS provider,
       max(CASE WHEN case_attribute_type_id = {CFG.attr_type_dpd} THEN case_attribute_value END) AS dpd
FROM latest_attribute
GROUP BY case_id"""

STG_DIALER = f"""
SELECT uniqueid, case_id, client_id, telecom_id, phone_number, disposition_code, call_date,
       CAST(call_date AS DATE) AS call_date_only,
       CASE WHEN disposition_code = {CFG.disposition_answered} THEN 1 ELSE 0 END AS is_answered,
       CASE WHEN disposition_code = {CFG.disposition_failed} THEN 1 ELSE 0 END AS is_failed,
       CASE WHEN disposition_code = {CFG.disposition_no_answer} THEN 1 ELSE 0 END AS is_no_answer
FROM (SELECT *, row_number() OVER (PARTITION BY uniqueid ORDER BY {ORDER}) AS rn FROM dialer_log) d
WHERE rn = 1 AND client_id IN ({ints(CFG.client_ids)})"""

STG_CONTACTS = f"""
SELECT contact_id, case_id, status_type_id, target_type_id, contact_date,
       CAST(contact_date AS DATE) AS contact_date_only, insert_user, update_date
FROM (SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY {ORDER}) AS rn FROM contacts_log) d
WHERE rn = 1 AND insert_user <> '{CFG.system_contact_user}'"""

ACTIVE_CASES = f"""
SELECT case_id, client_id, provider, dpd_days, {band_sql('dpd_days')} AS dpd_faixa
FROM (SELECT c.case_id, c.client_id, coalesce(ca.provider, '{NO_PROVIDER_LABEL}') AS provider,
             {int_or_null('ca.dpd')} AS dpd_days
      FROM stg_cases c LEFT JOIN stg_case_attributes ca ON ca.case_id = c.case_id) a"""

CALLS_IN_WINDOW = f"""
SELECT * FROM stg_dialer WHERE call_date_only >= {WIN_LO} AND call_date_only < {WIN_HI}"""

CONTACTS_IN_WINDOW = f"""
SELECT * FROM stg_contacts WHERE contact_date_only >= {WIN_LO} AND contact_date_only < {WIN_HI}"""

DIALED_CASES = """
SELECT case_id, count(*) AS total_calls FROM calls_in_window GROUP BY case_id"""

CONTACT_STATS = f"""
SELECT ct.case_id,
       count(DISTINCT CASE WHEN ct.status_type_id = {CFG.status_paid} THEN ct.contact_id END) AS paid_count,
       count(DISTINCT CASE WHEN ct.status_type_id IN ({ints(CFG.status_ptp)}) THEN ct.contact_id END) AS ptp_count,
       count(DISTINCT CASE WHEN ct.target_type_id IN ({ints(CFG.target_right_party)}) THEN ct.contact_id END) AS cc_count
FROM contacts_in_window ct
JOIN active_cases ac ON ac.case_id = ct.case_id
GROUP BY ct.case_id"""

MART_PENETRATION = f"""
SELECT ac.client_id, ac.provider, ac.dpd_faixa,
       count(ac.case_id) AS quantidade,
       count(dc.case_id) AS acionado,
       count(ac.case_id) - count(dc.case_id) AS sem_ac,
       {rate('count(dc.case_id)', 'count(ac.case_id)')} AS penetration_rate,
       CAST(sum(coalesce(dc.total_calls, 0)) AS BIGINT) AS total_calls,
       CAST(sum(coalesce(cs.paid_count, 0)) AS BIGINT) AS paid,
       CAST(sum(coalesce(cs.ptp_count, 0)) AS BIGINT) AS ptp,
       CAST(sum(coalesce(cs.cc_count, 0)) AS BIGINT) AS cc
FROM active_cases ac
LEFT JOIN dialed_cases dc ON dc.case_id = ac.case_id
LEFT JOIN contact_stats cs ON cs.case_id = ac.case_id
GROUP BY ac.client_id, ac.provider, ac.dpd_faixa"""

TELECOM_METRICS = """
SELECT client_id, case_id, telecom_id,
       max(phone_number) AS phone_number,
       count(*) AS total_calls,
       CAST(sum(is_answered) AS BIGINT) AS answered_calls,
       CAST(sum(is_failed) AS BIGINT) AS failed_calls,
       CAST(sum(is_no_answer) AS BIGINT) AS no_answer_calls
FROM calls_in_window
GROUP BY client_id, case_id, telecom_id"""

MART_PHONE_QUALITY = f"""
SELECT client_id, case_id, telecom_id, phone_number, total_calls, answered_calls, failed_calls, no_answer_calls,
       {rate('failed_calls', 'total_calls')} AS pct_failed,
       {rate('answered_calls', 'total_calls')} AS pct_answered,
       CASE WHEN total_calls > {CFG.cleanup_min_total_calls} AND failed_calls > {CFG.cleanup_min_failed_calls}
            THEN 1 ELSE 0 END AS is_cleanup_candidate
FROM telecom_metrics"""

# Named building blocks, in dependency order. ``with_ctes`` includes only
# what a statement refers to (transitively).
BLOCKS: dict[str, str] = {
    "cases_log": CASES_LOG,
    "attributes_log": ATTRIBUTES_LOG,
    "dialer_log": DIALER_LOG,
    "contacts_log": CONTACTS_LOG,
    "stg_cases": STG_CASES,
    "latest_attribute": LATEST_ATTRIBUTE,
    "stg_case_attributes": STG_CASE_ATTRIBUTES,
    "stg_dialer": STG_DIALER,
    "stg_contacts": STG_CONTACTS,
    "active_cases": ACTIVE_CASES,
    "calls_in_window": CALLS_IN_WINDOW,
    "contacts_in_window": CONTACTS_IN_WINDOW,
    "dialed_cases": DIALED_CASES,
    "contact_stats": CONTACT_STATS,
    "telecom_metrics": TELECOM_METRICS,
    "mart_penetration": MART_PENETRATION,
    "mart_phone_quality": MART_PHONE_QUALITY,
}


def _refs(sql: str) -> list[str]:
    import re

    words = set(re.findall(r"[a-z_]+", sql))
    return [b for b in BLOCKS if b in words]


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it needs, in dependency order."""
    need: list[str] = []

    def visit(name: str) -> None:
        if name in need:
            return
        for dep in _refs(BLOCKS[name]):
            if dep != name:
                visit(dep)
        need.append(name)

    for r in _refs(body):
        visit(r)
    order = [b for b in BLOCKS if b in need]
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({BLOCKS[n]}\n)" for n in order)
    body = body.strip()
    if body[:4].upper() == "WITH":  # merge the body's own CTEs into one WITH
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def block(name: str) -> str:
    return with_ctes(f"SELECT * FROM {name}")
