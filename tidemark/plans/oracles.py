"""Key -> DuckDB statement for the catalogue queries (see ``oracle_sql``)."""

from __future__ import annotations

from tidemark.config import SEED_WATERMARK
from tidemark.operators import textscan
from tidemark.plans.oracle_sql import CFG, band_sql, block, int_or_null, ints, rate, with_ctes

ORACLES: dict[str, str] = {
    "latest_per_key": with_ctes("""
        SELECT contact_id, case_id, status_type_id, target_type_id, contact_date, insert_user, update_date, ingest_seq
        FROM (SELECT *, row_number() OVER (PARTITION BY contact_id
                                           ORDER BY update_date DESC NULLS LAST, ingest_seq DESC NULLS LAST) AS rn
              FROM contacts_log) d
        WHERE rn = 1"""),
    "latest_attribute": block("latest_attribute"),
    "stg_cases": block("stg_cases"),
    "stg_case_attributes": block("stg_case_attributes"),
    "stg_dialer": block("stg_dialer"),
    "stg_contacts": block("stg_contacts"),
    "active_cases": block("active_cases"),
    "dpd_band": with_ctes(f"""
        SELECT case_id, dpd, dpd_days, {band_sql('dpd_days')} AS dpd_faixa
        FROM (SELECT case_id, dpd, {int_or_null('dpd')} AS dpd_days FROM stg_case_attributes) a"""),
    "calls_in_window": block("calls_in_window"),
    "contacts_in_window": block("contacts_in_window"),
    "dialed_cases": block("dialed_cases"),
    "contact_stats": block("contact_stats"),
    "contact_stats_distinct": block("contact_stats"),
    "contact_scope": with_ctes("""
        SELECT ct.* FROM stg_contacts ct JOIN active_cases ac ON ac.case_id = ct.case_id"""),
    "dialed_coverage": with_ctes("""
        SELECT ac.case_id, ac.client_id, ac.provider, ac.dpd_faixa,
               CASE WHEN dc.case_id IS NULL THEN 0 ELSE 1 END AS dialed,
               CAST(coalesce(dc.total_calls, 0) AS BIGINT) AS total_calls
        FROM active_cases ac LEFT JOIN dialed_cases dc ON dc.case_id = ac.case_id"""),
    "mart_penetration": block("mart_penetration"),
    "mart_penetration_by_delta": block("mart_penetration"),
    "telecom_metrics": block("telecom_metrics"),
    "mart_phone_quality": block("mart_phone_quality"),
    "mart_phone_quality_prefiltered": block("mart_phone_quality"),
    "cleanup_candidates": with_ctes("SELECT * FROM mart_phone_quality WHERE is_cleanup_candidate = 1"),
    "safe_rate_by_telecom": with_ctes(f"""
        SELECT client_id, telecom_id, calls, failed, answered,
               {rate('failed', 'calls')} AS pct_failed,
               {rate('answered', 'failed')} AS answered_per_failed
        FROM (SELECT client_id, telecom_id, count(*) AS calls,
                     CAST(sum(is_failed) AS BIGINT) AS failed, CAST(sum(is_answered) AS BIGINT) AS answered
              FROM stg_dialer GROUP BY client_id, telecom_id) g"""),
    "window_bounds": f"""
        SELECT as_of,
               CAST(date_trunc('month', as_of - INTERVAL {CFG.window_months_back} MONTH) AS DATE) AS inicio_mes,
               CAST(date_trunc('month', as_of + INTERVAL 1 MONTH) AS DATE) AS fim_mes
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS as_of FROM events) e""",
}


# ---- pulls, measurement, change-log maintenance -----------------------------------


SEED = f"TIMESTAMP '{SEED_WATERMARK:%Y-%m-%d %H:%M:%S}'"
SCOPE = f"client_id IN ({ints(CFG.client_ids)})"
DIALER_COLS = "uniqueid, case_id, client_id, telecom_id, phone_number, disposition_code, call_date, update_date"
CONTACT_COLS = "contact_id, case_id, status_type_id, target_type_id, contact_date, insert_user, update_date, ingest_seq"
PULLED = f"SELECT {DIALER_COLS}, ingest_seq FROM dialer_log WHERE update_date > TIMESTAMP '2024-01-28 23:45:00' AND {SCOPE}"
FULL_WINDOW = "call_date >= TIMESTAMP '2024-02-15 00:00:00' - INTERVAL 3 MONTH"


def latest(log: str, keys: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY update_date DESC NULLS LAST, ingest_seq DESC NULLS LAST) AS rn FROM {log}) x WHERE rn = 1")


ORACLES.update({
    "attribute_union": with_ctes(
        "SELECT case_id, case_attribute_type_id, case_attribute_value, update_date, ingest_seq FROM attributes_log"),
    "incremental_pull": with_ctes(PULLED),
    "incremental_scan": with_ctes(PULLED),
    "single_scan": with_ctes(PULLED),
    "sink_append": with_ctes(f"SELECT {DIALER_COLS}, ingest_seq FROM dialer_log"),
    "even_splits": with_ctes("""
        , ids AS (SELECT case_id * case_id * case_id AS id FROM dialer_log),
        bounds AS (SELECT min(id) AS lo, max(id) AS hi FROM ids),
        counted AS (SELECT len(list_filter(range(1, 17), lambda i: i < 16 AND id >= lo + (hi - lo) * i // 16)) AS r, count(*) AS n
                    FROM ids, bounds GROUP BY r)
        SELECT 'strides' AS method, count(*) AS ranges, CAST(sum(n) AS BIGINT) AS rows, max(n) * 16 <= sum(n) * 1.2 AS even FROM counted
        UNION ALL SELECT 'quantiles', 16, count(*), true FROM ids"""),
    "full_reload_pull": with_ctes(f"SELECT {DIALER_COLS} FROM dialer_log WHERE {FULL_WINDOW} AND {SCOPE}"),
    "partition_bounds": with_ctes(
        f"SELECT min(case_id) AS lo, max(case_id) AS hi, count(*) AS rows FROM ({PULLED}) p"),
    "batch_stats": with_ctes(f"SELECT count(*) AS row_count, max(update_date) AS batch_max FROM ({PULLED}) p"),
    "extraction_cost": with_ctes(f"""
        SELECT full_rows, incremental_rows, {rate('incremental_rows', 'full_rows', 6)} AS ratio
        FROM (SELECT count(*) FILTER (WHERE {FULL_WINDOW} AND {SCOPE}) AS full_rows,
                     count(*) FILTER (WHERE update_date > TIMESTAMP '2024-01-28 23:45:00' AND {SCOPE})
                       AS incremental_rows
              FROM dialer_log) c"""),
    "distinct_keys_by_landing": with_ctes("SELECT count(DISTINCT contact_id) AS distinct_keys FROM contacts_log"),
    "distinct_key_count": with_ctes(
        "SELECT count(*) AS distinct_keys FROM (SELECT DISTINCT contact_id FROM contacts_log) k"),
    "source_count": with_ctes(f"""
        SELECT 'cases' AS "table", count(*) AS source_count FROM cases_log WHERE {SCOPE}
        UNION ALL SELECT 'case_attributes', count(*) FROM attributes_log
                  WHERE case_attribute_type_id IN ({CFG.attr_type_provider}, {CFG.attr_type_dpd})
        UNION ALL SELECT 'dialer', count(*) FROM dialer_log WHERE {SCOPE}
        UNION ALL SELECT 'contacts', count(*) FROM contacts_log WHERE insert_user <> '{CFG.system_contact_user}'"""),
    "upsert_latest": with_ctes(f"SELECT {CONTACT_COLS} FROM ({latest('contacts_log', 'contact_id')}) l"),
    "prune_superseded": with_ctes(f"""
        SELECT {CONTACT_COLS}
        FROM (SELECT *, row_number() OVER (PARTITION BY contact_id
                                           ORDER BY update_date DESC NULLS LAST, ingest_seq DESC NULLS LAST) AS rn
              FROM contacts_log) x
        WHERE rn = 1 OR update_date >= TIMESTAMP '2000-11-04 00:00:00'"""),
})


def _morton(cols: list[str], bits: int = 8) -> str:
    n = len(cols)
    terms = [f"((({c} >> {i}) & 1) << {i * n + j})" for i in range(bits) for j, c in enumerate(cols)]
    return "(" + " | ".join(terms) + ")"


def _scaled(col: str, lo: str, hi: str, bits: int = 8) -> str:
    top = (1 << bits) - 1
    return (f"CASE WHEN {hi} = {lo} THEN CAST(0 AS BIGINT) ELSE "
            f"CAST(least(greatest(({col} - {lo}) * {top} // ({hi} - {lo}), 0), {top}) AS BIGINT) END")


ORACLES["zorder_key"] = with_ctes(f"""
    SELECT uniqueid, case_id, call_day, zx, zy, {_morton(['zx', 'zy'])} AS zkey
    FROM (SELECT b.uniqueid, b.case_id, b.call_day,
                 {_scaled('b.case_id', 'm.lo0', 'm.hi0')} AS zx,
                 {_scaled('b.call_day', 'm.lo1', 'm.hi1')} AS zy
          FROM (SELECT uniqueid, case_id,
                       CAST(date_diff('day', DATE '2023-01-01', CAST(call_date AS DATE)) AS INTEGER) AS call_day
                FROM dialer_log) b,
               (SELECT min(case_id) AS lo0, max(case_id) AS hi0,
                       min(CAST(date_diff('day', DATE '2023-01-01', CAST(call_date AS DATE)) AS INTEGER)) AS lo1,
                       max(CAST(date_diff('day', DATE '2023-01-01', CAST(call_date AS DATE)) AS INTEGER)) AS hi1
                FROM dialer_log) m) s""")


def _hilbert(bits: int = 8) -> str:
    """Level by level, a subquery each: quadrant, then the pair turned as the quadrant's curve is."""
    sql = f"SELECT uniqueid, zx, zy, zx AS x, zy AS y, CAST(0 AS BIGINT) AS d FROM ({ORACLES['zorder_key']}) z"
    for side in (1 << i for i in reversed(range(bits))):
        sql = f"""SELECT uniqueid, zx, zy, d + {side * side} * CASE WHEN r = 0 AND u = 0 THEN 0 WHEN r = 0 THEN 1 WHEN u = 1 THEN 2 ELSE 3 END AS d,
            CASE WHEN u = 1 THEN x % {side} WHEN r = 1 THEN {side - 1} - y % {side} ELSE y % {side} END AS x,
            CASE WHEN u = 1 THEN y % {side} WHEN r = 1 THEN {side - 1} - x % {side} ELSE x % {side} END AS y
            FROM (SELECT *, (x // {side}) % 2 AS r, (y // {side}) % 2 AS u FROM ({sql}) a) b"""
    return f"SELECT uniqueid, zx, zy, CAST(d AS BIGINT) AS hkey FROM ({sql}) h"


ORACLES["hilbert_key"] = _hilbert()


# ---- control log ------------------------------------------------------------------

RUNS = """
SELECT table_name, run_no, last_watermark, rows_processed,
       TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(run_no AS INTEGER)) AS updated_at, 'success' AS run_status
FROM (SELECT o_orderpriority AS table_name, o_orderkey // 1000 AS run_no,
             max(o_orderdate) AS last_watermark, count(*) AS rows_processed
      FROM orders GROUP BY o_orderpriority, o_orderkey // 1000) g"""

SEEDS = f"""
SELECT DISTINCT o_orderpriority AS table_name, {SEED} AS last_watermark, CAST(0 AS BIGINT) AS rows_processed,
       TIMESTAMP '2023-12-31 00:00:00' AS updated_at, 'initialized' AS run_status
FROM orders"""

CONTROL_LOG = f"""
SELECT * FROM ({SEEDS}) s
UNION ALL
SELECT table_name, last_watermark, rows_processed, updated_at, run_status FROM ({RUNS}) r"""

CURRENT = f"""
SELECT table_name, max(last_watermark) AS last_watermark, arg_max(rows_processed, updated_at) AS rows_processed,
       max(updated_at) AS updated_at, arg_max(run_status, updated_at) AS run_status
FROM ({CONTROL_LOG}) c GROUP BY table_name"""

ORACLES.update({
    "control_seed": SEEDS,
    "watermark_history": f"""
        SELECT table_name, updated_at, rows_processed, run_status, last_watermark AS recorded_watermark,
               max(last_watermark) OVER (PARTITION BY table_name ORDER BY updated_at
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS effective_watermark
        FROM ({CONTROL_LOG}) c""",
    "current_watermark": CURRENT,
    "watermark_with_lag": f"""
        SELECT table_name,
               strftime(greatest(coalesce(last_watermark, {SEED}) - INTERVAL 15 MINUTE, {SEED}),
                        '%Y-%m-%d %H:%M:%S') AS read_from
        FROM ({CURRENT}) c""",
    "watermark_advance": f"""
        SELECT table_name, run_no, batch_max, "before",
               greatest(coalesce(batch_max, "before"), "before") AS "after",
               CASE WHEN batch_max < "before" THEN 1 ELSE 0 END AS held
        FROM (SELECT table_name, run_no, last_watermark AS batch_max,
                     coalesce(max(last_watermark) OVER (PARTITION BY table_name ORDER BY updated_at
                                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                              {SEED}) AS "before"
              FROM ({RUNS}) r) x""",
    "control_mark_failed": f"""
        SELECT table_name, coalesce(last_watermark, {SEED}) AS last_watermark, CAST(0 AS BIGINT) AS rows_processed,
               TIMESTAMP '2024-02-15 06:00:00' AS updated_at,
               'failed: ' || substring('source unreachable after ' || CAST(rows_processed AS VARCHAR) || ' rows: '
                                       || repeat('timeout; ', 30), 1, 200) AS run_status
        FROM ({CURRENT}) c""",
    "watermark_guard": """
        WITH days AS (SELECT DISTINCT o_orderdate AS ts FROM orders),
        c AS (
          SELECT ts, 'plain' AS form, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text FROM days
          UNION ALL SELECT ts, 'date_only', strftime(ts, '%Y-%m-%d') FROM days
          UNION ALL SELECT ts, 'iso_t', strftime(ts, '%Y-%m-%dT%H:%M:%S') FROM days
          UNION ALL SELECT ts, 'injection', strftime(ts, '%Y-%m-%d %H:%M:%S') || ''' OR ''1''=''1' FROM days
          UNION ALL SELECT ts, 'newline', strftime(ts, '%Y-%m-%d %H:%M:%S') || chr(10) FROM days
          UNION ALL SELECT ts, 'bad_month', strftime(ts, '%Y') || '-13-01 00:00:00' FROM days)
        SELECT ts, form, text,
               CASE WHEN length(text) = 19
                         AND regexp_full_match(text, '\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}')
                         AND substring(text, 1, 4) <> '0000'
                         AND try_strptime(text, '%Y-%m-%d %H:%M:%S') IS NOT NULL THEN 1 ELSE 0 END AS accepted
        FROM c""",
})


# ---- data quality -----------------------------------------------------------------

DQ_SOURCES = {
    "bronze.cases": "cases_log",
    "bronze.case_attributes": "attributes_log",
    "bronze.dialer": "dialer_log",
    "bronze.contacts": "contacts_log",
    "stg_cases": "stg_cases",
    "stg_case_attributes": "stg_case_attributes",
    "stg_dialer": "stg_dialer",
    "stg_contacts": "stg_contacts",
    "mart_penetration_by_dpd_band": "mart_penetration",
    "mart_phone_quality": "mart_phone_quality",
    "orders": "orders",
    "latest_attribute": "latest_attribute",
}


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _check_sql(model: str, src: str, c) -> str:
    col = c.columns[0]
    head = f"SELECT '{model}' AS model, '{c.kind}' AS \"check\", '{c.label}' AS \"column\", "
    if c.kind == "not_null":
        return head + f"count(*) FILTER (WHERE {col} IS NULL) AS failures FROM {src}"
    if c.kind == "accepted_values":
        return head + f"count(*) FILTER (WHERE {col} NOT IN ({', '.join(_lit(v) for v in c.values)})) AS failures FROM {src}"
    if c.kind == "accepted_range":
        conds = []
        if c.min_value is not None:
            conds.append(f"{col} < {c.min_value}")
        if c.max_value is not None:
            conds.append(f"{col} > {c.max_value}")
        return head + f"count(*) FILTER (WHERE {' OR '.join(conds)}) AS failures FROM {src}"
    cols = ", ".join(c.columns)
    where = f"WHERE {col} IS NOT NULL " if c.kind == "unique" else ""
    return head + (f"(SELECT count(*) FROM (SELECT {cols} FROM {src} {where}GROUP BY {cols} "
                   f"HAVING count(*) > 1) d) AS failures")


def dq_sql(kinds: set[str] | None = None) -> str:
    from tidemark.plans.catalog import DQ_DECLARATIONS

    parts = [_check_sql(m, DQ_SOURCES[m], c) for m, checks in DQ_DECLARATIONS.items() for c in checks
             if kinds is None or c.kind in kinds]
    body = " UNION ALL ".join(f"({p})" for p in parts)
    return with_ctes(f"""SELECT model, "check", "column", CAST(failures AS BIGINT) AS failures,
       CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({body}) r""")


for _key, _kinds in {"dq_not_null": {"not_null"}, "dq_unique": {"unique"},
                     "dq_accepted_values": {"accepted_values"}, "dq_accepted_range": {"accepted_range"},
                     "dq_unique_combination": {"unique_combination"}, "dq_report": None}.items():
    ORACLES[_key] = dq_sql(_kinds)

ORACLES["dq_freshness"] = with_ctes("""
    SELECT table_name, max_loaded_at, (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max_loaded_at)) // 1000000
             AS age_seconds,
           CASE WHEN max_loaded_at IS NULL THEN 'error'
                WHEN epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max_loaded_at) > 48 * 3600000000 THEN 'error'
                WHEN epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max_loaded_at) > 26 * 3600000000 THEN 'warn'
                ELSE 'pass' END AS status
    FROM (SELECT event_type AS table_name, max(ts) AS max_loaded_at FROM events GROUP BY event_type
          UNION ALL SELECT 'cases', max(update_date) FROM cases_log
          UNION ALL SELECT 'case_attributes', max(update_date) FROM attributes_log
          UNION ALL SELECT 'dialer', max(update_date) FROM dialer_log
          UNION ALL SELECT 'contacts', max(update_date) FROM contacts_log) m""")


# ---- reconciliation ------------------------------------------------------------------

def _bronze_sim(log: str) -> str:
    return (f"SELECT * FROM {log} WHERE ingest_seq % 97 <> 0 "
            f"UNION ALL SELECT * FROM {log} WHERE ingest_seq % 89 = 0")


_RECON = [
    ("cases", "cases_log", "case_id", SCOPE),
    ("case_attributes", "attributes_log", "case_id, case_attribute_type_id",
     f"case_attribute_type_id IN ({CFG.attr_type_provider}, {CFG.attr_type_dpd})"),
    ("dialer", "dialer_log", "uniqueid", SCOPE),
    ("contacts", "contacts_log", "contact_id", f"insert_user <> '{CFG.system_contact_user}'"),
]

_counts = " UNION ALL ".join(
    f"""SELECT '{name}' AS "table",
       (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM ({latest(log, keys)}) s WHERE {scope}) a) AS source_count,
       (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM ({_bronze_sim(log)}) b WHERE {scope}) a) AS bronze_count"""
    for name, log, keys, scope in _RECON)

ORACLES["reconcile_counts"] = with_ctes(f"""
    SELECT "table", source_count, bronze_count, drift_pct,
           CASE WHEN drift_pct > 0.005 THEN 1 ELSE 0 END AS flagged,
           CASE WHEN source_count = 0 AND bronze_count > 0 THEN 1 ELSE 0 END AS empty_source
    FROM (SELECT "table", source_count, bronze_count,
                 CASE WHEN source_count > 0 THEN {rate('abs(source_count - bronze_count)', 'source_count', 6)}
                      ELSE CAST(0 AS DOUBLE) END AS drift_pct
          FROM ({_counts}) c) d""")

_CMP = ["case_id", "client_id", "telecom_id", "phone_number", "disposition_code", "call_date", "update_date"]
ORACLES["reconcile_rows"] = with_ctes(f"""
    WITH src AS (SELECT {DIALER_COLS} FROM ({latest('dialer_log', 'uniqueid')}) l WHERE {SCOPE}),
    drifted AS (SELECT * REPLACE (CASE WHEN ingest_seq % 89 = 0 THEN phone_number || '9' ELSE phone_number END
                                  AS phone_number)
                FROM ({_bronze_sim('dialer_log')}) b),
    brz AS ({latest('drifted', 'uniqueid')})
    SELECT uniqueid, status FROM (
      SELECT coalesce(s.uniqueid, b.uniqueid) AS uniqueid,
             CASE WHEN b.uniqueid IS NULL THEN 'missing'
                  WHEN s.uniqueid IS NULL THEN 'extra'
                  WHEN {' OR '.join(f's.{c} IS DISTINCT FROM b.{c}' for c in _CMP)} THEN 'changed' END AS status
      FROM src s FULL OUTER JOIN brz b ON s.uniqueid = b.uniqueid) r
    WHERE status IS NOT NULL""")


# ---- text scan ------------------------------------------------------------------------

RE2_LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"
_EMAIL_PLAIN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _raw_matches() -> str:
    parts = []
    for i, (name, pattern, _hint) in enumerate(textscan.RULES):
        if i == 0:  # RE2 has no lookahead: extract all addresses, drop the example hosts after
            parts.append(
                f"SELECT source, id, line, {_q(name)} AS rule, m FROM (SELECT source, id, line, "
                f"unnest(regexp_extract_all(line_text, {_q(_EMAIL_PLAIN)})) AS m FROM lines) e "
                f"WHERE NOT regexp_matches(m, {_q(r'@example\.(?:com|org|net)\b')})")
        else:
            parts.append(f"SELECT source, id, line, {_q(name)} AS rule, "
                         f"unnest(regexp_extract_all(line_text, {_q(pattern)})) AS m FROM lines")
    texts = ("SELECT 'documents' AS source, doc_id AS id, text FROM documents "
             "UNION ALL SELECT 'pages', page_id, html FROM pages")
    return f"""
    WITH texts AS ({texts}),
    split AS (SELECT source, id, string_split_regex(text, {_q(RE2_LINE_BREAK)}) AS parts FROM texts),
    lines AS (SELECT source, id, CAST(unnest(generate_series(1, len(parts))) AS INTEGER) AS line,
                     unnest(parts) AS line_text FROM split),
    raw AS ({' UNION ALL '.join(parts)})"""


def _kept(col: str = "m") -> str:
    allowed = " AND ".join(f"NOT contains({col}, {_q(a)})" for a in textscan.ALLOWED)
    return f"{allowed} AND NOT regexp_full_match({col}, {_q('(?i)' + textscan.PLACEHOLDER_HOST)})"


ORACLES["leak_findings"] = _raw_matches() + f"""
    SELECT source, id, line, rule, substring(m, 1, {textscan.MATCH_WIDTH}) AS matched,
           CASE rule {' '.join(f"WHEN {_q(n)} THEN {_q(h)}" for n, _, h in textscan.RULES)} END AS hint
    FROM raw WHERE {_kept()}"""

ORACLES["leak_allowlist"] = _raw_matches() + f"""
    SELECT source, id, line, rule, substring(m, 1, {textscan.MATCH_WIDTH}) AS matched,
           CASE WHEN {' OR '.join(f"contains(m, {_q(a)})" for a in textscan.ALLOWED)}
                THEN 1 ELSE 0 END AS allowed
    FROM raw"""

_rule_names = " UNION ALL ".join(f"SELECT {_q(n)} AS rule" for n, _, _ in textscan.RULES)
ORACLES["leak_summary"] = _raw_matches() + f""",
    kept AS (SELECT rule FROM raw WHERE {_kept()}),
    counts AS (SELECT rule, count(*) AS findings FROM kept GROUP BY rule),
    per_rule AS (SELECT r.rule, coalesce(c.findings, 0) AS findings FROM ({_rule_names}) r
                 LEFT JOIN counts c ON c.rule = r.rule
                 UNION ALL SELECT {_q(textscan.ALL_RULES)}, count(*) FROM kept)
    SELECT rule, findings, CASE WHEN findings = 0 THEN 'clean' ELSE 'fail' END AS verdict
    FROM per_rule"""


# ---- ingest, publish, re-run, streaming tail ------------------------------------------------

ORACLES.update({
    "ingest_batch": with_ctes(f"""
        SELECT {DIALER_COLS}, TIMESTAMP '2024-02-15 06:00:00' AS ingest_ts, DATE '2024-02-15' AS ingest_date
        FROM dialer_log WHERE update_date > {SEED} AND {SCOPE}"""),
    "bronze_append": with_ctes(f"""
        SELECT {DIALER_COLS}, DATE '2024-02-15' AS ingest_date
        FROM dialer_log WHERE update_date > {SEED} AND {SCOPE}"""),
    "ingest_all": with_ctes(f"""
        SELECT 'cases' AS table_name, count(*) AS rows_processed, max(update_date) AS last_watermark,
               'success' AS run_status FROM cases_log WHERE {SCOPE}
        UNION ALL SELECT 'case_attributes', count(*), max(update_date), 'success' FROM attributes_log
                  WHERE case_attribute_type_id IN ({CFG.attr_type_provider}, {CFG.attr_type_dpd})
        UNION ALL SELECT 'dialer', count(*), max(update_date), 'success' FROM dialer_log WHERE {SCOPE}
        UNION ALL SELECT 'contacts', count(*), max(update_date), 'success' FROM contacts_log"""),
    "overlap_idempotence": block("stg_dialer"),
    "mart_publish": block("mart_penetration"),
    "mart_rerun_diff": with_ctes("SELECT *, 'before_only' AS side FROM mart_penetration WHERE 1 = 0"),
    "mart_phone_quality_from_state": block("mart_phone_quality"),
    "mart_penetration_from_state": block("mart_penetration"),
    "stream_latest_state": with_ctes(
        f"SELECT {DIALER_COLS} FROM ({latest('dialer_log', 'uniqueid')}) l WHERE {SCOPE}"),
})

ORACLES["daily_run"] = block("mart_penetration")
_recon_run = " UNION ALL ".join(
    f"""SELECT '{name}' AS "table",
       (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {log} WHERE {scope}) a) AS source_count,
       (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {log} WHERE {scope}) a) AS bronze_count"""
    for name, log, keys, scope in [
        ("cases", "cases_log", "case_id", SCOPE),
        ("case_attributes", "attributes_log", "case_id, case_attribute_type_id",
         f"case_attribute_type_id IN ({CFG.attr_type_provider}, {CFG.attr_type_dpd})"),
        ("dialer", "dialer_log", "uniqueid", SCOPE),
        ("contacts", "contacts_log", "contact_id", f"insert_user <> '{CFG.system_contact_user}'"),
    ])
ORACLES["reconciliation_run"] = with_ctes(f"""
    SELECT "table", source_count, bronze_count, drift_pct,
           CASE WHEN drift_pct > 0.005 THEN 1 ELSE 0 END AS flagged,
           CASE WHEN source_count = 0 AND bronze_count > 0 THEN 1 ELSE 0 END AS empty_source,
           TIMESTAMP '2024-02-15 06:00:00.123456' AS checked_at
    FROM (SELECT *, CASE WHEN source_count > 0 THEN {rate('abs(source_count - bronze_count)', 'source_count', 6)}
                         ELSE CAST(0 AS DOUBLE) END AS drift_pct
          FROM ({_recon_run}) c) d""")

ORACLES["stream_latest_state_bucketed"] = ORACLES["stream_latest_state"]
ORACLES["maintenance_run"] = block("mart_penetration")
ORACLES["compact_report"] = with_ctes("""
    SELECT unnest(['rows_before', 'rows_after', 'rows_differing', 'files_not_more']) AS measure,
           unnest([count(*), count(*), 0, 1])::BIGINT AS value FROM dialer_log""")
ORACLES["compact_small_report"] = with_ctes("""
    SELECT unnest(['rows_before', 'rows_after', 'rows_differing', 'files_fewer', 'large_files_untouched', 'less_than_all_rewritten']) AS measure,
           unnest([count(*), count(*), 0, 1, 1, 1])::BIGINT AS value FROM dialer_log""")
ORACLES["stream_latest_state_rebucketed"] = ORACLES["stream_latest_state"]
ORACLES["tables_by_name"] = with_ctes(f"""
    SELECT 'cases' AS table_name, count(*) AS rows FROM cases_log WHERE update_date > {SEED} AND {SCOPE}
    UNION ALL SELECT 'case_attributes', count(*) FROM attributes_log
              WHERE update_date > {SEED} AND case_attribute_type_id IN ({CFG.attr_type_provider}, {CFG.attr_type_dpd})
    UNION ALL SELECT 'dialer', count(*) FROM dialer_log WHERE update_date > {SEED} AND {SCOPE}
    UNION ALL SELECT 'contacts', count(*) FROM contacts_log WHERE update_date > {SEED}""")
ORACLES["compacted_table"] = with_ctes(f"SELECT {DIALER_COLS}, ingest_seq FROM dialer_log")
ORACLES["daily_run_from_state"] = block("mart_penetration")
