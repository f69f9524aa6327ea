"""The penetration report kept by change: signed deltas instead of a rebuild.

A row that changes takes its old version's contribution back (-1) and brings its new one
(+1). Calls and contacts are summed per case, so a batch becomes a few numbers for the
cases it touches; each of these cases takes its old row out of its old segment and puts
its new row into its new one. What is stored are signed rows, appended batch by batch:
per case (calls, paid, ptp, cc in the window) and per segment. The report is the sum
per segment. Old versions are looked up in the change logs for the batch's keys only,
so a batch costs narrow scans and shuffles of its own size; nothing is rewritten.

The window moves the same way: rows that leave it count -1, rows that enter it +1.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import ReportConfig
from tidemark.functions.expressions import in_window, safe_rate
from tidemark.operators import marts, staging
from tidemark.operators.changelog import latest_per_key

SEGMENT = ("client_id", "provider", "dpd_faixa")
PER_CASE = ("total_calls", "paid_count", "ptp_count", "cc_count")
MEASURES = ("quantidade", "acionado", "total_calls", "paid", "ptp", "cc")
KEYS = {"cases": ("case_id",), "case_attributes": ("case_id", "case_attribute_type_id"), "dialer": ("uniqueid",), "contacts": ("contact_id",)}
Store = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Deltas:
    """Signed rows: ``cases`` (case_id and ``PER_CASE``), ``segments`` (``SEGMENT`` and ``MEASURES``)."""

    cases: DataFrame
    segments: DataFrame


def _of_keys(df: DataFrame, wanted: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows of ``df`` whose keys (nulls alike) are among ``wanted``'s."""
    theirs = wanted.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    return df.join(theirs, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], "left_semi")


def _of_cases(df: DataFrame, affected: DataFrame) -> DataFrame:
    """Rows of ``df`` of the affected cases. A null case counts for nothing, so plain equality will do:
    the rows then lie as a dedup by case wants them, and are not shuffled again."""
    return df.join(affected.select("case_id"), "case_id", "left_semi").select(*df.columns)


def signed_changes(log: DataFrame, batch: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """``sign``: -1 for the version in force before of every key in ``batch``, +1 for the one after."""
    old = latest_per_key(_of_keys(log, batch, keys), keys, order)
    new = latest_per_key(old.unionByName(batch.select(*log.columns)), keys, order)
    return old.withColumn("sign", F.lit(-1)).unionByName(new.withColumn("sign", F.lit(1)))


def _sums(rows: DataFrame, by: tuple[str, ...], measures: tuple[str, ...]) -> DataFrame:
    """Signed sums; groups that come to nothing are left out."""
    total = rows.groupBy(*by).agg(*[F.sum(m).cast("long").alias(m) for m in measures])
    return total.where(" OR ".join(f"{m} <> 0" for m in measures))


def _counted(log: DataFrame, table: str, cfg: ReportConfig, when: Column) -> DataFrame:
    """Versions of calls or contacts with what a dedup and the report need, and no more: the key, the
    order, ``case_id`` and ``hits``, the ``PER_CASE`` columns that a version counts for as bits.
    ``when`` says by a version's date whether it counts (1), counts negatively (-1) or not (0)."""
    if table == "dialer":
        scope, bits = staging.calls_scope(cfg), F.lit(1)
    else:
        status, target = F.col("status_type_id"), F.col("target_type_id")
        kinds = (status == cfg.status_paid, status.isin(*cfg.status_ptp), target.isin(*cfg.target_right_party))
        bits = sum((F.when(k & F.col("contact_id").isNotNull(), 2 << i).otherwise(0) for i, k in enumerate(kinds)), F.lit(0))
        scope = staging.contacts_scope(cfg)
    hits = F.when(scope, bits * when).otherwise(0).cast("byte")
    return log.select(*KEYS[table], *cfg.version_order, F.when(hits != 0, F.col("case_id")).alias("case_id"), hits.alias("hits"))


def _in(table: str, cfg: ReportConfig) -> Column:
    return F.coalesce(in_window("call_date" if table == "dialer" else "contact_date", *marts.bounds(cfg)), F.lit(False))


def _per_case(signed: DataFrame) -> DataFrame:
    """What counted versions with ``sign`` add to their cases."""
    hits = F.abs("hits")
    counted = [F.when(hits.bitwiseAND(F.lit(1 << i).cast("byte")) != 0, F.col("sign")).otherwise(0).alias(c) for i, c in enumerate(PER_CASE)]
    return signed.where("hits <> 0").select("case_id", *counted)


def _contributions(active: DataFrame, per_case: DataFrame, sign: int) -> DataFrame:
    """What active cases add to (or, with -1, take from) their segments."""
    counts = [F.coalesce(c, F.lit(0)) for c in PER_CASE]
    measures = [F.when(F.col("case_id").isNotNull(), 1).otherwise(0), F.when(counts[0] > 0, 1).otherwise(0), *counts]
    joined = active.join(per_case, "case_id", "left")
    return joined.select(*SEGMENT, *[(m * sign).cast("long").alias(n) for m, n in zip(measures, MEASURES)])


def _active(logs: dict[str, DataFrame], affected: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Active cases with their segments, of the affected ones, as of some change logs."""
    of = {t: _of_cases(logs[t], affected) for t in ("cases", "case_attributes")}
    return marts.active_cases(staging.stg_cases(of["cases"], cfg), staging.stg_case_attributes(of["case_attributes"], cfg), cfg)


def apply_batch(deltas: Deltas | None, logs: dict[str, DataFrame], batch: dict[str, DataFrame], cfg: ReportConfig, store: Store) -> Deltas:
    """``deltas`` after ``batch`` (change-log rows per source) has joined ``logs``, the change
    logs before it. ``store`` writes a small table and reads it back. With None, ``logs``
    must be empty and the batch is the first load.

    Rows that repeat or are older than what is in force change nothing: old and new
    version are the same, and their contributions cancel. A case of null id counts for
    nothing."""
    order = cfg.version_order
    parts = [signed_changes(*[_counted(d[t], t, cfg, F.when(_in(t, cfg), 1).otherwise(0)) for d in (logs, batch)], KEYS[t], order) for t in ("dialer", "contacts")]
    more = store(_sums(_per_case(parts[0]).unionByName(_per_case(parts[1])), ("case_id",), PER_CASE), "case-deltas")
    touched = more.select("case_id").unionByName(batch["cases"].select("case_id")).unionByName(batch["case_attributes"].select("case_id"))
    after = {t: logs[t].unionByName(batch[t].select(*logs[t].columns)) for t in ("cases", "case_attributes")}
    return _moved(deltas, more, store(touched.distinct(), "case-touched"), logs, after, cfg, cfg, store)


def _moved(deltas: Deltas | None, more: DataFrame, affected: DataFrame, before: dict, after: dict,
           cfg_before: ReportConfig, cfg: ReportConfig, store: Store) -> Deltas:
    """Append ``more`` per case, and the affected cases' moves between segments."""
    nothing = more.limit(0)
    held = deltas.cases if deltas else nothing
    mine = _of_cases(held, affected)
    old = _sums(mine, ("case_id",), PER_CASE)
    new = _sums(mine.unionByName(more), ("case_id",), PER_CASE)
    moves = _contributions(_active(after, affected, cfg), new, 1)
    if deltas:
        moves = moves.unionByName(_contributions(_active(before, affected, cfg_before), old, -1))
    segments = store(_sums(moves, SEGMENT, MEASURES), "segment-deltas")
    if not deltas:
        return Deltas(more, segments)
    return Deltas(held.unionByName(more), deltas.segments.unionByName(segments))


def move_window(deltas: Deltas, logs: dict[str, DataFrame], cfg: ReportConfig, to: ReportConfig, store: Store) -> Deltas:
    """``deltas`` for the window of ``to`` instead of that of ``cfg``: calls and contacts of days
    in only one of them are counted out or in. Only keys that have a version on those days
    are looked at."""
    parts = []
    for t in ("dialer", "contacts"):
        versions = _counted(logs[t], t, cfg, F.when(_in(t, cfg) & ~_in(t, to), -1).when(_in(t, to) & ~_in(t, cfg), 1).otherwise(0))
        keyed = _of_keys(versions, versions.where("hits <> 0"), KEYS[t])
        parts.append(_per_case(latest_per_key(keyed, KEYS[t], cfg.version_order).withColumn("sign", F.signum("hits").cast("int"))))
    changes = parts[0].unionByName(parts[1])
    more = store(_sums(changes, ("case_id",), PER_CASE), "case-deltas")
    return _moved(deltas, more, more.select("case_id"), logs, logs, cfg, to, store)


def compacted(deltas: Deltas, store: Store) -> Deltas:
    """The same sums in one row per case and per segment."""
    return Deltas(store(_sums(deltas.cases, ("case_id",), PER_CASE), "case-sums"), store(_sums(deltas.segments, SEGMENT, MEASURES), "segment-sums"))


def mart_from_deltas(deltas: Deltas) -> DataFrame:
    """The penetration report, as ``marts.mart_penetration`` builds it."""
    total = _sums(deltas.segments, SEGMENT, MEASURES).where("quantidade <> 0")
    return total.select(*SEGMENT, "quantidade", "acionado", (F.col("quantidade") - F.col("acionado")).alias("sem_ac"),
                        safe_rate("acionado", "quantidade").alias("penetration_rate"), *MEASURES[2:])
