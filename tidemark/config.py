"""Run parameters: business codes, the reporting window and the source catalogue.

Business codes are parameters, never literals inside the operators, so a code
that changes at the source is a one-line change here.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

# Fixed values that must match the reports being replaced (band labels, the
# default labels and the seed watermark).
DPD_BANDS: tuple[tuple[int, int | None, str], ...] = (
    (0, 30, "A: 0-30"),
    (31, 60, "B: 31-60"),
    (61, 90, "C: 61-90"),
    (91, 180, "D: 91-180"),
    (181, 360, "E: 181-360"),
    (361, None, "F: 361+"),
)
NO_DPD_LABEL = "Sem DPD"
NO_PROVIDER_LABEL = "Sem Provider"
SEED_WATERMARK = datetime(1900, 1, 1, 0, 0, 0)
WATERMARK_LAG_MINUTES = 15
MIN_RETENTION_HOURS = 168


@dataclass(frozen=True)
class ReportConfig:
    """Codes and window of the two reports (one frozen object per run)."""

    client_ids: tuple[int, ...] = (101, 102, 103)
    attr_type_provider: int = 11
    attr_type_dpd: int = 12
    disposition_answered: int = 201
    disposition_no_answer: int = 202
    disposition_failed: int = 203
    status_paid: int = 1
    status_ptp: tuple[int, ...] = (2, 3)
    target_right_party: tuple[int, ...] = (1, 2)
    system_contact_user: str = "auto_dialer"
    active_case_statute_id: int = 0
    window_months_back: int = 2
    cleanup_min_total_calls: int = 5
    cleanup_min_failed_calls: int = 6
    # The as-of date replaces current_date(): a run is reproducible. It has no default;
    # whatever uses the window asks for it, and ``run_daily`` takes it from its run time.
    as_of: date | None = None
    # Order of versions inside a change log, newest first. ``ingest_seq`` is a
    # total-order tie-breaker (the ingest stamp is constant within a batch).
    version_order: tuple[str, ...] = ("update_date", "ingest_ts", "ingest_seq")

    def report_date(self) -> date:
        if self.as_of is None:
            raise ValueError("ReportConfig.as_of is needed for the report window")
        return self.as_of


@dataclass(frozen=True)
class SourceSpec:
    """One extracted source table: what to pull, how to split the pull."""

    table_name: str
    source_table: str
    key: tuple[str, ...]
    columns: tuple[str, ...]
    watermark_column: str = "update_date"
    # Typed scope filter ``column IN (values)``; never free SQL text.
    scope_column: str | None = None
    scope_values: tuple[int, ...] = ()
    # Typed filter ``column <> value`` of the scope (rows without a value are out of scope too).
    exclude_column: str | None = None
    exclude_value: str | None = None
    # Whether the pull leaves the excluded rows at the source too, or only reconciliation does.
    exclude_when_pulled: bool = True
    partition_column: str | None = None
    num_partitions: int = 8
    lag_minutes: int = WATERMARK_LAG_MINUTES
    zorder: tuple[str, ...] = field(default_factory=tuple)
    # A source column that orders versions of a key (identity, row version).
    # Without one, a hash of the row breaks ties between versions that share
    # ``update_date`` and ingest stamp: deterministic, but not source order.
    sequence_column: str | None = None
    # Cap on rows per bronze file for a large batch (None: one file per read partition).
    max_records_per_file: int | None = None


def default_sources(cfg: ReportConfig = ReportConfig()) -> tuple[SourceSpec, ...]:
    """The four extracted sources of the reports."""
    return (
        SourceSpec(
            "cases", "collections.[case]", ("case_id",),
            ("case_id", "client_id", "ref_number", "debtor_id", "original_capital",
             "actual_capital", "case_statute_id", "update_date"),
            scope_column="client_id", scope_values=cfg.client_ids,
            partition_column="case_id", num_partitions=8, zorder=("case_id",),
        ),
        SourceSpec(
            "case_attributes", "collections.case_attribute",
            ("case_id", "case_attribute_type_id"),
            ("case_id", "case_attribute_type_id", "case_attribute_value", "update_date"),
            scope_column="case_attribute_type_id",
            scope_values=(cfg.attr_type_provider, cfg.attr_type_dpd),
            partition_column="case_id", num_partitions=8, zorder=("case_id",),
        ),
        SourceSpec(
            "dialer", "collections.dialer", ("uniqueid",),
            ("uniqueid", "case_id", "client_id", "telecom_id", "phone_number",
             "disposition_code", "call_date", "update_date"),
            scope_column="client_id", scope_values=cfg.client_ids,
            partition_column="case_id", num_partitions=16, zorder=("case_id", "call_date"),
        ),
        SourceSpec(
            "contacts", "collections.contact", ("contact_id",),
            ("contact_id", "case_id", "status_type_id", "target_type_id", "contact_date",
             "insert_user", "update_date"),
            exclude_column="insert_user", exclude_value=cfg.system_contact_user, exclude_when_pulled=False,
            partition_column="contact_id", num_partitions=8, zorder=("case_id", "contact_date"),
        ),
    )
