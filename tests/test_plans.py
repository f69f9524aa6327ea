"""Plan shapes that matter at scale."""

from tests.conftest import SF_SMALL
from tests.planutil import explain
from tidemark.plans.catalog import QUERIES


def test_penetration_mart_has_no_nested_loop_or_cartesian(spark):
    plan = explain(QUERIES["mart_penetration"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # Every per-case aggregate is partial before its exchange.
    assert plan.count("partial_count") >= 2


def test_scans_read_only_needed_columns(spark):
    plan = explain(QUERIES["mart_phone_quality"](spark, SF_SMALL))
    schema = [ln for ln in plan.splitlines() if "ReadSchema" in ln][0]
    assert "props" not in schema and "value" not in schema


def test_incremental_pull_filters_reach_parquet(spark):
    plan = explain(QUERIES["incremental_pull"](spark, SF_SMALL))
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln][0]
    assert "GreaterThan(ts" in pushed


def test_reconcile_counts_has_no_cross_join(spark):
    plan = explain(QUERIES["reconcile_counts"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rewrites_equal_plain_forms(spark):
    a = QUERIES["contact_stats"](spark, SF_SMALL)
    b = QUERIES["contact_stats_distinct"](spark, SF_SMALL)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_report_over_state_pushes_window_into_scan(spark):
    plan = explain(QUERIES["mart_phone_quality_from_state"](spark, SF_SMALL))
    pushed = " ".join(ln for ln in plan.splitlines() if "PushedFilters" in ln)
    assert "GreaterThanOrEqual(call_date" in pushed and "LessThan(call_date" in pushed
    assert "Window" not in plan  # no dedup at report time


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_o6_prefilter_equals_plain_form(spark):
    assert _same(QUERIES["mart_phone_quality_prefiltered"](spark, SF_SMALL), QUERIES["mart_phone_quality"](spark, SF_SMALL))


def test_o4_o7_report_equals_literal_form(spark):
    """The report (count_if, no scope join) equals the literal form: inner join to active cases,
    then three distinct counts, then the roll-up."""
    from datetime import date

    from pyspark.sql import functions as F

    from tidemark.config import ReportConfig
    from tidemark.operators import marts, staging
    from tidemark.sources import fixtures as fx

    cfg = ReportConfig(as_of=date(2024, 2, 15))
    active = marts.active_cases(staging.stg_cases(fx.cases_log(spark, SF_SMALL), cfg),
                                staging.stg_case_attributes(fx.attributes_log(spark, SF_SMALL), cfg), cfg)
    calls = staging.stg_dialer(fx.dialer_log(spark, SF_SMALL), cfg)
    dialed = marts.dialed_cases(calls, cfg).withColumn("dialed_case", F.col("case_id"))
    literal_counts = marts.contact_stats(staging.stg_contacts(fx.contacts_log(spark, SF_SMALL), cfg), active, cfg,
                                         distinct=True)
    literal = marts.penetration_rollup(active, dialed, literal_counts)
    assert _same(literal, QUERIES["mart_penetration"](spark, SF_SMALL))


def test_dq_report_deduplicates_each_log_once(spark, monkeypatch):
    """Four staged views, each stored once; what reads them has no dedup of history left."""
    from tidemark.plans import jobs

    stored = []
    store = jobs.stored_once
    monkeypatch.setattr(jobs, "stored_once", lambda df, name: stored.append(explain(df, "simple")) or store(df, name))
    plan = explain(QUERIES["dq_report"](spark, SF_SMALL), "simple")
    assert len(stored) == 4
    windows = sum(p.count("WindowGroupLimit") for p in stored)
    assert windows <= 2 * 4 and plan.count("WindowGroupLimit") <= 2  # the rest: the failing input's own dedup


def test_row_reconciliation_shuffles_hashes(spark):
    plan = explain(QUERIES["reconcile_rows"](spark, SF_SMALL))
    exchanged = [ln for ln in plan.splitlines() if "hashpartitioning" in ln]
    assert exchanged and "phone_number" not in " ".join(exchanged)
    import re

    blocks = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)
    assert blocks and not any("phone_number" in b or "call_date" in b for b in blocks)


def test_extraction_cost_filter_reaches_the_scan(spark, tmp_path):
    from datetime import datetime

    from tidemark.operators.cost import extraction_cost

    path = str(tmp_path / "log")
    spark.sql("SELECT id, timestamp_ntz'2024-01-01' AS called, timestamp_ntz'2024-01-01' AS updated FROM range(9)").write.parquet(path)
    plan = explain(extraction_cost(spark.read.parquet(path), "called", "updated", datetime(2024, 2, 1), datetime(2024, 1, 31)))
    assert any("Or(" in ln for ln in plan.splitlines() if "PushedFilters" in ln)


def test_freshness_reads_the_newest_landing_day(spark, tmp_path):
    from datetime import datetime

    from tidemark.plans import ingest, jobs
    from tidemark.plans.catalog import SPECS, _sources

    base, specs = str(tmp_path), [SPECS["contacts"]]
    for now in (datetime(2024, 2, 14), datetime(2024, 2, 15)):
        ingest.seed_for(specs, base, spark, now)
        ingest.ingest_all(spark, specs, ingest.dataframe_reader(_sources(spark, SF_SMALL)), base, now)
    plan = explain(jobs.source_freshness(spark, specs, base, datetime(2024, 2, 15)))
    assert any("ingest_date" in ln and "2024-02-15" in ln for ln in plan.splitlines() if "PartitionFilters" in ln)


def test_maintenance_prunes_history_once(spark, tmp_path, monkeypatch):
    """Bounds, range sampling and the write read the stored, pruned history."""
    from datetime import datetime

    from tidemark.operators import layout
    from tidemark.plans import ingest, jobs
    from tidemark.plans.catalog import SPECS, _sources

    base, specs, seen = str(tmp_path), [SPECS["dialer"]], []
    ingest.seed_for(specs, base, spark, datetime(2024, 2, 14))
    ingest.ingest_all(spark, specs, ingest.dataframe_reader(_sources(spark, SF_SMALL)), base, datetime(2024, 2, 14))
    cluster = layout.cluster
    monkeypatch.setattr(layout, "cluster", lambda df, *a: seen.append(explain(df, "simple")) or cluster(df, *a))
    jobs.run_maintenance(spark, specs, base, datetime(2024, 3, 1))
    assert len(seen) == 1 and "Exchange" not in seen[0] and "Window" not in seen[0]
    assert [layout.bits_for(n, 2) for n in (1, 400_000)] == [8, 14]
