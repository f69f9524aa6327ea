"""The composed daily and reconciliation jobs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.plans import jobs
from tidemark.plans.catalog import CFG, SPECS, _sources
from tidemark.plans import ingest
from tidemark.sources import bronze

NOW = datetime(2024, 2, 15, 6, 0, 0)


def test_daily_job_publishes_checked_reports(spark, tmp_path):
    base = str(tmp_path)
    res = jobs.run_daily(spark, list(SPECS.values()), ingest.dataframe_reader(_sources(spark, SF_SMALL)), base,
                         NOW, CFG)
    assert res.failed_checks == [] and res.stale_sources == []
    assert spark.read.parquet(res.published[jobs.PENETRATION]).count() == 46
    late = jobs.source_freshness(spark, list(SPECS.values()), base, datetime(2024, 2, 17, 7)).collect()
    assert {r.status for r in late} == {"error"} and len(late) == 4
    assert spark.read.parquet(res.published[jobs.PHONE]).count() == 48
    assert set(res.rows_landed) == set(SPECS)
    # A second run lands only the overlap and publishes version 2 with the same content.
    res2 = jobs.run_daily(spark, list(SPECS.values()), ingest.dataframe_reader(_sources(spark, SF_SMALL)), base,
                          datetime(2024, 2, 16, 6), CFG, check_staging=True)
    assert res2.failed_checks == []
    logged = spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/control/check_results")
    assert {"stg_dialer", "bronze.cases", jobs.PENETRATION} <= {r.model for r in logged.select("model").collect()}
    a = spark.read.parquet(res.published[jobs.PENETRATION])
    b = bronze.read_mart(spark, f"{base}/marts", jobs.PENETRATION)
    assert "/v=2-" in res2.published[jobs.PENETRATION]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_reconciliation_job_raises_on_drift(spark, tmp_path):
    base = str(tmp_path)
    specs = [SPECS["dialer"]]
    full = _sources(spark, SF_SMALL)
    partial = {"dialer": full["dialer"].filter(F.col("update_date") < F.lit("2024-01-20").cast("timestamp_ntz"))}
    ingest.seed_for(specs, base, spark, NOW)
    ingest.ingest_all(spark, specs, ingest.dataframe_reader(partial), base, NOW)
    with pytest.raises(ValueError, match="dialer"):
        jobs.run_reconciliation(spark, specs, lambda s: full[s.table_name], base, NOW)
    logged = jobs.run_reconciliation(spark, specs, lambda s: full[s.table_name], base, datetime(2024, 2, 16),
                                     fail_on_drift=False).collect()[0]
    assert logged.flagged == 1 and logged.bronze_count < logged.source_count


def test_maintenance_prunes_and_readers_see_base_plus_tail(spark, tmp_path):
    from tidemark.config import SourceSpec
    from tidemark.operators.changelog import latest_per_key

    spec = SourceSpec("calls", "src.calls", ("id",), ("id", "v", "update_date"), zorder=("id",), lag_minutes=0)
    base = str(tmp_path)

    def src(rows):
        return {"calls": spark.createDataFrame(rows, "id long, v string, update_date timestamp_ntz")}

    ingest.seed_for([spec], base, spark, datetime(2024, 1, 1))
    day1 = [(i, "a", datetime(2024, 1, 1, 1)) for i in range(100)]
    ingest.ingest_all(spark, [spec], ingest.dataframe_reader(src(day1)), base, datetime(2024, 1, 1, 2))
    day2 = day1 + [(i, "b", datetime(2024, 1, 2, 1)) for i in range(50)]
    ingest.ingest_all(spark, [spec], ingest.dataframe_reader(src(day2)), base, datetime(2024, 1, 2, 2))
    # Retention of one week at Feb 1: both landings are older, so only the newest version per key stays.
    rep = jobs.run_maintenance(spark, [spec], base, datetime(2024, 2, 1), retention_hours=168).collect()[0]
    assert (rep.rows_before, rep.rows_after) == (150, 100)
    day3 = day2 + [(7, "c", datetime(2024, 2, 2, 1))]
    ingest.ingest_all(spark, [spec], ingest.dataframe_reader(src(day3)), base, datetime(2024, 2, 2, 2))
    cur = bronze.current_bronze(spark, base, "calls")
    assert cur.count() == 101  # compacted base + the one new row
    latest = {r.id: r.v for r in latest_per_key(cur, ["id"], ["update_date", "ingest_ts", "ingest_seq"]).collect()}
    assert latest[7] == "c" and latest[3] == "b" and latest[60] == "a" and len(latest) == 100
    # A second pass starts from base + tail; key 7's older version is superseded and past the
    # 30-day retention, so it goes; the new version stays.
    rep2 = jobs.run_maintenance(spark, [spec], base, datetime(2024, 2, 3), retention_hours=24 * 30).collect()[0]
    assert (rep2.rows_before, rep2.rows_after) == (101, 100)
    assert {r.v for r in bronze.current_bronze(spark, base, "calls").filter("id = 7").collect()} == {"c"}


def test_command_line_daily_reconcile_maintain(spark, tmp_path, capsys):
    import json

    from tidemark.__main__ import main

    src_dir = str(tmp_path / "src")
    for name, df in _sources(spark, SF_SMALL).items():
        df.write.parquet(f"{src_dir}/{name}")
    base = str(tmp_path / "base")
    common = ["--base", base, "--source-dir", src_dir, "--now", "2024-02-15T06:00:00"]
    order = [x for t in SPECS for x in ("--sequence-column", f"{t}=ingest_seq")]
    assert main(["daily", *common, *order, "--register", "cli_bronze"]) == 0
    assert spark.table("cli_bronze.cases").count() > 0
    spark.sql("DROP DATABASE cli_bronze CASCADE")
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["failed_checks"] == [] and set(out["rows_landed"]) == set(SPECS)
    assert spark.read.parquet(out["published"][jobs.PENETRATION]).count() == 46
    assert main(["reconcile", *common]) == 0
    rec = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["reconciliation"]
    assert all(r["flagged"] == 0 for r in rec) and len(rec) == 4
    assert main(["maintain", "--base", base, "--now", "2024-03-01T00:00:00"]) == 0
    rep = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["maintenance"]
    assert len(rep) == 4 and all(r["rows_after"] <= r["rows_before"] for r in rep)


def test_scan_files_and_command_line(spark, tmp_path, capsys):
    from tidemark.__main__ import main
    from tidemark.operators import textscan

    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "conf.py").write_text("x = 1\nurl = 'jdbc:sqlserver://h;password=Hunter22x'\n")
    (tmp_path / "src" / "ok.md").write_text("write to ops@example.com\n")
    (tmp_path / ".git").mkdir()
    (tmp_path / ".git" / "config").write_text("bob@corp-mail.io\n")
    found = textscan.scan_files(spark, str(tmp_path), skip_dirs=[".git"]).collect()
    assert [(r.id.endswith("conf.py"), r.line, r.rule) for r in found] == [
        (True, 2, "JDBC/ODBC connection string with an embedded password")]
    assert main(["scan", "--base", str(tmp_path), "--skip-dir", ".git", "--out", str(tmp_path / "out")]) == 1
    assert '"findings": 1' in capsys.readouterr().out
    assert spark.read.json(str(tmp_path / "out")).count() == 1


@pytest.mark.parametrize("micro", [0, 123_456])
def test_jobs_fail_whatever_the_fraction_of_the_second(spark, tmp_path, micro):
    """Drift and failing checks are read from the rows just stored, not looked up by time."""
    now, base = NOW.replace(microsecond=micro), str(tmp_path)
    full = _sources(spark, SF_SMALL)
    broken = full | {"contacts": full["contacts"].withColumn("contact_id", F.lit(None).cast("long"))}
    with pytest.raises(ValueError, match="bronze.contacts.not_null"):
        jobs.run_daily(spark, list(SPECS.values()), ingest.dataframe_reader(broken), base, now)
    with pytest.raises(ValueError, match="reconciliation drift"):
        jobs.run_reconciliation(spark, [SPECS["contacts"]], lambda s: full[s.table_name], base, now)


def test_command_line_fails_on_drift_without_a_given_time(spark, tmp_path):
    from tidemark.__main__ import main

    base, src = str(tmp_path / "base"), str(tmp_path / "src")
    for name, df in _sources(spark, SF_SMALL).items():
        (df.limit(20) if name == "cases" else df).write.parquet(f"{src}/{name}")
    ingest.seed_for(list(SPECS.values()), base, spark, NOW)
    with pytest.raises(ValueError, match="reconciliation drift"):
        main(["reconcile", "--base", base, "--source-dir", src]) or main(["reconcile", "--base", base, "--source-dir", src])


@pytest.mark.parametrize("shift", [0, -3])
def test_no_row_is_lost_after_maintenance(spark, tmp_path, shift):
    """Landings after maintenance whose run time is equal to or before the newest one it took."""
    from datetime import timedelta

    from tidemark.config import SourceSpec

    spec = SourceSpec("calls", "src.calls", ("id",), ("id", "v", "update_date"), zorder=("id",), lag_minutes=0)
    base, when = str(tmp_path), datetime(2024, 1, 5, 2)

    def land(rows, now):
        df = spark.createDataFrame(rows, "id long, v string, update_date timestamp_ntz")
        ingest.ingest_all(spark, [spec], ingest.dataframe_reader({"calls": df}), base, now)

    ingest.seed_for([spec], base, spark, datetime(2024, 1, 1))
    land([(i, "a", datetime(2024, 1, 4)) for i in range(10)], when)
    jobs.run_maintenance(spark, [spec], base, datetime(2024, 2, 1))
    land([(i, "b", datetime(2024, 1, 4, 1)) for i in range(10, 20)], when + timedelta(days=shift))
    cur = bronze.current_bronze(spark, base, "calls")
    assert cur.count() == 20 and cur.select("id").distinct().count() == 20
    jobs.run_maintenance(spark, [spec], base, datetime(2024, 2, 8))
    assert bronze.current_bronze(spark, base, "calls").count() == 20


def test_versions_expire_but_the_one_in_force(spark, tmp_path):
    import os

    base, old = str(tmp_path), datetime(2020, 1, 1)
    paths = [bronze.publish_mart(spark, spark.range(n), base, "m", old) for n in (1, 2, 3)]
    for p in paths:
        os.utime(p, (old.timestamp(), old.timestamp()))
    with pytest.raises(ValueError):
        bronze.expire_versions(spark, base, "m", datetime(2020, 3, 1), 24)
    assert bronze.expire_versions(spark, base, "m", datetime(2020, 1, 2)) == []
    assert len(bronze.expire_versions(spark, base, "m", datetime(2020, 3, 1))) == 2
    assert bronze.read_mart(spark, base, "m").count() == 3


def test_daily_from_state_equals_daily_from_logs(spark, tmp_path):
    """Two daily runs (the second re-reads an overlap) over state tables give the same reports
    as the change-log path."""
    full = _sources(spark, SF_SMALL)
    early = {k: v.filter(F.col("update_date") < F.lit("2001-01-01").cast("timestamp_ntz")) if k == "cases" else v
             for k, v in full.items()}
    results = {}
    for mode, buckets in (("logs", None), ("state", 4)):
        base = str(tmp_path / mode)
        jobs.run_daily(spark, list(SPECS.values()), ingest.dataframe_reader(early), base, NOW, CFG,
                       state_buckets=buckets)
        res = jobs.run_daily(spark, list(SPECS.values()), ingest.dataframe_reader(full), base,
                             datetime(2024, 2, 16, 6), CFG, state_buckets=buckets)
        results[mode] = {n: spark.read.parquet(p) for n, p in res.published.items()}
    for name in (jobs.PENETRATION, jobs.PHONE):
        a, b = results["logs"][name], results["state"][name]
        assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_reports_resolve_before_the_first_batch_lands(spark, tmp_path):
    """Setup creates empty typed bronze tables, so staging and the reports run (empty)
    even when the first ingest brought nothing."""
    base = str(tmp_path)
    ingest.seed_for(list(SPECS.values()), base, spark, NOW)
    reports = jobs.build_reports(spark, base, CFG)
    assert reports[jobs.PENETRATION].count() == 0 and reports[jobs.PHONE].count() == 0


def test_a_version_expires_by_when_it_was_superseded(spark, tmp_path):
    """A base of long ago, superseded just now, stays for its readers; older ones go."""
    import os

    base = str(tmp_path)
    weeks = [datetime(2020, 1, 1), datetime(2020, 3, 1), datetime(2020, 3, 20)]
    paths = [bronze.publish_mart(spark, spark.range(n + 1), base, "m", at) for n, at in enumerate(weeks)]
    for p in paths:
        os.utime(p, (weeks[0].timestamp(), weeks[0].timestamp()))
    opened = spark.read.parquet(paths[1])
    assert bronze.expire_versions(spark, base, "m", datetime(2020, 3, 21)) == [os.path.basename(paths[0])]
    assert opened.count() == 2
    assert bronze.expire_versions(spark, base, "m", datetime(2020, 3, 28)) == [os.path.basename(paths[1])]


def test_readers_go_on_after_maintenance_and_tails_stay_short(spark, tmp_path):
    from tidemark.config import SourceSpec

    spec = SourceSpec("calls", "src.calls", ("id",), ("id", "v", "update_date"), zorder=("id",), lag_minutes=0)
    base = str(tmp_path)

    def land(k, now):
        df = spark.createDataFrame([(k, "a", now)], "id long, v string, update_date timestamp_ntz")
        ingest.ingest_all(spark, [spec], ingest.dataframe_reader({"calls": df}), base, now)

    ingest.seed_for([spec], base, spark, datetime(2024, 1, 1))
    opened = None
    for week in range(3):
        for day in range(2):
            land(10 * week + day, datetime(2024, 1, 2 + 7 * week + day))
        assert len(bronze.tail_landings(spark, base, "calls")) == 2
        opened = bronze.current_bronze(spark, base, "calls")
        jobs.run_maintenance(spark, [spec], base, datetime(2024, 1, 6 + 7 * week))
        assert opened.count() == 2 * (week + 1)  # what it was built on is still there
        assert bronze.tail_landings(spark, base, "calls") == []
        assert bronze.current_bronze(spark, base, "calls").count() == 2 * (week + 1)
    assert jobs.newest_landings(spark, base, "calls").count() == 1


def test_a_landing_adds_its_partition_to_a_registered_table(spark, tmp_path):
    from tidemark.config import SourceSpec

    spec = SourceSpec("calls", "src.calls", ("id",), ("id", "update_date"), lag_minutes=0)
    base, database = str(tmp_path), "reg_" + tmp_path.name.replace("-", "_")
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{tmp_path}/{database}.db'")
    ingest.seed_for([spec], base, spark, datetime(2024, 1, 1))
    for day in (2, 3, 3):
        now = datetime(2024, 1, day, 1)
        df = spark.createDataFrame([(day, now)], "id long, update_date timestamp_ntz")
        ingest.ingest_all(spark, [spec], lambda s, w, df=df: df, base, now, register_database=database)
    assert spark.table(f"`{database}`.calls").count() == 3
    with pytest.raises(ValueError):
        bronze.register_table(spark, database, "calls", f"{base}/bronze/calls", landed=(datetime(2024, 1, 4).date(), "x'y"))
