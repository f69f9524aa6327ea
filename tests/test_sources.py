"""Watermark guard, incremental predicate and JDBC option building (no database needed)."""

import dataclasses
from datetime import datetime

import pytest

from tests.planutil import explain
from tidemark.config import ReportConfig, SourceSpec, default_sources
from tidemark.sources import jdbc
from tidemark.sources.jdbc import (
    JdbcConnection,
    incremental_pull,
    jdbc_reader_options,
    validate_watermark,
    watermark_guard_col,
)


def test_accepts_well_formed_watermark():
    assert validate_watermark("2026-06-30 14:30:00") == "2026-06-30 14:30:00"


@pytest.mark.parametrize("value", ["2026-06-30", "2026-06-30T14:30:00", "1900-01-01 00:00:00' OR '1'='1", "",
                                   "2026-06-30 14:30:00\n", "9999-99-99 99:99:99"])
def test_rejects_anything_else(value):
    with pytest.raises(ValueError):
        validate_watermark(value)


def test_guard_column_matches_python_guard(spark):
    vals = ["2026-06-30 14:30:00", "2026-06-30", "2026-06-30T14:30:00", "1900-01-01 00:00:00' OR '1'='1", "",
            "2026-06-30 14:30:00\n", "9999-99-99 99:99:99"]
    df = spark.createDataFrame([(v,) for v in vals], "t string").select("t", watermark_guard_col("t").alias("ok"))
    assert {r.t: r.ok for r in df.collect()} == {v: int(v == vals[0]) for v in vals}


SPEC = SourceSpec("dialer", "collections.dialer", ("uniqueid",), ("uniqueid", "client_id", "update_date"),
                  scope_column="client_id", scope_values=(101,))


def test_incremental_pull_is_strict_and_scoped(spark):
    wm = datetime(2026, 1, 1)
    src = spark.createDataFrame(
        [("a", 101, datetime(2026, 1, 1)), ("b", 101, datetime(2026, 1, 1, 0, 0, 1)), ("c", 102, datetime(2026, 2, 1))],
        "uniqueid string, client_id int, update_date timestamp_ntz")
    assert [r.uniqueid for r in incremental_pull(src, SPEC, wm).collect()] == ["b"]


def test_incremental_predicates_reach_the_scan(spark, tmp_path):
    p = str(tmp_path / "src")
    spark.createDataFrame([("a", 101, datetime(2026, 1, 2))],
                          "uniqueid string, client_id int, update_date timestamp_ntz").write.parquet(p)
    spec = SourceSpec("dialer", "collections.dialer", ("uniqueid",), ("uniqueid", "client_id", "update_date"),
                      scope_column="client_id", scope_values=(101, 103))
    plan = explain(incremental_pull(spark.read.parquet(p), spec, datetime(2026, 1, 1)))
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln][0]
    assert "GreaterThan(update_date" in pushed and "In(client_id" in pushed


def test_jdbc_options_split_only_with_real_bounds():
    conn = JdbcConnection("jdbc:x://h/db", "u", "p", "d")
    o = jdbc_reader_options(conn, "t", (1, 100), "case_id", 16)
    assert o["partitionColumn"] == "case_id" and o["numPartitions"] == "16" and o["lowerBound"] == "1"
    assert "partitionColumn" not in jdbc_reader_options(conn, "t", (5, 5), "case_id")
    assert "partitionColumn" not in jdbc_reader_options(conn, "t", (None, None), "case_id")
    assert o["fetchsize"] == "10000" and o["preferTimestampNTZ"] == "true"


def test_connection_from_environment(monkeypatch):
    monkeypatch.setenv("TIDEMARK_JDBC_URL", "jdbc:x://h:1/db")
    monkeypatch.setenv("TIDEMARK_JDBC_USER", "reader")
    monkeypatch.setenv("TIDEMARK_JDBC_PASSWORD", "pw")
    c = JdbcConnection.from_env()
    assert c.options() == {"url": "jdbc:x://h:1/db", "fetchsize": "10000", "user": "reader", "password": "pw"}
    monkeypatch.delenv("TIDEMARK_JDBC_URL")
    with pytest.raises(KeyError):
        JdbcConnection.from_env()


def test_guard_edges_agree(spark):
    """Year 0, leap days, hour 24, minute/second 60: column and Python guards agree."""
    vals = ["0000-01-01 00:00:00", "0001-01-01 00:00:00", "2024-02-29 00:00:00", "2023-02-29 00:00:00",
            "2024-12-31 24:00:00", "2024-01-01 23:60:00", "2024-01-01 00:00:60", "9999-12-31 23:59:59"]

    def py(v):
        try:
            validate_watermark(v)
            return 1
        except ValueError:
            return 0

    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = {r.t: r.a for r in df.select("t", watermark_guard_col("t").alias("a")).collect()}
    assert got == {v: py(v) for v in vals}


def test_source_text_for_scopes_and_reserved_names():
    """What goes to the source: quoted reserved table name, integer lists, a quoted excluded value."""
    specs = {s.table_name: s for s in default_sources(ReportConfig())}
    assert specs["cases"].source_table == "collections.[case]"
    assert jdbc.key_count_table(specs["cases"]) == "(SELECT DISTINCT case_id FROM collections.[case] WHERE client_id IN (101, 102, 103)) k"
    assert jdbc.key_count_table(specs["contacts"]).endswith("FROM collections.contact WHERE insert_user <> 'auto_dialer') k")
    quoted = dataclasses.replace(specs["contacts"], exclude_value="o'x")
    assert jdbc.scope_sql(quoted) == ["insert_user <> 'o''x'"]
    assert jdbc.scope_sql(jdbc.pulled(quoted)) == []


def test_a_cluster_needs_a_shared_folder():
    from tidemark.session import shared_folder

    assert shared_folder("s3a://b/c", None, "yarn") == "s3a://b/c"
    assert shared_folder(None, "/mnt/c", "spark://h:7077") == "/mnt/c"
    assert shared_folder(None, None, "local[4]") is None and shared_folder(None, None, "local") is None
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(None, None, master)


def test_an_allowed_text_past_the_display_cut_is_allowed(spark):
    from tidemark.operators import textscan

    line = "jdbc:x;" + "a" * 90 + "&password=" + textscan.ALLOWED[0]
    df = spark.createDataFrame([(1, line)], "id long, text string")
    assert textscan.scan_text(df, "id", "text").count() == 0
    marked = textscan.scan_text(df, "id", "text", allowed=(), mark_allowed=True).collect()
    assert marked and all(r.allowed == 1 and textscan.ALLOWED[0] not in r.matched for r in marked)
