"""The control log against a few lines of Python, over random sequences of runs."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.config import SEED_WATERMARK
from tidemark.plans import control

START = datetime(2025, 3, 1)
TABLES = ["first", "second", "never_seeded"]
RUN = st.tuples(st.sampled_from(TABLES), st.sampled_from(["batch", "empty", "failed"]), st.integers(-50, 50), st.integers(1, 999),
                st.sampled_from([0, 123_456]))


def replay(runs):
    """Watermark, rows and status per table, and the watermark after each of its runs."""
    mark, last, history = {t: START for t in TABLES[:2]}, {}, {t: [] for t in TABLES}
    for i, (table, kind, day, rows, micro) in enumerate(runs):
        before = mark.get(table, SEED_WATERMARK)
        batch_max = START + timedelta(days=day, microseconds=micro)
        mark[table] = max(before, batch_max) if kind == "batch" else before
        last[table] = (rows if kind == "batch" else 0, "failed" if kind == "failed" else "success")
        history[table].append(mark[table])
    return mark, last, history


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(runs=st.lists(RUN, min_size=1, max_size=6))
def test_runs_replayed(spark, tmp_path_factory, runs):
    path = str(tmp_path_factory.mktemp("control") / "log")
    control.append_control(spark, path, [(t, START, 0, START, "initialized") for t in TABLES[:2]])
    for i, (table, kind, day, rows, micro) in enumerate(runs):
        now = START + timedelta(days=100, hours=i, microseconds=micro)
        if kind == "failed":
            control.mark_failed(spark, path, table, "m" * 300, now)
        else:
            batch_max = START + timedelta(days=day, microseconds=micro) if kind == "batch" else None
            control.update_watermark(spark, path, table, batch_max, rows if kind == "batch" else 0, now)
    mark, last, history = replay(runs)
    log = control.read_control(spark, path)
    for r in control.current_watermark(log).collect():
        assert r.last_watermark == mark[r.table_name]
        if r.table_name in last:
            rows, status = last[r.table_name]
            assert r.rows_processed == rows and r.run_status.startswith(status)
            assert not r.run_status.startswith("failed") or len(r.run_status) == len("failed: ") + 200
    for table in TABLES:
        after = [r.effective_watermark for r in control.watermark_history(log).where(f"table_name = '{table}' AND run_status <> 'initialized'")
                 .orderBy("updated_at").collect()]
        assert after == history[table]
        text = control.get_watermark(spark, path, table, lag_minutes=90)
        want = max(mark.get(table, SEED_WATERMARK) - timedelta(minutes=90), SEED_WATERMARK)
        assert text == want.replace(microsecond=0).strftime("%Y-%m-%d %H:%M:%S")


@pytest.mark.parametrize("days", [1, 30, 1000])
def test_running_max_in_blocks_equals_one_pass(spark, days):
    rows = [(t, START + timedelta(days=(7 * i) % 90, hours=i % 3), START + timedelta(days=(31 * i) % 77), i) for i in range(120) for t in ("a", "b")]
    df = spark.createDataFrame(rows, "table_name string, updated_at timestamp_ntz, last_watermark timestamp_ntz, n int")
    got = {(r.table_name, r.n): r.before for r in control.running_max(df, ["updated_at", "n"], days).collect()}
    for t in ("a", "b"):
        top = None
        for _, at, mark, n in sorted((r for r in rows if r[0] == t), key=lambda r: (r[1], r[3])):
            assert got[t, n] == top
            top = mark if top is None else max(top, mark)


def test_the_log_is_seeded_once(spark, tmp_path):
    path = str(tmp_path / "log")
    assert [control.seed_control(spark, path, tables, START) for tables in (["x", "y"], ["x", "y", "z"])] == [True, False]
    assert control.read_control(spark, path).count() == 2


def test_parallel_appends_all_arrive(spark, tmp_path):
    path = str(tmp_path / "log")
    names = [f"source{i}" for i in range(5)]
    with ThreadPoolExecutor(len(names)) as pool:
        list(pool.map(lambda n: control.update_watermark(spark, path, n, START, 7, START + timedelta(days=1)), names))
    assert {(r.table_name, r.rows_processed) for r in control.current_watermark(control.read_control(spark, path)).collect()} == {(n, 7) for n in names}


def test_a_folded_log_stays_short_and_loses_no_run(spark, tmp_path):
    from tidemark.sources import bronze

    path, day = str(tmp_path / "watermarks"), datetime(2024, 1, 1)
    control.seed_control(spark, path, ["a", "b"], day)
    wanted = {"a": SEED_WATERMARK, "b": SEED_WATERMARK}
    for n in range(12):
        now = day + timedelta(hours=n + 1)
        table = "ab"[n % 2]
        if n == 7:
            control.mark_failed(spark, path, table, "no connection", now)
        else:
            wanted[table] = control.update_watermark(spark, path, table, day + timedelta(minutes=n), 5, now)
        if n % 4 == 3:
            control.fold_control(spark, path)
            assert len(bronze.folder_names(spark, path)) <= 6  # the runs since the fold before, and the folded rows
        for t, at in wanted.items():
            assert control.get_watermark(spark, path, t) == at.strftime("%Y-%m-%d %H:%M:%S")
    history = control.read_history(spark, path)
    assert history.count() == 14 and history.distinct().count() == 14
    current = {r["table_name"]: r for r in control.current_watermark(control.read_control(spark, path)).collect()}
    assert current["a"]["updated_at"] == day + timedelta(hours=11) and current["b"]["run_status"] == "success"
    assert control.fold_if_long(spark, path) == 0 and control.fold_if_long(spark, path, 0) > 0
    assert control.read_history(spark, path).count() == 14
    assert control.watermark_history(control.read_history(spark, path)).count() == 14
