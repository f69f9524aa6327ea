"""Change-log semantics: dedup before scope, total order, pivot, upsert, retention."""

from datetime import datetime

import pytest

from tests.planutil import explain
from tidemark.config import ReportConfig
from tidemark.operators import changelog
from tidemark.operators.staging import stg_case_attributes, stg_cases

T = datetime


def _cases(spark, rows):
    return spark.createDataFrame(rows, "case_id long, client_id int, ref_number string, debtor_id long, "
                                       "original_capital decimal(18,2), actual_capital decimal(18,2), "
                                       "case_statute_id int, update_date timestamp_ntz, ingest_ts timestamp_ntz, "
                                       "ingest_seq long")


def test_closed_case_is_not_resurrected(spark):
    """The scope filter runs after the dedup."""
    log = _cases(spark, [
        (1, 101, "R", 1, None, None, 0, T(2024, 1, 1), T(2024, 1, 2), 1),
        (1, 101, "R", 1, None, None, 1, T(2024, 2, 1), T(2024, 2, 2), 2),  # closed later
        (2, 104, "R", 1, None, None, 0, T(2024, 2, 1), T(2024, 2, 2), 3),  # out of scope now
        (2, 101, "R", 1, None, None, 0, T(2024, 1, 1), T(2024, 1, 2), 4),
    ])
    assert stg_cases(log, ReportConfig()).count() == 0


def test_ties_are_broken_by_sequence(spark):
    """Equal update_date and ingest_ts; the higher sequence wins, every time."""
    rows = [(1, 101, f"R{i}", 1, None, None, 0, T(2024, 1, 1), T(2024, 1, 2), i) for i in (5, 9, 7)]
    for _ in range(3):
        got = changelog.latest_per_key(_cases(spark, rows).repartition(3), ["case_id"],
                                       ["update_date", "ingest_ts", "ingest_seq"]).collect()
        assert [r.ref_number for r in got] == ["R9"]


def test_dedup_has_partial_group_limit(spark):
    log = _cases(spark, [(1, 101, "R", 1, None, None, 0, T(2024, 1, 1), T(2024, 1, 2), 1)])
    plan = explain(changelog.latest_per_key(log, ["case_id"], ["update_date", "ingest_ts", "ingest_seq"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_pivot_keeps_newest_even_when_null(spark):
    log = spark.createDataFrame([
        (1, 11, "Provider A", T(2024, 1, 1), T(2024, 1, 1), 1),
        (1, 11, None, T(2024, 2, 1), T(2024, 2, 1), 2),  # newest provider is NULL
        (1, 12, "40", T(2024, 1, 1), T(2024, 1, 1), 3),
        (1, 12, "400", T(2023, 1, 1), T(2023, 1, 1), 4),
        (2, 99, "other", T(2024, 1, 1), T(2024, 1, 1), 5),  # a type that is not pivoted
    ], "case_id long, case_attribute_type_id int, case_attribute_value string, update_date timestamp_ntz, "
       "ingest_ts timestamp_ntz, ingest_seq long")
    got = {r.case_id: (r.provider, r.dpd) for r in stg_case_attributes(log).collect()}
    assert got == {1: (None, "40"), 2: (None, None)}


def test_upsert_replaces_and_inserts(spark):
    tgt = spark.createDataFrame([(1, "a", T(2024, 1, 1)), (2, "b", T(2024, 1, 1))], "k long, v string, update_date timestamp_ntz")
    upd = spark.createDataFrame([(2, "b2", T(2024, 2, 1)), (2, "b3", T(2024, 3, 1)), (3, "c", T(2024, 2, 1))],
                                "k long, v string, update_date timestamp_ntz")
    got = {r.k: r.v for r in changelog.upsert_latest(tgt, upd, ["k"], ["update_date"]).collect()}
    assert got == {1: "a", 2: "b3", 3: "c"}
    with pytest.raises(ValueError):
        changelog.assert_unique(upd, ["k"])


def test_retention_floor_and_keep_latest(spark):
    log = spark.createDataFrame([(1, T(2024, 1, 1)), (1, T(2024, 1, 10)), (1, T(2023, 1, 1)), (2, T(2020, 1, 1))],
                                "k long, update_date timestamp_ntz")
    with pytest.raises(ValueError):
        changelog.prune_superseded(log, ["k"], ["update_date"], "update_date", T(2024, 1, 12), 24)
    kept = changelog.prune_superseded(log, ["k"], ["update_date"], "update_date", T(2024, 1, 12), 24 * 30)
    assert sorted((r.k, r.update_date) for r in kept.collect()) == [(1, T(2024, 1, 1)), (1, T(2024, 1, 10)),
                                                                   (2, T(2020, 1, 1))]


def test_overlap_batch_is_strict(spark):
    log = spark.createDataFrame([(1, T(2024, 1, 1, 23, 45)), (2, T(2024, 1, 1, 23, 45, 1))], "k long, ts timestamp_ntz")
    assert [r.k for r in changelog.overlap_batch(log, "ts", T(2024, 1, 2), 15).collect()] == [2]


def test_retention_general_order_equals_rank_definition(spark):
    """Retention when the timestamp is not the leading order column: brute-force rank definition."""
    from pyspark.sql import Window, functions as F

    rows = [(k, T(2024, 1, d), T(2024, 1, (d * 7) % 28 + 1), i) for i, (k, d) in
            enumerate([(1, 1), (1, 5), (1, 9), (2, 3), (2, 20), (3, 2), (3, 2), (4, 27)])]
    log = spark.createDataFrame(rows, "k long, update_date timestamp_ntz, ingest_ts timestamp_ntz, seq long")
    order = ["update_date", "seq"]
    got = changelog.prune_superseded(log, ["k"], order, "ingest_ts", T(2024, 1, 31), 24 * 14)
    rn = F.row_number().over(Window.partitionBy("k").orderBy(*[F.col(c).desc() for c in order]))
    want = log.withColumn("rn", rn).filter((F.col("rn") == 1) | (F.col("ingest_ts") >= F.lit(T(2024, 1, 17)).cast(
        "timestamp_ntz"))).drop("rn")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_upsert_without_order_rejects_repeated_keys(spark):
    tgt = spark.createDataFrame([(1, "a")], "k long, v string")
    upd = spark.createDataFrame([(1, "b"), (1, "c")], "k long, v string")
    with pytest.raises(ValueError):
        changelog.upsert_latest(tgt, upd, ["k"])
    ok = changelog.upsert_latest(tgt, spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string"), ["k"])
    assert sorted((r.k, r.v) for r in ok.collect()) == [(1, "b"), (2, "c")]


def test_in_month_window(spark):
    from datetime import date

    from tidemark.functions.expressions import in_month_window

    df = spark.createDataFrame([(T(2023, 11, 30, 23, 59),), (T(2023, 12, 1),), (T(2024, 2, 29, 23, 59),), (T(2024, 3, 1),)],
                               "d timestamp_ntz")
    got = [r.d for r in in_month_window(df, "d", date(2024, 2, 15), 2).collect()]
    assert got == [T(2023, 12, 1), T(2024, 2, 29, 23, 59)]


def test_upsert_replaces_a_null_key(spark):
    target = spark.createDataFrame([(None, "old"), (1, "a")], "k long, v string")
    updates = spark.createDataFrame([(None, "new"), (2, "b")], "k long, v string")
    got = sorted(((r.k, r.v) for r in changelog.upsert_latest(target, updates, ["k"]).collect()), key=repr)
    assert got == [(1, "a"), (2, "b"), (None, "new")]


def test_bitmaps_of_landings_count_distinct_keys(spark):
    rows = [(k, n % 3) for n, k in enumerate([0, 1, -1, -40000, 32768, 32769, 10**12, 1, 1, 0, None, -1, 5, 5])]
    df = spark.createDataFrame(rows, "k long, landing int")
    bitmaps = changelog.key_bitmaps(df, "k", ["landing"])
    assert changelog.distinct_keys_of(bitmaps).first()[0] == len({k for k, _ in rows if k is not None})
    per_landing = {r["landing"]: r["distinct_keys"] for r in changelog.distinct_keys_of(bitmaps, ["landing"]).collect()}
    assert per_landing == {i: len({k for k, n in rows if n == i and k is not None}) for i in range(3)}
    assert changelog.distinct_keys_of(changelog.key_bitmaps(df.limit(0), "k")).first()[0] == 0
