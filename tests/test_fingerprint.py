import random

from pyspark.sql import functions as F

from tidemark.operators import fingerprint
from tidemark.operators.fingerprint import differing
from tidemark.operators.reconcile import reconcile_rows, rerun_diff

COLUMNS = "k long, j string, v string"


def some_rows(n):
    return [(i, f"j{i % 3}", f"v{i}") for i in range(n)] + [(None, None, "null"), (None, "x", None), (7, None, "half")]


def test_only_rows_that_differ_are_found(spark):
    rows = some_rows(3000)
    other = [r for r in rows if r[0] != 17] + [(9999, "j", "new"), (None, "y", "new")]
    other[other.index((40, "j1", "v40"))] = (40, "j1", "changed")
    other[other.index((None, None, "null"))] = (None, None, "not so")
    got = {(r["k"], r["j"]): r["status"] for r in reconcile_rows(spark.createDataFrame(rows, COLUMNS), spark.createDataFrame(other, COLUMNS), ["k", "j"]).collect()}
    assert got == {(17, "j2"): "missing", (9999, "j"): "extra", (None, "y"): "extra", (40, "j1"): "changed", (None, None): "changed"}


def test_rows_of_equal_ranges_are_not_joined(spark):
    rows = some_rows(5000)
    a, b = spark.createDataFrame(rows, COLUMNS), spark.createDataFrame(rows[:-1] + [(7, None, "other")], COLUMNS)
    x, y = differing(a, b, ["k", "j"], ["k", "j", "v"])
    assert x.where("v = 'half'").count() == y.where("v = 'other'").count() == 1
    assert x.count() <= 10 and y.count() <= 10  # one part of 65,536
    same = differing(a, a.repartition(7), ["k", "j"], ["k", "j", "v"])
    assert [d.count() for d in same] == [0, 0]
    plan = reconcile_rows(a, a.repartition(7), ["k", "j"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "LocalRelation <empty>" in plan


def test_fingerprints_count_repeats(spark):
    rows = [(1, "a", "x")] * 3 + [(2, "b", None)] * 2
    a, b = spark.createDataFrame(rows, COLUMNS), spark.createDataFrame(rows[1:] + [(2, "b", None)], COLUMNS)
    got = sorted((r["k"], r["side"]) for r in rerun_diff(a, b).collect())
    assert got == [(1, "before_only"), (2, "after_only")]
    assert rerun_diff(a, a.orderBy(F.rand())).count() == 0
    assert rerun_diff(a, a.limit(0)).count() == 5
    assert rerun_diff(spark.createDataFrame([], COLUMNS), spark.createDataFrame([], COLUMNS)).count() == 0


def test_tables_that_differ_all_over(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(i, "j", f"v{rnd.random()}") for i in range(2000)]
    other = [(k, j, v + "x") if k % 2 else (k, j, v) for k, j, v in rows]
    got = reconcile_rows(spark.createDataFrame(rows, COLUMNS), spark.createDataFrame(other, COLUMNS), ["k"], ["v"]).collect()
    assert sorted(r["k"] for r in got) == [k for k, *_ in rows if k % 2] and {r["status"] for r in got} == {"changed"}
    monkeypatch.setattr(fingerprint, "FANOUT", 4)
    x, _ = differing(spark.createDataFrame(rows, COLUMNS), spark.createDataFrame(other, COLUMNS), ["k"], ["v"], fanout=4, levels=3)
    assert x.count() == 2000
