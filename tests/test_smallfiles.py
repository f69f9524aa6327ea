"""Compaction of small files only: packing against brute force, untouched files, pruning."""

import random

from pyspark.sql import functions as F

from tidemark.operators import smallfiles


def first_fit(sizes, most):
    filled, bins = [], []
    for s in sizes:
        at = next((i for i, f in enumerate(filled) if f + s <= most), len(filled))
        filled[at:at + 1] = [(filled[at] if at < len(filled) else 0) + s]
        bins.append(at)
    return bins


def groups(rows):
    found = {}
    for path, bin_ in rows:
        if bin_ is not None:
            found.setdefault(bin_, set()).add(path)
    return {frozenset(g) for g in found.values()}


def test_packing_equals_first_fit_decreasing(spark):
    draw = random.Random(5)
    rows = [(d, f"f{d}-{i:03}", draw.choice([1, 7, 30, 49, 50, 51, draw.randint(1, 120)]), 1) for d in (1, 2, None) for i in range(60)]
    files = spark.createDataFrame(rows, "d int, file_path string, bytes long, rows long")
    got = smallfiles.pack_files(files, 100, 60, ["d"]).collect()
    assert sorted(r["file_path"] for r in got) == sorted(r[1] for r in rows)
    want = set()
    for d in (1, 2, None):
        mine = sorted((-s, p) for day, p, s, _ in rows if day == d and s < 60)
        bins = first_fit([-s for s, _ in mine], 100)
        want |= groups([(p, (d, b)) for (_, p), b in zip(mine, bins) if bins.count(b) > 1])
    assert groups([(r["file_path"], r["merged_into"]) for r in got]) == want and want
    numbers = {r["merged_into"] for r in got} - {None}
    assert numbers == set(range(len(want)))


def test_many_files_of_a_partition_are_dealt_to_several_packings(spark, monkeypatch):
    monkeypatch.setattr(smallfiles, "FILES_TOGETHER", 16)
    files = spark.range(200).select(F.format_string("f%03d", "id").alias("file_path"), F.lit(9).cast("long").alias("bytes"), F.lit(1).cast("long").alias("rows"))
    got = smallfiles.pack_files(files, 100, 50).collect()
    sizes = [sum(r["bytes"] for r in got if r["merged_into"] == b) for b in {r["merged_into"] for r in got}]
    assert len(got) == 200 and max(sizes) <= 100 and len(sizes) <= 20 + 14


def table(spark, path):
    rows = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, "a b").when(F.col("id") % 3 == 1, "x%20+y").alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    rows.where("id < 4500").repartition(1).write.partitionBy("day").parquet(path)
    for k in range(6):
        rows.where(f"id >= 4500 AND id < 5900 AND id % 6 = {k}").repartition(2).write.mode("append").partitionBy("day").parquet(path)
    return rows


def test_small_files_merge_within_their_partition_and_large_ones_stay(spark, tmp_path):
    path, out = str(tmp_path / "t"), str(tmp_path / "c")
    rows = table(spark, path).where("id < 5900")
    rep = smallfiles.compact_small(spark, path, out, target_bytes=60_000, by=["day"], sort_by=["id"])
    assert rep["rows_before"] == rep["rows_after"] == 5900
    assert rep["files_untouched"] == 3 and rep["files_merged"] == rep["files_before"] - 3 and rep["files_written"] < rep["files_merged"]
    assert 0 < rep["bytes_rewritten"] < rep["bytes_before"] / 2
    now = smallfiles.read(spark, path, out)
    assert now.columns == spark.read.parquet(path).columns
    assert now.exceptAll(rows.select(now.columns)).isEmpty() and rows.select(now.columns).exceptAll(now).isEmpty()
    written = smallfiles.table_files(spark.read.parquet(f"{out}/files"), ["day"]).collect()
    assert len(written) == rep["files_written"]
    # what lands afterwards is read, and a second pass over what is left finds nothing to do
    spark.createDataFrame([(9999, "a b", "late")], "id long, day string, v string").write.mode("append").partitionBy("day").parquet(path)
    assert smallfiles.read(spark, path, out).where("v = 'late'").count() == 1
    again = smallfiles.compact_small(spark, f"{out}/files", str(tmp_path / "c2"), target_bytes=60_000, small_bytes=1, by=["day"])
    assert again["files_written"] == 0 and again["rows_after"] == sum(r["rows"] for r in written)


def test_large_files_are_not_opened_for_the_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path)
    small = spark.read.parquet(path).where(F.col("_metadata.file_size") < 30_000)
    sizes = [r["bytes"] for r in smallfiles.table_files(small).collect()]
    assert sizes and max(sizes) < 30_000
    assert "file_size" in small._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark, tmp_path):
    path, out = str(tmp_path / "t"), str(tmp_path / "c")
    spark.createDataFrame([], "id long, v string").write.parquet(path)
    rep = smallfiles.compact_small(spark, path, out, target_bytes=100)
    assert rep["files_written"] == rep["rows_before"] == rep["rows_after"] == 0
    assert smallfiles.read(spark, path, out).count() == 0


def test_report_writes_more_files_not_larger_ones(spark, monkeypatch):
    from tests.conftest import SF_SMALL
    from tidemark.plans.catalog import runs

    reports = []
    whole = smallfiles.compact_small
    monkeypatch.setattr(smallfiles, "compact_small", lambda *a, **k: reports.append(whole(*a, **k)) or reports[-1])
    facts = []
    for rows in (10**9, 100):
        monkeypatch.setattr(runs, "LOAD_ROWS", rows)
        facts.append({r["measure"]: r["value"] for r in runs.compact_small_report(spark, SF_SMALL).collect()})
    for f in facts:
        f.pop("files_fewer")  # files of a few rows are as large as their footers, so they may not fit together
    assert facts[0] == facts[1] and facts[0]["rows_differing"] == 0
    assert reports[1]["files_before"] > 2 * reports[0]["files_before"]
