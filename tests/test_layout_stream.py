"""Compaction, Morton key, versioned publish and the streaming latest-state tail."""

from datetime import datetime

import pytest

from pyspark.sql import functions as F

from tidemark.functions.expressions import zorder_key
from tidemark.operators import layout, reconcile
from tidemark.sources import bronze
from tidemark.streaming.latest_state import tail_latest_state


def test_morton_interleaves_bits(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (3, 3), (255, 255)], "x long, y long")
    got = [r.z for r in df.select(zorder_key(["x", "y"], 8).alias("z")).collect()]
    assert got == [0, 1, 2, 3, 4, 15, 65535]


def test_compaction_keeps_rows_and_reduces_files(spark, tmp_path):
    src = str(tmp_path / "v1")
    spark.range(0, 20000).select(F.col("id").alias("case_id"), (F.col("id") % 97).alias("d"),
                                 F.lit(7).alias("hot")).repartition(40).write.parquet(src)
    rep = layout.compact(spark, src, str(tmp_path / "v2"), ["case_id", "d"], target_file_bytes=64 << 10)
    assert rep["rows_before"] == rep["rows_after"] == 20000
    assert rep["files_after"] < rep["files_before"]


def test_hot_z_value_spreads_over_files(spark, tmp_path):
    src = str(tmp_path / "hot")
    spark.range(0, 30000).select(F.lit(1).alias("case_id"), F.lit(1).alias("d"), "id").repartition(8).write.parquet(src)
    out = str(tmp_path / "hot2")
    layout.compact(spark, src, out, ["case_id", "d"], target_file_bytes=16 << 10)
    per_file = spark.read.parquet(out).groupBy(F.input_file_name()).count().collect()
    assert len(per_file) > 1 and max(r["count"] for r in per_file) < 30000


def test_publish_reads_newest_version(spark, tmp_path):
    base = str(tmp_path)
    bronze.publish_mart(spark, spark.createDataFrame([(1,)], "v int"), base, "m", datetime(2024, 1, 1))
    # A run that wrote version 2 and died before publishing it must not block the retry.
    spark.createDataFrame([(9,)], "v int").write.parquet(f"{base}/m/v=2")
    bronze.publish_mart(spark, spark.createDataFrame([(2,)], "v int"), base, "m", datetime(2024, 1, 2))
    assert [r.v for r in bronze.read_mart(spark, base, "m").collect()] == [2]
    assert bronze.published_version(spark, base, "m")[0] == 2


def test_rerun_diff_sees_duplicates(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(1,), (2,)], "v int")
    got = [(r.v, r.side) for r in reconcile.rerun_diff(a, b).collect()]
    assert got == [(1, "before_only")]


def test_stream_tail_merges_late_files(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

    schema = StructType([StructField("k", LongType()), StructField("v", StringType()),
                         StructField("update_date", TimestampNTZType()), StructField("ingest_date", StringType())])
    path = str(tmp_path / "bronze")
    spark.createDataFrame([(1, "new", datetime(2024, 2, 1), "d1"), (2, "x", datetime(2024, 1, 1), "d1")],
                          schema).write.mode("append").parquet(path)
    args = (spark, path, schema, str(tmp_path / "state"), "s", ["k"], ["update_date"], str(tmp_path / "ck"))
    assert tail_latest_state(*args) == 1
    # A late file carrying an older version of key 1 must not move it backwards.
    spark.createDataFrame([(1, "old", datetime(2023, 1, 1), "d2"), (3, "y", datetime(2024, 1, 1), "d2")],
                          schema).write.mode("append").parquet(path)
    assert tail_latest_state(*args) == 1
    assert tail_latest_state(*args) == 0  # drained: nothing new
    got = {r.k: r.v for r in bronze.read_mart(spark, str(tmp_path / "state"), "s").collect()}
    assert got == {1: "new", 2: "x", 3: "y"}


def test_bucketed_stream_tail_merges_like_the_plain_one(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

    schema = StructType([StructField("k", LongType()), StructField("v", StringType()),
                         StructField("update_date", TimestampNTZType()), StructField("ingest_date", StringType())])
    path = str(tmp_path / "bronze")
    spark.createDataFrame([(1, "new", datetime(2024, 2, 1), "d1"), (2, "x", datetime(2024, 1, 1), "d1"),
                           (None, "nullkey", datetime(2024, 1, 1), "d1")], schema).write.mode("append").parquet(path)
    args = (spark, path, schema, str(tmp_path / "state"), "s", ["k"], ["update_date"], str(tmp_path / "ck"))
    assert tail_latest_state(*args, buckets=4) == 1
    spark.createDataFrame([(1, "old", datetime(2023, 1, 1), "d2"), (3, "y", datetime(2024, 1, 1), "d2"),
                           (2, "x2", datetime(2024, 3, 1), "d2"), (None, "nullkey2", datetime(2024, 2, 1), "d2")],
                          schema).write.mode("append").parquet(path)
    assert tail_latest_state(*args, buckets=4) == 1
    got = {r.k: r.v for r in bronze.read_mart(spark, str(tmp_path / "state"), "s").collect()}
    assert got == {1: "new", 2: "x2", 3: "y", None: "nullkey2"}


def test_bucketed_merge_shuffles_only_the_batch(spark, tmp_path):
    from tests.planutil import explain
    from tidemark.streaming import latest_state as ls

    state_path = str(tmp_path / "v1")
    state = spark.range(0, 5000).select(F.col("id").alias("k"), F.lit("a").alias("v"),
                                        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("update_date"))
    ls.merge_bucketed(None, state, ["k"], ["update_date"], state_path, 8)
    table = spark.table(ls.bucketed_table(spark, state_path, state.schema, ["k"], 8))
    batch = state.filter("k % 10 = 0").withColumn("v", F.lit("b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = batch.select(*[F.col(c).alias(f"__b_{c}") for c in batch.columns])
        plan = explain(table.join(b, table["k"] == b["__b_k"], "left"), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = [ln for ln in plan.splitlines() if "FileScan" in ln and "Bucketed: true" in ln]
    assert scan and plan.count("Exchange") == 1


def test_bucketed_tail_leaves_no_catalog_entries(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

    schema = StructType([StructField("k", LongType()), StructField("v", StringType()),
                         StructField("update_date", TimestampNTZType()), StructField("ingest_date", StringType())])
    path = str(tmp_path / "bronze")
    for day, rows in (("d1", [(1, "a", datetime(2024, 1, 1), "d1")]), ("d2", [(1, "b", datetime(2024, 1, 2), "d2")])):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(path)
        tail_latest_state(spark, path, schema, str(tmp_path / "state"), "s", ["k"], ["update_date"],
                          str(tmp_path / "ck"), buckets=2)
    assert [r.v for r in bronze.read_mart(spark, str(tmp_path / "state"), "s").collect()] == ["b"]
    from tidemark.streaming.latest_state import _table

    import glob

    versions = glob.glob(f"{tmp_path / 'state'}/s/v=*")
    assert len(versions) == 2
    for path in versions:
        assert not spark.catalog.tableExists(_table(path))


def test_another_bucket_count_deals_the_state_out_anew(spark, tmp_path):
    """8 buckets, then 16, then the state's own count, with broadcast joins off: one row per key."""
    from pyspark.sql.types import LongType, StructField, StructType, TimestampNTZType

    from tidemark.streaming.latest_state import wanted_buckets

    schema = StructType([StructField("k", LongType()), StructField("v", LongType()), StructField("update_date", TimestampNTZType())])
    path, state = str(tmp_path / "bronze"), str(tmp_path / "state")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for step, buckets in enumerate((8, 16, None)):
            rows = [(k, step, datetime(2024, 1, 1 + step)) for k in range(50 * step, 200 + 50 * step)]
            spark.createDataFrame(rows, schema).write.mode("append").parquet(path)
            tail_latest_state(spark, path, schema, state, "s", ["k"], ["update_date"], str(tmp_path / "ck"), buckets=buckets)
            got = {r.k: r.v for r in bronze.read_mart(spark, state, "s").collect()}
            assert bronze.read_mart(spark, state, "s").count() == len(got) == 200 + 50 * step
            assert all(got[k] == step for k, *_ in rows)
            assert bronze.newest_pointer(spark, state, "s")["buckets"] == (buckets or 16)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert wanted_buckets(10, None) == 8 and wanted_buckets(10 << 40, 16) == 65536 and wanted_buckets(10, 16) == 16


def test_racing_publishers_have_one_order(spark, tmp_path):
    base = str(tmp_path)
    rows = [("m", 1, f"{base}/m/a", datetime(2024, 1, 1), None, "1"), ("m", 1, f"{base}/m/b", datetime(2024, 1, 1), None, "2")]
    for r in rows:
        bronze.append_rows(spark.createDataFrame([r], bronze._POINTER_SCHEMA), f"{base}/_pointers")
    assert bronze.published_version(spark, base, "m") == (1, f"{base}/m/b")


def test_text_keys_cannot_be_clustered(spark):
    from tidemark.operators import layout

    with pytest.raises(TypeError, match="neither a number nor a time"):
        layout.cluster(spark.createDataFrame([("a",)], "k string"), ["k"], 2)
    wide = spark.createDataFrame([(-(2**63),), (0,), (2**63 - 1,)], "k long")
    (scaled,), _ = layout.zorder_columns(wide, ["k"], 8)
    assert [r[0] for r in wide.orderBy("k").select(scaled).collect()] == [0, 127, 255]


def test_new_source_columns_are_read_on_request(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{path}/x=1")
    spark.createDataFrame([(2, "n")], "a int, b string").write.parquet(f"{path}/x=2")
    assert bronze.read_bronze(spark, path, merge_schema=True).where("b = 'n'").count() == 1
