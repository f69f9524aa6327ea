from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.expressions import hilbert_key
from tidemark.operators import layout


def test_the_curve_visits_every_cell_by_steps_of_one(spark):
    cells = spark.range(256).select((F.col("id") % 16).alias("x"), F.floor(F.col("id") / 16).alias("y"))
    path = [(r["x"], r["y"]) for r in cells.select("x", "y", hilbert_key("x", "y", 4).alias("d")).orderBy("d").collect()]
    keys = sorted(r["d"] for r in cells.select(hilbert_key("x", "y", 4).alias("d")).collect())
    assert keys == list(range(256)) and path[0] == (0, 0)
    assert all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(path, path[1:]))


def test_point_queries_read_fewer_files_on_a_skewed_key(spark, tmp_path):
    day = F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval((F.col("id") * 7919 % 90).cast("int"))
    df = spark.range(40_000).select((F.col("id") % 200 * (F.col("id") % 200) * (F.col("id") % 200)).alias("case_id"), day.alias("call_date"), "id")
    files = {}
    for curve in ("morton", "hilbert"):
        path = str(tmp_path / curve)
        layout.cluster(df, ["case_id", "call_date"], 32, 8, curve).write.parquet(path)
        back = spark.read.parquet(path)
        assert back.count() == 40_000 and back.select("id").distinct().count() == 40_000
        spans = back.groupBy(F.input_file_name().alias("f")).agg(F.min("case_id").alias("lo"), F.max("case_id").alias("hi"))
        files[curve] = sum(sum(r["lo"] <= k**3 <= r["hi"] for r in spans.collect()) for k in range(0, 200, 5))
    print(files)
    assert files["hilbert"] < 0.8 * files["morton"], files


def test_null_and_single_keys(spark):
    df = spark.createDataFrame([(None, 1), (5, 2), (7, 3), (7, 4)], "k long, v int")
    out = layout.cluster(df, ["k"], 2, 4, "hilbert")
    assert sorted(r["v"] for r in out.collect()) == [1, 2, 3, 4]
    assert layout.cluster(df.limit(0), ["k", "v"], 2, 4, "hilbert").count() == 0
