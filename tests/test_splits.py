from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import splits
from tidemark.plans import ingest
from tidemark.plans.catalog.common import FIRST_RUN_CUT, INGEST_NOW, SPECS, _sources
from tidemark.session import scratch_path
from tidemark.sources import bronze


def points_of(df, column, ranges):
    return splits.split_points(splits.merged(df.agg(splits.sketch_of(column).alias("sketch"))), ranges)


def sizes(df, column, points):
    return {r["range"]: r["rows"] for r in splits.range_sizes(df, column, points).collect()}


def test_skewed_ids_fall_into_even_ranges(spark):
    df = spark.range(40_000).select((F.col("id") * F.col("id") * F.col("id")).alias("k"))
    even = sizes(df, "k", points_of(df, "k", 16))
    assert len(even) == 16 and max(even.values()) <= 1.2 * 40_000 / 16
    strides = sizes(df, "k", [40_000**3 * i // 16 for i in range(1, 16)])
    assert max(strides.values()) > 5 * 40_000 / 16


def test_sketches_of_landings_merge(spark):
    df = spark.range(20_000).select((F.col("id") * 7 % 20_011).alias("k"), (F.col("id") % 5).alias("landing"))
    sketches = df.groupBy("landing").agg(splits.sketch_of("k").alias("sketch"))
    got = sizes(df, "k", splits.split_points(splits.merged(sketches), 10))
    assert len(got) == 10 and max(got.values()) <= 1.2 * 2000


def test_predicates_cover_every_value_once(spark):
    df = spark.createDataFrame([(v,) for v in [None, None, -5, 0, 3, 3, 3, 9, 10, 10**12]], "k long")
    points = points_of(df, "k", 4)
    parts = [df.where(p).count() for p in splits.range_predicates("k", points)]
    assert sum(parts) == 10
    numbers = sizes(df, "k", points)
    assert parts == [numbers.get(i, 0) for i in range(len(points) + 1)]
    assert splits.range_predicates("k", []) == ["1 = 1"]


def test_a_value_that_fills_ranges_and_empty_input(spark):
    hot = spark.range(1000).select(F.when(F.col("id") < 700, F.lit(5)).otherwise(F.col("id")).alias("k"))
    points = points_of(hot, "k", 8)
    assert points == sorted(set(points)) and len(points) < 7
    nothing = spark.createDataFrame([], "k long")
    assert points_of(nothing, "k", 8) == [] and points_of(spark.createDataFrame([(None,)], "k long"), "k", 8) == []


def test_the_next_read_is_cut_by_what_has_landed(spark):
    """Each landing's sketch is gathered in its bronze write; both runs' sketches cut the next read."""
    base, spec = scratch_path(spark, "splits"), SPECS["contacts"]
    ingest.seed_for([spec], base, spark, FIRST_RUN_CUT)
    cut = datetime(1999, 1, 1)
    for upto, now in ((cut, FIRST_RUN_CUT + timedelta(minutes=5)), (None, INGEST_NOW)):
        ingest.ingest_source(spark, spec, ingest.dataframe_reader(_sources(spark, SF_SMALL, upto)), base, now)
    points = bronze.landed_split_points(spark, base, "contacts", 8)
    landed = bronze.read_bronze(spark, f"{base}/bronze/contacts", "contacts")
    got = sizes(landed, spec.partition_column, points)
    assert len(got) == 8 and max(got.values()) <= 1.2 * landed.count() / 8
    assert len(splits.range_predicates(spec.partition_column, points)) == 8
