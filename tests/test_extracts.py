"""Extracts as a data source: what reaches the reader, its partitions, and appends that happen twice."""

import dataclasses
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, Not, StringStartsWith
from pyspark.sql.pandas.types import from_arrow_schema

from tidemark.config import SourceSpec
from tidemark.sources import extracts, jdbc

CUT = datetime(2024, 1, 5)
SPEC = SourceSpec("calls", "calls", ("id",), ("id", "client_id", "note", "update_date"), scope_column="client_id", scope_values=(1, 2),
                  exclude_column="note", exclude_value="robot", partition_column="id", num_partitions=4)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("extract") / "calls")
    rows = [(i, i % 4, None if i % 7 == 0 else "robot" if i % 5 == 0 else f"n{i}", None if i % 97 == 0 else datetime(2024, 1, 1) + timedelta(minutes=10 * i), i * 1.5)
            for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, client_id int, note string, update_date timestamp_ntz, unread double")
    df.repartitionByRange(24, "update_date").sortWithinPartitions("update_date").write.parquet(path)
    return path


def pull(spark, folder, spec=SPEC, at=CUT):
    return extracts.read_extract_incremental(spark, folder, spec, at)


def test_same_rows_as_the_plain_pull(spark, folder):
    wanted = jdbc.incremental_pull(spark.read.parquet(folder), SPEC, CUT)
    got = pull(spark, folder)
    assert got.schema == wanted.schema
    assert sorted(got.collect()) == sorted(wanted.collect()) and got.count() > 50


def test_watermark_and_scope_reach_the_reader(spark, folder):
    plan = pull(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "Filter (" not in plan and "unread" not in plan


def reader_for(folder, filters=(), **options):
    import pyarrow.parquet as pq

    schema = from_arrow_schema(pq.read_schema(extracts.committed_files(folder)[0]), prefer_timestamp_ntz=True)
    reader = extracts.ExtractReader(schema, {"path": folder, **options})
    return reader, list(reader.pushFilters(filters))


def test_reader_takes_what_it_can(spark, folder):
    left = [StringStartsWith(("note",), "n"), EqualTo(("unread",), 1.5), EqualTo(("a", "b"), 1)]
    reader, rest = reader_for(folder, [IsNotNull(("id",)), In(("client_id",), [1, None]), Not(EqualTo(("note",), "robot")), GreaterThan(("id",), 3), *left])
    assert rest == left and len(reader.filters) == 4


def test_row_groups_ruled_out_are_not_read(spark, folder):
    everything, _ = reader_for(folder, partitionColumn="id", numPartitions="3")
    late, _ = reader_for(folder, [GreaterThan(("update_date",), datetime(2024, 1, 8))], partitionColumn="id", numPartitions="3")
    groups = [sum(len(n) for p in r.partitions() for _, n in p.groups) for r in (everything, late)]
    assert groups[1] < groups[0]


def test_partitions_are_even_and_single_without_a_column(spark, folder):
    rows = [r["n"] for r in extracts.read_extract(spark, folder, ["id"], "id", 4).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(rows) == 4 and max(rows) <= 1.2 * 1200 / 4
    assert pull(spark, folder, dataclasses.replace(SPEC, partition_column=None)).rdd.getNumPartitions() == 1


def test_an_empty_window_is_one_empty_partition(spark, folder):
    got = pull(spark, folder, at=datetime(2030, 1, 1))
    assert got.rdd.getNumPartitions() == 1 and got.collect() == []


def test_a_folder_by_its_uri(spark, folder):
    assert pull(spark, f"file://{folder}").count() == pull(spark, folder).count()


def test_batches_sent_twice_count_once(spark, tmp_path):
    path = str(tmp_path / "sink")
    one, two = (spark.createDataFrame([(i, datetime(2024, 1, 1)) for i in part], "id long, at timestamp_ntz").repartition(3) for part in (range(20), range(20, 25)))
    for df, batch in ((one, "one"), (one, "one"), (two, "two"), (one, "one")):
        extracts.append_extract(df, path, batch)
    got = extracts.read_extract(spark, path)
    assert sorted(r["id"] for r in got.collect()) == list(range(25))
    assert got.schema == one.schema
    assert len(list((tmp_path / "sink").glob("*.parquet"))) == len(extracts.committed_files(path))


def test_an_attempt_that_is_run_again_leaves_no_repeated_row(spark, tmp_path):
    path = str(tmp_path / "sink")
    writer = extracts.ExtractWriter({"path": path, "batch": "b"})
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, 3]})
    lost, kept, empty = writer.write(iter([batch])), writer.write(iter([batch])), writer.write(iter([]))
    writer.commit([kept, None, empty])  # the driver never hears of the lost attempt
    assert [r["id"] for r in extracts.read_extract(spark, path).collect()] == [1, 2, 3]
    assert lost.file != kept.file and empty.file is None
    failed = extracts.ExtractWriter({"path": path, "batch": "c"})
    failed.abort([failed.write(iter([batch])), None])
    assert len(list((tmp_path / "sink").glob("part-c-*"))) == 0
    with pytest.raises(Exception, match="never overwritten"):
        spark.range(3).write.format(extracts.FORMAT).mode("overwrite").options(path=path, batch="d").save()
