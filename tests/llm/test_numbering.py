"""Gapless numbers: hot buckets are spread over tasks, any column names, and the operators that use them."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import packing, sharding
from tidemark.llm.common import shared_table
from tidemark.llm.numbering import numbered


def gapless(pairs):
    found = defaultdict(list)
    for key, n in pairs:
        found[key].append(n)
    return all(sorted(v) == list(range(len(v))) for v in found.values())


@pytest.fixture
def uncoalesced(spark):
    """As with large tables: no partitions are put together, and the rows are no side to broadcast."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_rows_that_are_all_alike_are_spread(uncoalesced):
    rows = shared_table(uncoalesced.range(6000).select((F.col("id") % 2).alias("k"), F.lit(None).cast("string").alias("x")), "alike")
    got = numbered(rows, ["k"], F.lit("one"), [F.col("x")], 100, "n").select("k", "n", F.spark_partition_id().alias("p")).collect()
    assert gapless((r["k"], r["n"]) for r in got) and len(got) == 6000
    tasks = defaultdict(int)
    for r in got:
        tasks[r["p"]] += 1
    assert len(tasks) == 8 and max(tasks.values()) < 3 * 6000 / 8


def test_small_buckets_are_numbered_in_order(spark):
    rows = shared_table(spark.range(300).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("b"), F.col("id").alias("v")), "ordered")
    got = numbered(rows, ["k"], F.col("b"), [F.col("v").desc()], 10**6, "n").collect()
    for k in range(3):
        mine = sorted((r for r in got if r["k"] == k), key=lambda r: r["n"])
        assert [r["v"] for r in mine] == sorted((r["v"] for r in mine), key=lambda v: (v % 7, -v)) and [r["n"] for r in mine] == list(range(100))


def test_any_column_names(spark):
    rows = shared_table(spark.range(20).selectExpr("1 AS k", "id AS `a.b`", "'x' AS _at_", "'y' AS PART", "'z' AS _row_"), "names")
    got = numbered(rows, ["k"], F.col("PART"), [F.col("`a.b`")], 4, "n")
    assert got.columns == [*rows.columns, "n"]
    assert gapless((1, r["n"]) for r in got.collect())


#: A third of the rows have no id, a third repeats one row, among others.
HOT = [(None, f"text {i % 40}") for i in range(120)] + [(7, "the same row")] * 120 + [(i, f"words of {i}") for i in range(100, 220)]


def test_slots_of_hot_ids(docs, monkeypatch):
    plain = shared = None
    for most in (1_000_000, 5):
        monkeypatch.setattr(sharding, "SLOTS_TOGETHER", most)
        got = sharding.shard_documents(docs(HOT), shards=3).collect()
        assert gapless((r["shard"], r["slot"]) for r in got) and len(got) == len(HOT)
        plain, shared = shared, sorted((r["text_crc32"], r["shard"]) for r in got)
    assert plain == shared


def test_packing_of_hot_ids(docs, monkeypatch):
    fills = []
    for together in (packing.RANKED_TOGETHER, 3):
        monkeypatch.setattr(packing, "RANKED_TOGETHER", together)
        pieces = shared_table(docs(HOT).selectExpr("doc_id", "0 AS piece", "cast(length(text) AS long) AS length", "crc32(encode(text, 'UTF-8')) AS ids_crc32"), "hot-pieces")
        got = packing.pack(pieces, ["doc_id", "piece", "ids_crc32"], 64).collect()
        held = defaultdict(list)
        for r in got:
            held[r["sequence_id"]].append((r["offset"], r["length"]))
        for places in held.values():
            places.sort()
            assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))] and sum(n for _, n in places) <= 64
        assert len(got) == len(HOT)
        fills.append(sorted(sum(n for _, n in p) for p in held.values()))
    assert fills[0] == fills[1]
