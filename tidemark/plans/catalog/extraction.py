"""Catalogue: incremental and full-window pulls, bounds, batch stats, extraction cost, source counts."""

from __future__ import annotations

import dataclasses
from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.operators import changelog, cost, splits
from tidemark.plans.catalog.common import AS_OF_TS, CFG, PULL_WATERMARK, SPECS, _ATTR_COLS, _sources, query
from tidemark.session import scratch_path
from tidemark.sources import extracts, jdbc
from tidemark.sources import fixtures as fx


# ---- scans, pulls, measurement ------------------------------------------------


@query
def attribute_union(spark, d):
    """H1: the two attribute row sets stacked by name."""
    return fx.attributes_log(spark, d).select(*_ATTR_COLS)


def _pulled(spark, d):
    lagged = PULL_WATERMARK - timedelta(minutes=SPECS["dialer"].lag_minutes)
    return jdbc.incremental_pull(fx.dialer_log(spark, d), SPECS["dialer"], lagged)


@query
def incremental_pull(spark, d):
    """B1 + B3: dialer rows above the lagged watermark, in client scope."""
    return _pulled(spark, d)


def _dialer_extract(spark, d):
    """The dialer source as a folder of Parquet extracts, in order of its watermark column."""
    path = scratch_path(spark, "extract-dialer")
    _sources(spark, d)["dialer"].repartitionByRange(8, "update_date").sortWithinPartitions("update_date").write.parquet(path)
    return path


@query
def incremental_scan(spark, d):
    """A1 + A4 + A15: the pull over a source of extracts, in partitions; watermark and scope go to its reader."""
    lagged = PULL_WATERMARK - timedelta(minutes=SPECS["dialer"].lag_minutes)
    return extracts.read_extract_incremental(spark, _dialer_extract(spark, d), SPECS["dialer"], lagged)


@query
def single_scan(spark, d):
    """A2: the same without a split column, by one reader."""
    spec = dataclasses.replace(SPECS["dialer"], partition_column=None)
    lagged = PULL_WATERMARK - timedelta(minutes=spec.lag_minutes)
    return extracts.read_extract_incremental(spark, _dialer_extract(spark, d), spec, lagged)


@query
def sink_append(spark, d):
    """The dialer source appended to extracts in two batches, the first sent twice, and read back."""
    path = scratch_path(spark, "sink")
    source = _sources(spark, d)["dialer"].select(*SPECS["dialer"].columns, "ingest_seq")
    early = F.col("update_date") <= F.lit(PULL_WATERMARK).cast("timestamp_ntz")
    for batch, rows in (("one", early), ("one", early), ("two", ~early)):
        extracts.append_extract(source.filter(rows), path, batch)
    return extracts.read_extract(spark, path)


@query
def full_reload_pull(spark, d):
    """The three-month full-window read the incremental pull replaces."""
    return jdbc.full_reload_pull(fx.dialer_log(spark, d), SPECS["dialer"], "call_date", AS_OF_TS, 3)


@query
def partition_bounds(spark, d):
    """A3: split-column bounds of the incremental window."""
    return jdbc.partition_bounds(_pulled(spark, d), "case_id")


SPLIT_RANGES = 16


@query
def even_splits(spark, d):
    """A3 + O9: sizes of 16 ranges of a skewed split column, by strides and by the merged sketches of two landings."""
    log = fx.dialer_log(spark, d).select((F.col("case_id") * F.col("case_id") * F.col("case_id")).alias("split_id"), "update_date")
    early = F.col("update_date") <= F.lit(PULL_WATERMARK).cast("timestamp_ntz")
    sketches = log.groupBy(early.alias("landing")).agg(splits.sketch_of("split_id").alias("sketch"))
    points = splits.split_points(splits.merged(sketches), SPLIT_RANGES)
    lo, hi = log.agg(F.min("split_id"), F.max("split_id")).first()
    strides = [lo + (hi - lo) * i // SPLIT_RANGES for i in range(1, SPLIT_RANGES)]
    parts = [splits.evenness(splits.range_sizes(log, "split_id", p), SPLIT_RANGES).select(F.lit(name).alias("method"), "*")
             for name, p in (("strides", strides), ("quantiles", points))]
    return parts[0].unionByName(parts[1])


@query
def batch_stats(spark, d):
    """Row count and newest update of the pulled batch, one pass."""
    return changelog.batch_stats(_pulled(spark, d), "update_date")


@query
def extraction_cost(spark, d):
    """L1: rows read by a full reload versus the incremental pull."""
    return cost.extraction_cost(fx.dialer_log(spark, d), "call_date", "update_date", AS_OF_TS, PULL_WATERMARK,
                                lag_minutes=15, months=3, scope=F.col("client_id").isin(*CFG.client_ids))


@query
def distinct_key_count(spark, d):
    """Distinct contact ids in the contact change log."""
    return changelog.distinct_key_count(fx.contacts_log(spark, d), ["contact_id"])


@query
def distinct_keys_by_landing(spark, d):
    """E7 + J7: distinct contact ids from the bitmaps of two landings, each made once and then merged."""
    log = fx.contacts_log(spark, d).select("contact_id", "update_date")
    early = F.col("update_date") <= F.lit("1999-01-01").cast("timestamp_ntz")
    landings = changelog.key_bitmaps(log.withColumn("landing", early), "contact_id", ["landing"])
    return changelog.distinct_keys_of(landings)


@query
def source_count(spark, d):
    """In-scope rows per source table."""
    out = None
    for name, fn in fx.LOGS.items():
        part = jdbc.count_in_scope(fn(spark, d), SPECS[name]).select(F.lit(name).alias("table"), "source_count")
        out = part if out is None else out.unionByName(part)
    return out
