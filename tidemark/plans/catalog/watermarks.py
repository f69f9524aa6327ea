"""Catalogue: the control log (seed, history, current watermark, lag, advance, failure, guard)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.config import SEED_WATERMARK
from tidemark.functions.expressions import ntz, watermark_text
from tidemark.plans import control
from tidemark.plans.catalog.common import query
from tidemark.sources import fixtures as fx
from tidemark.sources import jdbc


# ---- control log -------------------------------------------------------------

CONTROL_T0 = datetime(2024, 1, 1)


def _runs(spark, d):
    """Control-log runs derived from orders: one source per priority, one batch per 1000 order keys."""
    o = fx.table(spark, d, "orders")
    run_no = (F.col("o_orderkey") / F.lit(1000)).cast("long")
    g = o.groupBy(F.col("o_orderpriority").alias("table_name"), run_no.alias("run_no")).agg(
        F.max("o_orderdate").alias("last_watermark"), F.count(F.lit(1)).alias("rows_processed"))
    return g.select(
        "table_name", "run_no", "last_watermark", "rows_processed",
        (ntz(CONTROL_T0) + F.make_dt_interval(F.lit(0), F.col("run_no").cast("int"))).alias("updated_at"),
        F.lit("success").alias("run_status"),
    )


def _control_log(spark, d):
    runs = _runs(spark, d).drop("run_no")
    seeds = control.seed_rows(runs.select("table_name").distinct(), CONTROL_T0 - timedelta(days=1))
    return seeds.unionByName(runs)


@query
def control_seed(spark, d):
    """One ``initialized`` row per source at the seed watermark."""
    return control.seed_rows(_runs(spark, d).select("table_name").distinct(), CONTROL_T0 - timedelta(days=1))


@query
def watermark_history(spark, d):
    """Every run with the forward-only watermark in force after it."""
    return control.watermark_history(_control_log(spark, d))


@query
def current_watermark(spark, d):
    """G1: per source, watermark and the newest run's rows and status."""
    return control.current_watermark(_control_log(spark, d))


@query
def watermark_with_lag(spark, d):
    """I1 + C11-C13: read-from text per source, rewound 15 minutes, floored at the seed."""
    return control.watermark_with_lag(control.current_watermark(_control_log(spark, d)), 15)


@query
def watermark_advance(spark, d):
    """I2 + C14: per run, the watermark before, the batch max, the watermark after, and held batches."""
    from tidemark.functions.expressions import forward_only

    runs = control.running_max(_runs(spark, d), ["updated_at", "run_no"])
    prev = F.coalesce("before", ntz(SEED_WATERMARK))
    r = runs.select("table_name", "run_no", F.col("last_watermark").alias("batch_max"), prev.alias("before"))
    return r.select("table_name", "run_no", "batch_max", "before",
                    forward_only("batch_max", "before").alias("after"),
                    F.when(F.col("batch_max") < F.col("before"), 1).otherwise(0).alias("held"))


CONTROL_NOW = datetime(2024, 2, 15, 6, 0, 0)


@query
def control_mark_failed(spark, d):
    """I3 + C16: a failure row per source, watermark unchanged, message cut to 200 characters."""
    cur = control.current_watermark(_control_log(spark, d))
    msg = F.concat(F.lit("source unreachable after "), F.col("rows_processed").cast("string"),
                   F.lit(" rows: "), F.repeat(F.lit("timeout; "), 30))
    return control.failure_rows(cur.withColumn("message", msg), "message", CONTROL_NOW)


@query
def watermark_guard(spark, d):
    """B2: the watermark text guard over well-formed and malformed candidates per order date."""
    days = fx.table(spark, d, "orders").select(F.col("o_orderdate").alias("ts")).distinct()
    # Candidate texts are built by zone-free casts (see ``watermark_text``).
    good = watermark_text("ts")
    day = F.to_date("ts").cast("string")
    cands = F.array(
        F.struct(F.lit("plain").alias("form"), good.alias("text")),
        F.struct(F.lit("date_only").alias("form"), day.alias("text")),
        F.struct(F.lit("iso_t").alias("form"), F.regexp_replace(good, " ", "T").alias("text")),
        F.struct(F.lit("injection").alias("form"), F.concat(good, F.lit("' OR '1'='1")).alias("text")),
        F.struct(F.lit("newline").alias("form"), F.concat(good, F.lit("\n")).alias("text")),
        F.struct(F.lit("bad_month").alias("form"),
                 F.concat(F.substring(day, 1, 4), F.lit("-13-01 00:00:00")).alias("text")),
    )
    return days.select("ts", F.explode(cands).alias("c")).select(
        "ts", "c.form", "c.text", jdbc.watermark_guard_col("c.text").alias("accepted"))
