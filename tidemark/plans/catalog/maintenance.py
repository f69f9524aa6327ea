"""Catalogue: upsert, retention and the Z-order key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.expressions import ntz
from tidemark.operators import changelog, layout
from tidemark.plans.catalog.common import _SRC_CONTACT_COLS, query
from tidemark.sources import fixtures as fx


# ---- change log maintenance ---------------------------------------------------

UPSERT_CUT = datetime(1999, 1, 1)


@query
def upsert_latest(spark, d):
    """Latest state up to a cut, merged with the later changes = latest state overall."""
    log = fx.contacts_log(spark, d).select(*_SRC_CONTACT_COLS)
    before = log.filter(F.col("update_date") <= ntz(UPSERT_CUT))
    after = log.filter(F.col("update_date") > ntz(UPSERT_CUT))
    order = ["update_date", "ingest_seq"]
    target = changelog.latest_per_key(before, ["contact_id"], order)
    return changelog.upsert_latest(target, after, ["contact_id"], order)


PRUNE_AS_OF = datetime(2001, 11, 4)
PRUNE_RETENTION_H = 24 * 365


@query
def prune_superseded(spark, d):
    """K3: newest version per contact plus every version inside the retention."""
    log = fx.contacts_log(spark, d).select(*_SRC_CONTACT_COLS)
    return changelog.prune_superseded(log, ["contact_id"], ["update_date", "ingest_seq"], "update_date",
                                      PRUNE_AS_OF, PRUNE_RETENTION_H)


@query
def zorder_key(spark, d):
    """K2: Morton key of (case_id, call day) on the dialer log, 8 bits each."""
    log = fx.dialer_log(spark, d).select("uniqueid", "case_id", "call_date")
    with_day = log.withColumn("call_day", layout.days_since("call_date", layout.DAY_ORIGIN))
    (x, y), z = layout.zorder_columns(with_day, ["case_id", "call_day"], bits=8)
    return with_day.select("uniqueid", "case_id", "call_day", x.alias("zx"), y.alias("zy"), z.alias("zkey"))


@query
def hilbert_key(spark, d):
    """K2: place of (case_id, call day) of the dialer log on the Hilbert curve, 8 bits each."""
    log = fx.dialer_log(spark, d).select("uniqueid", "case_id", "call_date")
    with_day = log.withColumn("call_day", layout.days_since("call_date", layout.DAY_ORIGIN))
    (x, y), _ = layout.zorder_columns(with_day, ["case_id", "call_day"], bits=8)
    placed = with_day.select("uniqueid", x.alias("zx"), y.alias("zy"))
    return placed.select("*", layout.hilbert_key("zx", "zy", 8).alias("hkey"))
