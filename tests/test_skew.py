"""A third of all rows on one key: results stay whole and equal a brute-force computation."""

from datetime import date

import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.config import ReportConfig
from tidemark.operators import changelog, marts, staging
from tidemark.sources import fixtures as fx

CFG = ReportConfig(as_of=date(2024, 2, 15))


def _hot_dialer(spark):
    log = fx.dialer_log(spark, SF_SMALL)
    hot = F.col("ingest_seq") % 3 == 0
    # Every third call belongs to one case of client 102; half of those are re-sent versions of one call id.
    return (log.withColumn("case_id", F.when(hot, F.lit(5)).otherwise(F.col("case_id")))
               .withColumn("client_id", F.when(hot, F.lit(102)).otherwise(F.col("client_id")))
               .withColumn("uniqueid", F.when(hot & (F.col("ingest_seq") % 2 == 0), F.lit("call-hot"))
                           .otherwise(F.col("uniqueid"))))


def test_hot_key_dedup_matches_brute_force(spark):
    log = _hot_dialer(spark)
    got = changelog.latest_per_key(log, ["uniqueid"], ["update_date", "ingest_seq"]).toPandas()
    pdf = log.toPandas().sort_values(["update_date", "ingest_seq"], ascending=False)
    want = pdf.drop_duplicates("uniqueid", keep="first")
    assert len(got) == len(want)
    g = got.set_index("uniqueid")["ingest_seq"].sort_index()
    w = want.set_index("uniqueid")["ingest_seq"].sort_index()
    assert g.equals(w)


def test_hot_case_phone_mart_matches_brute_force(spark):
    calls = staging.stg_dialer(_hot_dialer(spark), CFG)
    got = marts.mart_phone_quality(calls, CFG).toPandas()
    c = calls.toPandas()
    c = c[(c.call_date >= pd.Timestamp("2023-12-01")) & (c.call_date < pd.Timestamp("2024-03-01"))]
    want = c.groupby(["client_id", "case_id", "telecom_id"]).agg(
        total_calls=("uniqueid", "size"), failed_calls=("is_failed", "sum")).reset_index()
    m = got.merge(want, on=["client_id", "case_id", "telecom_id"], suffixes=("", "_bf"))
    assert len(m) == len(got) == len(want)
    assert (m.total_calls == m.total_calls_bf).all() and (m.failed_calls == m.failed_calls_bf).all()
    assert got.total_calls.sum() == len(c)


def test_event_log_shows_one_row_per_map_task_for_the_hot_key():
    """Runs tools/skew_probe.py (its own Spark context, event log in a scratch folder) and checks
    that the dedup shuffle carries the hot call id as at most one row per map task."""
    import json
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, os.path.join(root, "tools", "skew_probe.py"), SF_SMALL],
                         capture_output=True, text=True, timeout=600, check=True).stdout
    rep = json.loads(out.strip().splitlines()[-1])
    unique_rows = rep["input_rows"] - rep["hot_call_versions"]
    written = [v["written"] for v in rep["stages"]["phone"].values()]
    # One stage writes exactly the non-hot rows plus 1..map_tasks copies of the hot key.
    assert any(unique_rows + 1 <= w <= unique_rows + rep["map_tasks"] for w in written), rep
