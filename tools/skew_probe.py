"""Measure shuffle volume and the largest reduce task under a hot key.

    python tools/skew_probe.py [sf_dir]

A third of all calls are moved onto one case, and half of those onto one call
id (thousands of versions of one key). The phone report runs over it, with
Spark's event log written to a fresh scratch folder; per shuffle stage the
probe prints the records written and the most records any one reduce task
read. With the partial WindowGroupLimit and partial aggregates, the hot key
ships at most one row per map task into each shuffle.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from datetime import date

    from tidemark.config import ReportConfig
    from tidemark.operators import marts, staging
    from tidemark.sources import fixtures as fx

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="skew-probe-", dir="/tmp")
    spark = (SparkSession.builder.master("local[8]").appName("skew-probe")
             .config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", log_dir).config("spark.eventLog.compress", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.adaptive.enabled", "false")  # fixed partitions: per-task numbers are comparable
             .config("spark.sql.autoBroadcastJoinThreshold", "-1").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    log = fx.dialer_log(spark, sf_dir).repartition(8)  # eight map tasks
    hot = F.col("ingest_seq") % 3 == 0
    log = (log.withColumn("case_id", F.when(hot, F.lit(5)).otherwise(F.col("case_id")))
              .withColumn("client_id", F.when(hot, F.lit(102)).otherwise(F.col("client_id")))
              .withColumn("uniqueid", F.when(hot & (F.col("ingest_seq") % 2 == 0), F.lit("call-hot"))
                          .otherwise(F.col("uniqueid"))))
    total = log.count()
    hot_case = log.filter(F.col("case_id") == 5).count()
    hot_versions = log.filter(F.col("uniqueid") == "call-hot").count()
    cfg = ReportConfig(as_of=date(2024, 2, 15))
    spark.sparkContext.setJobGroup("phone", "phone report over the hot dialer log")
    marts.mart_phone_quality(staging.stg_dialer(log, cfg), cfg).write.format("noop").mode("overwrite").save()
    # The penetration report with a third of calls and of contacts on the same hot case.
    contacts = fx.contacts_log(spark, sf_dir).repartition(8)
    contacts = contacts.withColumn("case_id", F.when(F.col("ingest_seq") % 3 == 0, F.lit(5)).otherwise(F.col("case_id")))
    spark.sparkContext.setJobGroup("penetration", "penetration report, hot case in calls and contacts")
    marts.mart_penetration(fx.cases_log(spark, sf_dir), fx.attributes_log(spark, sf_dir), log, contacts, cfg) \
        .write.format("noop").mode("overwrite").save()
    spark.stop()

    stages: dict[int, dict] = {}
    stage_group: dict[int, str] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or not os.path.basename(path).startswith("events_"):
            continue
        with open(path) as f:
            for line in f:
                try:
                    ev = json.loads(line)
                except json.JSONDecodeError:
                    continue
                if ev.get("Event") == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev.get("Task Metrics") or {}
                st = stages.setdefault(ev["Stage ID"], {"written": 0, "max_read": 0, "tasks": 0})
                st["tasks"] += 1
                st["written"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
                st["max_read"] = max(st["max_read"], (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0))
    by_group: dict[str, dict] = {}
    for sid, v in sorted(stages.items()):
        if v["written"] or v["max_read"]:
            by_group.setdefault(stage_group.get(sid, "") or "count", {})[sid] = v
    print(json.dumps({"input_rows": total, "hot_case_rows": hot_case, "hot_call_versions": hot_versions,
                      "map_tasks": 8, "stages": by_group}))


if __name__ == "__main__":
    main()
