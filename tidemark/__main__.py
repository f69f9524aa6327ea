"""Command line for the recurring jobs (``spark-submit`` or ``python -m tidemark``).

    python -m tidemark daily     --base DIR [--source-dir DIR | --jdbc] [--as-of YYYY-MM-DD] [--now ISO]
    python -m tidemark reconcile --base DIR [--source-dir DIR | --jdbc]
    python -m tidemark maintain  --base DIR [--retention-hours 168]
    python -m tidemark scan      --base DIR            (scans the text files under DIR; exit 1 on findings)

The session comes from ``SparkSession.builder.getOrCreate()``: cluster
settings (including ``spark.checkpoint.dir``) are whatever the submitter set.
Sources are either the JDBC database named by ``TIDEMARK_JDBC_*`` variables,
or parquet folders ``<source-dir>/<table_name>`` (exports, tests).
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys
from datetime import date, datetime


# Findings that ``scan`` prints; ``--out`` writes all of them.
SHOWN = 200


def _args(argv):
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("job", choices=["daily", "reconcile", "maintain", "scan"])
    p.add_argument("--base", required=True, help="folder holding bronze, control, marts")
    src = p.add_mutually_exclusive_group()
    src.add_argument("--source-dir", help="parquet folder per source table")
    src.add_argument("--jdbc", action="store_true", help="read the sources over JDBC (TIDEMARK_JDBC_*)")
    p.add_argument("--as-of", type=date.fromisoformat, default=None, help="report date (default: today)")
    p.add_argument("--now", type=datetime.fromisoformat, default=None, help="run time (default: now)")
    p.add_argument("--sequence-column", action="append", default=[], metavar="TABLE=COLUMN",
                   help="source column ordering versions of a key, per table (repeatable)")
    p.add_argument("--skip-dir", action="append", default=[], help="scan: a folder name to leave out (repeatable)")
    p.add_argument("--skip-suffix", action="append", default=[], help="scan: a file suffix to leave out (repeatable)")
    p.add_argument("--retention-hours", type=int, default=168)
    p.add_argument("--state-buckets", type=int, default=None,
                   help="daily: build the reports from bucketed latest-state tables kept by a stream")
    p.add_argument("--out", default=None, help="scan: folder for all findings (JSON lines)")
    p.add_argument("--register", default=None, metavar="DATABASE", help="daily: register the bronze tables in this database")
    p.add_argument("--no-fail", action="store_true", help="report failing checks / drift without failing")
    return p.parse_args(argv)


def main(argv=None) -> int:
    from pyspark.sql import SparkSession

    from tidemark.config import ReportConfig, default_sources
    from tidemark.plans import ingest, jobs
    from tidemark.sources import jdbc

    a = _args(argv if argv is not None else sys.argv[1:])
    spark = SparkSession.builder.appName(f"tidemark-{a.job}").getOrCreate()
    now = a.now or datetime.now()
    cfg = ReportConfig(as_of=a.as_of or now.date())
    order = dict(x.split("=", 1) for x in a.sequence_column)
    specs = [dataclasses.replace(s, sequence_column=order.get(s.table_name)) for s in default_sources(cfg)]

    def source_of(spec):
        if a.jdbc:
            return jdbc.read_jdbc_table(spark, jdbc.JdbcConnection.from_env(), spec.source_table)
        return spark.read.parquet(f"{a.source_dir.rstrip('/')}/{spec.table_name}")

    if a.job == "scan":
        from tidemark.operators import textscan

        found = textscan.scan_files(spark, a.base, a.skip_dir, a.skip_suffix)
        if a.out:  # all findings, written by the executors
            found.write.mode("errorifexists").json(a.out)
            found = spark.read.schema(found.schema).json(a.out)
        per_rule = {r.rule: r.findings for r in textscan.scan_summary(found).collect()}
        for f in found.orderBy("id", "line", "rule").limit(SHOWN).collect():
            print(f"{f.id}:{f.line}  {f.rule}\n    matched: {f.matched}\n    {f.hint}")
        n = per_rule.pop(textscan.ALL_RULES)
        print(json.dumps({"findings": n, "shown": min(n, SHOWN), "per_rule": per_rule}))
        return 1 if n else 0
    if a.job == "daily":
        if a.jdbc:
            conn = jdbc.JdbcConnection.from_env()
            read = lambda spec, wm: jdbc.read_jdbc_incremental(spark, conn, spec, wm)
        else:
            read = ingest.dataframe_reader({s.table_name: source_of(s) for s in specs})
        res = jobs.run_daily(spark, specs, read, a.base, now, cfg, fail_on_checks=not a.no_fail,
                             state_buckets=a.state_buckets, register_database=a.register)
        out = {"rows_landed": res.rows_landed, "published": res.published, "failed_checks": res.failed_checks}
    elif a.job == "reconcile":
        if a.jdbc:  # counted at the source: no source row crosses the network
            conn = jdbc.JdbcConnection.from_env()
            rows = jobs.run_reconciliation(spark, specs, None, a.base, now, fail_on_drift=not a.no_fail,
                                           source_counts=lambda spec: jdbc.source_key_count(spark, conn, spec))
        else:
            rows = jobs.run_reconciliation(spark, specs, source_of, a.base, now, fail_on_drift=not a.no_fail)
        rows = rows.collect()
        out = {"reconciliation": [r.asDict() for r in rows]}
    else:
        rows = jobs.run_maintenance(spark, specs, a.base, now, cfg, retention_hours=a.retention_hours).collect()
        out = {"maintenance": [r.asDict() for r in rows]}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
