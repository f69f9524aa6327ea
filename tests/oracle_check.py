"""Compare each catalogue query with its DuckDB oracle, as the driver does.

    python -m tests.oracle_check [sf_dir] [key ...]

With ``ORACLE_CHECK_JSON=<file>`` the per-key results are also written as JSON.
"""

from __future__ import annotations

import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(tbl):
    names = sorted(tbl.column_names)
    cols = [tbl.column(n).to_pylist() for n in names]
    rows = [tuple(_norm(c[i]) for c in cols) for i in range(tbl.num_rows)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, con, key: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    got = fn(spark, sf_dir).toArrow()
    t1 = time.time()
    exp = con.sql(sql).to_arrow_table()
    out = {"key": key, "spark_rows": got.num_rows, "oracle_rows": exp.num_rows, "secs": round(t1 - t0, 2)}
    gs = {f.name: str(f.type) for f in got.schema}
    es = {f.name: str(f.type) for f in exp.schema}
    out["names_ok"] = sorted(gs) == sorted(es)
    out["types_ok"] = gs == es
    if not out["types_ok"]:
        out["type_diff"] = {n: (gs.get(n), es.get(n)) for n in set(gs) | set(es) if gs.get(n) != es.get(n)}
    if out["names_ok"]:
        gr, er = _rows(got), _rows(exp)
        out["values_ok"] = gr == er
        if not out["values_ok"]:
            gset, eset = set(map(repr, gr)), set(map(repr, er))
            out["only_spark"] = sorted(gset - eset)[:3]
            out["only_oracle"] = sorted(eset - gset)[:3]
    else:
        out["values_ok"] = False
    return out


def main(argv):
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from tidemark.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:]
    spark = local_session()
    con = duck(sf_dir)
    qs, os_ = e.queries(), e.oracle_sql()
    bad = 0
    report = {}
    for k in (keys or sorted(qs)):
        if k not in os_:
            rows = qs[k](spark, sf_dir).count()
            print(f"ROWS-ONLY {k}: {rows}")
            report[k] = {"rows_only": True, "spark_rows": rows}
            continue
        try:
            r = compare(spark, con, k, qs[k], os_[k], sf_dir)
        except Exception as ex:  # report and go on
            bad += 1
            print(f"ERROR {k}: {type(ex).__name__}: {str(ex)[:400]}")
            report[k] = {"error": f"{type(ex).__name__}: {str(ex)[:400]}"}
            continue
        report[k] = {x: r[x] for x in ("spark_rows", "oracle_rows", "names_ok", "types_ok", "values_ok", "secs")}
        ok = r["values_ok"] and r["types_ok"]
        bad += not ok
        print(("OK   " if ok else "FAIL ") + str(r))
    print(f"{bad} problem(s)")
    out = os.environ.get("ORACLE_CHECK_JSON")
    if out:
        import json

        with open(out, "w") as f:
            json.dump({"sf_dir": sf_dir, "problems": bad, "queries": report}, f, indent=1)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
