"""Property tests: the change-log operators against pure-Python definitions on random logs."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import changelog

T0 = datetime(2024, 1, 1)
SCHEMA = "k long, t int, v string, update_date timestamp_ntz, seq long"

rows_st = st.lists(
    st.tuples(
        st.integers(0, 4),                                   # key
        st.sampled_from([11, 12, 13]),                       # attribute type
        st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),  # value, NULL allowed
        st.one_of(st.none(), st.integers(0, 5).map(lambda d: T0 + timedelta(days=d))),  # ties and NULLs
    ),
    min_size=0, max_size=25,
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _log(spark, rows):
    return spark.createDataFrame([(k, t, v, u, i) for i, (k, t, v, u) in enumerate(rows)], SCHEMA)


def _newest(rows_with_seq):
    # update_date DESC NULLS LAST, then seq DESC
    return max(rows_with_seq, key=lambda r: (r[3] is not None, r[3] or T0, r[4]))


@SETTINGS
@given(rows=rows_st)
def test_latest_per_key_is_the_newest_version(spark, rows):
    got = {r.k: r.seq for r in changelog.latest_per_key(_log(spark, rows), ["k"], ["update_date", "seq"]).collect()}
    want = {}
    for i, r in enumerate(rows):
        want.setdefault(r[0], []).append((*r, i))
    assert got == {k: _newest(v)[4] for k, v in want.items()}


@SETTINGS
@given(rows=rows_st)
def test_pivot_takes_newest_value_per_type(spark, rows):
    got = {r.k: (r.p, r.q) for r in changelog.pivot_latest(_log(spark, rows), "k", "t", "v", {11: "p", 12: "q"},
                                                             ["update_date", "seq"]).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        vals = []
        for t in (11, 12):
            cand = [(*r, i) for i, r in enumerate(rows) if r[0] == k and r[1] == t]
            vals.append(_newest(cand)[2] if cand else None)
        want[k] = tuple(vals)
    assert got == want


@SETTINGS
@given(rows=rows_st, days=st.integers(7, 12))
def test_retention_keeps_newest_and_recent(spark, rows, days):
    rows = [r for r in rows if r[3] is not None]
    as_of = T0 + timedelta(days=days)
    cutoff = as_of - timedelta(hours=168)
    got = sorted(r.seq for r in changelog.prune_superseded(_log(spark, rows), ["k"], ["update_date", "seq"],
                                                            "update_date", as_of, 168).collect())
    by_key = {}
    for i, r in enumerate(rows):
        by_key.setdefault(r[0], []).append((*r, i))
    keep = set()
    for v in by_key.values():
        keep.add(_newest(v)[4])
        keep.update(x[4] for x in v if x[3] >= cutoff)
    assert got == sorted(keep)


@SETTINGS
@given(old=rows_st, new=rows_st)
def test_upsert_equals_latest_of_everything_newer(spark, old, new):
    # Updates are newer than everything in the target (they come from a later batch).
    later = [(k, t, v, T0 + timedelta(days=30 + (u - T0).days if u else 30)) for k, t, v, u in new]
    everything = old + later
    log = _log(spark, everything)
    n_old = len(old)
    order = ["update_date", "seq"]
    target = changelog.latest_per_key(log.filter(f"seq < {n_old}"), ["k"], order)
    got = {r.k: r.seq for r in changelog.upsert_latest(target, log.filter(f"seq >= {n_old}"), ["k"], order).collect()}
    want = {r.k: r.seq for r in changelog.latest_per_key(log, ["k"], order).collect()}
    assert got == want


checks_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(-2, 4)),
                                 st.one_of(st.none(), st.sampled_from(["a", "b", "z"]))), max_size=25)


@SETTINGS
@given(rows=checks_rows)
def test_check_runner_counts_like_python(spark, rows):
    from collections import Counter

    from tidemark.operators import quality as dq

    df = spark.createDataFrame(rows, "k long, r long, v string")
    got = {(r.check, r.column): r.failures for r in dq.run_checks(df, "m", [
        dq.not_null("k"), dq.unique("k"), dq.accepted_range("r", 0, 3), dq.accepted_values("v", ["a", "b"]),
        dq.unique_combination("k", "v")]).collect()}
    keys = Counter(k for k, _, _ in rows if k is not None)
    pairs = Counter((k, v) for k, _, v in rows)
    want = {
        ("not_null", "k"): sum(k is None for k, _, _ in rows),
        ("unique", "k"): sum(c > 1 for c in keys.values()),
        ("accepted_range", "r"): sum(r is not None and not 0 <= r <= 3 for _, r, _ in rows),
        ("accepted_values", "v"): sum(v is not None and v not in ("a", "b") for _, _, v in rows),
        ("unique_combination", "k,v"): sum(c > 1 for c in pairs.values()),
    }
    assert got == want


side_st = st.dictionaries(st.integers(0, 15), st.one_of(st.none(), st.sampled_from(["x", "y"])), max_size=12)


@SETTINGS
@given(src=side_st, brz=side_st)
def test_row_reconciliation_like_python(spark, src, brz):
    from tidemark.operators import reconcile

    s = spark.createDataFrame(list(src.items()), "k long, v string")
    b = spark.createDataFrame(list(brz.items()), "k long, v string")
    got = {r.k: r.status for r in reconcile.reconcile_rows(s, b, ["k"]).collect()}
    want = {}
    for k in set(src) | set(brz):
        if k not in brz:
            want[k] = "missing"
        elif k not in src:
            want[k] = "extra"
        elif src[k] != brz[k]:
            want[k] = "changed"
    assert got == want


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.integers(-1000, 1000)), min_size=1, max_size=30))
def test_band_like_python(spark, values):
    from tidemark.config import DPD_BANDS, NO_DPD_LABEL
    from tidemark.functions.expressions import band

    def py_band(v):
        if v is None:
            return NO_DPD_LABEL
        for lo, hi, label in DPD_BANDS:
            if v >= lo and (hi is None or v <= hi):
                return label
        return NO_DPD_LABEL

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int")
    got = [r.b for r in df.select("i", band("v").alias("b")).orderBy("i").collect()]
    assert got == [py_band(v) for v in values]


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**6)), min_size=1, max_size=30))
def test_safe_rate_is_half_up_at_four_places(spark, pairs):
    from decimal import ROUND_HALF_UP, Decimal

    from tidemark.functions.expressions import safe_rate

    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a long, b long")
    got = [r.r for r in df.select("i", safe_rate("a", "b").alias("r")).orderBy("i").collect()]
    want = [None if b == 0 else float((Decimal(a) / Decimal(b)).quantize(Decimal("0.0001"), ROUND_HALF_UP))
            for a, b in pairs]
    assert got == want


@SETTINGS
@given(points=st.lists(st.tuples(st.integers(0, 255), st.integers(0, 255)), min_size=1, max_size=30))
def test_morton_key_like_python(spark, points):
    from tidemark.functions.expressions import zorder_key

    def interleave(x, y):
        return sum((((x >> i) & 1) << (2 * i)) | (((y >> i) & 1) << (2 * i + 1)) for i in range(8))

    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "i int, x long, y long")
    got = [r.z for r in df.select("i", zorder_key(["x", "y"], 8).alias("z")).orderBy("i").collect()]
    assert got == [interleave(x, y) for x, y in points]


ts_text = st.one_of(
    st.datetimes(min_value=datetime(1900, 1, 1), max_value=datetime(2100, 1, 1)).map(
        lambda d: d.strftime("%Y-%m-%d %H:%M:%S")),
    st.text(alphabet="0123456789-: T'\n", min_size=0, max_size=22),
    st.tuples(st.integers(0, 9999), st.integers(0, 99), st.integers(0, 99), st.integers(0, 99), st.integers(0, 99),
              st.integers(0, 99)).map(lambda t: "%04d-%02d-%02d %02d:%02d:%02d" % t),
)


@SETTINGS
@given(texts=st.lists(ts_text, min_size=1, max_size=20))
def test_guard_column_agrees_with_python_guard(spark, texts):
    from tidemark.sources.jdbc import validate_watermark, watermark_guard_col

    def ok(t):
        try:
            validate_watermark(t)
            return 1
        except ValueError:
            return 0

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.a for r in df.select("i", watermark_guard_col("t").alias("a")).orderBy("i").collect()]
    assert got == [ok(t) for t in texts]


@SETTINGS
@given(items=st.lists(st.tuples(
    st.one_of(st.none(), st.datetimes(min_value=datetime(1900, 1, 1), max_value=datetime(2100, 1, 1))),
    st.integers(0, 600)), min_size=1, max_size=20))
def test_lagged_watermark_text_like_python(spark, items):
    from tidemark.config import SEED_WATERMARK
    from tidemark.functions.expressions import lagged_watermark, watermark_text

    def py(wm, lag):
        wm = wm or SEED_WATERMARK
        if lag:
            wm = max(wm - timedelta(minutes=lag), SEED_WATERMARK)
        return wm.replace(microsecond=0).strftime("%Y-%m-%d %H:%M:%S")

    rows = [(i, wm, lag) for i, (wm, lag) in enumerate(items)]
    df = spark.createDataFrame(rows, "i int, wm timestamp_ntz, lag int")
    got = []
    for i, wm, lag in rows:  # the lag is a parameter of the expression, so one select per row
        got.append(df.filter(f"i = {i}").select(watermark_text(lagged_watermark("wm", lag)).alias("t")).first().t)
    assert got == [py(wm, lag) for _, wm, lag in rows]
