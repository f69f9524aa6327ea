"""Column builders for the scalar rules of the reports (all JVM-side).

Each function returns a ``Column``; nothing here runs Python per row.
"""

from __future__ import annotations

import calendar
from datetime import date, datetime
from decimal import Decimal
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import DPD_BANDS, NO_DPD_LABEL, SEED_WATERMARK


def _one() -> Column:
    """Decimal ``1.0``: rates are computed in decimal, as in SQL."""
    return F.lit(Decimal("1.0"))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def band(col: Column | str, bands=DPD_BANDS, default: str = NO_DPD_LABEL) -> Column:
    """Inclusive integer bands; NULL, negatives and gaps fall to ``default``."""
    c = _c(col)
    expr = None
    for lo, hi, label in bands:
        cond = c.between(lo, hi) if hi is not None else c >= lo
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def safe_rate(num: Column | str, den: Column | str, scale: int = 4) -> Column:
    """``round(num * 1.0 / nullif(den, 0), scale)`` in decimal, returned as double.

    NULL for an empty group instead of a division error. Decimal arithmetic
    rounds half-up exactly; the double cast is the last step.
    """
    n, d = _c(num), _c(den)
    return F.round(n * _one() / F.nullif(d, F.lit(0)), scale).cast("double")


def difference(a: Column | str, b: Column | str) -> Column:
    return _c(a) - _c(b)


def flag(cond: Column) -> Column:
    """0/1 int flag; a NULL condition gives 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def cleanup_flag(total: Column | str, failed: Column | str, min_total: int, min_failed: int) -> Column:
    """Both thresholds are kept even where one implies the other: they are parameters."""
    return flag((_c(total) > min_total) & (_c(failed) > min_failed))


def try_int(col: Column | str) -> Column:
    """String to int; anything unparsable becomes NULL instead of an error."""
    return _c(col).try_cast("int")


def month_start(d: date) -> date:
    return d.replace(day=1)


def add_months(d: date, n: int) -> date:
    m = d.month - 1 + n
    y, m = d.year + m // 12, m % 12 + 1
    return d.replace(year=y, month=m, day=min(d.day, calendar.monthrange(y, m)[1]))


def window_bounds(as_of: date, months_back: int) -> tuple[date, date]:
    """Half-open ``[first day of (as_of month - back), first day of next month)``.

    Computed once from the parameter, so both bounds reach the plan as
    literals and are pushed to the scan.
    """
    return month_start(add_months(as_of, -months_back)), month_start(add_months(as_of, 1))


def window_bounds_col(as_of: Column | str, months_back: int) -> tuple[Column, Column]:
    """Column form of :func:`window_bounds`, for a table of as-of dates."""
    a = _c(as_of)
    return F.trunc(F.add_months(a, -months_back), "month"), F.trunc(F.add_months(a, 1), "month")


def in_window(ts: Column | str, lo: date, hi: date) -> Column:
    """``lo <= cast(ts as date) < hi`` written on the raw timestamp so it can be pushed."""
    c = _c(ts)
    lo_ts = datetime(lo.year, lo.month, lo.day)
    hi_ts = datetime(hi.year, hi.month, hi.day)
    return (c >= ntz(lo_ts)) & (c < ntz(hi_ts))


def in_month_window(df, date_col: str, as_of: date, months_back: int):
    """Rows of ``df`` whose ``date_col`` falls in the rolling month window of ``as_of``."""
    lo, hi = window_bounds(as_of, months_back)
    return df.filter(in_window(date_col, lo, hi))


def ntz(value: datetime) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def watermark_text(col: Column | str) -> Column:
    """Whole-second ``yyyy-MM-dd HH:mm:ss`` text; truncating the fraction only ever re-reads rows.

    A zone-less timestamp is turned into text by a cast, which involves no zone:
    ``date_format`` would pass it through the session zone first, and a midnight
    that falls in a daylight-saving gap there would come out as 01:00.
    """
    return F.substring(_c(col).cast("timestamp_ntz").cast("string"), 1, 19)


def lagged_watermark(wm: Column | str, lag_minutes: int, seed: datetime = SEED_WATERMARK) -> Column:
    """Stored watermark (or the seed when unknown) rewound by the lag, floored at the seed."""
    base = F.coalesce(_c(wm), ntz(seed))
    if lag_minutes:
        base = base - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(lag_minutes), F.lit(0))
    return F.greatest(base, ntz(seed))


def forward_only(batch_max: Column | str, current: Column | str, seed: datetime = SEED_WATERMARK) -> Column:
    """Next watermark: never behind the current one."""
    cur = F.coalesce(_c(current), ntz(seed))
    return F.greatest(F.coalesce(_c(batch_max), cur), cur)


def drift_fraction(source: Column | str, bronze: Column | str, scale: int = 6) -> Column:
    """``round(|s - b| / s, 6)``, 0 for an empty source, exact decimal then double."""
    s, b = _c(source), _c(bronze)
    return F.when(s > 0, F.round(F.abs(s - b) * _one() / s, scale).cast("double")).otherwise(F.lit(0.0))


def failure_status(msg: Column | str, limit: int = 200) -> Column:
    return F.concat(F.lit("failed: "), F.substring(_c(msg), 1, limit))


def zorder_key(cols: Iterable[Column | str], bits: int = 8) -> Column:
    """Interleave the low ``bits`` bits of already-scaled non-negative int keys.

    Bit ``i`` of key ``j`` lands at position ``i * n + j`` (Morton order).
    """
    cs = [_c(c).cast("long") for c in cols]
    n = len(cs)
    if n * bits > 62:
        raise ValueError("interleaved key would not fit in a signed long")
    out = F.lit(0).cast("long")
    for i in range(bits):
        for j, c in enumerate(cs):
            bit = F.shiftright(c, i).bitwiseAND(F.lit(1))
            out = out.bitwiseOR(F.shiftleft(bit, i * n + j))
    return out


def hilbert_key(x: Column | str, y: Column | str, bits: int = 8) -> Column:
    """Place of an already-scaled non-negative pair on the Hilbert curve of ``2**bits`` cells a
    side. Neighbours on the curve are neighbours in the plane, so a range of it is one
    patch, where a range of the Morton order may be several.

    From the highest bit down: which quadrant, in the curve's order there, then the pair
    as that quadrant's own curve sees it (mirrored and swapped)."""
    if 2 * bits > 62:
        raise ValueError("the key would not fit in a signed long")

    def deeper(at: Column, side: Column) -> Column:
        right, up = ((at[c].bitwiseAND(side) != 0).cast("long") for c in ("x", "y"))
        inner = [at[c].bitwiseAND(side - 1) for c in ("x", "y")]
        mirrored = [F.when((up == 0) & (right == 1), side - 1 - c).otherwise(c) for c in inner]
        swapped = [F.when(up == 0, mirrored[1 - i]).otherwise(mirrored[i]) for i in range(2)]
        d = at["d"] + side * side * (right * 3).bitwiseXOR(up)
        return F.struct(swapped[0].alias("x"), swapped[1].alias("y"), d.alias("d"))

    start = F.struct(_c(x).cast("long").alias("x"), _c(y).cast("long").alias("y"), F.lit(0).cast("long").alias("d"))
    sides = F.array(*[F.lit(1 << i).cast("long") for i in reversed(range(bits))])
    return F.aggregate(sides, start, deeper)["d"]


def scale_to_bits(col: Column | str, lo, hi, bits: int = 8) -> Column:
    """Integer min/max scaling of a numeric key into ``[0, 2**bits)``."""
    top = (1 << bits) - 1
    c = _c(col).cast("long")
    if hi is None or lo is None or hi == lo:
        return F.lit(0).cast("long")
    span = int(hi) - int(lo)
    if span * top < 1 << 62:
        scaled = ((c - F.lit(int(lo))) * F.lit(top)) / F.lit(span)
    else:  # a wide key times the top would not fit in a long
        scaled = (c.cast("decimal(20,0)") - F.lit(Decimal(int(lo)))) * F.lit(top) / F.lit(Decimal(span))
    return F.least(F.greatest(scaled, F.lit(0)), F.lit(top)).cast("long")


def days_since(ts: Column | str, origin: date) -> Column:
    return F.datediff(F.to_date(_c(ts)), F.lit(origin))
