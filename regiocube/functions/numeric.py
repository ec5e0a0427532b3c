"""Numeric column helpers with the published marts' exact semantics.

The marts were produced by an engine whose ``ROUND(double, n)`` scales by
10**n, rounds half away from zero on the binary value and scales back, and
whose double->BIGINT cast rounds half to even. Spark's ``round`` works on the
shortest decimal string instead (1.005 -> 1.01 where the marts hold 1.0), and
a plain cast truncates. These helpers reproduce the published numbers while
staying plain JVM expressions inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_away(x, digits: int) -> Column:
    """``ROUND(x, digits)`` as scale -> round-half-away -> unscale on doubles.

    At scale 0 Spark's HALF_UP rounding of the shortest decimal string agrees
    with rounding the binary value, so scaling first gives bit-equal results.
    """
    col = _c(x)
    if digits == 0:
        return F.round(col, 0)
    scale = F.lit(float(10**digits))
    return F.round(col * scale, 0) / scale


def to_bigint(x) -> Column:
    """double -> BIGINT rounding half to even (2.5 -> 2, 3.5 -> 4, 2.7 -> 3)."""
    return F.rint(_c(x)).cast("long")


def safe_div(num, den) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of an ANSI divide-by-zero error."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def pct_distance(value, ref, digits: int, abs_denominator: bool = True) -> Column:
    """``ROUND((value - ref) / NULLIF(ABS(ref), 0) * 100, digits)``.

    With ``abs_denominator`` the sign follows ``value - ref`` even when the
    reference mean is negative; without it the raw mean is the denominator.
    """
    v, r = _c(value), _c(ref)
    den = F.abs(r) if abs_denominator else r
    return round_half_away(safe_div(v - r, den) * F.lit(100.0), digits)


def share_pct(part, total, digits: int | None = None) -> Column:
    """``part / NULLIF(total, 0) * 100`` optionally rounded."""
    out = safe_div(part, total) * F.lit(100.0)
    return out if digits is None else round_half_away(out, digits)


def cagr_pct(first_value, last_value, first_year, last_year, digits: int,
             guard_last_nonneg: bool = False) -> Column:
    """Compound annual growth rate in percent.

    Defined only when the window spans more than one year and the first value
    is positive; with ``guard_last_nonneg`` a negative last value also yields
    NULL (otherwise the fractional power of a negative ratio is NaN).
    """
    fv, lv = _c(first_value), _c(last_value)
    fy, ly = _c(first_year), _c(last_year)
    cond = (ly > fy) & (fv > 0)
    if guard_last_nonneg:
        cond = cond & (lv >= 0)
    growth = (F.pow(lv / fv, F.lit(1.0) / (ly - fy)) - F.lit(1.0)) * F.lit(100.0)
    return F.when(cond, round_half_away(growth, digits))


def nan_to_null(x) -> Column:
    """NaN would rank above every number and poison averages: make it NULL."""
    col = _c(x)
    return F.when(~F.isnan(col), col)
