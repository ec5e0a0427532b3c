"""Code rules of the statistical classifications, as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiocube.constants import CITIZEN_AGGREGATES


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def derive_country(geo="geo", nuts_level="nuts_level") -> Column:
    """ISO-2 prefix of ``geo`` for real geographies only.

    Aggregates (EU27_2020, EA20, ...) carry a NULL or blank level and get a
    NULL country, so they never enter country benchmarks.
    """
    lvl = _c(nuts_level)
    return F.when(lvl.isNotNull() & (lvl != F.lit("")), F.substring(_c(geo), 1, 2))


def parent_code(code="code") -> Column:
    """NUTS parent: the trimmed code minus its last character, '' for codes
    of two characters or fewer."""
    c = F.trim(_c(code))
    n = F.length(c)
    return F.when(n > 2, F.substring(c, F.lit(1), n - F.lit(1))).otherwise(F.lit(""))


def split_period(period="year") -> tuple[Column, Column]:
    """``YYYY-Qn`` -> (year INT, quarter STRING); a missing part gives ''."""
    p = _c(period)
    year = F.split_part(p, F.lit("-"), F.lit(1)).cast("int")
    quarter = F.split_part(p, F.lit("-"), F.lit(2))
    return year, quarter


def map_labels(col, mapping: Mapping, default: str | None = None) -> Column:
    """Simple-CASE label lookup.

    ``default=None`` leaves unknown codes NULL; ``default='code'`` falls back
    to the code itself (``ELSE col``).
    """
    src = _c(col)
    out = None
    for k, v in mapping.items():
        out = (F.when(src == F.lit(k), F.lit(v)) if out is None
               else out.when(src == F.lit(k), F.lit(v)))
    if out is None:
        return src if default == "code" else F.lit(None).cast("string")
    if default == "code":
        return out.otherwise(src.cast("string"))
    if default is not None:
        return out.otherwise(F.lit(default))
    return out


def is_member(col, codes: Iterable[str]) -> Column:
    """Three-valued membership (NULL probe -> NULL), as a literal IN list."""
    return _c(col).isin(list(codes))


def is_country_citizen(col="citizen", aggregates: Iterable[str] = CITIZEN_AGGREGATES) -> Column:
    """Two-letter citizenship codes that are real countries (not EU/EA)."""
    c = _c(col)
    return (F.length(c) == 2) & ~c.isin(list(aggregates))


def slice_predicate(slice_: Mapping[str, object] | None) -> Column:
    """Equality conjunction ``dim1 = v1 AND dim2 = v2 ...`` (TRUE when empty).

    A value given as a list/tuple/set becomes an IN list.
    """
    pred = F.lit(True)
    for dim, val in (slice_ or {}).items():
        if isinstance(val, (list, tuple, set, frozenset)):
            pred = pred & F.col(dim).isin(list(val))
        else:
            pred = pred & (F.col(dim) == F.lit(val))
    return pred
