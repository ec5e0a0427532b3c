"""Column-level helpers: engine-parity numerics and classification code rules."""

from regiocube.functions.codes import (
    derive_country,
    is_country_citizen,
    is_member,
    map_labels,
    parent_code,
    slice_predicate,
    split_period,
)
from regiocube.functions.numeric import (
    cagr_pct,
    nan_to_null,
    pct_distance,
    round_half_away,
    safe_div,
    share_pct,
    to_bigint,
)

__all__ = [
    "cagr_pct", "derive_country", "is_country_citizen", "is_member", "map_labels",
    "nan_to_null", "parent_code", "pct_distance", "round_half_away", "safe_div",
    "share_pct", "slice_predicate", "split_period", "to_bigint",
]
