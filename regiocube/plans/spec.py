"""Declarative dataset and mart specifications."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

MartBuilder = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class MartSpec:
    """One mart: a builder over the clean table, its grain and its gates."""

    name: str
    build: MartBuilder
    key: tuple[str, ...]
    min_rows: int = 0
    #: Published row order; ``-name`` sorts descending. NULLs come last either way.
    order_by: tuple[str, ...] = ()
    #: Columns that the mart must have besides its key.
    required: tuple[str, ...] = ()
    #: Rows of the clean table (a slice) in which these columns must be a key,
    #: else the mart would pick one of several observations.
    slice_: Mapping[str, object] | None = None
    slice_key: tuple[str, ...] = ()


@dataclass(frozen=True)
class DatasetSpec:
    """One dataflow: raw dims, enrichment and marts.

    ``dims`` are the raw key dimensions (including ``geo``); codelists are
    joined for ``freq``, ``unit`` (when present) and ``codelist_dims``;
    ``label_maps`` are inline label maps ``{dim: (mapping, default)}``.
    ``period`` is 'year', 'quarter' (``YYYY-Qn`` split at clean time) or
    'month' (a separate integer ``month`` column). ``unlabelled`` dims may lack
    their ``<dim>_label_en``.
    """

    slug: str
    dataflow: str
    dims: tuple[str, ...]
    codelist_dims: tuple[str, ...] = ()
    label_maps: Mapping[str, tuple[Mapping, str | None]] = field(default_factory=dict)
    source_filter: Mapping[str, object] = field(default_factory=dict)
    period: str = "year"
    with_parent: bool = True
    drop_incomplete: bool = False
    not_null: tuple[str, ...] = ("geo", "year")
    min_rows: int = 100
    unlabelled: tuple[str, ...] = ()
    flag_described: bool = True
    #: How landed text is read: ``delimiter`` and ``encoding`` (tab or comma, UTF-8 by default).
    read_options: Mapping[str, str] = field(default_factory=dict)
    marts: tuple[MartSpec, ...] = ()

    @property
    def extra_time(self) -> tuple[str, ...]:
        return {"quarter": ("quarter",), "month": ("month",)}.get(self.period, ())

    @property
    def required_columns(self) -> tuple[str, ...]:
        """The columns that the clean table must have (DQ-1)."""
        labelled = [d for d in ("freq", "unit", *self.codelist_dims, *self.label_maps)
                    if d not in self.unlabelled and d in (*self.dims, *self.extra_time)]
        return tuple(dict.fromkeys([
            *self.dims, "year", *self.extra_time, *(f"{d}_label_en" for d in labelled), "geo_label_en", "nuts_level",
            *(("nuts_parent_code", "nuts_parent_label_en") if self.with_parent else ()), "country", "value", "flag",
            *(("flag_desc_en",) if self.flag_described else ())]))

    @property
    def raw_schema(self) -> str:
        """Declared types of landed long observations (SRC-9)."""
        times = {"year": "year int", "quarter": "year string", "month": "year int, month int"}[self.period]
        return ", ".join([*(f"{d} string" for d in self.dims), times, "value double", "flag string"])

    @property
    def required_tables(self) -> tuple[str, ...]:
        """The marts that a run must have written."""
        return tuple(m.name for m in self.marts)
