"""raw -> clean enrichment (labels, geo hierarchy, country, casts).

All joins here are dimension lookups: the dimension side (codelists, the geo
hierarchy) is bounded by the classification size, proven by
``bounded_broadcast`` before hinting, so the observation side is never
shuffled by enrichment.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiocube.constants import LEVEL_NAMES, OBSOLETE_CODE
from regiocube.functions.codes import derive_country, map_labels, parent_code, split_period
from regiocube.functions.numeric import nan_to_null
from regiocube.operators.common import bounded_broadcast, is_bounded


# ---------------------------------------------------------------- ENR-1
def enrich_labels(obs: DataFrame, codelists: Mapping[str, DataFrame],
                  suffix: str = "_label_en") -> DataFrame:
    """LEFT JOIN one ``(code, label_en)`` codelist per dimension.

    Adds ``<dim>_label_en``; unmatched codes keep the row with a NULL label.
    """
    out = obs
    for dim, cl in codelists.items():
        lab = f"{dim}{suffix}"
        d = bounded_broadcast(cl.select(F.col("code").alias(f"__{dim}_code"),
                                        F.col("label_en").alias(lab)))
        out = out.join(d, out[dim] == d[f"__{dim}_code"], "left").drop(f"__{dim}_code")
    return out


def enrich_flags(obs: DataFrame, flags: DataFrame, col: str = "flag",
                 out_col: str = "flag_desc_en") -> DataFrame:
    """Flag description lookup (``flag`` -> ``flag_desc_en``)."""
    d = bounded_broadcast(flags.select(F.col("code").alias("__flag_code"),
                                       F.col("label_en").alias(out_col)))
    return obs.join(d, obs[col] == d["__flag_code"], "left").drop("__flag_code")


# ---------------------------------------------------------------- ENR-2/3
def geo_with_parent(geo: DataFrame) -> DataFrame:
    """Pre-join the hierarchy with itself once: code -> own and parent label."""
    g = geo.select("code", "label_en", "nuts_level", "parent_code")
    p = geo.select(F.col("code").alias("__p_code"), F.col("label_en").alias("parent_label_en"))
    return g.join(p, g["parent_code"] == p["__p_code"], "left").drop("__p_code")


def enrich_geo(obs: DataFrame, geo: DataFrame, with_parent: bool = True,
               geo_col: str = "geo") -> DataFrame:
    """Geo label, NUTS level, derived country and (optionally) the parent.

    ``country`` = first two characters of ``geo`` only for rows whose level is
    set; aggregates get NULL.
    """
    # Prove the bound on the hierarchy itself: the parent lookup is unique on
    # code (the hierarchy's key), so it adds no rows; the optimizer's estimate
    # of the self-join (a product of both sides) would force a counting job.
    small = is_bounded(geo)
    if with_parent:
        g = geo_with_parent(geo).select(
            F.col("code").alias("__geo_code"),
            F.col("label_en").alias("geo_label_en"),
            F.col("nuts_level"),
            F.col("parent_code").alias("nuts_parent_code"),
            F.col("parent_label_en").alias("nuts_parent_label_en"),
        )
    else:
        g = geo.select(
            F.col("code").alias("__geo_code"),
            F.col("label_en").alias("geo_label_en"),
            F.col("nuts_level"),
        )
    if small:
        g = F.broadcast(g)
    out = obs.join(g, obs[geo_col] == g["__geo_code"], "left").drop("__geo_code")
    return out.withColumn("country", derive_country(F.col(geo_col), F.col("nuts_level")))


# ---------------------------------------------------------------- ENR-4/5
def with_period_split(obs: DataFrame, period_col: str = "year") -> DataFrame:
    """Replace a ``YYYY-Qn`` period column by ``year`` INT + ``quarter``."""
    year, quarter = split_period(period_col)
    cols = [c for c in obs.columns if c != period_col]
    return obs.select(*cols, year.alias("year"), quarter.alias("quarter"))


def cast_observations(obs: DataFrame, year_col: str = "year", value_col: str = "value") -> DataFrame:
    """``year`` -> INT and ``value`` -> DOUBLE; dirty text becomes NULL
    (``try_cast``), NaN becomes NULL."""
    return (obs.withColumn(year_col, F.col(year_col).try_cast("int"))
               .withColumn(value_col, nan_to_null(F.col(value_col).try_cast("double"))))


# ---------------------------------------------------------------- ENR-6
def with_mapped_labels(obs: DataFrame, maps: Mapping[str, tuple[Mapping, str | None]]) -> DataFrame:
    """Inline label maps: ``{dim: (mapping, default)}`` -> ``<dim>_label_en``.

    ``default='code'`` keeps the code for unknown values, ``None`` leaves NULL;
    an empty mapping with ``'code'`` copies the code (label := code).
    """
    out = obs
    for dim, (mapping, default) in maps.items():
        out = out.withColumn(f"{dim}_label_en", map_labels(dim, mapping, default))
    return out


# ---------------------------------------------------------------- ENR-7
def build_geo(labels: DataFrame, annotations: DataFrame) -> DataFrame:
    """Geo hierarchy from code labels and their annotations.

    ``labels``: (code, label_en). ``annotations``: (code, type, title) with
    types LEVEL and IS_STANDARD_CODE. Obsolete codes stay with a blank level
    and parent; LEVEL 0/1/2/3 -> country/NUTS1/NUTS2/NUTS3; the parent (code
    minus its last character) is set only for NUTS levels; an unknown LEVEL
    gives a blank level. Of several annotations of one type the first listed counts: by
    ``position`` if the table has that column, else as read.
    Output: (code, label_en, nuts_level, parent_code).
    """
    listed = F.col("position") if "position" in annotations.columns else F.monotonically_increasing_id()
    placed = annotations.withColumn("__at", listed)

    def first(kind: str) -> Column:
        return F.min_by("title", F.when(F.col("type") == kind, F.col("__at")))

    ann = placed.groupBy("code").agg(first("LEVEL").alias("__level"), first("IS_STANDARD_CODE").alias("__std"))
    joined = labels.join(ann, "code", "left")
    obsolete = F.coalesce(F.col("__std") == F.lit(OBSOLETE_CODE), F.lit(False))
    level = F.coalesce(map_labels("__level", LEVEL_NAMES, None), F.lit(""))
    level = F.when(obsolete, F.lit("")).otherwise(level)
    parent = F.when(level.startswith("NUTS"), parent_code("code")).otherwise(F.lit(""))
    return joined.select("code", "label_en", level.alias("nuts_level"), parent.alias("parent_code"))


# ---------------------------------------------------------------- ENR-8/9
def drop_incomplete(obs: DataFrame, cols: Sequence[str] = ("year", "value")) -> DataFrame:
    """Reject rows whose period or value is NULL."""
    cond: Column = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return obs.filter(cond)


def analysable(clean: DataFrame) -> DataFrame:
    """Mart input: rows with a value and a real country."""
    return clean.filter(F.col("value").isNotNull() & F.col("country").isNotNull())


# ---------------------------------------------------------------- clean
def clean_observations(
    obs: DataFrame,
    dims: Sequence[str],
    geo: DataFrame,
    codelists: Mapping[str, DataFrame] | None = None,
    flags: DataFrame | None = None,
    label_maps: Mapping[str, tuple[Mapping, str | None]] | None = None,
    with_parent: bool = True,
    extra_time: Sequence[str] = (),
) -> DataFrame:
    """raw observations -> clean table.

    Column order: dims (without geo), geo, year, extra time columns,
    ``<dim>_label_en`` for every labelled dim, geo label/level/country/parent,
    value, flag, flag_desc_en.
    """
    out = enrich_labels(obs, codelists or {})
    if label_maps:
        out = with_mapped_labels(out, label_maps)
    out = enrich_geo(out, geo, with_parent=with_parent)
    if flags is not None:
        out = enrich_flags(out, flags)
    else:
        out = out.withColumn("flag_desc_en", F.lit(None).cast("string"))
    non_geo = [d for d in dims if d != "geo"]
    labelled = [d for d in [*non_geo, *extra_time]
                if (codelists and d in codelists) or (label_maps and d in label_maps)]
    geo_cols = ["geo_label_en", "nuts_level", "country"]
    if with_parent:
        geo_cols += ["nuts_parent_code", "nuts_parent_label_en"]
    cols = (non_geo + ["geo", "year", *extra_time] + [f"{d}_label_en" for d in labelled]
            + geo_cols + ["value", "flag", "flag_desc_en"])
    return out.select(*cols)
