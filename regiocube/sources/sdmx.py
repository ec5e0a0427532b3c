"""Wide SDMX TSV -> long observations (SRC-1, SRC-2).

File format (one file per dataflow)::

    freq,unit,geo\\TIME_PERIOD<TAB>2000 <TAB>2001 <TAB>...
    A,EUR_HAB,AL<TAB>: <TAB>3100 <TAB>12.5 b<TAB>...

The header row names the comma-joined key dims, a backslash, the time
dimension, then one column per period (with a trailing space). Cells hold
the value and optional flag letters; ``:`` marks a missing value.

The header lines are read by one job; files with the same header
are read together, every data row as strings; the melt is ``DataFrame.unpivot`` (an Expand: narrow, no shuffle),
so ingest scales with the number of input splits. Uncompressed TSV is
splittable; gzip files are one task each.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocube.constants import MISSING_CELL
from regiocube.functions.codes import slice_predicate
from regiocube.functions.numeric import nan_to_null
from regiocube.sources.files import data_files, files_by_header
from regiocube.sources.readers import text_options

_QUARTER = re.compile(r"^\d{4}-Q[1-4]$")
_MONTH = re.compile(r"^\d{4}-(0[1-9]|1[0-2])$")
_YEAR = re.compile(r"^\d{4}$")
#: Observation flags are runs of these letters after the value.
_FLAG_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def parse_header(first_col: str) -> tuple[list[str], str]:
    """``'freq,unit,geo\\TIME_PERIOD'`` -> (['freq', 'unit', 'geo'], 'TIME_PERIOD')."""
    keys, _, time_dim = first_col.partition("\\")
    return [k.strip() for k in keys.split(",")], time_dim.strip()


def period_kind(periods: list[str]) -> str:
    """'year', 'quarter' or 'month' from the header's period labels."""
    if all(_YEAR.match(p) for p in periods):
        return "year"
    if all(_QUARTER.match(p) for p in periods):
        return "quarter"
    if all(_MONTH.match(p) for p in periods):
        return "month"
    return "mixed"


def melt_wide(wide: DataFrame) -> DataFrame:
    """Wide SDMX frame (as read from the TSV) -> long observations.

    Output: key dims (string), ``year`` INT, ``quarter`` STRING (when the
    header has ``YYYY-Qn`` periods) or ``month`` INT (``YYYY-MM``), ``period``
    STRING (only for mixed headers), ``value`` DOUBLE (``:`` and
    non-numbers -> NULL, NaN -> NULL) and ``flag`` STRING (trailing letters,
    NULL when absent).
    """
    key_col = wide.columns[0]
    dims, _ = parse_header(key_col)
    period_cols = wide.columns[1:]
    periods = [p.strip() for p in period_cols]
    kind = period_kind(periods)
    # Rename period columns to their trimmed labels; the key column to a
    # plain name (its header contains commas and a backslash).
    renamed = wide.select(F.col(f"`{key_col}`").alias("__key"),
                          *[F.col(f"`{c}`").alias(p) for c, p in zip(period_cols, periods)])
    long = renamed.unpivot("__key", periods, "__period", "__cell")
    parts = F.split(F.col("__key"), ",")
    cell = F.trim(F.col("__cell"))
    # value token, then optional lowercase flag letters ("12.5 b", "12b", ": c"):
    # the letters are trimmed off once, what is left and what went are the two.
    bare = F.rtrim(cell, F.lit(_FLAG_LETTERS))
    token = F.rtrim(bare)
    flag = F.substring(cell, F.length(bare) + 1, F.length(cell))
    value = F.when(token == F.lit(MISSING_CELL), F.lit(None).cast("double")).otherwise(
        nan_to_null(token.try_cast("double")))
    cols = [F.trim(parts.getItem(i)).alias(d) for i, d in enumerate(dims)]
    per = F.col("__period")
    if kind == "year":
        cols.append(per.cast("int").alias("year"))
    elif kind == "quarter":
        cols += [F.split_part(per, F.lit("-"), F.lit(1)).cast("int").alias("year"),
                 F.split_part(per, F.lit("-"), F.lit(2)).alias("quarter")]
    elif kind == "month":
        cols += [F.split_part(per, F.lit("-"), F.lit(1)).cast("int").alias("year"),
                 F.split_part(per, F.lit("-"), F.lit(2)).cast("int").alias("month")]
    else:
        cols += [per.alias("period"),
                 F.split_part(per, F.lit("-"), F.lit(1)).try_cast("int").alias("year")]
    cols += [value.alias("value"), F.nullif(flag, F.lit("")).alias("flag")]
    return long.select(*cols)


def read_sdmx_tsv(spark: SparkSession, path: str, source_filter: Mapping[str, object] | None = None,
                  options: Mapping[str, str] | None = None) -> DataFrame:
    """Read one wide SDMX TSV, or a folder of them, as long observations.

    Files of a folder may cover different periods: each distinct header is
    read with its own columns and the observations are united by name (a
    column that a file lacks is NULL). The headers are read by one job.
    ``source_filter`` keeps only the given dim values (SRC-2), applied right after
    the melt so nothing else is carried. ``options`` are a declared delimiter (tab
    by default) and an encoding that extends ASCII."""
    files = data_files(spark, path)
    by_header = files_by_header(spark, files) if files else {}
    if not by_header:
        raise FileNotFoundError(f"no SDMX TSV with a header under {path}")
    obs = None
    for header in sorted(by_header):
        wide = (spark.read.option("sep", "\t").option("header", "true").option("inferSchema", "false")
                .option("mode", "PERMISSIVE").options(**text_options(options)).csv(by_header[header]))
        part = melt_wide(wide)
        obs = part if obs is None else obs.unionByName(part, allowMissingColumns=True)
    if source_filter:
        obs = obs.filter(slice_predicate(source_filter))
    return obs


def wide_layout(obs: DataFrame) -> DataFrame:
    """Long annual observations laid out as a wide SDMX table (the inverse of
    the melt): key column ``freq,unit,cat,geo\\TIME_PERIOD``, one text column
    per year (trailing space in the header), cells ``value flag`` or ``:``.
    The year columns come from the data (one distinct job)."""
    whole = F.col("value") == F.floor(F.col("value"))
    num = F.when(whole, F.col("value").cast("long").cast("string")).otherwise(F.col("value").cast("string"))
    text = F.concat(F.coalesce(num, F.lit(":")), F.lit(" "), F.coalesce(F.col("flag"), F.lit("")))
    key = F.concat_ws(",", "freq", "unit", "cat", "geo").alias("__key")
    wide = obs.groupBy(key).pivot("year").agg(F.max(text))
    years = [c for c in wide.columns if c != "__key"]
    return wide.select(F.col("__key").alias("freq,unit,cat,geo\\TIME_PERIOD"),
                       *[F.coalesce(F.col(y), F.lit(": ")).alias(f"{y} ") for y in years])


def write_sdmx_tsv(wide: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Land a wide layout as tab-separated text, one header line per part
    file (``read_sdmx_tsv`` reads the folder back; ``append`` adds files)."""
    (wide.write.mode(mode).option("sep", "\t").option("header", "true")
     .option("quoteAll", "false").option("escape", "\u0000").csv(path))


def filter_slice(obs: DataFrame, keep: Mapping[str, object]) -> DataFrame:
    """SRC-2: keep only the given dim values before landing."""
    return obs.filter(slice_predicate(keep))
