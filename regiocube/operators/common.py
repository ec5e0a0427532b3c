"""Join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Codelists and geo hierarchies hold a few thousand codes at most; anything
# above this is not a dimension table and must not be broadcast.
DIMENSION_ROW_BOUND = 200_000
# Plan-statistics bound (bytes) under which no counting job is needed.
DIMENSION_BYTE_BOUND = 8 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` (the figure Spark itself uses
    for auto-broadcast): exact for local relations, file size for scans,
    an upper bound through filters/projections. None if unavailable."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # noqa: BLE001 - statistics are best effort
        return None


def is_bounded(df: DataFrame, max_rows: int = DIMENSION_ROW_BOUND,
               max_bytes: int = DIMENSION_BYTE_BOUND) -> bool:
    """Whether ``df`` is proven small: first from the plan statistics (no
    job); when they are missing or large, from ``limit(max_rows + 1).count()``."""
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return True
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DIMENSION_ROW_BOUND,
                      max_bytes: int = DIMENSION_BYTE_BOUND) -> DataFrame:
    """Broadcast-hint ``df`` only when its size is proven small.

    Above the bound the hint is dropped and Spark plans a shuffle join (AQE
    may still convert it at run time from measured sizes).
    """
    return F.broadcast(df) if is_bounded(df, max_rows, max_bytes) else df


def literal_frame(spark: SparkSession, rows: Sequence[Sequence], names: Sequence[str],
                  types: Sequence[str] | None = None) -> DataFrame:
    """A small table of fixed values (codelists, label maps) as one literal
    array. Unlike ``createDataFrame`` over a Python list (an RDD scan of
    unknown size), the optimizer knows its exact size, so broadcasting it
    needs no counting job."""
    types = list(types or ["string"] * len(names))
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(r, names, types)])
               for r in rows]
    row_type = ", ".join(f"{n}: {t}" for n, t in zip(names, types))
    arr = F.array(*structs) if structs else F.array().cast(f"array<struct<{row_type}>>")
    return spark.range(1).select(F.inline(arr))


def left_lookup(df: DataFrame, dim: DataFrame, on_left: str, key: str,
                cols: dict[str, str]) -> DataFrame:
    """LEFT JOIN ``dim`` on ``df[on_left] = dim[key]`` adding ``cols``.

    ``cols`` maps dimension column -> output column name. Unmatched rows keep
    NULLs. ``dim`` must be unique on ``key`` (see ``quality.check_key``), or
    the join fans out.
    """
    sel = [F.col(key).alias("__k")] + [F.col(src).alias(dst) for src, dst in cols.items()]
    d = dim.select(*sel)
    out = df.join(d, df[on_left] == d["__k"], "left")
    return out.drop("__k")
