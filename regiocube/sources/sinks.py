"""Parquet/CSV sinks for clean tables, marts and the geo dimension
(SNK-1..SNK-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiocube.operators.quality import TableMetrics


def write_clean(df: DataFrame, path: str, partition_by: Sequence[str] = ("year",),
                metrics: TableMetrics | None = None) -> None:
    """SNK-1: overwrite the clean table; partitioned by year so consumer
    filters on year prune whole folders. The rows are dealt by the partition
    columns first (a rebalance, which also splits a large year), so a folder
    gets a few files of the advised size instead of one from every task.
    ``metrics`` are counted in the same pass."""
    out = df.hint("rebalance", *partition_by) if partition_by else df
    if metrics is not None:
        out = metrics.attach(out)
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def mart_path(root: str, slug: str, vintage: str | int, name: str) -> str:
    return f"{root.rstrip('/')}/{slug}/{vintage}/{name}.parquet"


def write_mart(df: DataFrame, root: str, slug: str, vintage: str | int, name: str,
               sort_keys: Sequence[str | Column] | None = None) -> str:
    """SNK-2 (+ SNK-4): one parquet per mart and vintage, overwritten.

    With ``sort_keys`` the rows are range-partitioned and sorted (a global
    sort: distributed, no single task), which is how a published mart keeps
    its ORDER BY."""
    path = mart_path(root, slug, vintage, name)
    write_table(df, path, sort_keys)
    return path


def write_table(df: DataFrame, path: str, sort_keys: Sequence[str | Column] | None = None,
                metrics: TableMetrics | None = None) -> None:
    """One parquet table in its published order; ``metrics`` are counted in the same pass."""
    out = metrics.placed(df) if metrics is not None else df
    out = sort_for_publish(out, sort_keys) if sort_keys else out
    (metrics.attach(out) if metrics is not None else out).write.mode("overwrite").parquet(path)


def sort_for_publish(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """SNK-4: the published row order (``-name`` descends; NULLs come last
    either way). Only at publish time; inside a plan an ORDER BY has no
    meaning and costs a shuffle."""
    return df.orderBy(*[_sort_key(k) for k in keys])


def _sort_key(key: str | Column) -> Column:
    if not isinstance(key, str):
        return key
    return F.col(key[1:]).desc_nulls_last() if key.startswith("-") else F.col(key).asc_nulls_last()


def write_geo(df: DataFrame, path: str) -> None:
    """SNK-3: the geo dimension as one CSV with a header. The hierarchy holds
    a few thousand codes (a classification, not data), so a single output
    partition is bounded."""
    (df.select("code", "label_en", "nuts_level", "parent_code")
       .na.fill("", ["nuts_level", "parent_code"])
       .orderBy(F.col("code")).coalesce(1)
       .write.mode("overwrite").option("header", "true").csv(path))
