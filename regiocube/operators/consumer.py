"""Consumer query surface over clean tables and marts (QRY-1..QRY-5).

Ad-hoc SQL works as is (``df.createOrReplaceTempView`` + ``spark.sql``);
these helpers are the recurring shapes as DataFrame operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiocube.functions.numeric import round_half_away


def top_k(df: DataFrame, partition: Sequence[str], order: Sequence[Column], k: int,
          rank_col: str = "pos") -> DataFrame:
    """QRY-1: the first ``k`` rows per partition (``row_number`` with a total
    order; Spark plans a WindowGroupLimit, so each task keeps only k rows per
    partition before the sort). The limit is the feature here."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w).cast("long")).filter(F.col(rank_col) <= k)


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 10) -> DataFrame:
    """QRY-2: the first ``n`` rows in a total order (``orderBy`` + ``limit``
    plans a TakeOrderedAndProject: each task keeps its own top ``n``, the
    driver merges ``n`` rows per task; no global sort). The limit is the
    feature here."""
    return df.orderBy(*order).limit(n)


def count_by(df: DataFrame, col: str, out: str = "n_rows") -> DataFrame:
    """QRY-3: row count per value of ``col``."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def group_gap(df: DataFrame, keys: Sequence[str], dim: str, a: str, b: str, digits: int = 2,
              names: Sequence[str] = ("avg_a", "avg_b", "gap")) -> DataFrame:
    """QRY-4: conditional averages of two groups and their gap per key
    (e.g. female vs male rates)."""
    g = df.filter(F.col("value").isNotNull()).groupBy(*keys).agg(
        F.avg(F.when(F.col(dim) == F.lit(a), F.col("value"))).alias("__a"),
        F.avg(F.when(F.col(dim) == F.lit(b), F.col("value"))).alias("__b"))
    return g.select(*keys, round_half_away("__a", digits).alias(names[0]),
                    round_half_away("__b", digits).alias(names[1]),
                    round_half_away(F.col("__a") - F.col("__b"), digits).alias(names[2]))


def sign_counts(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """QRY-4: growing vs declining vs flat series per key."""
    return df.groupBy(*keys).agg(
        F.count_if(F.col(col) > 0).alias("n_growth"),
        F.count_if(F.col(col) < 0).alias("n_decline"),
        F.count_if(F.col(col) == 0).alias("n_flat"))


def compare_marts(a: DataFrame, b: DataFrame, keys: Sequence[str], col_a: str, col_b: str,
                  flag: str = "a_lt_b") -> DataFrame:
    """QRY-5: join two marts on their common grain and flag ``a < b``."""
    j = a.select(*keys, col_a).join(b.select(*keys, col_b), list(keys), "inner")
    return j.withColumn(flag, F.col(col_a) < F.col(col_b))
