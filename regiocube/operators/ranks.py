"""Exact rank() over groups of any size: value ranges with prefix counts.

A window over a whole group puts the group into one task. Here a group's different
values are counted first (map-side combined, so a value that a third of all rows
share is one row), and dealt to ranges of the value, whose limits are a sample of that group's
values. A range's values are ordered in a window of their own; what lies before a
range is a prefix sum over the ranges' counts. The rank of a value is the
prefix, plus the rows before it in its range, plus one: ties share it, exactly as
``rank()`` gives it. The sample only balances the work: any monotone
assignment of values to ranges yields the same ranks. It is drawn by a hash of the
value, so it depends on the set of values alone: the two places that use it, and
a task that is run again, find the same limits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A group has about STEP * STEP ranges at most, looked up in two steps.
STEP = 32
#: Different values up to which a group is one range.
RANGE_ROWS = 100_000


def _range_of(value: Column, knots: Column) -> Column:
    """A number that grows with how many of a group's sorted knots lie below ``value``, found in two steps."""
    steps = F.floor(F.size(knots) / STEP).cast("int")
    coarse = F.when(steps > 0, F.transform(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), lambda j: F.element_at(knots, j * STEP)))
    above = F.coalesce(F.size(F.filter(coarse, lambda k: k < value)), F.lit(0))
    fine = F.slice(knots, above * STEP + 1, F.lit(STEP - 1))
    return above * STEP + F.size(F.filter(fine, lambda k: k < value))


def value_ranks(rows: DataFrame, partition: Sequence[str], value: str = "value", descending: bool = False,
                range_rows: int | None = None) -> DataFrame:
    """(partition..., value, rank, n): the rank of each different value in its group, and the group's rows.

    ``rank`` is ``rank() OVER (PARTITION BY partition ORDER BY value [DESC] NULLS LAST)``. NULLs are a
    value of their own (last either way), NaN is above all numbers, and NULLs in partition columns make a
    group, all as in a window. ``range_rows`` are the different values up to which a group is one range.
    """
    part, most = list(partition), range_rows or RANGE_ROWS
    counted = rows.groupBy(*part, value).agg(F.count(F.lit(1)).alias("__rows"))
    groups = counted.groupBy(*[F.col(c).alias(f"__g_{c}") for c in part]).agg(
        F.count(F.lit(1)).alias("__values"), F.sum("__rows").alias("n"))
    sized = counted.join(groups, same(counted, groups, part, "__g_")).drop(*[f"__g_{c}" for c in part])
    # About STEP * STEP values of a group, fewer where its ranges would be small.
    ranges = F.least(F.lit(STEP * STEP), F.ceil(F.col("__values") / most))
    drawn = F.pmod(F.xxhash64(value), F.ceil(F.col("__values") / ranges)) == 0
    knots = (sized.filter((F.col("__values") > most) & F.col(value).isNotNull() & drawn)
             .groupBy(*[F.col(c).alias(f"__k_{c}") for c in part]).agg(F.sort_array(F.collect_list(value)).alias("__knots")))
    null_last = -1 if descending else 1 << 30
    span = (F.when(F.col(value).isNull(), null_last).when(F.col("__knots").isNull(), 0)
            .otherwise(_range_of(F.col(value), F.col("__knots"))).cast("int"))
    dealt = sized.join(knots, same(sized, knots, part, "__k_"), "left").select(*part, value, "__rows", "n", span.alias("__range"))
    # One row per range: about STEP * STEP in a group.
    spans = (dealt.groupBy(*[F.col(c).alias(f"__r_{c}") for c in (*part, "__range")]).agg(F.sum("__rows").alias("__held"))
             .withColumn("__before", F.sum("__held").over(
                 Window.partitionBy(*[f"__r_{c}" for c in part])
                 .orderBy(F.col("__r___range").desc() if descending else F.col("__r___range").asc())
                 .rowsBetween(Window.unboundedPreceding, -1))))
    by_value = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    inside = Window.partitionBy(*part, "__range").orderBy(by_value).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("__inside", F.coalesce(F.sum("__rows").over(inside), F.lit(0)))
    return placed.join(spans, same(placed, spans, [*part, "__range"], "__r_"), "left").select(
        *part, value, (F.coalesce("__before", F.lit(0)) + F.col("__inside") + 1).cast("long").alias("rank"), "n")


def same(left: DataFrame, right: DataFrame, columns: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of ``columns`` with the prefixed columns of ``right``."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"{prefix}{c}"]) for c in columns])


def with_ranks(rows: DataFrame, partition: Sequence[str], value: str, rank: str, n: str | None = None,
               descending: bool = False, where: Column | None = None, range_rows: int | None = None) -> DataFrame:
    """``rows`` with the rank of their value among the rows of ``where`` (all by default) in their group.

    A row outside ``where`` gets NULL. The join's other side holds one row per different
    value, so a frequent value only repeats on the row side, which AQE splits.
    """
    keys = [*partition, value]
    flag = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    marked = rows.withColumn("__in", flag)
    ranks = value_ranks(marked.filter("__in").select(*keys), partition, value, descending, range_rows).select(
        *[F.col(c).alias(f"__v_{c}") for c in keys], F.col("rank").alias(rank), F.col("n").alias(n or "__n"))
    joined = marked.join(ranks, same(marked, ranks, keys, "__v_") & marked["__in"], "left")
    return joined.drop("__in", *[f"__v_{c}" for c in keys], *([] if n else ["__n"]))
