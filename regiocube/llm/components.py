"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocube.llm.common import dropped, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst: long, not null).

    The component is the smallest node of the connected set. Large-star and
    small-star steps alternate until the edge table stays as it was; then every
    node points straight at its smallest member. The number of rounds grows with the
    logarithm of the longest chain. Each round is two aggregations with
    map-side combine and two joins on the node; its result is a written table,
    so a lost executor repeats one round at most.
    """
    pairs = (edges.where("src <> dst")
             .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    now = stored(pairs, "star")
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == seen or state["n"] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select("v", "v").distinct())
        seen = (state["n"], state["h"])
        after = stored(_small_star(_large_star(now)), "star")
        dropped(now)
        now = after


def _large_star(e: DataFrame) -> DataFrame:
    """Each node points its larger neighbours at its smallest neighbour (or itself)."""
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Each node points its smaller neighbours and itself at the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
