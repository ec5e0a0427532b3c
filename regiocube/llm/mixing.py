"""Mixing sources to target weights by Pareto order sampling.

Targets are a water level over the sources (a source's share by weight, at most
``max_copies`` times its size). Each document of a source gets the whole part
of target / size as certain copies. The rest of the target goes to a sample with
unequal inclusion probabilities: a document's is in proportion to its weight (the
whole part of the square root of its size), such that the expected words are the
rest; documents that would pass 1 are certain and the others share what they leave.
The others are ranked by the odds of a uniform random number divided by their
inclusion odds and taken from the front. The sample's size is fixed in words: the cut
lies where their sum is nearest to the rest. Long documents come up early, so it
falls among short ones and the sum lands close to the target.

The ranking is a distributed prefix sum: ranks fall into buckets of a few
thousand rows, buckets are summed per source, and rows are ordered only
within their bucket. A source with a third of all rows has a third of the
buckets; no task sorts a source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiocube.llm.common import n_words, stored

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
SEED = 7
#: Rows of a source that one bucket of the ranking holds, about.
BUCKET_ROWS = 4096


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, source_rows, target) from (source, size); one row per source.

    Sources by code point, null last, take the weights in turn. The sources
    share the sum of all sizes by weight; a source that would get more than
    ``max_copies`` times its size gets that, and the others share the excess
    likewise: a common level per weight, found by one ordered pass over
    the sources (a row per source; the only unpartitioned window).
    """
    return _water_level(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows")),
                        weights, max_copies)


def _water_level(by_source: DataFrame, weights: Sequence[int], max_copies: int) -> DataFrame:
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = (by_source
               .withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int")).cast("long"))
               .withColumn("most", F.col("source_size") * max_copies)
               .withColumn("total", F.sum("source_size").over(everything)))
    # By the level at which a source is full: what is left for it and those after it.
    full = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    onward = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(onward))
    leveled = weighed.withColumn("level", level)
    open_level = F.when(F.col("most") / F.col("weight") > F.col("level"), F.col("level"))
    return (leveled.withColumn("common", F.max(open_level).over(everything))
            .select("source", "source_size", "source_rows",
                    F.least(F.col("most").cast("double"),
                            F.coalesce(F.col("common") * F.col("weight"), F.col("most").cast("double"))).alias("target")))


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) drawn from the MD5 of seed and key: the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def _inclusion(shapes: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with each source's certain copies, the rest, and what its inclusion probabilities need.

    ``shapes`` (source, weight, words): a source has fewer weights than the cube root of three times its
    words, so a window holds few rows. Weights above ``least_certain`` are certain to be in the sample and hold
    ``sure`` words; the others have ``weighed`` words times weight. All sums are of integers, hence exact.
    """
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    rests = (targets.withColumnRenamed("source", "of").withColumn("certain", F.floor(ratio))
             .withColumn("rest", F.col("target") - F.col("certain") * F.col("source_size")))
    down = Window.partitionBy("source").orderBy(F.col("weight").desc())
    heavier = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum(F.col("words") * F.col("weight")).over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    sums = (shapes.withColumn("heavier", heavier).withColumn("onward", onward)
            .join(rests, F.col("source").eqNullSafe(F.col("of"))))
    # The heaviest weight whose probability stays below 1 when all heavier ones are certain.
    open_ = F.when((F.col("rest") - F.col("heavier")) * F.col("weight") < F.col("onward"), F.struct("weight", "heavier", "onward"))
    top = sums.groupBy("of").agg(F.max(open_).alias("top")).withColumnRenamed("of", "for")
    return (rests.join(top, F.col("of").eqNullSafe(F.col("for"))).drop("for")
            .select("*", F.col("top.weight").alias("least_certain"), F.col("top.heavier").alias("sure"),
                    F.col("top.onward").alias("weighed")).drop("top"))


def allocate(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` as struct ``row``, with doc_id, source, size, source_size, target, copies and chance.

    ``copies`` is how often the mix takes the whole document (0 to ``max_copies``); ``chance`` is the
    inclusion probability in the sample beside the certain copies (0 where a source has no rest).

    - null or empty text: size 0; it takes no share of any target;
    - null source: a source of its own, the last one;
    - null doc_ids and rows that repeat a doc_id: drawn by id and text, so different texts draw
      different numbers; rows equal in both draw the same one, and any of them may be the one taken;
    - a source without words: target 0, no copies;
    - empty table: empty result; clashing column names stay inside ``row``.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       n_words(text).alias("size"), F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("digest"))
    rows = rows.withColumn("weight", F.greatest(F.lit(1), F.floor(F.sqrt(F.col("size").cast("double")))).cast("long"))
    shapes = stored(rows.groupBy("source", "weight").agg(F.sum("size").alias("words"), F.count("*").alias("rows")), "mix-shapes")
    by_source = shapes.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("rows").alias("source_rows"))
    sources = stored(_inclusion(shapes, _water_level(by_source, weights, max_copies)), "mix-sources")
    u = F.col("u")
    chance = F.when(F.col("rest") <= 0, 0.0).when(F.col("weight") > F.coalesce("least_certain", F.lit(0)), 1.0).otherwise(
        F.least(F.lit(1.0), (F.col("rest") - F.col("sure")) * F.col("weight") / F.col("weighed")))
    # Documents that are certain come first, in the order of their draws; nothing has to tell them apart.
    odds = F.when(F.col("chance") >= 1, u - 1).otherwise(F.coalesce(
        F.try_divide(u * (1 - F.col("chance")), (1 - u) * F.col("chance")), u / (1 - u)))
    # Scaled by the source's own odds, ranks are spread about evenly.
    mean = F.coalesce(F.try_divide(F.col("rest"), F.col("source_size") - F.col("rest")), F.lit(0.0))
    scaled = F.col("odds") * F.when(mean > 0, mean).otherwise(1.0)
    place = F.when(F.col("odds") < 0, F.col("odds")).otherwise(scaled / (1 + scaled))
    drawn = (rows.join(sources, F.col("source").eqNullSafe(F.col("of")))
             .withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
             .withColumn("u", uniform(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest"), seed))
             .withColumn("chance", chance)
             .withColumn("odds", odds)
             .withColumn("buckets", F.ceil(F.col("source_rows") / BUCKET_ROWS))
             .withColumn("bucket", F.floor(place * F.col("buckets"))))
    held = drawn.groupBy("key", "bucket").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = held.select("key", "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    # The join follows the window and shares its keys: the rows move once.
    inside = (Window.partitionBy("key", "bucket").orderBy("odds", F.col("doc_id").asc_nulls_last(), "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (drawn.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(base, ["key", "bucket"])
            .withColumn("ahead", F.col("base") + F.col("inside"))
            .withColumn("extra", ((F.col("ahead") * 2 + F.col("size") <= F.col("rest") * 2) & (F.col("rest") > 0)).cast("long"))
            .select("row", "doc_id", "source", "size", "source_size", "target",
                    (F.col("certain").cast("long") + F.col("extra")).alias("copies"), "chance"))


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (see ``allocate``)."""
    taken = allocate(docs, weights, max_copies, seed).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
