"""Top lists of long slots from short lists of the slots inside them.

A partial list holds the `counters` most frequent topics of a fine slot and place, and `missed`, the greatest
count that did not get on it (0: nothing is missing).  Lists of many fine slots add up: a
topic has at least the sum of its counters, and at most that and `missed` of every
slot whose list does not have it.  These bounds prove most top lists of hours and days without
the counts of all topics, of which there may be a thousand times as many.  What they do not
prove is counted: the topics that may still be among the first k, or, where a topic on no list may be, all topics of that slot and place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicflow.functions import slots
from topicflow.operators import ranking
from topicflow.schema import GRAIN_SLOT, LEVEL_KEYS, TOP_K

FINER = {"day": "hour", "hour": "minute"}
COUNTERS = 3 * TOP_K


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """On keys that may be null; those of the right side go."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def coarser_slot(grain: str) -> Column:
    """The slot of this grain that a finer slot lies in."""
    fine = F.col(GRAIN_SLOT[FINER[grain]])
    return (slots.day_of_hour(fine) if grain == "day" else F.floor(fine / 100).cast("int")).alias(GRAIN_SLOT[grain])


def partial_lists(counts: DataFrame, level: str, grain: str, counters: int = COUNTERS) -> DataFrame:
    """Of counts by fine slot, place and topic: the rows on each list, with the list's `missed`.

    One list more than `counters` is cut early in each task, so a hot slot or place never meets in one.
    """
    keys = [GRAIN_SLOT[FINER[grain]], *LEVEL_KEYS[level]]
    kept = ranking.top_per(counts, keys, counters + 1)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranking.ranking()))
    missed = F.max(F.when(F.col("_rank") > counters, F.col("count")).otherwise(0)).over(Window.partitionBy(*keys))
    return kept.withColumn("_rank", rank).withColumn("missed", missed).where(F.col("_rank") <= counters).drop("_rank")


def bounds(lists: DataFrame, level: str, grain: str) -> DataFrame:
    """slot, place, topic, low, high: what the lists tell of each topic; `unseen` is the bound of topics on no list."""
    place = LEVEL_KEYS[level]
    keys = [GRAIN_SLOT[grain], *place]
    rows = lists.withColumn(GRAIN_SLOT[grain], coarser_slot(grain))
    # One row per list, then one per slot and place.
    unseen = rows.groupBy(*keys, GRAIN_SLOT[FINER[grain]]).agg(F.max("missed").alias("missed")).groupBy(*keys).agg(F.sum("missed").alias("unseen"))
    found = rows.groupBy(*keys, "topic").agg(F.sum("count").alias("low"), F.sum("missed").alias("_there"))
    return _join(found, unseen, keys).select(*keys, "topic", "low", (F.col("low") + F.col("unseen") - F.col("_there")).alias("high"), "unseen")


def candidates(known: DataFrame, level: str, grain: str, k: int = TOP_K) -> DataFrame:
    """The topics that may be among the first k of their slot and place, each with what is known:

    `open`, whether a topic on no list may be; `exact`, whether the topic's count is known.
    """
    keys = [GRAIN_SLOT[grain], *LEVEL_KEYS[level]]
    first = ranking.top_per(known.withColumnRenamed("low", "count"), keys, k)
    bar = first.groupBy(*keys).agg(F.when(F.count(F.lit(1)) == k, F.min("count")).otherwise(0).alias("bar"))
    return _join(known, bar, keys).where(F.col("high") >= F.col("bar")).select(
        *keys, "topic", F.col("low").alias("count"), (F.col("low") == F.col("high")).alias("exact"),
        ((F.col("unseen") > 0) & (F.col("unseen") >= F.col("bar"))).alias("open"))


def top_from_lists(lists: DataFrame, counts: DataFrame, level: str, grain: str, k: int = TOP_K) -> DataFrame:
    """The exact top lists of a grain.  `counts`, the finer counts by topic, are read only where the lists do not decide."""
    slot, place = GRAIN_SLOT[grain], LEVEL_KEYS[level]
    keys = [slot, *place]
    may_be = candidates(bounds(lists, level, grain), level, grain, k)
    coarse = counts.withColumn(slot, coarser_slot(grain))

    def recounted(wanted: DataFrame, by: list[str]) -> DataFrame:
        return _join(coarse, wanted, by, "left_semi").groupBy(*keys, "topic").agg(F.sum("count").alias("count"))

    decided = may_be.where(~F.col("open") & F.col("exact")).select(*keys, "topic", "count")
    some = recounted(may_be.where(~F.col("open") & ~F.col("exact")).select(*keys, "topic"), [*keys, "topic"])
    whole = recounted(may_be.where("open").select(*keys).distinct(), keys)
    return ranking.top_per(decided.unionByName(some).unionByName(whole), keys, k)
