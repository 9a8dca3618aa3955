"""Topic occurrences and their counts by time slot and place."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.functions import slots
from topicflow.operators.parse import OK
from topicflow.schema import GRAIN_SLOT, LEVEL_KEYS, LEVELS


def with_topics(messages: DataFrame) -> DataFrame:
    return messages.where(F.size("tags") > 0)


def explode_topics(messages: DataFrame, *extra: str) -> DataFrame:
    """One row per topic occurrence: a tag used twice in a message counts twice."""
    kept = ["time_ms", *GRAIN_SLOT.values(), "country", "city", *extra]
    return with_topics(messages).select(*kept, F.explode("tags").alias("topic"))


def complete_occurrences(occurrences: DataFrame) -> DataFrame:
    """Occurrences without a null in the fields the counters need."""
    return occurrences.dropna(subset=["time_ms", "country", "city", "topic"])


def _counted(frame: DataFrame, keys: Iterable[str], counter: Column) -> DataFrame:
    return frame.groupBy(*keys).agg(counter.alias("count"))


def trend_keys(level: str, grain: str) -> list[str]:
    return [GRAIN_SLOT[grain], *LEVEL_KEYS[level], "topic"]


def trend_counts(occurrences: DataFrame, level: str, grain: str) -> DataFrame:
    """Occurrences per slot, place of the level, and topic.

    Counting combines inside each task first, so a topic or place that holds a
    large share of the rows still sends one row per task through the shuffle.
    """
    return _counted(occurrences, trend_keys(level, grain), F.count(F.lit(1)))


def coarser_counts(counts: DataFrame, level: str, grain: str) -> DataFrame:
    """Counts of a coarser level from those of a finer one: counts add up."""
    return _counted(counts, trend_keys(level, grain), F.sum("count"))


def hours_to_days(hour_counts: DataFrame, level: str) -> DataFrame:
    """Day counts from hour counts of the same level."""
    return _counted(
        hour_counts.withColumn("dayslot", slots.day_of_hour(F.col("hourslot"))),
        trend_keys(level, "day"), F.sum("count"))


def trend_counts_all_levels(occurrences: DataFrame, grain: str) -> DataFrame:
    """All three levels with one aggregation over grouping sets.

    The occurrences are counted at city level first; the grouping sets then expand
    those counts, not the raw occurrences.
    """
    slot = GRAIN_SLOT[grain]
    c = {name: F.col(name) for name in (slot, "country", "city", "topic")}
    city_counts = trend_counts(occurrences, "city", grain)
    sets = [[c[slot], *[c[k] for k in LEVEL_KEYS[level]], c["topic"]] for level in LEVELS]
    return city_counts.groupingSets(sets, *c.values()).agg(
        F.when(F.grouping("country") == 1, "world").when(F.grouping("city") == 1, "country")
        .otherwise("city").alias("level"),
        F.sum("count").alias("count"),
    ).select("level", *c, "count")


def bucket_counts(occurrences: DataFrame, minutes: int, level: str = "world", zone: str = slots.UTC) -> DataFrame:
    """Counts per bucket of `minutes` inside the hour."""
    bucket = slots.bucket_slot(F.col("time_ms"), minutes, zone).alias("minuteslot")
    keyed = occurrences.select(bucket, *LEVEL_KEYS[level], "topic")
    return _counted(keyed, trend_keys(level, "minute"), F.count(F.lit(1)))


def topics_per_key(trends: DataFrame, level: str, grain: str) -> DataFrame:
    """How many topics each slot and place has; a trend table has one row per topic."""
    return _counted(trends, [GRAIN_SLOT[grain], *LEVEL_KEYS[level]], F.count(F.lit(1)))


def base_counts(parsed: DataFrame, grain: str, landing: str, zone: str = slots.UTC) -> DataFrame:
    """Everything a batch run needs from its lines, in one parse and one shuffle.

    Rows are counted by (slot, country, city, topic).  `count` holds the occurrences
    of the topic; `lines` and `tagged` hold the lines and tagged messages whose first
    topic it is.  A line without topics, refused or not, counts under a null topic
    in the slot of its event time or, lacking that, the one it landed in.  Rows with
    a topic are the city trends; coarser trends, top lists and the slot summary
    follow without touching the lines again.
    """
    slot = GRAIN_SLOT[grain]
    ok = F.col("verdict") == OK
    rows = parsed.select(
        F.when(ok, slots.slot(F.col("time_ms"), grain, zone)).otherwise(F.col(landing)).alias(slot),
        F.when(ok, F.col("country")).alias("country"),
        F.when(ok, F.col("city")).alias("city"),
        F.posexplode_outer(F.when(ok, F.col("tags"))).alias("_position", "topic"),
    )
    first = F.coalesce(F.col("_position") == 0, F.lit(True))
    return rows.groupBy(slot, "country", "city", "topic").agg(
        F.count("topic").alias("count"),
        F.count_if(first).alias("lines"),
        F.count_if(F.col("_position") == 0).alias("tagged"),
    )
