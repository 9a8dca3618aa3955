"""Slot summaries: lines, tagged messages and topics per slot, as long rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.functions import slots
from topicflow.operators.topics import base_counts
from topicflow.schema import GRAIN_SLOT

COUNT_TYPES = ("total", "tagged", "trends")


def _long(wide: DataFrame, slot: str) -> DataFrame:
    pairs = ", ".join(f"'{t}', {t}" for t in COUNT_TYPES)
    return wide.selectExpr(slot, f"stack({len(COUNT_TYPES)}, {pairs}) as (count_type, count)")


def summary_of_base(base: DataFrame, grain: str) -> DataFrame:
    """The summary from base counts.  Topics are first reduced to one row per slot
    and topic, which makes the topic count exact and keeps a hot slot spread out."""
    slot = GRAIN_SLOT[grain]
    per_topic = base.groupBy(slot, "topic").agg(F.sum("lines").alias("lines"), F.sum("tagged").alias("tagged"))
    wide = per_topic.groupBy(slot).agg(
        F.sum("lines").alias("total"), F.sum("tagged").alias("tagged"), F.count("topic").alias("trends"))
    return _long(wide, slot)


def topic_sketches(base: DataFrame, grain: str) -> DataFrame:
    """A mergeable sketch of each slot's distinct topics, of fixed size (12 bits, about 1.6 % error)."""
    slot = GRAIN_SLOT[grain]
    return base.where(F.col("topic").isNotNull()).groupBy(slot).agg(F.hll_sketch_agg("topic").alias("topics"))


def day_summary(hour_summary: DataFrame, day_trends: DataFrame) -> DataFrame:
    """Day summaries without the lines: totals add up over hours, and a day's world trends have one row per topic."""
    sums = hour_summary.where(F.col("count_type") != "trends").groupBy(
        slots.day_of_hour(F.col("hourslot")).alias("dayslot"), "count_type").agg(F.sum("count").alias("count"))
    topics = day_trends.groupBy("dayslot").agg(F.count(F.lit(1)).alias("topics"))
    trends = sums.where(F.col("count_type") == "total").join(topics, "dayslot", "left").select(
        "dayslot", F.lit("trends").alias("count_type"), F.coalesce("topics", F.lit(0)).alias("count"))
    return sums.unionByName(trends)


def early_summary(hour_summary: DataFrame, hour_sketches: DataFrame) -> DataFrame:
    """Day summaries so far, of the hours there are; the number of topics is an estimate."""
    day = slots.day_of_hour(F.col("hourslot")).alias("dayslot")
    sums = hour_summary.where(F.col("count_type") != "trends").groupBy(day, "count_type").agg(F.sum("count").alias("count"))
    merged = hour_sketches.groupBy(day).agg(F.hll_sketch_estimate(F.hll_union_agg("topics")).alias("topics"))
    return sums.unionByName(merged.select("dayslot", F.lit("trends").alias("count_type"), F.col("topics").cast("long").alias("count")))


def slot_summary(parsed: DataFrame, grain: str, landing: str, zone: str = slots.UTC) -> DataFrame:
    return summary_of_base(base_counts(parsed, grain, landing, zone), grain)


def total_lines(lines: DataFrame, landing: str) -> DataFrame:
    """Every line of a landing slot, refused ones too."""
    return lines.groupBy(landing).agg(F.count(F.lit(1)).alias("count"))


def tagged_messages(messages: DataFrame, grain: str) -> DataFrame:
    return messages.groupBy(GRAIN_SLOT[grain]).agg(F.count_if(F.size("tags") > 0).alias("count"))


def distinct_topics(occurrences: DataFrame, grain: str) -> DataFrame:
    slot = GRAIN_SLOT[grain]
    return occurrences.select(slot, "topic").distinct().groupBy(slot).agg(F.count(F.lit(1)).alias("count"))


def summary_series(summary: DataFrame, grain: str) -> DataFrame:
    """Long rows to one row per slot with its label; a missing type stays null."""
    slot = GRAIN_SLOT[grain]
    wide = summary.groupBy(slot).pivot("count_type", list(COUNT_TYPES)).agg(F.first("count"))
    return wide.withColumn("label", slots.slot_label(F.col(slot), grain)).orderBy(slot)


def slot_totals(summary: DataFrame, grain: str) -> DataFrame:
    """Totals by slot, only for slots that have all three types."""
    slot = GRAIN_SLOT[grain]
    return summary.groupBy(slot).pivot("count_type", list(COUNT_TYPES)).agg(F.first("count")).dropna()
