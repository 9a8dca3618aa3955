"""Batch runs: the hour job and the day job."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.functions import slots as slot_fn
from topicflow.operators import locations, parse, ranking, summary, topics
from topicflow.schema import GRAIN_SLOT, LEVELS, TOP_K, counts_name, locations_name, sketches_name, top_name, trends_name
from topicflow.session import run_dir, together
from topicflow.sinks import files
from topicflow.sinks.store import Store
from topicflow.sources import lines as line_sources


def run_slots(
    store: Store, lines: DataFrame, grain: str, landing: str, slots: Iterable[int] | None = None,
    zone: str = slot_fn.UTC, k: int = TOP_K,
) -> list[int]:
    """Trends, top lists and the summary of every hour or day slot in `lines`.

    The lines are parsed and shuffled once, into a table of base counts in the
    shared folder.  World trends are summed from the country trends just written,
    and the top lists are cut from the written trends.  A lost executor costs only
    tasks of the step that runs; nothing is held in memory between steps.

    `slots` names the slots the lines cover in full.  Only those are replaced, and
    a slot that has no rows any more is emptied.  Without it, the slots found in
    the lines are replaced.  Returns the slots found.
    """
    spark, slot = store.spark, GRAIN_SLOT[grain]
    base_path = run_dir(spark, f"base-{grain}")
    base = topics.base_counts(parse.parse_lines(lines), grain, landing, zone)
    if slots is not None:
        base = base.where(F.col(slot).isin(sorted(set(slots))))
    try:
        base.write.parquet(base_path)
        staged = spark.read.schema(base.schema).parquet(base_path)
        # One row per slot of this run.
        seen = staged.groupBy(slot).agg(F.bool_or(F.col("topic").isNotNull()).alias("topics")).collect()
        found = sorted(r[slot] for r in seen)
        covered = set(found if slots is None else slots)
        no_lines = covered - set(found)
        no_topics = covered - {r[slot] for r in seen if r["topics"]}
        counts = staged.where(F.col("topic").isNotNull()).drop("lines", "tagged")

        def write(name: str, rows: DataFrame, emptied: set[int]) -> Callable[[], None]:
            def step() -> None:
                store.replace(name, rows)
                store.drop_slots(name, emptied)
            return step

        def trends(level: str, rows: DataFrame) -> Callable[[], None]:
            return write(trends_name(level, grain), rows, no_topics)

        def written(level: str) -> DataFrame:
            return store.stored(trends_name(level, grain), found)

        def top(level: str) -> Callable[[], None]:
            return write(top_name(level, grain), ranking.top_topics(written(level), level, grain, k), no_topics)

        sketches = [write(sketches_name(grain), summary.topic_sketches(staged, grain), no_topics)] if grain == "hour" else []
        together(
            spark,
            trends("city", counts),
            trends("country", topics.coarser_counts(counts, "country", grain)),
            write(counts_name(grain), summary.summary_of_base(staged, grain), no_lines),
            *sketches,
        )
        together(
            spark,
            trends("world", topics.coarser_counts(written("country"), "world", grain)),
            top("city"), top("country"),
        )
        top("world")()
    finally:
        files.delete(spark, base_path)
    return found


def hour_job(store: Store, landed: str, now: datetime, look_back: int = 3, zone: str = slot_fn.UTC,
             k: int = TOP_K) -> list[int]:
    """Recount the last closed hours."""
    hours = slot_fn.previous_hours(now, look_back, zone)
    lines = line_sources.landed_hours(store.spark, landed, hours)
    return run_slots(store, lines, "hour", "landing_hour", hours, zone, k)


def day_job(store: Store, daily: str, day: int, zone: str = slot_fn.UTC, k: int = TOP_K) -> list[int]:
    """Recount one day from its lines."""
    lines = line_sources.landed_day(store.spark, daily, day)
    return run_slots(store, lines, "day", "landing_day", [day], zone, k)


class IncompleteDays(ValueError):
    """Hours of a day are not stored."""


def missing_hours(store: Store, days: Iterable[int]) -> list[int]:
    """The hours of these days without a summary: never counted, without lines, or already expired."""
    hours = [day * 100 + h for day in sorted(set(days)) for h in range(24)]
    there = {r.hourslot for r in store.stored(counts_name("hour"), hours).select("hourslot").distinct().collect()}
    return [h for h in hours if h not in there]


def roll_up_days(store: Store, days: Iterable[int], into: Store | None = None, k: int = TOP_K,
                 quiet: Iterable[int] = ()) -> None:
    """Day trends, top lists and summaries from the stored hours, without the lines.

    Hour tables expire, and a day of which hours are gone would be replaced by a part of
    itself: every hour must have its summary, but for those named `quiet`, which had no
    lines.  A day that has no topics any more is emptied, one without lines has no summary.
    """
    days = sorted(set(days))
    gone = sorted(set(missing_hours(store, days)) - set(quiet))
    if gone:
        raise IncompleteDays(f"{len(gone)} hours are not stored, {gone[0]} the first: count the days from their lines")
    out = store if into is None else into
    hours = [day * 100 + h for day in days for h in range(24)]
    for level in LEVELS:
        hour_counts = store.stored(trends_name(level, "hour"), hours)
        out.replace(trends_name(level, "day"), topics.hours_to_days(hour_counts, level))
        full = {r.hourslot // 100 for r in hour_counts.select("hourslot").distinct().collect()}
        out.drop_slots(trends_name(level, "day"), set(days) - full)
        written = out.stored(trends_name(level, "day"), sorted(full))
        out.replace(top_name(level, "day"), ranking.top_topics(written, level, "day", k))
        out.drop_slots(top_name(level, "day"), set(days) - full)
    hour_summary = store.stored(counts_name("hour"), hours)
    out.replace(counts_name("day"), summary.day_summary(hour_summary, out.stored(trends_name("world", "day"), days)))
    with_lines = {r.hourslot // 100 for r in hour_summary.select("hourslot").distinct().collect()}
    out.drop_slots(counts_name("day"), set(days) - with_lines)


def early_day_summary(store: Store, days: Iterable[int]) -> DataFrame:
    """The summary of days that are not over, from the hours stored so far; `trends` is estimated from their sketches."""
    hours = [day * 100 + h for day in sorted(set(days)) for h in range(24)]
    return summary.early_summary(store.stored(counts_name("hour"), hours), store.stored(sketches_name("hour"), hours))


def location_job(store: Store, lines: DataFrame, zone: str = slot_fn.UTC) -> None:
    """Positions by country and by city.  The lines are parsed once, into a staged
    table that both tables are written from."""
    spark, staged_path = store.spark, run_dir(store.spark, "positions")
    rows = locations.locations(parse.parse_messages(lines, zone), "city").withColumn(
        "dayslot", slot_fn.slot(F.col("time_ms"), "day", zone))
    try:
        rows.write.parquet(staged_path)
        staged = spark.read.schema(rows.schema).parquet(staged_path)
        together(spark, *[
            lambda name=locations_name(level): store.replace(name, staged) for level in ("country", "city")])
    finally:
        files.delete(spark, staged_path)


def expire_all(store: Store, names: Iterable[str], as_of: datetime | None = None) -> dict[str, list[str]]:
    return {name: store.expire(name, as_of) for name in names}
