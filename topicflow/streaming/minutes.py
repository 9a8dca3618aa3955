"""Minute trends from a stream of messages.

Two ways to cut minutes.  By event time (the default): windows with a watermark,
exact under replay and lateness.  A message stamped later than its batch counts in
the minute it came in, so a wrong clock elsewhere cannot move the watermark ahead.
By tick: everything that arrived since the last tick counts in the minute of the
tick.  Several batches of one minute are added up before anything is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from topicflow.functions import slots
from topicflow.operators import ranking, topics
from topicflow.operators.live import RECENT_MS, recent
from topicflow.schema import TOP_K, top_name, trends_name
from topicflow.session import together
from topicflow.sinks import files
from topicflow.sinks.store import Store
from topicflow.streaming.batches import batch_label, each_batch, staged

LATENESS = "60 seconds"
TICK = "60 seconds"
_COARSER = {"country": "city", "world": "country"}


def split(messages: DataFrame, now_ms=None, within_ms: int | None = RECENT_MS) -> DataFrame:
    """Topic occurrences (time_ms, country, city, topic) of recent messages."""
    if within_ms is not None:
        messages = recent(messages, now_ms, within_ms)
    return topics.complete_occurrences(topics.explode_topics(messages)).select("time_ms", "country", "city", "topic")


def _windowed(messages: DataFrame, lateness: str, clock: Column | None, once: bool) -> DataFrame:
    now = F.current_timestamp() if clock is None else clock
    timed = messages.withColumn("ts", F.least("ts", now)).withWatermark("ts", lateness)
    if once:
        timed = timed.dropDuplicatesWithinWatermark(["t_id"])
    return topics.explode_topics(timed, "ts").select(
        F.window("ts", "1 minute").alias("window"), "country", "city", "topic")


def _minute_of_window(zone: str):
    return slots.slot(F.unix_millis(F.col("window.start")), "minute", zone).alias("minuteslot")


def minute_counts(messages: DataFrame, lateness: str = LATENESS, zone: str = slots.UTC,
                  clock: Column | None = None, once: bool = False) -> DataFrame:
    """City counts per minute, emitted once when the minute is closed.  `clock` replaces the batch's time.

    State is held for the finest level only.  All rows of a minute close in the same
    batch, so the coarser levels are sums inside that batch (see `minute_writer`).

    `once` counts a message once however often a source that delivers at least once sends it:
    its id is held for the lateness, and a later copy is late by itself, unless the id comes
    with another time.  That costs one small state row per message instead of per topic.
    """
    counted = _windowed(messages, lateness, clock, once).groupBy("window", "country", "city", "topic").agg(
        F.count(F.lit(1)).alias("count"))
    return counted.select(_minute_of_window(zone), "country", "city", "topic", "count")


def minute_counts_all_levels(messages: DataFrame, lateness: str = LATENESS, zone: str = slots.UTC,
                             clock: Column | None = None, once: bool = False) -> DataFrame:
    """The three levels from one stateful operator, for sinks that take a plain
    stream.  Each occurrence is repeated per level, so this holds three times the
    keys of `minute_counts`."""
    nothing = F.lit(None).cast("string")
    place = F.explode(F.array(
        F.struct(F.lit("city").alias("level"), F.col("country"), F.col("city")),
        F.struct(F.lit("country").alias("level"), F.col("country"), nothing.alias("city")),
        F.struct(F.lit("world").alias("level"), nothing.alias("country"), nothing.alias("city")),
    )).alias("place")
    counted = (
        _windowed(messages, lateness, clock, once).select("window", "topic", place).select("window", "place.*", "topic")
        .groupBy("window", "level", "country", "city", "topic").agg(F.count(F.lit(1)).alias("count")))
    return counted.select("level", _minute_of_window(zone), "country", "city", "topic", "count")


def _write_levels(store: Store, city_counts: DataFrame, label: str, k: int, world_k: int | None) -> None:
    """All six tables of some minutes, side by side, from staged `city_counts`."""
    counts = {"city": city_counts}
    for level, finer in _COARSER.items():
        counts[level] = topics.coarser_counts(counts[finer], level, "minute")
    folder = {"hourslot": F.floor(F.col("minuteslot") / 100).cast("int"), "batch": F.lit(label)}

    def step(name: str, rows: DataFrame):
        return lambda: store.replace(name, rows.withColumns(folder))

    steps = []
    for level, rows in counts.items():
        cut = level == "world" and world_k is not None
        steps.append(step(trends_name(level, "minute"), ranking.top_topics(rows, level, "minute", world_k) if cut else rows))
        steps.append(step(top_name(level, "minute"), ranking.top_topics(rows, level, "minute", k)))
    together(city_counts.sparkSession, *steps)


def minute_writer(
    messages: DataFrame, store: Store, checkpoint: str, lateness: str = LATENESS, zone: str = slots.UTC,
    k: int = TOP_K, world_k: int | None = TOP_K, clock: Column | None = None, once: bool = False,
) -> DataStreamWriter:
    """Minute trends and top lists of all levels, by event time.  `world_k` cuts the
    world trends to a top list as well; None keeps them whole."""
    def write(city: DataFrame, batch_id: int) -> None:
        label = batch_label(city, batch_id)
        with staged(city, store.spark) as counts:
            if not counts.isEmpty():
                _write_levels(store, counts, label, k, world_k)

    return each_batch(minute_counts(messages, lateness, zone, clock, once), write, checkpoint)


def tick_writer(
    messages: DataFrame, store: Store, checkpoint: str, zone: str = slots.UTC, k: int = TOP_K,
    world_k: int | None = TOP_K, within_ms: int | None = RECENT_MS, tick: str = TICK, clock: Column | None = None,
) -> DataStreamWriter:
    """Minute trends by tick.  The tick's time is the batch's own, which the
    checkpoint keeps: a batch that is run again falls into the same minute.

    Each batch leaves its city counts in a folder of its minute; the minute's tables
    are written from the sum of these, so they hold one row per place and topic, and
    lists are cut from whole minutes.  Folders of minutes that are over are dropped.
    """
    now = F.current_timestamp() if clock is None else clock
    arrived = split(messages, None, within_ms).withColumn("minuteslot", slots.slot(F.unix_millis(now), "minute", zone))
    parts = f"{checkpoint}-minutes"

    def write(batch: DataFrame, batch_id: int) -> None:
        label = batch_label(batch, batch_id)
        minutes = [r.minuteslot for r in batch.select("minuteslot").distinct().collect()]
        for minute in minutes:  # one, as all rows of a batch have its time
            rows = topics.trend_counts(batch.where(F.col("minuteslot") == minute), "city", "minute")
            rows.write.mode("overwrite").parquet(f"{parts}/{minute}/{label}")
            spark = batch.sparkSession
            so_far = spark.read.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{parts}/{minute}")
            with staged(topics.coarser_counts(so_far, "city", "minute"), store.spark) as city:
                _write_levels(store, city, f"{label.rsplit('-', 1)[0]}-{minute}", k, world_k)
            for old in files.children(spark, parts):
                if int(old) < minute:
                    files.delete(spark, f"{parts}/{old}")

    return each_batch(arrived, write, checkpoint).trigger(processingTime=tick)
