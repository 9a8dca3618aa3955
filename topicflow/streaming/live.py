"""Live rows from a stream: positions and messages by ingest second."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from topicflow.functions import slots
from topicflow.operators import live
from topicflow.schema import LEVELS, LIVE_KEY, live_locations_name, live_messages_name
from topicflow.session import together
from topicflow.sinks.store import Store
from topicflow.streaming.batches import batch_label, each_batch, kept, staged


# How long a second's rows can still be replaced by a later batch.
LATENESS = "180 seconds"


def last_writes(messages: DataFrame, second: Column, lateness: str = LATENESS) -> DataFrame:
    """A stream of the latest row of each kind, ingest second and message millisecond, across all batches.

    The state holds one row per key and lets go of a second when the watermark passes it.  In update
    mode a batch gives the keys whose latest row it changed.  Rows are ordered by message id and place in the
    message, so the outcome does not depend on how the feed was cut into batches.
    """
    timed = messages.withColumn("ingested", F.timestamp_seconds(second)).withWatermark("ingested", lateness)
    rows = live.entries(timed, second, "t_id", "ingested")
    return live.last_write_wins(rows, ["t_id", "position"], ["ingested", "kind", *LIVE_KEY])


def last_write_writer(
    messages: DataFrame, store: Store, checkpoint: str, levels: Iterable[str] = LEVELS, zone: str = slots.UTC,
    within_ms: int | None = live.RECENT_MS, lateness: str = LATENESS, now_ms: Column | None = None,
) -> DataStreamWriter:
    """Keep the live tables as a store does whose primary key is (second, millisecond).

    A later batch replaces the rows of earlier ones by key.  The key does not hold the place, so
    one state serves all levels.  A batch that is run again writes the same rows under the same keys.
    """
    levels = tuple(levels)
    clock = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    if within_ms is not None:
        messages = live.recent(messages, clock, within_ms)
    second = F.floor(clock / 1000).cast("bigint")

    def write(batch: DataFrame, batch_id: int) -> None:
        label = batch_label(batch, batch_id)
        with staged(batch.withColumn("minuteslot", slots.slot(F.col("secslot") * 1000, "minute", zone)), store.spark) as rows:
            together(batch.sparkSession, *[
                lambda name=name_of(level), own=rows.where(F.col("kind") == kind): store.upsert(name, own, label=label)
                for kind, name_of in (("location", live_locations_name), ("message", live_messages_name)) for level in levels])

    return each_batch(last_writes(messages, second, lateness), write, checkpoint, "update")


def live_writer(
    messages: DataFrame, store: Store, checkpoint: str, levels: Iterable[str] = LEVELS,
    zone: str = slots.UTC, within_ms: int | None = live.RECENT_MS, last_write_wins: bool = False,
    now_ms: Column | None = None,
) -> DataStreamWriter:
    """Append the rows of every batch to the live tables.

    `last_write_wins` keeps one row per ingest second and message millisecond of a batch;
    `last_write_writer` does so across batches.  Otherwise all rows are kept.  `now_ms`
    replaces the clock.
    """
    levels = tuple(levels)
    clock = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    if within_ms is not None:
        messages = live.recent(messages, clock, within_ms)
    # The batch is kept: without what no live row holds.
    stamped = messages.select("t_id", "user_name", "country", "city", "time_ms", "text", "coords", "tags", clock.alias("_ingest_ms"))
    second = F.floor(F.col("_ingest_ms") / 1000).cast("bigint")

    def write(batch: DataFrame, batch_id: int) -> None:
        label = batch_label(batch, batch_id)
        with kept(batch):
            places = {
                "minuteslot": slots.slot(F.col("secslot") * 1000, "minute", zone),
                "batch": F.lit(label),
            }
            n, tags = batch.agg(F.count(F.lit(1)), F.sum(F.size("tags"))).first()
            steps = []
            for level in levels:
                locations = live.live_locations(batch, level, second, "t_id")
                texts = live.live_messages(batch, level, second, "t_id")
                if last_write_wins:
                    locations = live.last_write_wins(locations, ["t_id"])
                    texts = live.last_write_wins(texts, ["t_id", "position"])
                for name, rows, most in ((live_locations_name(level), locations, n), (live_messages_name(level), texts, tags or 0)):
                    steps.append(lambda name=name, rows=rows.withColumns(places), most=most: store.replace(name, rows, n_rows=most))
            together(batch.sparkSession, *steps)

    return each_batch(stamped, write, checkpoint)
