"""Live feed rows: positions and messages stamped with the second they came in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.functions import slots
from topicflow.operators.locations import has_position, position, with_position
from topicflow.operators.topics import with_topics
from topicflow.schema import LEVEL_KEYS, LIVE_KEY

RECENT_MS = 60_000


def recent(messages: DataFrame, now_ms: Column | int | None = None, within_ms: int = RECENT_MS) -> DataFrame:
    """Messages no older than `within_ms`; `now` is the clock unless given."""
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    now = now if isinstance(now, Column) else F.lit(now)
    return messages.where(F.col("time_ms") + F.lit(within_ms) >= now)


def ingest_second(ingest: Column | None = None) -> Column:
    return slots.second_slot(F.current_timestamp() if ingest is None else ingest)


def live_locations(messages: DataFrame, level: str, secslot: Column | None = None, *extra: str) -> DataFrame:
    second = ingest_second() if secslot is None else secslot
    return with_position(messages).select(
        second.alias("secslot"), *LEVEL_KEYS[level], "time_ms",
        F.col("lat").cast("float").alias("lat"), F.col("long").cast("float").alias("long"),
        *extra,
    )


def live_messages(messages: DataFrame, level: str, secslot: Column | None = None, *extra: str) -> DataFrame:
    """One row per topic occurrence; `position` is the topic's place in its message."""
    second = ingest_second() if secslot is None else secslot
    return with_topics(messages).select(
        second.alias("secslot"), *LEVEL_KEYS[level], F.posexplode("tags").alias("position", "topic"),
        F.col("user_name").alias("user"), "time_ms", F.col("text").alias("tweet"), *extra,
    )


def entries(messages: DataFrame, secslot: Column, *extra: str) -> DataFrame:
    """The live rows of both kinds in one pass: a `kind` of `location` once for each message with a
    position, of `message` for each topic occurrence.  `position` is the topic's place in its message."""
    lon, lat = position()
    here = F.when(has_position(), F.array(F.struct(F.lit("location").alias("kind"), F.lit(0).alias("position"), F.lit(None).cast("string").alias("topic"))))
    each = F.transform("tags", lambda tag, i: F.struct(F.lit("message").alias("kind"), i.alias("position"), tag.alias("topic")))
    nothing = F.filter(each, lambda e: F.lit(False))
    return messages.select(
        secslot.alias("secslot"), "country", "city", "time_ms", lat.cast("float").alias("lat"), lon.cast("float").alias("long"),
        F.col("user_name").alias("user"), F.col("text").alias("tweet"), *extra,
        F.explode(F.concat(F.coalesce(here, nothing), each)).alias("_entry"),
    ).select("_entry.*", "*").drop("_entry")


def last_write_wins(rows: DataFrame, arrival: list[str], keys: Sequence[str] = LIVE_KEY) -> DataFrame:
    """One row per (secslot, time_ms): the one that arrived last.

    `arrival` names the columns that tell the order.  Ids are numbers written as text and
    grow as messages arrive: they count as numbers, and as text only where they are none.
    `max_by` combines inside each task, so many rows of one second and
    millisecond are never gathered in one place.
    """
    rest = [c for c in rows.columns if c not in keys and c not in arrival]
    text = {name for name, kind in rows.dtypes if kind == "string"}
    order = [part for c in arrival for part in ([F.expr(f"try_cast({c} as bigint)"), F.col(c)] if c in text else [F.col(c)])]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_row.*")
