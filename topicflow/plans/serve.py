"""Lookups over the serving tables.

The geo level follows from the arguments: a country narrows to that country, a
country and a city to that city.  An empty string counts as absent, and a city
without a country is ignored.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.functions import slots
from topicflow.operators import ranking, summary
from topicflow.operators import topics as topic_ops
from topicflow.schema import (
    GRAIN_SLOT, LEVEL_KEYS, TOP_K, counts_name, live_locations_name, live_messages_name, top_name, trends_name,
)
from topicflow.sinks.store import Store

MINUTE_DELAY = timedelta(seconds=120)
LIVE_DELAY = timedelta(seconds=60)
LIVE_LIMIT = 10
# How many topics the plain topic lists give.
TOPIC_LIMIT = {"day": 10, "hour": 1000}


def resolve_level(country: str | None = None, city: str | None = None) -> str:
    if not country:
        return "world"
    return "city" if city else "country"


def _in_place(rows: DataFrame, level: str, country: str | None, city: str | None) -> DataFrame:
    for key, wanted in zip(LEVEL_KEYS[level], (country, city)):
        rows = rows.where(F.col(key) == wanted)
    return rows


def _slot_rows(store: Store, name_of, grain: str, slot: int, country, city, as_of) -> DataFrame:
    level = resolve_level(country, city)
    rows = store.read(name_of(level, grain), [slot], as_of).where(F.col(GRAIN_SLOT[grain]) == slot)
    return _in_place(rows, level, country, city)


def top_topics(store: Store, grain: str, slot: int, country: str | None = None, city: str | None = None,
               k: int = TOP_K, as_of: datetime | None = None) -> DataFrame:
    """The stored top list, sorted and cut again."""
    return ranking.first_by_count(_slot_rows(store, top_name, grain, slot, country, city, as_of), k)


def slot_totals(store: Store, grain: str, slot: int, as_of: datetime | None = None) -> DataFrame:
    """`total`, `tagged` and `trends` of a slot; no row unless all three are there."""
    rows = store.read(counts_name(grain), [slot], as_of).where(F.col(GRAIN_SLOT[grain]) == slot)
    return summary.slot_totals(rows, grain)


def trend_count(store: Store, grain: str, slot: int, country: str | None = None, city: str | None = None,
                as_of: datetime | None = None) -> DataFrame:
    """How many topics a slot and place has."""
    return _slot_rows(store, trends_name, grain, slot, country, city, as_of).agg(F.count(F.lit(1)).alias("count"))


def daily_page(store: Store, now: datetime, zone: str = slots.UTC) -> tuple[DataFrame, DataFrame]:
    """Yesterday's world top list and totals."""
    slot = slots.yesterday(now, zone)
    return top_topics(store, "day", slot, as_of=now), slot_totals(store, "day", slot, as_of=now)


def hourly_page(store: Store, now: datetime, zone: str = slots.UTC) -> tuple[DataFrame, DataFrame]:
    """The last closed hour's world top list and totals."""
    slot = slots.now_slot(now, "hour", timedelta(hours=1), zone)
    return top_topics(store, "hour", slot, as_of=now), slot_totals(store, "hour", slot, as_of=now)


def topics(store: Store, grain: str, slot: int | None = None, country: str | None = None, city: str | None = None,
           limit: int | None = None, as_of: datetime | None = None) -> DataFrame:
    """Topics of a slot and place in topic order; without a slot, the first of the world table."""
    limit = TOPIC_LIMIT[grain] if limit is None else limit
    if slot is None:
        name, first, n = trends_name("world", grain), [], 0
        # Slots are folders: the earliest are read, until there are enough rows.
        for early in store.slots(name):
            n += store.read(name, [early], as_of).limit(limit).count()
            first.append(early)
            if n >= limit:
                break
        rows = store.read(name, first, as_of)
        return rows.orderBy(GRAIN_SLOT[grain], "topic").limit(limit)
    return _slot_rows(store, trends_name, grain, slot, country, city, as_of).orderBy("topic").limit(limit)


def minute_topics(store: Store, now: datetime, country: str | None = None, city: str | None = None,
                  zone: str = slots.UTC) -> DataFrame:
    """The top list of the minute two minutes ago.

    Counts of one minute add up over the stream's batches: a tick stream may close
    a minute in two of them.
    """
    slot = slots.now_slot(now, "minute", MINUTE_DELAY, zone)
    rows = _slot_rows(store, trends_name, "minute", slot, country, city, now)
    summed = topic_ops.coarser_counts(rows, resolve_level(country, city), "minute")
    return ranking.first_by_count(summed)


def pick_messages(rows: DataFrame, second: int, topic: str | None = None, country: str | None = None,
                  city: str | None = None, limit: int = LIVE_LIMIT) -> DataFrame:
    """The first messages of one ingest second, of a topic and place if given."""
    picked = _in_place(rows.where(F.col("secslot") == second), resolve_level(country, city), country, city)
    if topic:
        picked = picked.where(F.col("topic") == topic)
    return picked.drop("secslot").orderBy("time_ms", "topic", "user", "tweet").limit(limit)


def pick_locations(rows: DataFrame, second: int, country: str | None = None, city: str | None = None) -> DataFrame:
    """The positions of one ingest second, of a place if given."""
    picked = _in_place(rows.where(F.col("secslot") == second), resolve_level(country, city), country, city)
    return picked.drop("secslot").withColumnsRenamed({"lat": "latitude", "long": "longitude"})


def _live_rows(store: Store, name_of, now: datetime, country, city, zone: str) -> tuple[DataFrame, int]:
    second = int((now - LIVE_DELAY).timestamp())
    name = name_of(resolve_level(country, city))
    return store.read(name, [slots.minute_of_second(second, zone)], now), second


def live_messages(store: Store, now: datetime, topic: str | None = None, country: str | None = None,
                  city: str | None = None, limit: int = LIVE_LIMIT, zone: str = slots.UTC) -> DataFrame:
    """Messages that came in one minute ago."""
    rows, second = _live_rows(store, live_messages_name, now, country, city, zone)
    return pick_messages(rows, second, topic, country, city, limit)


def live_locations(store: Store, now: datetime, country: str | None = None, city: str | None = None,
                   zone: str = slots.UTC) -> DataFrame:
    """Positions that came in one minute ago."""
    rows, second = _live_rows(store, live_locations_name, now, country, city, zone)
    return pick_locations(rows, second, country, city)


def timeslots(store: Store, grain: str = "day", as_of: datetime | None = None) -> DataFrame:
    """The slots there are, with labels.

    Days and hours are folders: their names and footers tell, no row is read.  Of the minutes,
    which share their hour's folder, only the slot column is read.
    """
    slot, name = GRAIN_SLOT[grain], top_name("world", grain)
    if grain == "minute":
        found = store.read(name, as_of=as_of).select(slot).distinct()
    else:
        found = store.spark.createDataFrame([(s,) for s in store.visible_slots(name, as_of)], f"{slot} int")
    return found.withColumn("label", slots.slot_label(F.col(slot), grain)).orderBy(slot)


def stats(store: Store, grain: str, as_of: datetime | None = None) -> DataFrame:
    """The summary of every slot as one row, for charts."""
    return summary.summary_series(store.read(counts_name(grain), as_of=as_of), grain)
