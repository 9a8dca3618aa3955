"""The store in SQL: a view for every table, a table function for every lookup.

    catalog.register(store)
    spark.sql("SELECT * FROM top_topics('day', 20240115, 'ASIA')")

Functions take the grain and slot first, then the country and the city.  As in `serve`, the level
follows from these: an empty string counts as absent, and a city without a country is ignored.  Their bodies name
one branch per table; Catalyst folds the arguments, so that one branch is left and
its slot prunes to one folder.

Views and functions belong to the session.  Views hold the folders that are there when they are
registered: register again after a job has written.  Expired rows are hidden when a query runs.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from topicflow.functions import slots
from topicflow.plans.serve import LIVE_DELAY, LIVE_LIMIT
from topicflow.schema import (
    COUNTS_TTL, GRAIN_SLOT, GRAINS, LEVEL_KEYS, LEVELS, TABLES, TOP_K, counts_name, live_locations_name, live_messages_name, top_name, trends_name,
)
from topicflow.sinks.store import Store

_PLACE = "in_country STRING DEFAULT NULL, in_city STRING DEFAULT NULL"
_COUNTRY, _CITY = "nullif(in_country, '')", "nullif(in_city, '')"
_AT = {
    "world": f"{_COUNTRY} IS NULL",
    "country": f"country = {_COUNTRY} AND {_CITY} IS NULL",
    "city": f"country = {_COUNTRY} AND city = {_CITY}",
}


def _geo(level: str) -> str:
    return ", ".join(k if k in LEVEL_KEYS[level] else f"CAST(NULL AS STRING) AS {k}" for k in LEVEL_KEYS["city"])


def _slot_is(grain: str) -> str:
    # Minutes lie in the folder of their hour.
    return f"{GRAIN_SLOT[grain]} = in_slot" + (" AND hourslot = in_slot DIV 100" if grain == "minute" else "")


def _topics(name_of: Callable[[str, str], str]) -> str:
    """The topics of a slot and place, from the table of its grain and level."""
    return " UNION ALL ".join(
        f"SELECT CAST({GRAIN_SLOT[grain]} AS BIGINT) AS slot, {_geo(level)}, topic, count FROM {name_of(level, grain)} "
        f"WHERE in_grain = '{grain}' AND {_slot_is(grain)} AND {_AT[level]}"
        for grain in GRAINS for level in LEVELS)


def _live(name_of: Callable[[str], str], columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {_geo(level)}, {columns} FROM {name_of(level)} "
        f"WHERE minuteslot = in_minute AND secslot = in_second AND {_AT[level]}" for level in LEVELS)


def _functions() -> dict[str, tuple[str, str, str]]:
    """Name: parameters, columns, body."""
    slot, topic_columns = "in_grain STRING, in_slot BIGINT", "slot BIGINT, country STRING, city STRING, topic STRING, count BIGINT"
    totals = " UNION ALL ".join(
        f"SELECT CAST({GRAIN_SLOT[grain]} AS BIGINT) AS slot, count_type, count FROM {counts_name(grain)} WHERE in_grain = '{grain}' AND {_slot_is(grain)}"
        for grain in COUNTS_TTL)
    some = " UNION ALL ".join(
        f"SELECT DISTINCT CAST({GRAIN_SLOT[grain]} AS BIGINT) AS slot FROM {top_name('world', grain)} WHERE in_grain = '{grain}'" for grain in GRAINS)
    live = "in_minute BIGINT, in_second BIGINT"
    return {
        "top_topics": (f"{slot}, {_PLACE}", topic_columns,
                       f"SELECT slot, country, city, topic, sum(count) FROM ({_topics(top_name)}) GROUP BY slot, country, city, topic "
                       f"ORDER BY sum(count) DESC, topic LIMIT {TOP_K}"),
        "slot_topics": (f"{slot}, {_PLACE}", topic_columns, _topics(trends_name)),
        "topic_count": (f"{slot}, {_PLACE}", "count BIGINT", f"SELECT count(*) FROM ({_topics(trends_name)})"),
        "slot_totals": (slot, "slot BIGINT, total BIGINT, tagged BIGINT, trends BIGINT",
                        f"SELECT * FROM ({totals}) PIVOT (first(count) FOR count_type IN ('total', 'tagged', 'trends')) "
                        "WHERE total IS NOT NULL AND tagged IS NOT NULL AND trends IS NOT NULL"),
        "timeslots": ("in_grain STRING", "slot BIGINT", some),
        "live_messages": (f"{live}, in_topic STRING DEFAULT NULL, {_PLACE}", "country STRING, city STRING, topic STRING, user STRING, time_ms BIGINT, tweet STRING",
                          f"SELECT * FROM ({_live(live_messages_name, 'topic, user, time_ms, tweet')}) WHERE nullif(in_topic, '') IS NULL OR topic = in_topic "
                          f"ORDER BY time_ms, topic, user, tweet LIMIT {LIVE_LIMIT}"),
        "live_locations": (f"{live}, {_PLACE}", "country STRING, city STRING, time_ms BIGINT, latitude FLOAT, longitude FLOAT",
                           _live(live_locations_name, "time_ms, lat, long")),
    }


def live_slots(now: datetime, zone: str = slots.UTC) -> tuple[int, int]:
    """The minute and second that a live lookup at `now` asks for."""
    second = int((now - LIVE_DELAY).timestamp())
    return slots.minute_of_second(second, zone), second


def register(store: Store, as_of: datetime | None = None) -> list[str]:
    """Views of all tables and the functions over them, in the store's session.  Returns the functions' names."""
    for name, table in TABLES.items():
        # The partition columns come along: lookups prune by them.
        rows = store.visible(name, as_of)
        rows.select(*table.columns, *[p for p in table.partitions if p not in table.columns]).createOrReplaceTempView(name)
    found = _functions()
    for name, (parameters, columns, body) in found.items():
        store.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {body}")
    return list(found)
