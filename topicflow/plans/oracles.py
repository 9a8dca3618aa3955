"""The same queries as plain SQL over `events`, `nation` and `region`.

The SQL states each line's shape directly; it neither writes nor reads JSON lines.
"""

from __future__ import annotations

from topicflow.plans.queries import CITY, CLOCK_DAYS, COUNTRY, MINUTE_K, NOW
from topicflow.schema import GRAIN_SLOT, GRAINS, LEVEL_KEYS, LEVELS

_NOW_MS = int(NOW.timestamp() * 1000)

_MESSAGES = """
WITH placed AS (
  SELECT e.event_id, e.ts, epoch_us(e.ts) // 1000 AS time_ms, e.user_id, e.event_type, e.props,
         'k' || json_extract_string(e.props, '$.k') AS k, n.n_name, r.r_name
  FROM events e
  LEFT JOIN nation n ON n.n_nationkey = e.user_id % 25
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey),
shaped AS (
  SELECT *, CAST(event_id AS VARCHAR) AS t_id, CAST(user_id AS VARCHAR) AS u_id, 'user_' || user_id AS user_name,
         event_type || ' ' || props AS text, r_name AS country, n_name AS city,
         CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS dayslot,
         CAST(strftime(ts, '%Y%m%d%H') AS INTEGER) AS hourslot,
         CAST(strftime(ts, '%Y%m%d%H%M') AS BIGINT) AS minuteslot,
         CASE WHEN event_id % 3 = 0 THEN user_id % 360 - 180 + 0.5::DOUBLE END AS lon,
         CASE WHEN event_id % 3 = 0 THEN user_id % 180 - 90 + 0.25::DOUBLE END AS lat,
         CASE WHEN event_id % 7 = 0 THEN CAST([] AS VARCHAR[])
              WHEN event_id % 11 = 0 THEN [event_type, event_type, k] ELSE [event_type, k] END AS hashtags,
         CASE WHEN event_id % 2 = 0 THEN CAST([] AS VARCHAR[])
              WHEN event_id % 13 = 0 THEN [event_type]
              ELSE ['u' || CAST(user_id % 40 AS VARCHAR)] END AS mentions,
         CASE WHEN event_id % 23 = 0 THEN 'malformed' WHEN event_id % 17 = 0 THEN 'no_user'
              WHEN event_id % 10 = 0 THEN 'no_place' ELSE 'ok' END AS verdict
  FROM placed),
messages AS (SELECT *, list_concat(hashtags, mentions) AS tags FROM shaped WHERE verdict = 'ok'),
occurrences AS (
  SELECT event_id, t_id, ts, time_ms, dayslot, hourslot, minuteslot, country, city, user_name, text,
         unnest(tags) AS topic, generate_subscripts(tags, 1) AS position
  FROM messages)
"""


def _keys(level: str, grain: str) -> str:
    return ", ".join([GRAIN_SLOT[grain], *LEVEL_KEYS[level]])


def _trends(level: str, grain: str) -> str:
    keys = _keys(level, grain)
    return f'SELECT {keys}, topic, CAST(count(*) AS BIGINT) AS "count" FROM occurrences GROUP BY {keys}, topic'


def _top(level: str, grain: str, k: int = 20) -> str:
    keys = _keys(level, grain)
    return (f'SELECT {keys}, topic, "count" FROM (SELECT *, row_number() OVER (PARTITION BY {keys} '
            f'ORDER BY "count" DESC, topic) AS rn FROM ({_trends(level, grain)})) WHERE rn <= {k}')


def _all_levels(grain: str) -> str:
    slot = GRAIN_SLOT[grain]
    parts = []
    for level in LEVELS:
        geo = ", ".join(k if k in LEVEL_KEYS[level] else f"CAST(NULL AS VARCHAR) AS {k}" for k in ("country", "city"))
        parts.append(f"SELECT '{level}' AS level, {slot}, {geo}, topic, \"count\" FROM ({_trends(level, grain)})")
    return " UNION ALL ".join(parts)


def _totals(grain: str) -> str:
    """One row per slot: every line, tagged messages, topics."""
    slot = GRAIN_SLOT[grain]
    return f"""
      SELECT {slot}, total, coalesce(tagged, 0) AS tagged, coalesce(trends, 0) AS trends
      FROM (SELECT {slot}, CAST(count(*) AS BIGINT) AS total FROM shaped GROUP BY {slot})
      LEFT JOIN (SELECT {slot}, CAST(count(*) AS BIGINT) AS tagged FROM messages WHERE len(tags) > 0 GROUP BY {slot})
        USING ({slot})
      LEFT JOIN (SELECT {slot}, CAST(count(DISTINCT topic) AS BIGINT) AS trends FROM occurrences GROUP BY {slot})
        USING ({slot})"""


def _summary(grain: str) -> str:
    slot = GRAIN_SLOT[grain]
    return " UNION ALL ".join(
        f"SELECT {slot}, '{t}' AS count_type, {t} AS \"count\" FROM ({_totals(grain)})"
        for t in ("total", "tagged", "trends"))


_LABEL = {
    "day": "strftime(strptime(CAST(dayslot AS VARCHAR), '%Y%m%d'), '%Y/%m/%d')",
    "hour": "strftime(strptime(CAST(hourslot AS VARCHAR), '%Y%m%d%H'), '%Y/%m/%d %Hh')",
    "minute": "strftime(strptime(CAST(minuteslot AS VARCHAR), '%Y%m%d%H%M'), '%Y/%m/%d %H:%M')",
}


def _place(country: str | None = None, city: str | None = None) -> str:
    found = [f"{k} = '{v}'" for k, v in (("country", country), ("city", city)) if v]
    return " AND ".join(found) or "TRUE"


def _live_messages(level: str) -> str:
    geo = "".join(f"{k}, " for k in LEVEL_KEYS[level])
    return f'SELECT time_ms // 1000 AS secslot, {geo}topic, user_name AS "user", time_ms, text AS tweet FROM occurrences'


def _live_locations(level: str) -> str:
    geo = "".join(f"{k}, " for k in LEVEL_KEYS[level])
    return (f"SELECT time_ms // 1000 AS secslot, {geo}time_ms, CAST(lat AS FLOAT) AS lat, CAST(lon AS FLOAT) AS long "
            "FROM messages WHERE lat IS NOT NULL")


def _newest(rows: str, place: str) -> str:
    return f"SELECT * FROM ({rows}) WHERE {place} AND secslot = (SELECT max(secslot) FROM ({rows}) WHERE {place})"


def _live_page(where: str, level: str, limit: int) -> str:
    geo = "".join(f"{k}, " for k in LEVEL_KEYS[level])
    return (f'SELECT {geo}topic, "user", time_ms, tweet FROM ({_live_messages("city")}) WHERE {where} '
            f'ORDER BY time_ms, topic, "user", tweet LIMIT {limit}')


def _live_positions(where: str, level: str) -> str:
    geo = "".join(f"{k}, " for k in LEVEL_KEYS[level])
    return f'SELECT {geo}time_ms, lat AS latitude, long AS longitude FROM ({_live_locations("city")}) WHERE {where}'


def _landed(where: str = "TRUE") -> str:
    """Lines without an event time land at the clock's hour."""
    return f"""
      SELECT CASE WHEN verdict = 'malformed' THEN {NOW:%Y%m%d} ELSE dayslot END AS landing_day,
             CASE WHEN verdict = 'malformed' THEN {NOW:%Y%m%d%H} ELSE hourslot END AS landing_hour,
             CAST(count(*) AS BIGINT) AS "count"
      FROM shaped WHERE {where} GROUP BY ALL"""


_TSV = """
SELECT concat_ws(chr(9), t_id, CAST(time_ms AS VARCHAR),
         CASE WHEN lon IS NULL THEN '' ELSE '[' || CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || ']' END,
         array_to_string(CASE WHEN event_id % 19 = 0 THEN list_append(hashtags, 'bare') ELSE hashtags END, ','),
         array_to_string(mentions, ','),
         CASE WHEN event_id % 17 = 0 THEN '' ELSE u_id END, CASE WHEN event_id % 17 = 0 THEN '' ELSE n_name END,
         CASE WHEN event_id % 10 = 0 THEN '' ELSE 'city' END, CASE WHEN event_id % 10 = 0 THEN '' ELSE n_name END,
         CASE WHEN event_id % 10 = 0 THEN '' ELSE r_name END,
         CASE WHEN event_id % 10 = 0 THEN '' ELSE n_name || ', ' || r_name END, text) AS value
FROM shaped WHERE verdict <> 'malformed'
"""

_ENVELOPE = """
SELECT t_id, CASE WHEN event_id % 17 <> 0 THEN u_id END AS u_id,
       CASE WHEN event_id % 17 <> 0 THEN user_name ELSE 'Anonymous' END AS user_name,
       CASE WHEN event_id % 10 <> 0 THEN city END AS city, CASE WHEN event_id % 10 <> 0 THEN country END AS country,
       time_ms, text, verdict, array_to_string(list_concat(hashtags, mentions), ',') AS tags, lon, lat
FROM shaped WHERE verdict <> 'malformed'
"""


def _bodies() -> dict[str, str]:
    day, hour = "20240115", "2024011607"
    malformed, not_malformed = "verdict = 'malformed'", "verdict <> 'malformed'"
    slots = "dayslot, hourslot, minuteslot"
    found = {
        "parse_tweets": f"""SELECT t_id, u_id, user_name, city, country, time_ms, {slots}, text,
            array_to_string(tags, ',') AS tags, lon, lat FROM messages""",
        "rejects_by_reason": """SELECT dayslot AS landing_day, verdict AS reason, CAST(count(*) AS BIGINT) AS "count"
            FROM shaped WHERE verdict <> 'ok' GROUP BY ALL""",
        "topic_explode": f"SELECT time_ms, {slots}, country, city, topic FROM occurrences",
        "message_times": """SELECT t_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS utc_text,
            minuteslot - minuteslot % 100 % 30 AS half_hour,
            CAST(strftime(ts - INTERVAL 5 HOUR, '%Y%m%d') AS INTEGER) AS ny_day,
            CAST(strftime(ts - INTERVAL 5 HOUR, '%Y%m%d%H') AS INTEGER) AS ny_hour,
            CAST(strftime(ts - INTERVAL 5 HOUR, '%Y%m%d%H%M') AS BIGINT) AS ny_minute FROM messages""",
        "envelope": _ENVELOPE,
        "envelope_tsv": _TSV,
        "trends_world_half_hour": """SELECT minuteslot - minuteslot % 100 % 30 AS minuteslot, topic,
            CAST(count(*) AS BIGINT) AS "count" FROM occurrences GROUP BY ALL""",
        "rollup_hour_to_day": _trends("city", "day"),
        "total_lines": """SELECT hourslot AS landing_hour, CAST(count(*) AS BIGINT) AS "count"
            FROM shaped GROUP BY ALL""",
        "tagged_messages": """SELECT hourslot, CAST(count(*) FILTER (len(tags) > 0) AS BIGINT) AS "count"
            FROM messages GROUP BY ALL""",
        "distinct_topics": """SELECT hourslot, CAST(count(DISTINCT topic) AS BIGINT) AS "count"
            FROM occurrences GROUP BY ALL""",
        "trend_count": """SELECT dayslot, country, city, CAST(count(DISTINCT topic) AS BIGINT) AS "count"
            FROM occurrences GROUP BY ALL""",
        "rt_last_write_wins": """SELECT secslot, time_ms, topic, "user", tweet FROM (
            SELECT time_ms // 1000 AS secslot, time_ms, topic, user_name AS "user", text AS tweet, row_number() OVER (
              PARTITION BY time_ms ORDER BY event_id DESC, position DESC) AS rn FROM occurrences) WHERE rn = 1""",
        "stream_recent": f"""SELECT time_ms, country, city, topic FROM occurrences
            WHERE time_ms + 60000 >= {_NOW_MS}""",
    }
    for grain in GRAINS:
        for level in LEVELS:
            found[f"trends_{level}_{grain}"] = _trends(level, grain)
            found[f"top_{level}_{grain}"] = _top(level, grain)
    for grain in ("day", "hour"):
        slot = GRAIN_SLOT[grain]
        found[f"trends_all_levels_{grain}"] = _all_levels(grain)
        found[f"slot_summary_{grain}"] = _summary(grain)
        found[f"job_{grain}"] = _top("city", grain)
        found[f"timeslots_{grain}"] = f"SELECT DISTINCT {slot}, {_LABEL[grain]} AS label FROM occurrences"
        found[f"stats_{grain}"] = f"SELECT *, {_LABEL[grain]} AS label FROM ({_totals(grain)})"
    for level in ("country", "city"):
        geo = ", ".join(LEVEL_KEYS[level])
        found[f"locations_{level}"] = f"SELECT {geo}, time_ms, lat, lon AS long FROM messages WHERE lat IS NOT NULL"
    for level in LEVELS:
        found[f"rt_locations_{level}"] = _live_locations(level)
        found[f"rt_tweets_{level}"] = _live_messages(level)
        found[f"stream_minute_{level}"] = _trends(level, "minute")
        found[f"stream_top3_{level}"] = _top(level, "minute", MINUTE_K)
        found[f"top3_{level}_minute"] = _top(level, "minute", 3)
        found[f"top3_{level}_hour"] = _top(level, "hour", 3)

    def served_top(grain: str, slot: str, country: str | None = None, city: str | None = None) -> str:
        level = "city" if city else "country" if country else "world"
        return f"""SELECT * FROM ({_trends(level, grain)}) WHERE {GRAIN_SLOT[grain]} = {slot}
            AND {_place(country, city)} ORDER BY "count" DESC, topic LIMIT 20"""

    def served_topics(grain: str, limit: int, where: str, level: str, order: str) -> str:
        return f"SELECT * FROM ({_trends(level, grain)}) WHERE {where} ORDER BY {order} LIMIT {limit}"

    def topic_count(where: str) -> str:
        return f'SELECT CAST(count(DISTINCT topic) AS BIGINT) AS "count" FROM occurrences WHERE {where}'

    asia_tweets = _newest(_live_messages("country"), _place(COUNTRY))
    newest_minute = "minuteslot = (SELECT max(minuteslot) FROM occurrences)"
    found |= {
        "serve_daily": served_top("day", day),
        "serve_daily_totals": f"SELECT * FROM ({_totals('day')}) WHERE dayslot = {day}",
        "serve_daily_country": served_top("day", day, COUNTRY),
        "serve_daily_city": served_top("day", day, COUNTRY, CITY),
        "serve_daily_trend_count": topic_count(f"dayslot = {day} AND {_place(COUNTRY, CITY)}"),
        "serve_hourly": served_top("hour", hour),
        "serve_hourly_totals": f"SELECT * FROM ({_totals('hour')}) WHERE hourslot = {hour}",
        "serve_hourly_country": served_top("hour", hour, COUNTRY),
        "serve_hourly_trend_count": topic_count(f"hourslot = {hour} AND {_place(COUNTRY)}"),
        "serve_topics_day": served_topics("day", 10, f"dayslot = {day} AND {_place(COUNTRY)}", "country", "topic"),
        "serve_topics_day_first": served_topics("day", 10, "TRUE", "world", "dayslot, topic"),
        "serve_topics_hour": served_topics("hour", 1000, f"hourslot = {hour}", "world", "topic"),
        "serve_minute": f'SELECT * FROM ({_trends("world", "minute")}) WHERE {newest_minute} '
                        'ORDER BY "count" DESC, topic LIMIT 20',
        "serve_live_tweets": f'SELECT topic, "user", time_ms, tweet FROM ({_newest(_live_messages("world"), "TRUE")}) '
                             'ORDER BY time_ms, topic, "user", tweet LIMIT 10',
        "serve_live_tweets_topic": f'SELECT country, topic, "user", time_ms, tweet FROM ({asia_tweets}) '
                                   f"WHERE topic = (SELECT min(topic) FROM ({asia_tweets})) ORDER BY time_ms, topic, \"user\", tweet LIMIT 10",
        "serve_live_locations": 'SELECT time_ms, lat AS latitude, long AS longitude '
                                f'FROM ({_newest(_live_locations("world"), "TRUE")})',
        "serve_live_locations_city": 'SELECT country, city, time_ms, lat AS latitude, long AS longitude '
                                     f'FROM ({_newest(_live_locations("city"), _place(COUNTRY, CITY))})',
        "timeslots_minute": f"SELECT DISTINCT minuteslot, {_LABEL['minute']} AS label FROM occurrences",
        "job_rollup_days": _trends("city", "day"),
        "job_locations": "SELECT country, city, time_ms, lat, lon AS long FROM messages WHERE lat IS NOT NULL",
        "stream_minute_all_levels": _all_levels("minute"),
        "stream_top_world_minute": _top("world", "minute", MINUTE_K),
        "stream_tick": 'SELECT country, city, topic, CAST(count(*) AS BIGINT) AS "count" FROM occurrences GROUP BY ALL',
        "stream_live_tweets": 'SELECT country, city, topic, user_name AS "user", time_ms, text AS tweet FROM occurrences',
        "stream_live_locations": f'SELECT country, time_ms, lat, long FROM ({_live_locations("country")})',
        "landing": _landed(),
        "stream_late": f"""{_trends("city", "minute")} UNION ALL
            SELECT CAST(strftime(date_trunc('day', max(ts)) + INTERVAL {CLOCK_DAYS // 2} DAY, '%Y%m%d%H%M') AS BIGINT), '-', '-', 'flush', 2 FROM shaped
            UNION ALL
            SELECT CAST(strftime(date_trunc('day', max(ts)) + INTERVAL {CLOCK_DAYS} DAY, '%Y%m%d%H%M') AS BIGINT), '-', '-', 'future', 1 FROM shaped""",
        "stream_tick_top": f"""SELECT minuteslot, country, topic, "count" FROM (
            SELECT *, row_number() OVER (PARTITION BY country ORDER BY "count" DESC, topic) AS rn FROM (
                SELECT (SELECT CAST(strftime(date_trunc('day', max(ts)) + INTERVAL {CLOCK_DAYS} DAY, '%Y%m%d%H%M') AS BIGINT) FROM shaped) AS minuteslot,
                       country, topic, CAST(count(*) AS BIGINT) AS "count" FROM occurrences GROUP BY ALL)) WHERE rn <= 3""",
        "rejects_all_reasons": """SELECT dayslot AS landing_day, reason, CAST(count(*) AS BIGINT) AS "count" FROM (
            SELECT dayslot, CASE WHEN event_id % 23 = 0 THEN 'malformed' WHEN event_id % 29 = 0 THEN 'missing_key'
                WHEN event_id % 17 = 0 THEN 'no_user' WHEN event_id % 10 = 0 THEN 'no_place'
                WHEN event_id % 31 = 0 THEN 'bad_timestamp' END AS reason FROM shaped) WHERE reason IS NOT NULL GROUP BY ALL""",
        "landing_rejects": f"SELECT *, TRUE AS kept FROM ({_landed(not_malformed)}) UNION ALL "
                           f"SELECT *, FALSE AS kept FROM ({_landed(malformed)})",
        "landed_hour_job": f"SELECT * FROM ({_trends('country', 'hour')}) WHERE hourslot BETWEEN 2024011605 AND {hour}",
        "landed_day_job": served_top("day", day),
        "expired_hours": f"""SELECT * FROM ({_trends("world", "hour")}) WHERE hourslot > (
            SELECT CAST(strftime(min(h) + (max(h) - min(h)) / 2, '%Y%m%d%H') AS INTEGER)
            FROM (SELECT date_trunc('hour', ts) AS h FROM shaped))""",
        "dump_and_publish": _trends("country", "day"),
        "allowed_lines": """SELECT r_name AS topic, verdict, CAST(count(*) AS BIGINT) AS "count" FROM shaped
            WHERE event_id % 10 <> 0 AND event_id % 23 <> 0 AND r_name IN ('ASIA', 'EUROPE') GROUP BY ALL""",
        "live_page": _live_page("TRUE", "world", 10),
        "live_page_topic": _live_page(f"country = '{COUNTRY}' AND topic = 'click'", "country", 10),
        "live_page_city": _live_page(_place(COUNTRY, CITY), "city", 5),
        "live_positions": _live_positions("TRUE", "world"),
        "live_positions_city": _live_positions(_place(COUNTRY, CITY), "city"),
        "rt_last_location_wins": """SELECT secslot, country, time_ms, lat, long FROM (
            SELECT time_ms // 60000 * 60 AS secslot, country, time_ms // 60000 * 60000 AS time_ms, CAST(lat AS FLOAT) AS lat,
                   CAST(lon AS FLOAT) AS long, row_number() OVER (PARTITION BY time_ms // 60000 ORDER BY event_id DESC) AS rn
            FROM messages WHERE lat IS NOT NULL) WHERE rn = 1""",
        "serve_topics_hour_cut": served_topics("hour", 5, f"hourslot = {hour}", "world", "topic"),
        "landing_recent": _landed(f"verdict = 'malformed' OR time_ms >= {_NOW_MS} - 3 * 86400000"),
        "compact_day": _landed(),
        "sql_top_country": f"SELECT dayslot AS slot, country, CAST(NULL AS VARCHAR) AS city, topic, \"count\" FROM ({served_top('day', day, COUNTRY)})",
        "sql_top_hour": f"SELECT hourslot AS slot, topic, \"count\" FROM ({served_top('hour', hour)})",
        "sql_totals": f"SELECT dayslot AS slot, total, tagged, trends FROM ({_totals('day')}) WHERE dayslot = {day}",
        "sql_topic_counts": f"""SELECT dayslot AS slot, CAST(count(DISTINCT topic) FILTER ({_place(COUNTRY, CITY)}) AS BIGINT) AS "count"
            FROM occurrences GROUP BY dayslot""",
        "sql_shares": f"""SELECT topic, c."count" AS here, w."count" AS everywhere FROM ({_trends("country", "day")}) c JOIN ({_trends("world", "day")}) w USING (dayslot, topic)
            WHERE dayslot = {day} AND {_place(COUNTRY)}""",
        "sql_live": f"SELECT country, CAST(NULL AS VARCHAR) AS city, topic, \"user\", time_ms, tweet FROM ({_live_page(_place(COUNTRY), 'country', 10)})",
        "top_from_lists_day": _top("world", "day", 5),
        "top_from_lists_day_country": _top("country", "day", 3),
        "top_from_lists_hour_city": _top("city", "hour"),
        "live_compacted": f"""SELECT {_NOW_MS // 1000} AS secslot, country, topic, user_name AS "user", time_ms, text AS tweet FROM occurrences""",
        "rollup_summary": f"SELECT *, {_LABEL['day']} AS label FROM ({_totals('day')})",
        "rollup_incomplete": f"""SELECT * FROM ({_summary("day")}) WHERE dayslot = (
            SELECT CAST(strftime(date_trunc('day', min(ts)) + INTERVAL 1 DAY, '%Y%m%d') AS INTEGER) FROM shaped WHERE date_trunc('hour', ts) >= (
                SELECT date_trunc('hour', min(h) + (max(h) - min(h)) / 2) FROM (SELECT date_trunc('hour', ts) AS h FROM shaped)))""",
        "stream_replayed": _trends("city", "minute"),
        "stream_last_write": f"""SELECT {_NOW_MS // 1000} AS secslot, country, city, topic, "user", time_ms // 60000 * 60000 AS time_ms, tweet FROM (
            SELECT *, user_name AS "user", text AS tweet, row_number() OVER (
                PARTITION BY time_ms // 60000 ORDER BY event_id DESC, position DESC) AS rn FROM occurrences) WHERE rn = 1""",
        "stream_last_location": f"""SELECT {_NOW_MS // 1000} AS secslot, country, time_ms // 60000 * 60000 AS time_ms,
            CAST(lat AS FLOAT) AS lat, CAST(lon AS FLOAT) AS long FROM (
            SELECT *, row_number() OVER (PARTITION BY time_ms // 60000 ORDER BY event_id DESC) AS rn FROM messages WHERE lat IS NOT NULL) WHERE rn = 1""",
        "landing_counts": """SELECT CAST(count(*) AS BIGINT) AS lines, CAST(count(*) FILTER (verdict = 'malformed') AS BIGINT) AS malformed FROM shaped""",
        "landing_capped": f"SELECT *, CAST(3 AS BIGINT) AS batches FROM ({_landed()})",
        "upserted_days": _trends("country", "day"),
        "complete_topics": """SELECT time_ms, country, city, unnest(list_concat(hashtags, mentions)) AS topic FROM shaped
            WHERE event_id % 23 <> 0 AND event_id % 10 <> 0""",
    }
    return found


def sql() -> dict[str, str]:
    return {name: f"{_MESSAGES}{body}" for name, body in _bodies().items()}
