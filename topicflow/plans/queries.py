"""The registered queries: every operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import AbstractContextManager
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from topicflow.functions import slots
from topicflow.operators import envelope, live, locations, parse, partial_lists, ranking, summary, topics
from topicflow.plans import catalog, jobs, serve
from topicflow.schema import (
    GRAIN_SLOT, GRAINS, LEVEL_KEYS, LEVELS, TABLES, TOP_K, counts_name, live_locations_name, live_messages_name, locations_name,
    top_name, trends_name,
)
from topicflow.session import run_dir
from topicflow.sinks import dump, files, publish
from topicflow.sinks.store import Store
from topicflow.sources import adapter
from topicflow.sources import lines as line_sources
from topicflow.streaming import landing, minutes
from topicflow.streaming import live as live_stream
from topicflow.streaming.batches import run_available, staged

Query = Callable[[SparkSession, str], DataFrame]

# The clock of the lookups, inside the span of the driver's events.
NOW = datetime(2024, 1, 16, 8, 30, tzinfo=timezone.utc)
COUNTRY, CITY = "ASIA", "NATION_2"
LANDING = {"day": "landing_day", "hour": "landing_hour"}


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_lines(adapter.envelope_lines(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.messages(_parsed(spark, sf_dir))


def _occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.explode_topics(_messages(spark, sf_dir))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 20 topics of every day and country."""
    counts = topics.trend_counts(_occurrences(spark, sf_dir), "country", "day")
    return ranking.top_topics(counts, "country", "day")


# -- parsing and projections ------------------------------------------------

def parse_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted messages; lists as text, so that every engine prints them alike."""
    return _messages(spark, sf_dir).select(
        "t_id", "u_id", "user_name", "city", "country", "time_ms", *GRAIN_SLOT.values(), "text",
        F.array_join("tags", ",").alias("tags"),
        F.get("coords", F.lit(0)).alias("lon"), F.get("coords", F.lit(1)).alias("lat"),
    )


def rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = parse.rejects(_parsed(spark, sf_dir))
    return refused.groupBy("landing_day", "reason").agg(F.count(F.lit(1)).alias("count"))


def topic_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _occurrences(spark, sf_dir)


def message_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as text, as half-hour buckets, and as slots of another zone."""
    m, time_ms, ny = _messages(spark, sf_dir), F.col("time_ms"), "America/New_York"
    return m.select(
        "t_id", slots.date_time_text(time_ms).alias("utc_text"),
        slots.bucket_slot(time_ms, 30).alias("half_hour"),
        slots.slot(time_ms, "day", ny).alias("ny_day"), slots.slot(time_ms, "hour", ny).alias("ny_hour"),
        slots.slot(time_ms, "minute", ny).alias("ny_minute"),
    )


def envelope_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slim messages from raw statuses, read back field by field."""
    made = envelope.to_envelopes(adapter.raw_status_lines(spark, sf_dir))
    back = parse.parse_lines(made)
    return back.select(
        "t_id", "u_id", "user_name", "city", "country", "time_ms", "text", "verdict",
        F.array_join("tags", ",").alias("tags"),
        F.get("coords", F.lit(0)).alias("lon"), F.get("coords", F.lit(1)).alias("lat"),
    )


def envelope_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.to_tsv(adapter.raw_status_lines(spark, sf_dir)).select("value")


# -- counts, ranking, summaries ----------------------------------------------

def _trends(level: str, grain: str) -> Query:
    return lambda spark, sf_dir: topics.trend_counts(_occurrences(spark, sf_dir), level, grain)


def _top(level: str, grain: str, k: int = TOP_K) -> Query:
    return lambda spark, sf_dir: ranking.top_topics(_trends(level, grain)(spark, sf_dir), level, grain, k)


def _top_from_lists(level: str, grain: str, k: int, counters: int) -> Query:
    """Top lists put together from short lists of the finer slots, written first as a job would have them."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        finer = _trends(level, partial_lists.FINER[grain])(spark, sf_dir)
        path = run_dir(spark, "lists")
        lists = partial_lists.partial_lists(finer, level, grain, counters)
        lists.write.parquet(path)
        return partial_lists.top_from_lists(spark.read.schema(lists.schema).parquet(path), finer, level, grain, k)

    return run


def _all_levels(grain: str) -> Query:
    return lambda spark, sf_dir: topics.trend_counts_all_levels(_occurrences(spark, sf_dir), grain)


def trends_world_half_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.bucket_counts(_occurrences(spark, sf_dir), 30)


def rollup_hour_to_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.hours_to_days(_trends("city", "hour")(spark, sf_dir), "city")


def _slot_summary(grain: str) -> Query:
    return lambda spark, sf_dir: summary.slot_summary(_parsed(spark, sf_dir), grain, LANDING[grain])


def total_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.total_lines(adapter.envelope_lines(spark, sf_dir), "landing_hour")


def tagged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.tagged_messages(_messages(spark, sf_dir), "hour")


def distinct_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.distinct_topics(_occurrences(spark, sf_dir), "hour")


def trend_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many topics every day and city has."""
    return topics.topics_per_key(_trends("city", "day")(spark, sf_dir), "city", "day")


# -- positions and live rows ---------------------------------------------------

def _locations(level: str) -> Query:
    return lambda spark, sf_dir: locations.locations(_messages(spark, sf_dir), level)


def _event_second():
    """The event's own second stands in for the second it came in."""
    return slots.second_slot(F.col("ts"))


def _rt_locations(level: str) -> Query:
    return lambda spark, sf_dir: live.live_locations(_messages(spark, sf_dir), level, _event_second())


def _rt_messages(level: str) -> Query:
    return lambda spark, sf_dir: live.live_messages(
        _messages(spark, sf_dir), level, _event_second()).drop("position")


def rt_last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = live.live_messages(_messages(spark, sf_dir), "world", _event_second(), "t_id")
    return live.last_write_wins(rows, ["t_id", "position"])


def rt_last_location_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions by minute instead of second, so that many collide."""
    minute = F.floor(F.col("time_ms") / 60_000).cast("bigint")
    rows = live.live_locations(_messages(spark, sf_dir).withColumn("time_ms", minute * 60_000), "country", minute * 60, "t_id")
    return live.last_write_wins(rows, ["t_id"])


def rt_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of the messages that were recent at the lookup clock."""
    return minutes.split(_messages(spark, sf_dir), int(NOW.timestamp() * 1000))


# -- lookups over stored tables ------------------------------------------------

_stores: dict[tuple[str, ...], Store] = {}


def store_of(spark: SparkSession, sf_dir: str, grain: str) -> Store:
    """The serving tables of a grain, written by its job over all lines on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, grain)
    if key not in _stores:
        store = Store(spark, run_dir(spark, f"store-{grain}"))
        jobs.run_slots(store, adapter.envelope_lines(spark, sf_dir), grain, LANDING[grain])
        _stores[key] = store
    return _stores[key]


def _served(grain: str, lookup: Callable[[Store], DataFrame]) -> Query:
    return lambda spark, sf_dir: lookup(store_of(spark, sf_dir, grain))


def _rolled_store(spark: SparkSession, sf_dir: str) -> Store:
    """All days rolled up from the stored hours, on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, "rolled")
    if key not in _stores:
        hours = store_of(spark, sf_dir, "hour")
        days = sorted({h // 100 for h in hours.slots(top_name("world", "hour"))})
        out = Store(spark, run_dir(spark, "rollup"))
        # Hours without a line have no summary.
        jobs.roll_up_days(hours, days, out, quiet=jobs.missing_hours(hours, days))
        _stores[key] = out
    return _stores[key]


def job_roll_up_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days' city trends rolled up from the stored hours."""
    return _rolled_store(spark, sf_dir).read(trends_name("city", "day"))


def rollup_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day page's totals after a roll-up."""
    return serve.stats(_rolled_store(spark, sf_dir), "day")


def rollup_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of which the first has lost an hour: it is refused, the second is rolled up."""
    hours, part = store_of(spark, sf_dir, "hour"), Store(spark, run_dir(spark, "incomplete"))
    middle, _ = _span(adapter.envelope_lines(spark, sf_dir))
    lost = min(h for h in hours.slots(counts_name("hour")) if h >= middle)
    days = [lost // 100, slots.next_day(lost // 100)]
    quiet = set(jobs.missing_hours(hours, days))
    for name in [counts_name("hour"), *(trends_name(level, "hour") for level in LEVELS)]:
        there = [h for day in days for h in range(day * 100, day * 100 + 24)]
        part.replace(name, hours.stored(name, there).where(F.col("hourslot") != lost).drop("written_at"))
    for day in days:
        try:
            jobs.roll_up_days(part, [day], quiet=quiet)
        except jobs.IncompleteDays:
            continue
    return part.read(counts_name("day"))


def _in_sql(store_of_query: Callable[[SparkSession, str], Store], sql: str) -> Query:
    """A lookup as a statement over the registered views and functions."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        catalog.register(store_of_query(spark, sf_dir))
        return spark.sql(sql)

    return run


def job_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, run_dir(spark, "locations"))
    jobs.location_job(store, adapter.envelope_lines(spark, sf_dir))
    return store.read(locations_name("city"))


def _live(pick, rows: Callable[[str], Query], country: str | None = None, city: str | None = None, **options) -> Query:
    """A live lookup of the newest second the place has; `of_newest` asks for the first topic of that second."""
    level = serve.resolve_level(country, city)
    of_newest = options.pop("of_newest", False)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = rows(level)(spark, sf_dir)
        here = found
        for key, wanted in zip(LEVEL_KEYS[level], (country, city)):
            here = here.where(F.col(key) == wanted)
        newest = here.agg(F.max("secslot")).first()[0]
        topic = {"topic": here.where(F.col("secslot") == newest).agg(F.min("topic")).first()[0]} if of_newest else {}
        return pick(found, newest, country=country, city=city, **options, **topic)

    return run


# -- streams, landing, compaction ------------------------------------------------

# Short enough to cut the lists of a minute.
MINUTE_K = 3
# The clock of a stream that reads past events: so many days after the last of them.
CLOCK_DAYS = 20
REPLAY_DAYS = 100
FUTURE_MS = 4_102_444_800_000  # the year 2100
# Lines of a file of a feed.  Lines come sorted by time, so a part of them lies in few of the tasks that write it; a batch reads by files.
FEED_ROWS = 100_000


def _span(lines: DataFrame) -> tuple[int, datetime]:
    """The middle one of the hours there are lines of, and the stream's clock."""
    first, last, day = lines.agg(F.min("landing_hour"), F.max("landing_hour"), F.max("landing_day")).first()
    hours = [datetime.strptime(str(h), "%Y%m%d%H") for h in (first, last)]
    middle = hours[0] + (hours[1] - hours[0]) / 2
    return int(middle.strftime("%Y%m%d%H")), datetime.strptime(str(day), "%Y%m%d").replace(tzinfo=timezone.utc) + timedelta(CLOCK_DAYS)


def _message(spark: SparkSession, time_ms: int, topic: str) -> DataFrame:
    return spark.range(1).select(F.to_json(F.struct(
        F.lit(topic).alias("id_str"), F.lit(str(time_ms)).alias("timestamp_ms"), F.lit("").alias("text"),
        F.struct(F.array(F.lit(topic)).alias("hashtags")).alias("entities"),
        F.struct(F.lit("0").alias("id_str")).alias("user"),
        F.struct(F.lit("-").alias("name"), F.lit("-").alias("country_code")).alias("place"),
    )).alias("value"))


def _at(clock: datetime) -> Column:
    return F.timestamp_micros(F.lit(int(clock.timestamp() * 1_000_000)))


def _feed(spark: SparkSession, start: Callable[[DataFrame, str, Column], DataStreamWriter], parts: list[tuple[DataFrame, datetime]],
          on_disk: bool = False) -> None:
    """Feed parts (lines, clock) to a query one after another; it starts again from its checkpoint for each."""
    folder, checkpoint = run_dir(spark, "stream"), run_dir(spark, "checkpoint")
    try:
        for part, now in parts:
            part.write.mode("append").option("maxRecordsPerFile", FEED_ROWS).parquet(folder)
            run_available(start(line_sources.file_stream(spark, folder, "parquet"), checkpoint, _at(now)), spark, on_disk)
    finally:
        files.delete(spark, folder)
        files.delete(spark, checkpoint)


def _made_lines(spark: SparkSession, sf_dir: str) -> AbstractContextManager[DataFrame]:
    """All lines, written once: filters on a line or its hour would make every line anew for each part of a feed."""
    return staged(adapter.envelope_lines(spark, sf_dir), spark)


def _arrive(spark: SparkSession, sf_dir: str, start: Callable[[DataFrame, str, Column], DataStreamWriter],
            flush: bool = False, late: bool = False) -> None:
    """Feed all lines to a query in two parts, the first wholly before the second.  The
    query is stopped and started again from its checkpoint for each part.

    `flush` adds messages half way to the clock: the first moves the watermark, the
    second lets the next batch act on it.  `late` then sends the first part once more,
    which is too late, with a message of the year 2100, and two more such messages an
    hour later.
    """
    with _made_lines(spark, sf_dir) as lines:
        middle, clock = _span(lines)
        first = lines.where(F.col("landing_hour") <= middle).select("value")
        parts = [(first, clock), (lines.where(F.col("landing_hour") > middle).select("value"), clock)]
        if flush:
            ahead = int((clock - timedelta(CLOCK_DAYS // 2)).timestamp() * 1000)
            parts += [(_message(spark, ahead, "flush"), clock)] * 2
        if late:
            future = _message(spark, FUTURE_MS, "future")
            parts += [(first.union(future), clock)] + [(future, clock + timedelta(hours=1))] * 2
        _feed(spark, start, parts)


def _minute_store(spark: SparkSession, sf_dir: str) -> Store:
    """The minute tables as a stream of all lines leaves them, run on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, "minute")
    if key not in _stores:
        store = Store(spark, run_dir(spark, "store-minute"))
        _arrive(spark, sf_dir, lambda lines, checkpoint, now: minutes.minute_writer(
            parse.parse_messages(lines), store, checkpoint, k=MINUTE_K, world_k=None, clock=now), flush=True)
        _stores[key] = store
    return _stores[key]


def _stream_minutes(level: str, top: bool = False) -> Query:
    name = (top_name if top else trends_name)(level, "minute")
    return lambda spark, sf_dir: _minute_store(spark, sf_dir).stored(name).select(*TABLES[name].columns)


def stream_minute_all_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-operator form, through a plain file sink."""
    out = run_dir(spark, "levels")

    def start(lines: DataFrame, checkpoint: str, now: Column) -> DataStreamWriter:
        counts = minutes.minute_counts_all_levels(parse.parse_messages(lines), clock=now)
        return (counts.writeStream.outputMode("append").format("parquet")
                .option("path", out).option("checkpointLocation", checkpoint))

    _arrive(spark, sf_dir, start, flush=True)
    return spark.read.parquet(out)


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes of a feed with late rows, which count nowhere, and rows of the year 2100, which
    count in the minute they came in and hold nothing up."""
    out = run_dir(spark, "late")

    def start(lines: DataFrame, checkpoint: str, now: Column) -> DataStreamWriter:
        counts = minutes.minute_counts(parse.parse_messages(lines), clock=now)
        return (counts.writeStream.outputMode("append").format("parquet")
                .option("path", out).option("checkpointLocation", checkpoint))

    _arrive(spark, sf_dir, start, flush=True, late=True)
    return spark.read.parquet(out)


def stream_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City minutes of a feed that sends each of its halves twice, well inside the lateness: every message counts once.
    Every id and every count is held until the end, so the state is on disk."""
    out = run_dir(spark, "replayed")

    def start(feed: DataFrame, checkpoint: str, now: Column) -> DataStreamWriter:
        counts = minutes.minute_counts(parse.parse_messages(feed), f"{REPLAY_DAYS // 2} days", clock=now, once=True)
        return (counts.writeStream.outputMode("append").format("parquet")
                .option("path", out).option("checkpointLocation", checkpoint))

    with _made_lines(spark, sf_dir) as lines:
        middle, clock = _span(lines)
        far = clock + timedelta(REPLAY_DAYS)
        halves = [lines.where(F.col("landing_hour") <= middle).select("value"), lines.where(F.col("landing_hour") > middle).select("value")]
        flushes = [_message(spark, int((far - timedelta(days=3 - i)).timestamp() * 1000), f"flush{i}") for i in range(3)]
        _feed(spark, start, [(part, far) for part in (*[h for half in halves for h in (half, half)], *flushes)], on_disk=True)
    return spark.read.parquet(out).where(~F.col("topic").startswith("flush"))


def _last_write_store(spark: SparkSession, sf_dir: str) -> Store:
    """Live tables of a stream whose messages all came in in one second, the newer ids first, with times cut to minutes so that
    many rows share their key across batches."""
    key = (spark.sparkContext.applicationId, sf_dir, "last-write")
    if key not in _stores:
        store = Store(spark, run_dir(spark, "last-write"))
        number = F.regexp_extract("value", '"id_str":"([0-9]+)"', 1).cast("long")

        def start(feed: DataFrame, checkpoint: str, now: Column) -> DataStreamWriter:
            messages = parse.parse_messages(feed).withColumn("time_ms", F.floor(F.col("time_ms") / 60_000) * 60_000)
            return live_stream.last_write_writer(messages, store, checkpoint, within_ms=None, now_ms=F.unix_millis(now))

        odd = number % 2 == 1
        with _made_lines(spark, sf_dir) as made:
            lines = made.select("value")
            _feed(spark, start, [(lines.where(odd), NOW), (lines.where(~odd), NOW)])
        _stores[key] = store
    return _stores[key]


def stream_last_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _last_write_store(spark, sf_dir).stored(live_messages_name("city")).select(*TABLES[live_messages_name("city")].columns)


def stream_last_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _last_write_store(spark, sf_dir).stored(live_locations_name("country")).select(*TABLES[live_locations_name("country")].columns)


def stream_tick_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top lists in tick mode, where two batches fall into one minute; the minute is the clock's."""
    store = Store(spark, run_dir(spark, "ticks"))
    _arrive(spark, sf_dir, lambda lines, checkpoint, now: minutes.tick_writer(
        parse.parse_messages(lines), store, checkpoint, k=3, world_k=3, within_ms=None, clock=now))
    return store.stored(top_name("country", "minute")).select(*TABLES[top_name("country", "minute")].columns)


def serve_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minute page, asked two minutes after the newest minute there is."""
    store = _minute_store(spark, sf_dir)
    newest = store.stored(trends_name("world", "minute")).agg(F.max("minuteslot")).first()[0]
    asked = datetime.strptime(str(newest), slots.SLOT_FORMAT["minute"]).replace(tzinfo=timezone.utc)
    return serve.minute_topics(store, asked + serve.MINUTE_DELAY)


def timeslots_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.timeslots(_minute_store(spark, sf_dir), "minute", NOW)


def stream_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick mode counts what arrives, whatever its event time: the minutes depend on
    the clock, the sums over them do not."""
    store = Store(spark, run_dir(spark, "ticks"))
    _arrive(spark, sf_dir, lambda lines, checkpoint, now: minutes.tick_writer(
        parse.parse_messages(lines), store, checkpoint, world_k=None, within_ms=None, clock=now))
    rows = store.stored(trends_name("city", "minute"))
    return rows.groupBy("country", "city", "topic").agg(F.sum("count").alias("count"))


def _live_store(spark: SparkSession, sf_dir: str) -> Store:
    """The live tables of a stream whose messages all came in at the lookup clock."""
    key = (spark.sparkContext.applicationId, sf_dir, "live")
    if key not in _stores:
        store = Store(spark, run_dir(spark, "live"))
        _arrive(spark, sf_dir, lambda lines, checkpoint, now: live_stream.live_writer(
            parse.parse_messages(lines), store, checkpoint, within_ms=None, now_ms=F.lit(int(NOW.timestamp() * 1000))))
        _stores[key] = store
    return _stores[key]


def _fresh_live_store(spark: SparkSession, sf_dir: str) -> Store:
    """The live tables written anew: a lookup by SQL goes by the real clock, and live rows stay visible for two minutes."""
    _stores.pop((spark.sparkContext.applicationId, sf_dir, "live"), None)
    return _live_store(spark, sf_dir)


def _live_page(lookup: Callable[..., DataFrame], *place: str, **options) -> Query:
    """A lookup in the live tables, one minute after the messages came in."""
    return lambda spark, sf_dir: lookup(
        _live_store(spark, sf_dir), NOW + serve.LIVE_DELAY, **dict(zip(("country", "city"), place)), **options)


def stream_live_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live message rows of a stream, without the clock's columns."""
    rows = _live_store(spark, sf_dir).stored(live_messages_name("city"))
    return rows.select("country", "city", "topic", "user", "time_ms", "tweet")


def stream_live_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _live_store(spark, sf_dir).stored(live_locations_name("country"))
    return rows.select("country", "time_ms", "lat", "long")


def live_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live rows after the batches of their minute were merged into one folder."""
    store, name = _live_store(spark, sf_dir), live_messages_name("country")
    store.compact(name, store.slots(name))
    return store.stored(name).select(*TABLES[name].columns)


def _landed(spark: SparkSession, sf_dir: str) -> str:
    root = run_dir(spark, "landed")
    now_ms = F.lit(int(NOW.timestamp() * 1000))
    _arrive(spark, sf_dir, lambda lines, checkpoint, _: landing.landing_writer(
        lines, root, checkpoint, oldest_days=None, now_ms=now_ms, backlog=True))
    return root


def _damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines; the remainder of the id takes the text from some and the time from others."""
    number = F.regexp_extract("value", '"id_str":"([0-9]+)"', 1).cast("long")
    value = F.when(number % 29 == 0, F.regexp_replace("value", '"text":', '"body":')).when(
        number % 31 == 0, F.regexp_replace("value", '"timestamp_ms":"-?[0-9]+"', '"timestamp_ms":"soon"')).otherwise(F.col("value"))
    return adapter.envelope_lines(spark, sf_dir).withColumn("value", value)


def rejects_all_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = parse.rejects(parse.parse_lines(_damaged_lines(spark, sf_dir)))
    return refused.groupBy("landing_day", "reason").agg(F.count(F.lit(1)).alias("count"))


def landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing that sets malformed lines aside: lines per folder, kept and refused."""
    root, refused = run_dir(spark, "landed"), run_dir(spark, "refused")
    now_ms = F.lit(int(NOW.timestamp() * 1000))
    _arrive(spark, sf_dir, lambda lines, checkpoint, _: landing.landing_writer(
        lines, root, checkpoint, on_error="reject", rejects=refused, oldest_days=None, now_ms=now_ms, backlog=True))
    return _lines_per_hour(line_sources.landed_lines(spark, root)).withColumn("kept", F.lit(True)).union(
        _lines_per_hour(line_sources.landed_lines(spark, refused)).withColumn("kept", F.lit(False)))


def landing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What landing tells of its batches: lines and malformed ones, added up."""
    told: list[tuple[int, int]] = []
    now_ms = F.lit(int(NOW.timestamp() * 1000))
    _arrive(spark, sf_dir, lambda lines, checkpoint, _: landing.landing_writer(
        lines, run_dir(spark, "landed"), checkpoint, on_error="reject", rejects=run_dir(spark, "refused"), oldest_days=None, now_ms=now_ms,
        backlog=True, max_rejects=0.5, on_counts=lambda batch, n, malformed: told.append((n, malformed))))
    return spark.createDataFrame(told, "lines long, malformed long").agg(F.sum("lines").alias("lines"), F.sum("malformed").alias("malformed"))


def landing_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog of several files landed under a cap of one file a batch: lines per hour, and how many batches it took."""
    root, folder = run_dir(spark, "landed"), run_dir(spark, "backlog")
    adapter.envelope_lines(spark, sf_dir).select("value").repartition(3).write.parquet(folder)
    capped = line_sources.file_stream(spark, folder, "parquet", files_per_batch=1)
    now_ms = F.lit(int(NOW.timestamp() * 1000))
    run_available(landing.landing_writer(capped, root, run_dir(spark, "checkpoint"), oldest_days=None, now_ms=now_ms, backlog=True))
    files.delete(spark, folder)
    landed = line_sources.landed_lines(spark, root)
    batches = landed.agg(F.countDistinct("batch").alias("batches"))
    return _lines_per_hour(landed).join(F.broadcast(batches))  # one row


def upserted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day trends of the first half of the hours, corrected by the whole counts of the topics that the second half touches."""
    store, name = Store(spark, run_dir(spark, "upsert")), trends_name("country", "day")
    occurrences = _occurrences(spark, sf_dir)
    middle, _ = _span(adapter.envelope_lines(spark, sf_dir))
    store.replace(name, topics.trend_counts(occurrences.where(F.col("hourslot") <= middle), "country", "day"))
    keys = topics.trend_keys("country", "day")
    touched = occurrences.where(F.col("hourslot") > middle).select(*keys).distinct()
    whole = topics.trend_counts(occurrences, "country", "day").join(touched, keys, "left_semi")
    for _ in range(2):  # again changes nothing
        store.upsert(name, whole)
    return store.read(name)


def complete_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of all lines, refused ones too, without those that lack a time or a place."""
    timed = _parsed(spark, sf_dir).select("*", *slots.slot_columns(F.col("time_ms")))
    return topics.complete_occurrences(topics.explode_topics(timed)).select("time_ms", "country", "city", "topic")


def landed_hour_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines landed by a stream, the last three closed hours counted, the hour page looked up."""
    store = Store(spark, run_dir(spark, "landed-hours"))
    jobs.hour_job(store, _landed(spark, sf_dir), NOW)
    return store.read(trends_name("country", "hour"))


def landed_day_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines landed by a stream, one day compacted and counted, its page looked up."""
    hourly, daily, day = _landed(spark, sf_dir), run_dir(spark, "daily"), slots.yesterday(NOW)
    store = Store(spark, run_dir(spark, "landed-days"))
    landing.compact_day(spark, hourly, daily, day)
    jobs.day_job(store, daily, day)
    return serve.top_topics(store, "day", day)


def expired_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour tables written in two halves a day apart, then dropped by age: the later half is left."""
    store = Store(spark, run_dir(spark, "expiry"))
    name = trends_name("world", "hour")
    counts = _trends("world", "hour")(spark, sf_dir)
    middle, _ = _span(adapter.envelope_lines(spark, sf_dir))
    store.replace(name, counts.where(F.col("hourslot") <= middle), written_at=NOW - timedelta(days=2))
    store.replace(name, counts.where(F.col("hourslot") > middle), written_at=NOW)
    store.expire(name, NOW + timedelta(minutes=1))
    return store.stored(name).select(*TABLES[name].columns)


def dump_and_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines published to text files, read back, counted, dumped and read back once more."""
    sent, dumped = run_dir(spark, "published"), run_dir(spark, "dump")
    publish.publish(adapter.envelope_lines(spark, sf_dir), {"path": sent}, "text")
    messages = parse.parse_messages(line_sources.text_lines(spark, sent))
    dump.dump(topics.trend_counts(topics.explode_topics(messages), "country", "day"), dumped, "json")
    return spark.read.schema("dayslot int, country string, topic string, count long").json(dumped)


def allowed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the allowed broker topics: the topic is the place a message comes from."""
    records = adapter.envelope_lines(spark, sf_dir).select(
        "value", F.coalesce(F.get_json_object("value", "$.place.country_code"), F.lit("none")).alias("topic"))
    allowed = line_sources.allowed_topics(records, ["ASIA", "EUROPE"])
    return parse.parse_lines(allowed).groupBy("topic", "verdict").agg(F.count(F.lit(1)).alias("count"))


def _lines_per_hour(landed: DataFrame) -> DataFrame:
    return landed.groupBy("landing_day", "landing_hour").agg(F.count(F.lit(1)).alias("count"))


def landing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per landed hour; lines without an event time land at the clock's hour."""
    return _lines_per_hour(line_sources.landed_lines(spark, _landed(spark, sf_dir)))


def landing_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an extract at the clock lands: nothing older than three days."""
    lines = adapter.envelope_lines(spark, sf_dir)
    now_ms = F.lit(int(NOW.timestamp() * 1000))
    return _lines_per_hour(landing.with_landing_slots(lines, now_ms=now_ms))


def compact_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours into days, for every landed day; lines per day and hour afterwards."""
    hourly, daily = _landed(spark, sf_dir), run_dir(spark, "daily")
    days = line_sources.landed_lines(spark, hourly).select("landing_day").distinct().collect()
    landing.compact_days(spark, hourly, daily, [r["landing_day"] for r in days])
    return _lines_per_hour(line_sources.landed_lines(spark, daily))


def registry() -> dict[str, Query]:
    found: dict[str, Query] = {
        "parse_tweets": parse_messages,
        "rejects_by_reason": rejects_by_reason,
        "topic_explode": topic_explode,
        "message_times": message_times,
        "envelope": envelope_lines,
        "envelope_tsv": envelope_tsv,
        "trends_world_half_hour": trends_world_half_hour,
        "rollup_hour_to_day": rollup_hour_to_day,
        "total_lines": total_lines,
        "tagged_messages": tagged_messages,
        "distinct_topics": distinct_topics,
        "trend_count": trend_count,
        "rt_last_write_wins": rt_last_write_wins,
        "stream_recent": rt_recent,
    }
    for grain in GRAINS:
        for level in LEVELS:
            found[f"trends_{level}_{grain}"] = _trends(level, grain)
            found[f"top_{level}_{grain}"] = _top(level, grain)
    for grain in ("day", "hour"):
        found[f"trends_all_levels_{grain}"] = _all_levels(grain)
        found[f"slot_summary_{grain}"] = _slot_summary(grain)
        found[f"job_{grain}"] = _served(grain, lambda s, name=top_name("city", grain): s.read(name))
    for level in ("country", "city"):
        found[f"locations_{level}"] = _locations(level)
    for level in LEVELS:
        found[f"rt_locations_{level}"] = _rt_locations(level)
        found[f"rt_tweets_{level}"] = _rt_messages(level)

    day, hour = slots.yesterday(NOW), slots.previous_hours(NOW, 1)[0]
    day_store, hour_store = (lambda spark, sf_dir, grain=grain: store_of(spark, sf_dir, grain) for grain in ("day", "hour"))
    found |= {
        "serve_daily": _served("day", lambda s: serve.daily_page(s, NOW)[0]),
        "serve_daily_totals": _served("day", lambda s: serve.daily_page(s, NOW)[1]),
        "serve_daily_country": _served("day", lambda s: serve.top_topics(s, "day", day, COUNTRY)),
        "serve_daily_city": _served("day", lambda s: serve.top_topics(s, "day", day, COUNTRY, CITY)),
        "serve_daily_trend_count": _served("day", lambda s: serve.trend_count(s, "day", day, COUNTRY, CITY)),
        "serve_hourly": _served("hour", lambda s: serve.hourly_page(s, NOW)[0]),
        "serve_hourly_totals": _served("hour", lambda s: serve.hourly_page(s, NOW)[1]),
        "serve_hourly_country": _served("hour", lambda s: serve.top_topics(s, "hour", hour, COUNTRY)),
        "serve_hourly_trend_count": _served("hour", lambda s: serve.trend_count(s, "hour", hour, COUNTRY)),
        "serve_topics_day": _served("day", lambda s: serve.topics(s, "day", day, COUNTRY)),
        "serve_topics_day_first": _served("day", lambda s: serve.topics(s, "day")),
        "serve_topics_hour": _served("hour", lambda s: serve.topics(s, "hour", hour)),
        "serve_minute": serve_minute,
        "serve_live_tweets": _live(serve.pick_messages, _rt_messages),
        "serve_live_tweets_topic": _live(serve.pick_messages, _rt_messages, COUNTRY, of_newest=True),
        "serve_live_locations": _live(serve.pick_locations, _rt_locations),
        "serve_live_locations_city": _live(serve.pick_locations, _rt_locations, COUNTRY, CITY),
        "timeslots_day": _served("day", lambda s: serve.timeslots(s, "day")),
        "timeslots_hour": _served("hour", lambda s: serve.timeslots(s, "hour")),
        "stats_day": _served("day", lambda s: serve.stats(s, "day")),
        "stats_hour": _served("hour", lambda s: serve.stats(s, "hour")),
        "job_rollup_days": job_roll_up_days,
        "job_locations": job_locations,
        "stream_minute_all_levels": stream_minute_all_levels,
        "stream_top_world_minute": _stream_minutes("world", top=True),
        "stream_tick": stream_tick,
        "stream_live_tweets": stream_live_tweets,
        "stream_live_locations": stream_live_locations,
        "landing": landing_hours,
        "landing_recent": landing_recent,
        "compact_day": compact_days,
        "stream_late": stream_late,
        "stream_tick_top": stream_tick_top,
        "rejects_all_reasons": rejects_all_reasons,
        "landing_rejects": landing_rejects,
        "landed_hour_job": landed_hour_job,
        "landed_day_job": landed_day_job,
        "expired_hours": expired_hours,
        "dump_and_publish": dump_and_publish,
        "allowed_lines": allowed_lines,
        "live_page": _live_page(serve.live_messages),
        "live_page_topic": _live_page(serve.live_messages, COUNTRY, topic="click"),
        "live_page_city": _live_page(serve.live_messages, COUNTRY, CITY, limit=5),
        "live_positions": _live_page(serve.live_locations),
        "live_positions_city": _live_page(serve.live_locations, COUNTRY, CITY),
        "rt_last_location_wins": rt_last_location_wins,
        "serve_topics_hour_cut": _served("hour", lambda s: serve.topics(s, "hour", hour, limit=5)),
        "timeslots_minute": timeslots_minute,
        "sql_top_country": _in_sql(day_store, f"SELECT * FROM top_topics('day', {day}, '{COUNTRY}')"),
        "sql_top_hour": _in_sql(hour_store, f"SELECT slot, topic, count FROM top_topics('hour', {hour})"),
        "sql_totals": _in_sql(day_store, f"SELECT * FROM slot_totals('day', {day})"),
        "sql_topic_counts": _in_sql(
            day_store, f"SELECT t.slot, n.count FROM timeslots('day') t, LATERAL topic_count('day', t.slot, '{COUNTRY}', '{CITY}') n"),
        "sql_shares": _in_sql(day_store, f"SELECT c.topic, c.count AS here, w.count AS everywhere FROM slot_topics('day', {day}, '{COUNTRY}') c "
                                         f"JOIN slot_topics('day', {day}) w ON c.topic = w.topic"),
        "sql_live": _in_sql(_fresh_live_store, "SELECT * FROM live_messages({0}, {1}, '', '{2}')".format(*catalog.live_slots(NOW + serve.LIVE_DELAY), COUNTRY)),
        "live_compacted": live_compacted,
        "top_from_lists_day": _top_from_lists("world", "day", 5, 8),
        "top_from_lists_day_country": _top_from_lists("country", "day", 3, 3),
        "top_from_lists_hour_city": _top_from_lists("city", "hour", TOP_K, partial_lists.COUNTERS),
        "rollup_summary": rollup_summary,
        "rollup_incomplete": rollup_incomplete,
        "stream_replayed": stream_replayed,
        "stream_last_write": stream_last_write,
        "stream_last_location": stream_last_location,
        "landing_counts": landing_counts,
        "landing_capped": landing_capped,
        "upserted_days": upserted_days,
        "complete_topics": complete_topics,
    }
    for level in LEVELS:
        found[f"stream_minute_{level}"] = _stream_minutes(level)
        found[f"stream_top3_{level}"] = _stream_minutes(level, top=True)
        found[f"top3_{level}_minute"] = _top(level, "minute", 3)
        found[f"top3_{level}_hour"] = _top(level, "hour", 3)
    return found
