from datetime import datetime, timedelta, timezone

import pytest
from lines import T0, at, frame

from topicflow.operators import parse
from topicflow.plans import jobs, serve
from topicflow.schema import TABLES, counts_name, top_name, trends_name
from topicflow.session import run_dir, shared_dir
from topicflow.sinks import dump
from topicflow.sinks.store import Store
from topicflow.sources import lines as sources
from topicflow.streaming import landing

HOUR = 3_600_000
NOW = datetime(2015, 9, 17, 8, 10, tzinfo=timezone.utc)
DAY, H5, H6, H7 = 20150917, 2015091705, 2015091706, 2015091707


@pytest.fixture
def store(spark):
    return Store(spark, run_dir(spark, "store"))


def counts(rows):
    return {tuple(v for k, v in r.asDict().items() if k != "count"): r["count"] for r in rows.collect()}


def trends(spark, rows, slot="dayslot"):
    return spark.createDataFrame(rows, f"{slot} int, topic string, count bigint")


def land(spark, root, lines, label):
    landed = landing.with_landing_slots(frame(spark, lines), oldest_days=None)
    landing.write_landed(landed, root, label)


def test_replacing_a_slot_leaves_the_others_and_nothing_stale(spark, store):
    name = trends_name("world", "day")
    assert store.read(name).count() == 0
    store.replace(name, trends(spark, [(1, "a", 1), (1, "b", 2), (2, "a", 3)]))
    store.replace(name, trends(spark, [(1, "c", 9)]))
    store.replace(name, trends(spark, [(1, "c", 9)]))
    assert counts(store.read(name)) == {(1, "c"): 9, (2, "a"): 3}
    assert counts(store.read(name, [2, 77])) == {(2, "a"): 3}
    assert counts(store.read(name, range(2, 100))) == {(2, "a"): 3}
    assert [c for c, _ in store.read(name).dtypes] == list(TABLES[name].columns)


def test_a_hot_slot_is_written_by_several_tasks(spark, store):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64KB")
    try:
        rows = spark.range(0, 60_000, 1, 8).selectExpr(
            "cast(if(id % 10 = 0, 2, 1) as int) as dayslot", "uuid() as topic", "1L as count")
        store.replace(trends_name("world", "day"), rows)
    finally:
        spark.conf.set(key, before)
    written = store.stored(trends_name("world", "day")).where("dayslot = 1")
    assert written.count() == 54_000
    assert len(written.inputFiles()) > 2


def test_lookup_prunes_folders_and_pushes_the_place(spark, store):
    rows = spark.createDataFrame([(d, c, "t", 1) for d in (1, 2) for c in ("US", "DE")],
                                 "dayslot int, country string, topic string, count bigint")
    store.replace(trends_name("country", "day"), rows)
    found = serve.topics(store, "day", 1, "US")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dayslot=1" in plan or "PartitionFilters: [isnotnull(dayslot" in plan
    assert "EqualTo(country,US)" in plan
    assert counts(found) == {(1, "US", "t"): 1}


def test_retention_hides_and_then_drops(spark, store):
    name = trends_name("world", "hour")
    store.replace(name, trends(spark, [(H5, "a", 1)], "hourslot"), written_at=NOW)
    store.replace(name, trends(spark, [(H6, "a", 2)], "hourslot"), written_at=NOW + timedelta(hours=1))
    later = NOW + timedelta(days=1, minutes=30)
    assert counts(store.read(name, as_of=NOW + timedelta(hours=2))) == {(H5, "a"): 1, (H6, "a"): 2}
    assert counts(store.read(name, as_of=later)) == {(H6, "a"): 2}
    assert store.stored(name).count() == 2
    assert store.expire(name, later) == [f"hourslot={H5}"]
    assert counts(store.stored(name).select("hourslot", "topic", "count")) == {(H6, "a"): 2}
    day = trends_name("world", "day")
    store.replace(day, trends(spark, [(1, "a", 1)]), written_at=NOW)
    assert store.expire(day, NOW + timedelta(days=999)) == []


def test_hour_job_recounts_the_last_hours(spark, store):
    landed = run_dir(spark, "landed")
    land(spark, landed, [at(T0, "a", "a", "b"), at(T0 + HOUR, "c"), at(T0 + 9 * HOUR, "x"), at(T0)], "first")
    assert jobs.hour_job(store, landed, NOW) == [H5, H6]
    assert counts(store.read(trends_name("city", "hour"))) == {
        (H5, "US", "X", "a"): 2, (H5, "US", "X", "b"): 1, (H6, "US", "X", "c"): 1}
    before = counts(store.read(trends_name("world", "hour")))
    jobs.hour_job(store, landed, NOW)
    assert counts(store.read(trends_name("world", "hour"))) == before
    land(spark, landed, [at(T0 + 2 * HOUR, "late")], "second")
    assert jobs.hour_job(store, landed, NOW) == [H5, H6, H7]
    assert jobs.hour_job(store, landed, NOW, look_back=1) == [H7]
    assert counts(store.read(counts_name("hour")))[H5, "total"] == 2
    assert counts(serve.slot_totals(store, "hour", H5).selectExpr("hourslot", "trends as count")) == {(H5,): 2}


def test_a_slot_without_topics_any_more_is_emptied(spark, store):
    with_topic = frame(spark, [at(T0, "a"), at(T0 + HOUR, "b")]).selectExpr("value", f"{H5} as landing_hour")
    jobs.run_slots(store, with_topic, "hour", "landing_hour", [H5, H6])
    without = frame(spark, [at(T0)]).selectExpr("value", f"{H5} as landing_hour")
    jobs.run_slots(store, without, "hour", "landing_hour", [H5, H6])
    for level in ("city", "country", "world"):
        assert store.stored(trends_name(level, "hour")).count() == 0
        assert store.stored(top_name(level, "hour")).count() == 0
    assert counts(store.read(counts_name("hour"))) == {(H5, "total"): 1, (H5, "tagged"): 0, (H5, "trends"): 0}


def test_day_job_equals_the_roll_up_of_hours(spark, store):
    hourly, daily = run_dir(spark, "hourly"), run_dir(spark, "daily")
    land(spark, hourly, [at(T0 + h * HOUR, "a", f"t{h % 3}", city=f"c{h % 2}") for h in range(12)], "b0")
    jobs.hour_job(store, hourly, datetime(2015, 9, 18, tzinfo=timezone.utc), look_back=24)
    assert landing.compact_day(spark, hourly, daily, DAY) == 12
    assert jobs.day_job(store, daily, DAY) == [DAY]
    rolled = Store(spark, run_dir(spark, "rolled"))
    quiet = jobs.missing_hours(store, [DAY])
    assert len(quiet) == 12
    jobs.roll_up_days(store, [DAY], rolled, quiet=quiet)
    for level in ("world", "country", "city"):
        for name in (trends_name(level, "day"), top_name(level, "day")):
            assert counts(rolled.read(name)) == counts(store.read(name)) != {}


def test_a_day_whose_hours_expired_is_not_rolled_up(spark, store):
    lines = [at(T0 - 5 * HOUR + h * HOUR, "a") for h in range(24)]
    rows = frame(spark, lines).selectExpr("value", "0 as landing_hour")
    jobs.run_slots(store, rows, "hour", "landing_hour")
    jobs.roll_up_days(store, [DAY])
    whole = counts(store.read(trends_name("world", "day")))
    assert whole == {(DAY, "a"): 24}
    # Rows of the first three hours, as if written when these closed, are past their day at 05:15.
    morning = datetime(2015, 9, 18, 5, 15, tzinfo=timezone.utc)
    names = [trends_name(level, "hour") for level in ("world", "country", "city")] + [counts_name("hour")]
    for name in names:
        early = store.stored(name, [DAY * 100 + h for h in range(3)]).drop("written_at")
        copy = spark.createDataFrame(early.collect(), early.schema)
        store.replace(name, copy, written_at=morning - timedelta(days=1, hours=1))
    assert all(len(found) == 3 for found in jobs.expire_all(store, names, morning).values())
    with pytest.raises(ValueError, match="3 hours are not stored"):
        jobs.roll_up_days(store, [DAY])
    assert counts(store.read(trends_name("world", "day"))) == whole
    for name in names[:3]:
        store.drop_slots(name, [DAY * 100 + h for h in range(24)])
    jobs.roll_up_days(store, [DAY], quiet=range(DAY * 100, DAY * 100 + 24))
    assert counts(store.read(trends_name("world", "day"))) == {}


def test_the_first_topics_need_no_scan_of_all_slots(spark, store):
    name = trends_name("world", "day")
    store.replace(name, trends(spark, [(d, t, 1) for d in (1, 2, 3) for t in "ab"]))
    found = serve.topics(store, "day", limit=3)
    assert [(r.dayslot, r.topic) for r in found.collect()] == [(1, "a"), (1, "b"), (2, "a")]
    assert {f.split("dayslot=")[1][0] for f in found.inputFiles()} == {"1", "2"}
    assert store.slots(name) == [1, 2, 3]


def test_compaction_can_break_off_and_run_again(spark):
    hourly, daily = run_dir(spark, "hourly"), run_dir(spark, "daily")
    land(spark, hourly, [at(T0, "a"), at(T0 + HOUR, "b")], "b0")

    def compacted():
        return sorted(r.value for r in sources.landed_lines(spark, daily).collect())

    first = sorted(r.value for r in sources.landed_lines(spark, hourly).collect())
    assert landing.compact_day(spark, hourly, daily, DAY) == 2
    assert compacted() == first
    assert landing.compact_day(spark, hourly, daily, DAY) == 0
    # The hour folders come back, as if the drop had not happened, with a late line.
    land(spark, hourly, [at(T0, "a"), at(T0 + HOUR, "b")], "b0")
    land(spark, hourly, [at(T0, "late")], "b1")
    assert landing.compact_day(spark, hourly, daily, DAY) == 1
    assert len(compacted()) == 3
    assert sources.landed_lines(spark, hourly).count() == 0
    assert landing.compact_day(spark, hourly, daily, 20200101) == 0


def test_landed_slots_are_pruned(spark):
    root = run_dir(spark, "landed")
    land(spark, root, [at(T0, "a"), at(T0 + HOUR, "b"), at(T0 + 48 * HOUR, "c")], "b0")
    hours = sources.look_back(spark, root, NOW)
    assert hours.count() == 2
    plan = hours._jdf.queryExecution().executedPlan().toString()
    assert "landing_hour" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sources.landed_day(spark, root, DAY).count() == 2


def test_location_tables(spark, store):
    lines = frame(spark, [at(T0, "a", coordinates=[10, 20]), at(T0, "b", coordinates=[]),
                          at(T0, "c").replace("[1, 2]", "[NaN, 2]")])
    jobs.location_job(store, lines)
    assert [tuple(r) for r in store.read("tweet_locations_city").collect()] == [("US", "X", T0, 20.0, 10.0)]
    assert [tuple(r) for r in store.read("tweet_locations_country").collect()] == [("US", T0, 20.0, 10.0)]


def test_levels_of_a_lookup():
    assert [serve.resolve_level(*a) for a in ((), ("US",), ("US", "X"), ("", "X"), (None, "X"), ("US", ""))] == [
        "world", "country", "city", "world", "world", "country"]


def test_pages_and_lists(spark, store):
    lines = frame(spark, [at(T0, *"abc"), at(T0, "a", country="DE", city="Y"), at(T0, "a", city="Z")])
    for grain, slot in (("day", DAY), ("hour", H5)):
        landing_slot = f"landing_{grain}"
        jobs.run_slots(store, lines.selectExpr("value", f"{slot} as {landing_slot}"), grain, landing_slot)
    top, totals = serve.daily_page(store, NOW + timedelta(days=1))
    assert [(r.topic, r["count"]) for r in top.collect()] == [("a", 3), ("b", 1), ("c", 1)]
    assert tuple(totals.first()) == (DAY, 3, 3, 3)
    top, totals = serve.hourly_page(store, NOW - timedelta(hours=2))
    assert top.count() == 3 and totals.count() == 1
    assert serve.daily_page(store, NOW)[1].count() == 0
    assert counts(serve.top_topics(store, "day", DAY, "US", "Z")) == {(DAY, "US", "Z", "a"): 1}
    assert serve.trend_count(store, "day", DAY, "US").first()[0] == 3
    assert [r.topic for r in serve.topics(store, "day", DAY, limit=2).collect()] == ["a", "b"]
    assert [r.topic for r in serve.topics(store, "hour").collect()] == ["a", "b", "c"]
    assert [tuple(r) for r in serve.timeslots(store, "hour").collect()] == [(H5, "2015/09/17 05h")]
    assert [tuple(r) for r in serve.stats(store, "day").collect()] == [(DAY, 3, 3, 3, "2015/09/17")]


def test_text_and_gzip_sources(spark, tmp_path):
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    lines = frame(spark, [at(T0, "a"), "", at(T0, "b")]).coalesce(1)
    lines.write.text(plain)
    lines.write.option("compression", "gzip").text(packed)
    assert sources.text_lines(spark, [plain, packed]).count() == 6
    spread = sources.text_lines(spark, packed, 5)
    assert spread.rdd.getNumPartitions() == 5
    assert parse.parse_messages(sources.stamped(spread, H5, "landing_hour")).count() == 2


def test_dumps(spark, tmp_path):
    for fmt in ("json", "csv", "text"):
        path = str(tmp_path / fmt)
        dump.dump(trends(spark, [(1, "a", 2)]), path, fmt)
        assert "a" in spark.read.text(path).first().value
    with pytest.raises(ValueError):
        dump.dump(trends(spark, [(1, "a", 2)]), str(tmp_path / "x"), "nothing")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_broker_options():
    options = sources.broker_options("h:9092", ["t1", "t2"], max_per_trigger=10)
    assert options == {"kafka.bootstrap.servers": "h:9092", "subscribe": "t1,t2", "startingOffsets": "latest",
                       "maxOffsetsPerTrigger": "10"}
    assert sources.broker_options("h:9092", ["t"], NOW)["startingTimestamp"] == "1442477400000"
    with pytest.raises(ValueError):
        sources.broker_options("h:9092", [])
