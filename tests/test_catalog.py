"""The store in SQL."""

import re
from datetime import datetime, timezone

import pytest
from lines import T0, at, frame

from topicflow.plans import catalog, jobs, serve
from topicflow.schema import TABLES
from topicflow.session import run_dir
from topicflow.sinks.store import Store

HOUR = 3_600_000
NOW = datetime(2015, 9, 18, 6, 0, tzinfo=timezone.utc)
DAY, H5 = 20150917, 2015091705


@pytest.fixture(scope="module")
def store(spark):
    store = Store(spark, run_dir(spark, "store"))
    lines = [at(T0 + h * HOUR, "all", f"t{h % 3}", city=f"c{h % 2}", country="US" if h % 3 else "DE") for h in range(-20, 12)]
    for grain in ("day", "hour"):
        jobs.run_slots(store, frame(spark, lines).selectExpr("value", f"0 as landing_{grain}"), grain, f"landing_{grain}")
    assert set(catalog.register(store)) >= {"top_topics", "slot_totals", "live_messages"}
    return store


def rows(found, *columns):
    return sorted(tuple(r[c] for c in columns) for r in found.collect())


@pytest.mark.parametrize("place", [(), ("US",), ("US", "c1"), ("", "c1"), ("US", ""), ("XX",)])
def test_functions_equal_the_lookups(spark, store, place):
    args = "".join(f", '{p}'" for p in place)
    for grain, slot in (("day", DAY), ("hour", H5)):
        named = dict(zip(("country", "city"), place))
        assert rows(spark.sql(f"SELECT * FROM top_topics('{grain}', {slot}{args})"), "topic", "count") == rows(serve.top_topics(store, grain, slot, **named), "topic", "count")
        assert rows(spark.sql(f"SELECT * FROM slot_topics('{grain}', {slot}{args})"), "topic", "count") == rows(
            serve.topics(store, grain, slot, limit=1000, **named), "topic", "count")
        assert rows(spark.sql(f"SELECT * FROM topic_count('{grain}', {slot}{args})"), "count") == rows(serve.trend_count(store, grain, slot, **named), "count")


def test_totals_and_slots(spark, store):
    assert rows(spark.sql(f"SELECT * FROM slot_totals('day', {DAY})"), "total", "tagged", "trends") == rows(
        serve.slot_totals(store, "day", DAY), "total", "tagged", "trends")
    assert spark.sql("SELECT * FROM slot_totals('day', 20990101)").count() == 0
    assert rows(spark.sql("SELECT * FROM timeslots('hour')"), "slot") == rows(serve.timeslots(store, "hour"), "hourslot")
    assert spark.sql("SELECT * FROM timeslots('century')").count() == 0


def test_a_lookup_prunes_to_one_folder_of_one_table(spark, store):
    found = spark.sql(f"SELECT * FROM top_topics('day', {DAY}, 'US')")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<country:string,topic:string,count:bigint>" in plan
    assert re.search(rf"PartitionFilters: \[[^\]]*dayslot#\d+ = {DAY}", plan) and "EqualTo(country,US)" in plan


def test_views_show_the_public_columns_and_partitions(spark, store):
    for name, table in TABLES.items():
        assert spark.table(name).columns == [*table.columns, *[p for p in table.partitions if p not in table.columns]]


def test_live_functions(spark):
    live = Store(spark, run_dir(spark, "live"))
    live.replace("rt_tweet_country", spark.createDataFrame(
        [(5, "US", "a", "u", t, "x", 8, "b0") for t in range(12)] + [(5, "DE", "b", "u", 1, "x", 8, "b0"), (6, "US", "b", "u", 1, "x", 8, "b0")],
        "secslot long, country string, topic string, user string, time_ms long, tweet string, minuteslot long, batch string"))
    catalog.register(live)
    assert rows(spark.sql("SELECT * FROM live_messages(8, 5, '', 'US')"), "time_ms") == [(t,) for t in range(10)]
    assert spark.sql("SELECT * FROM live_messages(8, 5, 'b', 'US')").count() == 0
    assert rows(spark.sql("SELECT * FROM live_messages(8, 5, NULL, 'DE')"), "topic") == [("b",)]
    assert spark.sql("SELECT * FROM live_locations(8, 5)").columns == ["country", "city", "time_ms", "latitude", "longitude"]
    assert catalog.live_slots(NOW) == (201509180559, int(NOW.timestamp()) - 60)
