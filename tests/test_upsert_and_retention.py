"""Row-level writes, retention from footers, lookups by topic, day summaries without lines."""

from datetime import datetime, timedelta, timezone

import pytest
from lines import T0, at, frame
from pyspark.sql import functions as F

from topicflow.operators import summary, topics
from topicflow.plans import jobs, serve
from topicflow.schema import TABLES, counts_name, live_messages_name, sketches_name, top_name, trends_name
from topicflow.session import run_dir
from topicflow.sinks import files
from topicflow.sinks.store import Store

HOUR = 3_600_000
NOW = datetime(2015, 9, 17, 8, 10, tzinfo=timezone.utc)
DAY, H5 = 20150917, 2015091705


@pytest.fixture
def store(spark):
    return Store(spark, run_dir(spark, "store"))


def day_rows(spark, rows):
    return spark.createDataFrame(rows, "dayslot int, country string, topic string, count bigint")


def found(rows):
    return sorted(map(tuple, rows.collect()), key=str)


def test_upsert_changes_some_keys_and_leaves_the_others(spark, store):
    name = trends_name("country", "day")
    store.replace(name, day_rows(spark, [(1, "US", "a", 1), (1, "US", "b", 2), (1, "DE", "a", 3), (2, "US", "a", 4), (3, None, "a", 5)]))
    more = day_rows(spark, [(1, "US", "b", 20), (1, "FR", "c", 6), (3, None, "a", 50), (4, "US", "a", 7), (4, "US", "a", 6)])
    want = sorted([(1, "US", "a", 1), (1, "US", "b", 20), (1, "DE", "a", 3), (2, "US", "a", 4), (3, None, "a", 50), (1, "FR", "c", 6), (4, "US", "a", 7)], key=str)
    for _ in range(2):
        store.upsert(name, more)
        assert found(store.read(name)) == want
    store.upsert(name, more.limit(0))
    assert found(store.read(name)) == want


def test_upsert_touches_only_its_folders(spark, store):
    name = trends_name("world", "day")
    store.replace(name, spark.createDataFrame([(d, "a", d) for d in range(1, 41)], "dayslot int, topic string, count bigint"))
    before = {f: files.children(spark, f"{store.path(name)}/dayslot={f}") for f in range(1, 41)}
    assert {f.rsplit("dayslot=")[1].split("/")[0] for f in store._in_folders(name, [7, 9, 99]).inputFiles()} == {"7", "9"}
    store.upsert(name, spark.createDataFrame([(7, "b", 1)], "dayslot int, topic string, count bigint"))
    after = {f: files.children(spark, f"{store.path(name)}/dayslot={f}") for f in range(1, 41)}
    assert {f for f in before if before[f] != after[f]} == {7}
    assert store.read(name).count() == 41


def test_upsert_keeps_the_age_of_rows_it_leaves(spark, store):
    name = trends_name("world", "hour")
    rows = lambda *r: spark.createDataFrame(r, "hourslot int, topic string, count bigint")
    store.replace(name, rows((H5, "a", 1), (H5, "b", 1)), written_at=NOW)
    store.upsert(name, rows((H5, "b", 2)), written_at=NOW + timedelta(hours=3))
    assert found(store.read(name, as_of=NOW + timedelta(days=1, hours=1))) == [(H5, "b", 2)]
    assert store.expire(name, NOW + timedelta(days=1, hours=1)) == []


def test_upsert_of_stream_tables_leaves_one_folder_a_slot(spark, store):
    name = live_messages_name("world")
    def rows(*r):
        return spark.createDataFrame(r, "secslot long, topic string, user string, time_ms long, tweet string, minuteslot long")
    store.upsert(name, rows((60, "a", "u", 1, "x", 5), (60, "b", "u", 2, "x", 5), (120, "c", "u", 1, "x", 6)), label="q-0")
    for label in ("q-1", "q-1", "q-2"):
        store.upsert(name, rows((60, "z", "u", 2, "y", 5)), label=label)
    assert found(store.stored(name).select("secslot", "time_ms", "topic")) == [(120, 1, "c"), (60, 1, "a"), (60, 2, "z")]
    assert files.children(spark, f"{store.path(name)}/minuteslot=5") == ["batch=q-2"]
    # As if a run broke off after it wrote and before it dropped the older folder.
    both = store.stored(name).where("minuteslot = 5").withColumn("batch", F.lit("q-3"))
    both = spark.createDataFrame(both.collect(), both.schema)
    both.write.mode("append").partitionBy("minuteslot", "batch").parquet(store.path(name))
    assert store.stored(name).count() == 5
    store.upsert(name, rows((60, "y", "u", 2, "y", 5)), label="q-3")
    assert found(store.stored(name).select("secslot", "time_ms", "topic")) == [(120, 1, "c"), (60, 1, "a"), (60, 2, "y")]
    with pytest.raises(ValueError, match="label"):
        store.upsert(name, rows((60, "y", "u", 2, "y", 5)))
    with pytest.raises(ValueError, match="no key"):
        store.upsert("tweet_locations_city", rows())


def test_retention_reads_footers_only(spark, store):
    name = trends_name("world", "hour")
    hours = spark.createDataFrame([(H5 + h, f"t{i}", i) for h in range(3) for i in range(50)], "hourslot int, topic string, count bigint")
    store.replace(name, hours.where(F.col("hourslot") == H5), written_at=NOW)
    store.replace(name, hours.where(F.col("hourslot") > H5), written_at=NOW + timedelta(hours=2))
    newest = store.newest_writes(name)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(written_at)]" in plan and "PushedGroupBy: [hourslot]" in plan
    assert {(r.hourslot, r.newest) for r in newest.collect()} == {
        (H5 + h, int((NOW + timedelta(hours=2 * (h > 0))).timestamp()) * 1_000_000) for h in range(3)}
    later = NOW + timedelta(days=1, hours=1)
    assert store.visible_slots(name, NOW) == [H5, H5 + 1, H5 + 2]
    assert store.visible_slots(name, later) == [H5 + 1, H5 + 2]
    assert store.expire(name, later) == [f"hourslot={H5}"] and store.expire(name, later) == []
    assert store.slots(name) == [H5 + 1, H5 + 2]
    # The user's own session keeps its settings.
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
    assert Store(spark, run_dir(spark, "none")).expire(name, later) == []


def test_slots_of_days_come_from_folder_names(spark, store):
    name = top_name("world", "day")
    store.replace(name, spark.createDataFrame([(DAY, "a", 1), (DAY + 1, "b", 2)], "dayslot int, topic string, count bigint"))
    rows = serve.timeslots(store, "day")
    assert [(r.dayslot, r.label) for r in rows.collect()] == [(DAY, "2015/09/17"), (DAY + 1, "2015/09/18")]
    assert not rows.inputFiles()
    with pytest.raises(ValueError, match="no folder per slot"):
        store.visible_slots(top_name("world", "minute"))


def read_rows(frame):
    """Rows that the scans of a frame gave."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    metrics = []

    def walk(node):
        if "Scan parquet" in node.nodeName():
            metrics.append(node.metrics().apply("numOutputRows").value())
        for child in (node.children().apply(i) for i in range(node.children().size())):
            walk(child)

    walk(plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan)
    return sum(metrics)


def test_a_lookup_of_an_absent_topic_reads_no_row_group(spark, store):
    name = trends_name("world", "day")
    store.replace(name, spark.range(0, 40_000, 2).selectExpr("20150917 as dayslot", "concat('t', lpad(id, 6, '0')) as topic", "id as count"))
    some = store.read(name, [DAY])
    assert read_rows(some.where(F.col("topic") == "t000100")) > 0
    # Inside the range of each file's topics, so only the filter tells.
    assert read_rows(some.where(F.col("topic") == "t000101")) == 0
    assert some.where(F.col("topic") == "t000100").count() == 1


def test_roll_up_writes_the_summary_of_the_day_job(spark, store):
    def slotted(rows, slot, name):
        return frame(spark, rows).selectExpr("value", f"{slot} as {name}")
    rows = [at(T0 - 5 * HOUR + h * HOUR, "all", f"t{h % 5}") for h in range(24)] + [at(T0)] * 3
    jobs.run_slots(store, slotted(rows, 0, "landing_hour"), "hour", "landing_hour")
    whole = Store(spark, run_dir(spark, "whole"))
    jobs.run_slots(whole, slotted(rows, 0, "landing_day"), "day", "landing_day")
    jobs.roll_up_days(store, [DAY])
    assert found(store.read(counts_name("day"))) == found(whole.read(counts_name("day"))) == sorted(
        [(DAY, "total", 27), (DAY, "tagged", 24), (DAY, "trends", 6)], key=str)
    # A day of which all hours are quiet has no summary.
    store.drop_slots(counts_name("hour"), [DAY * 100 + h for h in range(24)])
    for level in ("world", "country", "city"):
        store.drop_slots(trends_name(level, "hour"), [DAY * 100 + h for h in range(24)])
    jobs.roll_up_days(store, [DAY], quiet=range(DAY * 100, DAY * 100 + 24))
    assert found(store.read(counts_name("day"))) == []


def test_a_sketch_of_hours_is_within_its_bound(spark):
    """Hours share most topics, so their numbers do not add up; the merged sketches do."""
    base = spark.range(0, 60_000).selectExpr("cast(2015091700 + id % 6 as int) as hourslot", "concat('t', (id div 6) * 3 + id % 6 div 2) as topic")
    exact = base.select("topic").distinct().count()
    assert base.groupBy("hourslot").agg(F.countDistinct("topic").alias("n")).agg(F.sum("n")).first()[0] > 1.9 * exact
    hour_summary = spark.createDataFrame([(2015091700 + h, t, 10) for h in range(6) for t in ("total", "tagged", "trends")], "hourslot int, count_type string, count long")
    early = {r.count_type: r["count"] for r in summary.early_summary(hour_summary, summary.topic_sketches(base, "hour")).collect()}
    assert (early["total"], early["tagged"]) == (60, 60)
    assert abs(early["trends"] - exact) < 0.05 * exact


def test_early_figures_of_a_day(spark, store):
    rows = frame(spark, [at(T0 + h * HOUR, "all", f"t{h}") for h in range(3)]).selectExpr("value", "0 as landing_hour")
    jobs.run_slots(store, rows, "hour", "landing_hour")
    assert {r.count_type: r["count"] for r in jobs.early_day_summary(store, [DAY]).collect()} == {"total": 3, "tagged": 3, "trends": 4}
    assert store.stored(sketches_name("hour")).count() == 3


def test_every_table_with_a_key_has_its_columns():
    for table in TABLES.values():
        assert set(table.key) | set(table.lookup) <= set(table.columns)
        assert not table.key or table.partitions[0] in table.key or table.in_batches
    assert topics.trend_keys("city", "day") == list(TABLES[trends_name("city", "day")].key)


def test_compaction_switches_at_once_and_drops_later(spark, store, monkeypatch):
    name = live_messages_name("world")
    def write(label, minute, *times):
        rows = spark.createDataFrame([(60, f"t{t}", "u", t, "x", minute, label) for t in times], "secslot long, topic string, user string, time_ms long, tweet string, minuteslot long, batch string")
        store.replace(name, rows, n_rows=len(times))
    def rows():
        return sorted((r.minuteslot, r.time_ms) for r in store.stored(name).collect())
    for i in range(4):
        write(f"q-{i}", 5, 2 * i, 2 * i + 1)
    write("q-4", 6, 99)
    want = [(5, t) for t in range(8)] + [(6, 99)]
    folder = f"{store.path(name)}/minuteslot=5"
    assert rows() == want and len(files.children(spark, folder)) == 4

    # The run breaks off before the switch: nobody reads what it wrote.
    with monkeypatch.context() as broken:
        broken.setattr(files, "write_text", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            store.compact(name, [5, 6, 7])
    assert len(files.children(spark, folder)) == 5 and rows() == want
    under_way = store.stored(name)
    assert store.compact(name, [5, 6, 7]) == 1
    # Old folders are still there for lookups under way, and count no more.
    assert len(files.children(spark, folder)) == 5 and rows() == want
    assert under_way.count() == len(want)
    assert store.stored(name).where("minuteslot = 5").select(F.input_file_name()).distinct().count() == 1
    assert store.compact(name, [5, 6, 7]) == 0
    assert len(files.children(spark, folder)) == 1 and rows() == want
    # A late batch of the slot counts beside the merged folder, and merges with it.
    write("q-9", 5, 100)
    want = sorted(want + [(5, 100)])
    assert rows() == want and store.compact(name, [5]) == 1 and rows() == want
    store.upsert(name, spark.createDataFrame([(60, "new", "u", 0, "y", 5)], "secslot long, topic string, user string, time_ms long, tweet string, minuteslot long"), label="q-10")
    assert rows() == want and files.children(spark, folder) == ["batch=q-10"]
    with pytest.raises(ValueError, match="batches"):
        store.compact(trends_name("world", "day"), [1])


def test_a_stream_batch_is_few_files(spark, store):
    name = trends_name("world", "minute")
    rows = spark.range(0, 2000, 1, 8).selectExpr("202401150000 + id % 3 as minuteslot", "concat('t', id) as topic", "id as count", "2024011500 as hourslot", "'b' as batch")
    store.replace(name, rows, n_rows=2000)
    assert len(store.stored(name).inputFiles()) == 1
