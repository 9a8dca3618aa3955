import json
import time
from collections import Counter
from datetime import datetime, timedelta

import pytest
from lines import T0, at, frame
from pyspark.sql import functions as F

from topicflow.operators import live, parse, topics
from topicflow.plans import queries, serve
from topicflow.schema import top_name, trends_name
from topicflow.session import run_dir, shared_dir
from topicflow.sinks import files, publish
from topicflow.sinks.store import Store
from topicflow.sources import lines as sources
from topicflow.streaming import landing, minutes
from topicflow.streaming import live as live_stream
from topicflow.streaming.batches import run_available, staged, state_partitions

MINUTE = 60_000
M0 = T0 // MINUTE * MINUTE


class Feed:
    """One file per micro-batch, read in the order written."""

    def __init__(self, spark, tmp_path):
        self.spark, self.folder, self.n = spark, tmp_path / "feed", 0
        self.folder.mkdir()

    def put(self, *lines):
        (self.folder / f"{self.n:03d}.txt").write_text("\n".join(lines) + "\n")
        self.n += 1
        time.sleep(0.02)

    def lines(self, files=1):
        return sources.file_stream(self.spark, str(self.folder), files_per_batch=files)

    def messages(self):
        return parse.parse_messages(self.lines())


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


@pytest.fixture
def store(spark):
    return Store(spark, run_dir(spark, "store"))


def counted(rows, *keys):
    out = Counter()
    for r in rows.collect():
        out[tuple(r[k] for k in keys)] += r["count"]
    return out


def sample():
    return [at(M0 + i * 7000, f"t{i % 3}", "all", country="US" if i % 2 else "DE", city=f"c{i % 4}") for i in range(40)]


def flush():
    return at(M0 + 1000 * MINUTE, "flush")


def test_stream_equals_batch_and_survives_restarts(spark, feed, store):
    checkpoint, lines = run_dir(spark, "checkpoint"), sample()
    for part in (lines[:15], lines[15:30], lines[30:], [flush()], [flush()]):
        feed.put(*part)
        run_available(minutes.minute_writer(feed.messages(), store, checkpoint, world_k=None))
    batch = topics.explode_topics(parse.parse_messages(frame(spark, lines)))
    for level in ("city", "country", "world"):
        want = topics.trend_counts(batch, level, "minute")
        keys = [c for c in want.columns if c != "count"]
        assert counted(store.stored(trends_name(level, "minute")), *keys) == counted(want, *keys)


def test_one_operator_form_gives_the_same_levels(spark, feed):
    lines, out = sample(), run_dir(spark, "levels")
    for part in (lines, [flush()], [flush()]):
        feed.put(*part)
    run_available(minutes.minute_counts_all_levels(feed.messages()).writeStream.format("parquet")
                  .option("path", out).option("checkpointLocation", run_dir(spark, "checkpoint")))
    batch = topics.explode_topics(parse.parse_messages(frame(spark, lines)))
    keys = ("level", "minuteslot", "country", "city", "topic")
    minute = batch.withColumn("dayslot", F.col("minuteslot"))
    want = topics.trend_counts_all_levels(minute, "day").withColumnRenamed("dayslot", "minuteslot")
    assert counted(spark.read.parquet(out), *keys) == counted(want, *keys)


def test_late_rows_are_dropped_and_world_is_cut(spark, feed, store):
    feed.put(*[at(M0, f"w{i:02d}") for i in range(30)])
    feed.put(at(M0 + 5 * MINUTE, "b"))
    feed.put(at(M0 + 6 * MINUTE, "c"))
    feed.put(at(M0, "late"))
    feed.put(flush())
    feed.put(flush())
    run_available(minutes.minute_writer(feed.messages(), store, run_dir(spark, "checkpoint")))
    world = store.stored(trends_name("world", "minute"))
    assert world.where(F.col("topic") == "late").count() == 0
    assert world.where(F.col("topic").startswith("w")).count() == 20
    assert store.stored(trends_name("city", "minute")).where(F.col("topic").startswith("w")).count() == 30
    assert store.stored(top_name("country", "minute")).where(F.col("topic").startswith("w")).count() == 20
    assert {r.topic for r in world.where(~F.col("topic").startswith("w")).collect()} == {"b", "c"}


def test_a_message_of_the_future_holds_nothing_up(spark, feed, store):
    checkpoint, lines = run_dir(spark, "checkpoint"), sample()
    clock = M0 + 30 * MINUTE

    def run(now):
        run_available(minutes.minute_writer(feed.messages(), store, checkpoint, world_k=None, clock=F.timestamp_millis(F.lit(now))))

    feed.put(*lines[:10], at(4_102_444_800_000, "future"))
    run(M0 + 2 * MINUTE)
    feed.put(*lines[10:20])
    feed.put(*lines[20:], at(clock - 5 * MINUTE, "x"))
    run(clock)
    for _ in range(2):
        feed.put(at(4_102_444_800_000, "end"))
        run(clock + 60 * MINUTE)
    found = counted(store.stored(trends_name("world", "minute")), "topic")
    batch = topics.explode_topics(parse.parse_messages(frame(spark, lines)))
    assert {k: n for k, n in found.items() if k[0] not in ("future", "x", "end")} == counted(topics.trend_counts(batch, "world", "day"), "topic")
    future = store.stored(trends_name("world", "minute")).where(F.col("topic") == "future").collect()
    assert [r.minuteslot for r in future] == [201509170552]


def test_a_feed_over_two_months_loses_nothing(spark, tmp_path, monkeypatch):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for name in ("nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    moved = F.when(F.col("event_id") % 2 == 0, F.col("ts") + F.expr("interval 31 days")).otherwise(F.col("ts"))
    source.withColumn("ts", moved.cast("timestamp_ntz")).write.parquet(str(tmp_path / "events.parquet"))
    got = counted(queries.stream_minute_all_levels(spark, str(tmp_path)).where("topic <> 'flush'"), "level", "minuteslot", "country", "city", "topic")
    want = Counter()
    for level in ("world", "country", "city"):
        for r in queries.registry()[f"trends_{level}_minute"](spark, str(tmp_path)).collect():
            d = r.asDict()
            want[(level, d["minuteslot"], d.get("country"), d.get("city"), d["topic"])] += d["count"]
    assert got == want


def test_ticks_of_one_minute_add_up_before_the_cut(spark, feed, store):
    checkpoint, clock = run_dir(spark, "checkpoint"), F.timestamp_millis(F.lit(M0))
    for part in ("aaabb", "cccbb"):
        feed.put(*[at(M0, t) for t in part])
        run_available(minutes.tick_writer(feed.messages(), store, checkpoint, k=1, world_k=1, within_ms=None, clock=clock))
    assert counted(store.stored(trends_name("world", "minute")), "topic") == {("b",): 4}
    assert counted(store.stored(top_name("country", "minute")), "country", "topic") == {("US", "b"): 4}
    assert counted(store.stored(trends_name("city", "minute")), "topic") == {("a",): 3, ("b",): 4, ("c",): 3}
    assert store.stored(trends_name("city", "minute")).count() == 3


def test_ticks_count_what_arrived(spark, feed, store):
    for part in (["a", "b"], ["a"], ["c"]):
        feed.put(*[at(M0, t) for t in part])
    writer = minutes.tick_writer(feed.messages(), store, run_dir(spark, "checkpoint"), within_ms=None)
    run_available(writer)
    assert counted(store.stored(trends_name("country", "minute")), "country", "topic") == {
        ("US", "a"): 2, ("US", "b"): 1, ("US", "c"): 1}


def test_ticks_drop_old_messages(spark, feed, store):
    now = int(time.time() * 1000)
    feed.put(at(now, "new"), at(now - 10 * MINUTE, "old"))
    run_available(minutes.tick_writer(feed.messages(), store, run_dir(spark, "checkpoint")))
    assert counted(store.stored(trends_name("world", "minute")), "topic") == {("new",): 1}


def test_recent_boundary(spark):
    messages = parse.parse_messages(frame(spark, [at(M0, "edge"), at(M0 - 1, "old")]))
    assert [r.topic for r in minutes.split(messages, M0 + MINUTE).collect()] == ["edge"]


def test_live_rows_and_lookups(spark, feed, store):
    feed.put(at(M0, "a", "b", coordinates=[10, 20]), at(M0 + 1, "a", country="DE", city="Y", coordinates=[]))
    feed.put(at(M0 + 2, "c", coordinates=[11, 21]))
    clock = F.lit(M0)
    run_available(live_stream.live_writer(feed.messages(), store, run_dir(spark, "checkpoint"), now_ms=clock))
    from datetime import datetime, timedelta, timezone
    asked = datetime.fromtimestamp(M0 // 1000, timezone.utc) + timedelta(seconds=60)
    rows = serve.live_messages(store, asked).collect()
    assert [(r.topic, r.user, r.tweet) for r in rows] == [
        ("a", "nine", "t"), ("b", "nine", "t"), ("a", "nine", "t"), ("c", "nine", "t")]
    assert [r.time_ms for r in serve.live_messages(store, asked, "a", "US", "X").collect()] == [M0]
    assert serve.live_messages(store, asked + timedelta(seconds=1)).count() == 0
    assert {(r.latitude, r.longitude) for r in serve.live_locations(store, asked).collect()} == {(20.0, 10.0), (21.0, 11.0)}
    assert serve.live_locations(store, asked, "DE").count() == 0
    assert serve.live_locations(store, asked, "US", "X").columns == ["country", "city", "time_ms", "latitude", "longitude"]


def test_last_write_wins(spark, feed, store):
    feed.put(at(M0, "a", "b", id_str="1"), at(M0, "c", "d", id_str="2"))
    run_available(live_stream.live_writer(
        feed.messages(), store, run_dir(spark, "checkpoint"), ("world",), now_ms=F.lit(M0), last_write_wins=True))
    assert [r.topic for r in store.stored("rt_tweet_world").collect()] == ["d"]
    assert store.stored("rt_tweet_locations_world").count() == 1


def test_the_last_write_wins_across_batches_and_restarts(spark, feed, store):
    checkpoint = run_dir(spark, "checkpoint")

    def run(now=M0):
        run_available(live_stream.last_write_writer(feed.messages(), store, checkpoint, within_ms=None, now_ms=F.lit(now)))

    def rows(name, *columns):
        return sorted(tuple(r) for r in store.stored(name).select("time_ms", *columns).collect())

    feed.put(at(M0, "a", "b", id_str="9", coordinates=[1, 2]), at(M0 + 1, "x", id_str="3"))
    run()
    feed.put(at(M0, "c", id_str="10", coordinates=[3, 4]), at(M0, "old", id_str="8", coordinates=[9, 9]), at(M0 + 2, "y", id_str="4", country="DE"))
    feed.put(at(M0 + 1, "w", "z", id_str="30", country="FR"), at(M0 + 1, "v", id_str="20"))
    run()
    for level, place in (("world", ()), ("country", ("country",)), ("city", ("country", "city"))):
        wheres = {(): [(), (), ()], ("country",): [("US",), ("FR",), ("DE",)], ("country", "city"): [("US", "X"), ("FR", "X"), ("DE", "X")]}[place]
        assert rows(f"rt_tweet_{level}", "topic", *place) == [(M0, "c", *wheres[0]), (M0 + 1, "z", *wheres[1]), (M0 + 2, "y", *wheres[2])]
        assert rows(f"rt_tweet_locations_{level}", "lat", "long")[0] == (M0, 4.0, 3.0)
    run()  # nothing new
    assert len(rows("rt_tweet_world")) == 3
    # Another second is another key; the watermark lets go of the first one.
    feed.put(at(M0, "later", id_str="1"))
    run(M0 + 3_600_000)
    feed.put(at(M0 + 7, "last", id_str="2"))
    run(M0 + 3_600_000)
    assert [r.topic for r in store.stored("rt_tweet_world").where(f"secslot = {(M0 + 3_600_000) // 1000}").orderBy("time_ms").collect()] == ["later", "last"]


def test_one_pass_gives_the_rows_of_both_kinds(spark):
    messages = parse.parse_messages(frame(spark, [
        at(M0, "a", "b", coordinates=[1, 2]), at(M0 + 1, coordinates=[1, 2]), at(M0 + 2, "c", coordinates=[]), at(M0 + 3, coordinates=[1])]))
    second = F.lit(5).cast("long")
    both = live.entries(messages, second, "t_id")
    for kind, wanted in (("location", live.live_locations(messages, "city", second)), ("message", live.live_messages(messages, "city", second))):
        got = both.where(F.col("kind") == kind).select(*wanted.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect())) != []


@pytest.mark.parametrize("once", [True, False])
def test_a_replayed_part_counts_once_if_asked(spark, feed, store, once):
    checkpoint, lines = run_dir(spark, "checkpoint"), [at(M0 + i * 1000, f"t{i % 3}", id_str=str(i)) for i in range(30)]
    for part in (lines[:20], lines[:20], lines[10:], [at(M0 + 100 * MINUTE, "f", id_str="f1")], [at(M0 + 200 * MINUTE, "f", id_str="f2")], [at(M0 + 300 * MINUTE, "f", id_str="f3")]):
        feed.put(*part)
        run_available(minutes.minute_writer(feed.messages(), store, checkpoint, lateness="5 minutes", world_k=None, once=once))
    times = 1 if once else 2
    found = counted(store.stored(trends_name("city", "minute")).where("topic <> 'f'"), "topic")
    assert sum(found.values()) == (30 if once else 60)
    assert not once or found == {("t0",): 10 * times, ("t1",): 10 * times, ("t2",): 10 * times}


def small_tables(spark, folder, n=60):
    """Events of two days, in order of time, with the two tables of places."""
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=45 * i), 100 + i % 9, ("view", "click")[i % 2], f'{{"k": {i % 4}}}') for i in range(n)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string").coalesce(1).write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame([(i, f"N{i}", i % 2) for i in range(25)], "n_nationkey int, n_name string, n_regionkey int").coalesce(1).write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(0, "A"), (1, "B")], "r_regionkey int, r_name string").coalesce(1).write.parquet(f"{folder}/region.parquet")
    return str(folder)


def test_a_replayed_feed_keeps_its_state_on_disk_and_the_session_its_own_store(spark, tmp_path, monkeypatch):
    ran, run = [], queries.run_available
    monkeypatch.setattr(queries, "run_available", lambda *a, **k: ran.append(run(*a, **k)))
    provider, in_memory = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    untracked = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    tables, before = small_tables(spark, tmp_path), spark.conf.get(provider)
    spark.conf.set(provider, in_memory)
    try:
        got = counted(queries.stream_replayed(spark, tables), "minuteslot", "country", "city", "topic")
        assert spark.conf.get(provider) == in_memory and spark.conf.get(untracked, None) is None
    finally:
        spark.conf.set(provider, before)
    want = counted(queries.registry()["trends_city_minute"](spark, tables), "minuteslot", "country", "city", "topic")
    assert got == want and sum(got.values()) > 60
    states = [json.loads(p.json)["stateOperators"] for query in ran for p in query.recentProgress]
    assert len(ran) == 7 and all(states)
    assert all("rocksdbCommitFlushLatency" in operator["customMetrics"] for batch in states for operator in batch)


def test_the_parts_of_a_feed_lie_in_files_of_few_lines(spark, monkeypatch):
    monkeypatch.setattr(queries, "FEED_ROWS", 10)
    lines = spark.createDataFrame([(x,) for x in sample()], "value string").coalesce(1)
    out, sizes = run_dir(spark, "out"), []

    def start(feed, checkpoint, now):
        def write(batch, batch_id):
            sizes.append(sorted(r["count"] for r in batch.groupBy(F.input_file_name()).count().collect()))
            batch.write.mode("append").parquet(out)
        return feed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)

    queries._feed(spark, start, [(lines, queries.NOW), (lines.limit(15), queries.NOW)])
    assert sizes == [[10] * 4, [5, 10]]
    assert Counter(r.value for r in spark.read.parquet(out).collect()) == Counter(sample()) + Counter(sample()[:15])


def test_landing_counts_its_lines_and_refuses_too_many_malformed(spark, feed):
    told, root, checkpoint = [], run_dir(spark, "landed"), run_dir(spark, "checkpoint")

    def pull(**options):
        run_available(landing.landing_writer(feed.lines(), root, checkpoint, oldest_days=None, on_counts=lambda *x: told.append(x), **options))

    feed.put(at(M0, "a"), "junk", at(M0, "b"), at(M0, "c"))
    feed.put(at(M0, "d"))
    pull(max_rejects=0.25)
    assert told == [(0, 4, 1), (1, 1, 0)]
    feed.put("junk", at(M0, "e"))
    with pytest.raises(Exception, match="1 of 2 lines of batch 2 are malformed"):
        pull(max_rejects=0.25)
    assert sources.landed_lines(spark, root).count() == 5
    pull(max_rejects=0.5)  # the same batch again
    assert told[2:] == [(2, 2, 1)] * 2 and sources.landed_lines(spark, root).count() == 7


def test_a_capped_backlog_lands_in_several_batches(spark, feed):
    root = run_dir(spark, "landed")
    for i in range(5):
        feed.put(at(M0, f"t{i}"))
    run_available(landing.landing_writer(feed.lines(2), root, run_dir(spark, "checkpoint"), oldest_days=None))
    rows = sources.landed_lines(spark, root)
    assert rows.count() == 5 and rows.select("batch").distinct().count() == 3


def test_the_last_write_is_that_of_the_largest_number(spark):
    rows = spark.createDataFrame([(1, 5, "a", "9"), (1, 5, "b", "10"), (1, 5, "c", "2"), (1, 6, "d", "x"), (1, 6, "e", "7"), (1, 7, "f", "y"), (1, 7, "g", "z")],
                                 "secslot long, time_ms long, topic string, id string")
    assert {r.time_ms: r.topic for r in live.last_write_wins(rows, ["id"]).collect()} == {5: "b", 6: "e", 7: "g"}


def test_state_partitions_follow_the_cores_and_the_session_keeps_its_own(spark, feed):
    feed.put(*sample())
    before, checkpoint = spark.conf.get("spark.sql.shuffle.partitions"), run_dir(spark, "checkpoint")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        run_available(minutes.minute_counts(feed.messages()).writeStream.format("parquet").option("path", run_dir(spark, "out"))
                      .option("checkpointLocation", checkpoint), spark)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
        with state_partitions(spark) as n:
            assert n == 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    folders = files.children(spark, f"{checkpoint}/state/0")
    assert len([f for f in folders if f.isdigit()]) == 2 * spark.sparkContext.defaultParallelism


def test_tables_of_a_stateful_batch_are_written_from_files(spark, feed, store, monkeypatch):
    seen, replace, upsert = [], Store.replace, Store.upsert
    monkeypatch.setattr(Store, "replace", lambda self, name, rows, *a, **k: (seen.append(rows.inputFiles()), replace(self, name, rows, *a, **k)))
    monkeypatch.setattr(Store, "upsert", lambda self, name, rows, *a, **k: (seen.append(rows.inputFiles()), upsert(self, name, rows, *a, **k)))
    feed.put(*sample())
    feed.put(flush())
    feed.put(flush())
    run_available(minutes.minute_writer(feed.messages(), store, run_dir(spark, "checkpoint"), world_k=None))
    run_available(live_stream.last_write_writer(feed.messages(), store, run_dir(spark, "checkpoint"), within_ms=None, now_ms=F.lit(M0)))
    assert len(seen) >= 12 and all(seen)
    assert not [f for f in files.children(spark, shared_dir(spark)) if f.startswith("batch-")]


def test_a_staged_frame_is_read_back_and_dropped(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x long, y string")
    with staged(rows, spark) as back:
        assert back.schema == rows.schema and sorted(back.collect(), key=str) == sorted(rows.collect(), key=str)
        folder = back.inputFiles()[0].rsplit("/", 1)[0]
        assert files.exists(spark, folder)
    assert not files.exists(spark, folder)


def test_lines_of_a_feed_are_made_once(spark, tmp_path, monkeypatch):
    made, lines = [], queries.adapter.envelope_lines
    monkeypatch.setattr(queries.adapter, "envelope_lines", lambda *a: made.append(a) or lines(*a))
    with queries._made_lines(spark, "/root/testdata/sf0.001") as found:
        want = lines(spark, "/root/testdata/sf0.001")
        assert "to_json" not in found._jdf.queryExecution().toString()
        assert Counter(found.collect()) == Counter(want.collect()) and len(made) == 1


def test_landing_by_event_hour(spark, feed):
    root, checkpoint = run_dir(spark, "landed"), run_dir(spark, "checkpoint")
    now = F.lit(M0 + 2 * 3_600_000)

    def pull(**options):
        run_available(landing.landing_writer(feed.lines(), root, checkpoint, now_ms=now, **options))

    feed.put(at(M0, "a"), "junk", at(M0 - 4 * 86_400_000, "too old"))
    pull()
    feed.put(at(M0, "b"))
    pull()
    pull()
    found = Counter((r.landing_day, r.landing_hour) for r in sources.landed_lines(spark, root).collect())
    assert found == {(20150917, 2015091705): 2, (20150917, 2015091707): 1}


def test_landing_error_policies(spark, feed):
    root, rejects = run_dir(spark, "landed"), run_dir(spark, "rejects")
    feed.put(at(M0, "a"), "junk")

    def writer(**options):
        return landing.landing_writer(feed.lines(), root, run_dir(spark, "checkpoint"), oldest_days=None, **options)

    run_available(writer(on_error="reject", rejects=rejects))
    assert sources.landed_lines(spark, root).count() == 1
    assert sources.landed_lines(spark, rejects).first().value == "junk"
    with pytest.raises(Exception, match="malformed message line"):
        run_available(writer(on_error="fail"))
    with pytest.raises(ValueError):
        writer(on_error="reject")


def test_landing_as_gzip_text(spark, feed):
    root = run_dir(spark, "landed")
    feed.put(at(M0, "a"))
    run_available(landing.landing_writer(
        feed.lines(), root, run_dir(spark, "checkpoint"), fmt="text", oldest_days=None))
    rows = sources.landed_hours(spark, root, [2015091705], "text")
    assert parse.parse_messages(rows).count() == 1


def test_publish_and_allow_list(spark, feed, tmp_path):
    feed.put(at(M0, "a"), at(M0, "b"))
    out = str(tmp_path / "out")
    run_available(publish.publish_stream(feed.lines(), {"path": out}, run_dir(spark, "checkpoint"), "text"))
    assert spark.read.text(out).count() == 2
    publish.publish(frame(spark, [at(M0, "c")]), {"path": str(tmp_path / "out2")}, "text")
    assert spark.read.text(str(tmp_path / "out2")).count() == 1
    records = spark.createDataFrame([("x", "t1"), ("y", "t2")], "value string, topic string")
    assert [r.value for r in sources.allowed_topics(records, ["t2"]).collect()] == ["y"]


def test_no_python_in_the_stateful_plan(spark, feed):
    feed.put(at(M0, "a"))
    batch_form = live.live_messages(parse.parse_messages(frame(spark, [at(M0, "a")])), "world")
    assert "EvalPython" not in batch_form._jdf.queryExecution().executedPlan().toString()
    assert minutes.minute_counts(feed.messages()).isStreaming
