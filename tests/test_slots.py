from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from topicflow.functions import slots

MS = 1442469035685


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize("zone, want", [
    ("UTC", (20150917, 2015091705, 201509170550)),
    ("America/New_York", (20150917, 2015091701, 201509170150)),
])
def test_slots_do_not_depend_on_the_session_zone(spark, zone, want):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            assert one(spark, *slots.slot_columns(F.lit(MS), zone)) == want
            back = spark.range(1).select(slots.wall_clock(F.lit(MS)).alias("w")).select(slots.epoch_ms("w"))
            assert back.first()[0] == MS
            assert one(spark, slots.date_time_text(F.lit(MS))) == ("2015-09-17 05:50:35",)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_slot_types(spark):
    frame = spark.range(1).select(*slots.slot_columns(F.lit(MS)))
    assert frame.dtypes == [("dayslot", "int"), ("hourslot", "int"), ("minuteslot", "bigint")]


def test_labels(spark):
    labels = [slots.slot_label(F.lit(v), g) for g, v in
              (("day", 20150917), ("hour", 2015091705), ("minute", 201509170550))]
    assert one(spark, *labels) == ("2015/09/17", "2015/09/17 05h", "2015/09/17 05:50")


def test_buckets(spark):
    assert one(spark, *[slots.bucket_slot(F.lit(MS), m) for m in (30, 15, 1)]) == (
        201509170530, 201509170545, 201509170550)
    with pytest.raises(ValueError):
        slots.bucket_slot(F.lit(MS), 7)


def test_relative_slots():
    now = datetime(2024, 3, 1, 0, 30, tzinfo=timezone.utc)
    assert slots.yesterday(now) == 20240229
    assert slots.previous_hours(now) == [2024022923, 2024022922, 2024022921]
    assert slots.now_slot(now, "minute", timedelta(minutes=2)) == 202403010028
    assert slots.now_slot(now, "hour", zone="America/New_York") == 2024022919
    assert slots.minute_of_second(1442469035) == 201509170550
    with pytest.raises(ValueError):
        slots.now_slot(datetime(2024, 3, 1), "day")
