"""Time slots: calendar integers such as 20150917, 2015091705, 201509170550.

Every function takes the zone explicitly, so a slot never depends on the zone of
the machine or of the session.  Slots are integer arithmetic on date fields, which
stays inside generated code; no date is formatted and parsed back.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicflow.schema import GRAIN_SLOT

UTC = "UTC"
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"

# The slot layouts, as format patterns for driver-side clocks.
SLOT_FORMAT = {"day": "%Y%m%d", "hour": "%Y%m%d%H", "minute": "%Y%m%d%H%M"}


def wall_clock(time_ms: Column, zone: str = UTC) -> Column:
    """Epoch milliseconds as the zone's wall-clock time (timestamp_ntz)."""
    utc = F.timestamp_add("MILLISECOND", time_ms, F.expr(_EPOCH))
    return utc if zone == UTC else F.convert_timezone(F.lit(UTC), F.lit(zone), utc)


def epoch_ms(wall: str) -> Column:
    """A column of UTC wall-clock times (timestamp_ntz) as epoch milliseconds, rounded
    down.  Built from the fields, because a timestamp difference would first convert
    to the session zone."""
    return F.expr(f"(unix_date(cast({wall} as date)) * 86400L + hour({wall}) * 3600 + minute({wall}) * 60) * 1000 "
                  f"+ floor(extract(second from {wall}) * 1000)")


def instant(time_ms: Column) -> Column:
    """Epoch milliseconds as a timestamp, for watermarks and windows."""
    return F.timestamp_millis(time_ms)


def _slots_of(wall: Column) -> dict[str, Column]:
    day = F.year(wall) * 10000 + F.month(wall) * 100 + F.dayofmonth(wall)
    hour = day * 100 + F.hour(wall)
    return {"day": day, "hour": hour, "minute": hour.cast("bigint") * 100 + F.minute(wall)}


def slot_of(wall: Column, grain: str) -> Column:
    """The calendar integer of a wall-clock time."""
    return _slots_of(wall)[grain]


def slot(time_ms: Column, grain: str, zone: str = UTC) -> Column:
    return slot_of(wall_clock(time_ms, zone), grain)


def slot_columns(time_ms: Column, zone: str = UTC) -> list[Column]:
    """All three slot columns, named as in the tables."""
    found = _slots_of(wall_clock(time_ms, zone))
    return [found[grain].alias(name) for grain, name in GRAIN_SLOT.items()]


def bucket_slot(time_ms: Column, minutes: int, zone: str = UTC) -> Column:
    """Minute slot at the start of a bucket of `minutes` (a divisor of 60)."""
    if minutes <= 0 or 60 % minutes:
        raise ValueError("a bucket must divide the hour")
    minute = slot(time_ms, "minute", zone)
    return (minute - F.pmod(F.pmod(minute, F.lit(100)), F.lit(minutes))).cast("bigint")


def date_time_text(time_ms: Column, zone: str = UTC) -> Column:
    """`yyyy-MM-dd HH:mm:ss`; the milliseconds are dropped."""
    return wall_clock(time_ms - F.pmod(time_ms, F.lit(1000)), zone).cast("string")


def second_slot(ts: Column) -> Column:
    """Epoch seconds of a timestamp."""
    return F.unix_seconds(ts)


def day_of_hour(hourslot: Column) -> Column:
    """The day slot an hour slot belongs to."""
    return F.floor(hourslot / F.lit(100)).cast("int")


def slot_label(slot_col: Column, grain: str) -> Column:
    """`2015/09/17`, `2015/09/17 05h` or `2015/09/17 05:50`."""
    text = slot_col.cast("string")
    day = F.concat_ws("/", text.substr(1, 4), text.substr(5, 2), text.substr(7, 2))
    if grain == "day":
        return day
    if grain == "hour":
        return F.concat(day, F.lit(" "), text.substr(9, 2), F.lit("h"))
    return F.concat(day, F.lit(" "), text.substr(9, 2), F.lit(":"), text.substr(11, 2))


def now_slot(now: datetime, grain: str, back: timedelta = timedelta(0), zone: str = UTC) -> int:
    """The slot of `now - back`; `now` must carry its zone."""
    if now.tzinfo is None:
        raise ValueError("now needs a time zone")
    return int((now - back).astimezone(ZoneInfo(zone)).strftime(SLOT_FORMAT[grain]))


def yesterday(now: datetime, zone: str = UTC) -> int:
    """Yesterday's calendar day in `zone`, also across a clock change."""
    return int((now.astimezone(ZoneInfo(zone)).date() - timedelta(days=1)).strftime(SLOT_FORMAT["day"]))


def next_day(dayslot: int) -> int:
    return int((datetime.strptime(str(dayslot), SLOT_FORMAT["day"]) + timedelta(days=1)).strftime(SLOT_FORMAT["day"]))


def previous_hours(now: datetime, hours: int = 3, zone: str = UTC) -> list[int]:
    """The `hours` closed hour slots before `now`, newest first."""
    return [now_slot(now, "hour", timedelta(hours=h), zone) for h in range(1, hours + 1)]


def minute_of_second(secslot: int, zone: str = UTC) -> int:
    """The minute slot that holds an epoch second (a driver-side constant)."""
    return int(datetime.fromtimestamp(secslot, ZoneInfo(zone)).strftime(SLOT_FORMAT["minute"]))
