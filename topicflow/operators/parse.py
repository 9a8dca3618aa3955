"""Envelope lines to messages, with a verdict for every line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.functions import jsonline, slots
from topicflow.schema import MESSAGE_FIELDS, REQUIRED_KEYS

OK = "ok"
# In the order they are tested; the first that applies wins.
VERDICTS = ("malformed", "missing_key", "no_user", "no_place", "bad_timestamp", OK)

# Event times whose slots fit their columns: years 1000 to 2146.
FIRST_TIME_MS, END_TIME_MS = -30_610_224_000_000, 5_585_587_200_000

_EMPTY = "cast(array() as array<string>)"
_TIME = "try_cast(obj.timestamp_ms as bigint)"

# The message columns, from the envelope `obj`.
_COLUMNS = {
    "t_id": "obj.id_str",
    "u_id": "obj.user.id_str",
    "user_name": "coalesce(obj.user.screen_name, obj.user.id_str, 'Anonymous')",
    "coords": "coalesce(obj.coordinates, cast(array() as array<double>))",
    "tags": f"filter(concat(coalesce(obj.entities.hashtags, {_EMPTY}), "
            f"coalesce(obj.entities.user_mentions, {_EMPTY})), tag -> tag is not null)",
    "city": "obj.place.name",
    "country": "obj.place.country_code",
    "time_ms": f"case when {_TIME} >= {FIRST_TIME_MS} and {_TIME} < {END_TIME_MS} then {_TIME} end",
    "text": "obj.text",
}
MESSAGE_COLUMNS = tuple(_COLUMNS)


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Add the message columns and a `verdict` to every line; no line is dropped."""
    read = jsonline.read_objects(lines, line, MESSAGE_FIELDS)
    verdict = (
        F.when(~jsonline.is_whole(line), "malformed")
        .when(~jsonline.has_keys(line, REQUIRED_KEYS), "missing_key")
        .when(F.expr("obj.user.id_str is null"), "no_user")
        .when(F.expr("obj.place.name is null or obj.place.country_code is null"), "no_place")
        .when(F.expr(f"({_COLUMNS['time_ms']}) is null"), "bad_timestamp")
        .otherwise(OK)
    )
    columns = [F.expr(f"{c} as {name}") for name, c in _COLUMNS.items()]
    return read.select(*lines.columns, *columns, verdict.alias("verdict"))


def messages(parsed: DataFrame, zone: str = slots.UTC) -> DataFrame:
    """The accepted lines as messages, with their event time and slots."""
    return parsed.where(F.col("verdict") == OK).select(
        *MESSAGE_COLUMNS,
        slots.instant(F.col("time_ms")).alias("ts"),
        *slots.slot_columns(F.col("time_ms"), zone),
    )


def rejects(parsed: DataFrame) -> DataFrame:
    """The refused lines with the reason; all columns the lines came with are kept."""
    drop = [c for c in MESSAGE_COLUMNS if c in parsed.columns]
    return parsed.where(F.col("verdict") != OK).drop(*drop).withColumnRenamed("verdict", "reason")


def parse_messages(lines: DataFrame, zone: str = slots.UTC, line: str = "value") -> DataFrame:
    return messages(parse_lines(lines, line), zone)


def refuse_errors(parsed: DataFrame) -> DataFrame:
    """Fail the run on the first malformed line instead of setting it aside."""
    message = F.concat(F.lit("malformed message line: "), F.coalesce(F.col("value"), F.lit("null")))
    checked = F.when(F.col("verdict") == "malformed", F.raise_error(message).cast("string")).otherwise(F.col("verdict"))
    return parsed.withColumn("verdict", checked)
