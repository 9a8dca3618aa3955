"""Message lines made from the driver tables `events`, `nation` and `region`.

Every event becomes exactly one line.  The remainders of ids below only choose the
*shape* of a line (with or without coordinates, tags, a user, a place; cut off or
whole), so that every parse verdict and edge shape occurs; they select nothing.
The country is the region, the city is the nation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.functions import slots

# Stated, so that opening the tables reads no file footers.
_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string"
_NATION = "n_nationkey int, n_name string, n_regionkey int"
_REGION = "r_regionkey int, r_name string"

_NO_STRINGS = "cast(array() as array<string>)"
_SHAPES = {
    "id_str": "cast(event_id as string)",
    "timestamp_ms": "cast(time_ms as string)",
    "text": "concat_ws(' ', event_type, props)",
    "point": "case when event_id % 3 = 0 then "
             "array(user_id % 360 - 180 + double(0.5), user_id % 180 - 90 + double(0.25)) end",
    "hashtags": f"case when event_id % 7 = 0 then {_NO_STRINGS} "
                "when event_id % 11 = 0 then array(event_type, event_type, k) else array(event_type, k) end",
    "mentions": f"case when event_id % 2 = 0 then {_NO_STRINGS} "
                "when event_id % 13 = 0 then array(event_type) else array(concat('u', user_id % 40)) end",
    "user": "case when event_id % 17 <> 0 then named_struct('id_str', cast(user_id as string), "
            "'screen_name', concat('user_', user_id), 'location', n_name) end",
    "place": "case when event_id % 10 <> 0 then named_struct('place_type', 'city', 'name', n_name, "
             "'country_code', r_name, 'full_name', concat_ws(', ', n_name, r_name)) end",
}
_KEEP_NULLS = "map('ignoreNullFields', 'false')"


def _spread(frame: DataFrame) -> DataFrame:
    """Give every core a share of an input that comes in fewer partitions than there
    are cores; parsing is the costly step.  A large input has more and is left alone."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame


def _shaped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their place and the parts of their message.  Catalyst broadcasts
    the two dimension tables as long as their files are below its size threshold."""
    def table(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")

    places = table("nation", _NATION).join(table("region", _REGION), F.expr("n_regionkey = r_regionkey"))
    placed = _spread(table("events", _EVENTS)).join(places, F.expr("user_id % 25 = n_nationkey"), "left")
    timed = placed.select(
        "event_id", "user_id", "event_type", "props", "n_name", "r_name",
        slots.epoch_ms("ts").alias("time_ms"), F.expr("concat('k', get_json_object(props, '$.k')) as k"))
    return timed.selectExpr("event_id", "time_ms", *[f"{shape} as {name}" for name, shape in _SHAPES.items()])


def _landed(shaped: DataFrame, line: str) -> DataFrame:
    """Lines with the slots they landed in.  Some lines lose their closing brace, as
    when a connection drops."""
    wall = slots.wall_clock(F.col("time_ms"))
    return shaped.withColumn("line", F.expr(line)).select(
        slots.slot_of(wall, "day").alias("landing_day"),
        slots.slot_of(wall, "hour").alias("landing_hour"),
        F.expr("substr(line, 1, length(line) - if(event_id % 23 = 0, 1, 0)) as value"),
    )


def envelope_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One slim message line per event, with the slots it landed in."""
    return _landed(_shaped_events(spark, sf_dir), f"""
        to_json(struct(id_str, timestamp_ms, text, coalesce(point, cast(array() as array<double>)) as coordinates,
                       struct(hashtags, mentions as user_mentions) as entities, user, place), {_KEEP_NULLS})""")


def raw_status_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw API status per event: tags and mentions are objects, and some tag
    lists also hold a bare string."""
    return _landed(_shaped_events(spark, sf_dir), f"""
        concat('{{', concat_ws(',',
          regexp_replace(to_json(struct(id_str, timestamp_ms, text)), '^[{{]|[}}]$', ''),
          concat('"coordinates":', coalesce(to_json(if(point is null, null, struct(point as coordinates))), 'null')),
          concat('"entities":{{"hashtags":[',
            array_join(concat(transform(hashtags, t -> to_json(named_struct('text', t))),
                              if(event_id % 19 = 0, array('"bare"'), {_NO_STRINGS})), ','),
            '],"user_mentions":[',
            array_join(transform(mentions, u -> to_json(named_struct('screen_name', u, 'name', u))), ','), ']}}'),
          concat('"user":', coalesce(to_json(user, {_KEEP_NULLS}), 'null')),
          concat('"place":', coalesce(to_json(place, {_KEEP_NULLS}), 'null'))), '}}')""")
