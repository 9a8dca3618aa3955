"""Raw API statuses to slim envelope lines, as JSON or as tab-separated text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.functions import delimited, jsonline
from topicflow.schema import RAW_STATUS, REQUIRED_KEYS

TSV_COLUMNS = ("t_id", "time_ms", "coords", "hashtags", "u_ment", "u_id", "u_loc",
               "pl_type", "pl_name", "pl_cc", "pl_full_name", "text")


def read_statuses(lines: DataFrame, line: str = "value") -> DataFrame:
    """Parse raw lines once; lines that are no status are dropped."""
    read = jsonline.read_objects(lines, line, RAW_STATUS)
    keep = jsonline.is_whole(line) & jsonline.has_keys(line, REQUIRED_KEYS)
    return read.where(keep).withColumnRenamed("obj", "status").drop("_parsed")


def _names(elements: Column, key: str) -> Column:
    """The named member of each well-formed element; other elements are skipped."""
    names = F.transform(elements, lambda e: F.try_variant_get(e, f"$.{key}", "string"))
    return jsonline.list_or_empty(jsonline.without_nulls(names))


def _names_or_text(elements: Column, key: str) -> Column:
    """The named member of each element, or the element itself as text."""
    def flat(e: Column) -> Column:
        return F.coalesce(F.try_variant_get(e, f"$.{key}", "string"), F.try_variant_get(e, "$", "string"), F.to_json(e))

    return jsonline.list_or_empty(F.transform(elements, flat))


def _fields(obj: Column, *names: str) -> Column:
    return F.struct(*[obj[n].alias(n) for n in names])


def envelope_struct(status: Column) -> Column:
    return F.struct(
        status["id_str"].alias("id_str"),
        status["timestamp_ms"].alias("timestamp_ms"),
        jsonline.list_or_empty(status["coordinates"]["coordinates"], "double").alias("coordinates"),
        F.struct(
            _names(status["entities"]["hashtags"], "text").alias("hashtags"),
            _names(status["entities"]["user_mentions"], "screen_name").alias("user_mentions"),
        ).alias("entities"),
        _fields(status["user"], "id_str", "screen_name", "location").alias("user"),
        _fields(status["place"], "place_type", "name", "country_code", "full_name").alias("place"),
        status["text"].alias("text"),
    )


def to_envelopes(raw_lines: DataFrame, line: str = "value") -> DataFrame:
    """Envelope lines; null members are written, so a key that was there stays there."""
    others = [F.col(c) for c in raw_lines.columns if c != line]
    envelope = F.to_json(envelope_struct(F.col("status")), {"ignoreNullFields": "false"})
    return read_statuses(raw_lines, line).select(*others, envelope.alias("value"))


def to_tsv(raw_lines: DataFrame, line: str = "value") -> DataFrame:
    """Tab-separated lines with always the same 12 columns."""
    s = F.col("status")
    coords = F.to_json(s["coordinates"]["coordinates"])
    cells = (
        s["id_str"], s["timestamp_ms"], coords,
        delimited.comma_list(_names_or_text(s["entities"]["hashtags"], "text")),
        delimited.comma_list(_names_or_text(s["entities"]["user_mentions"], "screen_name")),
        s["user"]["id_str"], s["user"]["location"],
        s["place"]["place_type"], s["place"]["name"], s["place"]["country_code"], s["place"]["full_name"],
        s["text"],
    )
    others = [F.col(c) for c in raw_lines.columns if c != line]
    return read_statuses(raw_lines, line).select(*others, delimited.tab_line(*cells).alias("value"))
