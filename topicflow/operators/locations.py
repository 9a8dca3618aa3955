"""Positions of messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.schema import LEVEL_KEYS


def position() -> tuple[Column, Column]:
    """Longitude and latitude, as they come."""
    return F.get("coords", F.lit(0)), F.get("coords", F.lit(1))


def has_position() -> Column:
    lon, lat = position()
    return (F.size("coords") >= 2) & lon.isNotNull() & lat.isNotNull() & ~F.isnan(lon) & ~F.isnan(lat)


def with_position(messages: DataFrame) -> DataFrame:
    """Messages with a usable [lon, lat] pair, as columns `lat` and `long`."""
    lon, lat = position()
    return messages.where(has_position()).withColumns({"lat": lat, "long": lon})


def locations(messages: DataFrame, level: str) -> DataFrame:
    """One position per message, keyed by place and time."""
    return with_position(messages).select(*LEVEL_KEYS[level], "time_ms", "lat", "long")
