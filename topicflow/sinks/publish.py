"""Envelope lines to a message broker, or any sink that takes a `value` column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

KAFKA = "kafka"


def broker_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def publish(lines: DataFrame, options: dict[str, str], fmt: str = KAFKA) -> None:
    lines.select("value").write.mode("append").format(fmt).options(**options).save()


def publish_stream(lines: DataFrame, options: dict[str, str], checkpoint: str, fmt: str = KAFKA) -> DataStreamWriter:
    """A writer ready to start; the caller sets the trigger."""
    return (lines.select("value").writeStream.format(fmt).options(**options)
            .option("checkpointLocation", checkpoint))
