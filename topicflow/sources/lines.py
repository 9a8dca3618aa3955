"""Message lines from text files, landed slots and brokers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.functions import slots as slot_fn

LANDED = "value string, landing_day int, landing_hour int, batch string"


def text_lines(spark: SparkSession, path: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """One `value` per line of a file or folder.

    Gzip files cannot be split: give `partitions` to spread their lines before the
    parse.
    """
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.text(paths)
    return lines if partitions is None else lines.repartition(partitions)


def stamped(lines: DataFrame, slot: int, landing: str) -> DataFrame:
    """Lines of one folder that stands for one slot."""
    return lines.withColumn(landing, F.lit(slot).cast("int"))


def landed_lines(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """All landed lines, from hour folders or from compacted days."""
    return spark.read.schema(LANDED).format(fmt).load(root).select("value", "landing_day", "landing_hour", "batch")


def landed_hours(spark: SparkSession, root: str, hours: Iterable[int], fmt: str = "parquet") -> DataFrame:
    """Lines of the given hour slots.  The filter is on partition columns, also on
    the day above them, so only those folders are listed and read."""
    wanted = sorted(set(hours))
    days = sorted({h // 100 for h in wanted})
    return landed_lines(spark, root, fmt).where(F.col("landing_day").isin(days) & F.col("landing_hour").isin(wanted))


def landed_day(spark: SparkSession, root: str, day: int, fmt: str = "parquet") -> DataFrame:
    return landed_lines(spark, root, fmt).where(F.col("landing_day") == day)


def look_back(spark: SparkSession, root: str, now: datetime, hours: int = 3,
              zone: str = slot_fn.UTC, fmt: str = "parquet") -> DataFrame:
    """Lines of the last closed hours; overlapping runs heal an outage."""
    return landed_hours(spark, root, slot_fn.previous_hours(now, hours, zone), fmt)


def broker_options(
    servers: str, topics: Sequence[str], starting: str | datetime = "latest", max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of a broker source.  `topics` is the allow-list; `starting` is
    `latest`, `earliest` or a time.  Offsets are kept in the query's checkpoint."""
    if not topics:
        raise ValueError("no topic allowed")
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics)}
    if isinstance(starting, datetime):
        options["startingTimestamp"] = str(int(starting.timestamp() * 1000))
    else:
        options["startingOffsets"] = starting
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def broker_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Needs Spark's Kafka connector on the class path."""
    records = spark.readStream.format("kafka").options(**options).load()
    return records.select(F.col("value").cast("string").alias("value"), "topic")


def file_stream(spark: SparkSession, path: str, fmt: str = "text", schema: str = "value string",
                files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def allowed_topics(records: DataFrame, topics: Sequence[str]) -> DataFrame:
    return records.where(F.col("topic").isin(list(topics)))
