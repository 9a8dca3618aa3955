"""Landing: a stream of lines into folders by event hour, and hours into days."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from topicflow.functions import jsonline, slots
from topicflow.operators.parse import END_TIME_MS, FIRST_TIME_MS
from topicflow.sinks import files
from topicflow.sources.lines import landed_lines
from topicflow.streaming.batches import batch_label, each_batch, kept

Counts = Callable[[int, int, int], None]
ON_ERROR = ("keep", "reject", "fail")
OLDEST_DAYS = 3
_DAY_MS = 86_400_000
_EVENT_TIME = "struct<timestamp_ms:string>"
_MOVED = "landing_day int, landing_hour int, batch string, move int"
_PARTITIONS = ("landing_day", "landing_hour", "batch")


def with_landing_slots(
    lines: DataFrame, zone: str = slots.UTC, on_error: str = "keep", oldest_days: int | None = OLDEST_DAYS,
    now_ms: Column | None = None,
) -> DataFrame:
    """Add `landing_day`, `landing_hour` and `malformed` to every line.

    Only the event time is read from the line.  A line without a usable one lands
    in the hour it came in.  Lines older than `oldest_days` are left out.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error is one of {ON_ERROR}")
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    read = jsonline.read_objects(lines.select("value"), "value", _EVENT_TIME)
    whole = jsonline.is_whole("value")
    time_ms = F.expr("try_cast(obj.timestamp_ms as bigint)")
    usable = whole & (time_ms >= FIRST_TIME_MS) & (time_ms < END_TIME_MS)
    timed = read.select("value", (~whole).alias("malformed"), F.when(usable, time_ms).alias("_time_ms"))
    if oldest_days is not None:
        timed = timed.where(F.coalesce(F.col("_time_ms") >= now - oldest_days * _DAY_MS, F.lit(True)))
    if on_error == "fail":
        message = F.concat(F.lit("malformed message line: "), F.coalesce("value", F.lit("null")))
        timed = timed.withColumn("malformed", F.when(F.col("malformed"), F.raise_error(message).cast("boolean")).otherwise(F.lit(False)))
    wall = slots.wall_clock(F.coalesce(F.col("_time_ms"), now), zone)
    return timed.select(
        "value", "malformed",
        slots.slot_of(wall, "day").alias("landing_day"),
        slots.slot_of(wall, "hour").alias("landing_hour"),
    )


def write_landed(lines: DataFrame, root: str, label: str, fmt: str = "parquet", backlog: bool = False) -> None:
    """Write one batch of lines under its own label; writing it again replaces it.

    A usual pull covers an hour or two, so every task adds a file or two and the
    lines are not shuffled.  A `backlog` of many hours is first rebalanced by hour:
    a full hour is spread over several files, a sparse one gets a single file.
    `text` writes gzip lines, which readers cannot split.
    """
    codec = {"parquet": "zstd", "text": "gzip"}[fmt]
    rows = lines.select("value", "landing_day", "landing_hour", F.lit(label).alias("batch"))
    if backlog:
        rows = rows.hint("rebalance", F.col("landing_day"), F.col("landing_hour"))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", codec).partitionBy(*_PARTITIONS).format(fmt).save(root))


def landing_writer(
    lines: DataFrame, root: str, checkpoint: str, fmt: str = "parquet", zone: str = slots.UTC,
    on_error: str = "keep", rejects: str | None = None, oldest_days: int | None = OLDEST_DAYS,
    now_ms: Column | None = None, backlog: bool = False, max_rejects: float | None = None, on_counts: Counts | None = None,
) -> DataStreamWriter:
    """Land a stream.  Start it with `run_available` for a pull of what is new; the
    source's `maxOffsetsPerTrigger` or `maxFilesPerTrigger` bounds one batch, and a backlog lands in several.

    Malformed lines are kept with the others, set aside under `rejects`, or fail
    the run.  A run also fails, before it writes anything of the batch, if more than the share
    `max_rejects` of a batch is malformed.  `on_counts` is told (batch, lines, malformed) of every batch.
    A batch that is written twice or counted is read once and kept meanwhile.
    """
    if on_error == "reject" and rejects is None:
        raise ValueError("name a folder for the rejected lines")
    slotted = with_landing_slots(lines, zone, on_error, oldest_days, now_ms)
    counted = max_rejects is not None or on_counts is not None

    def count(rows: DataFrame, batch_id: int) -> None:
        n, malformed = rows.agg(F.count(F.lit(1)), F.count_if("malformed")).first()
        if on_counts is not None:
            on_counts(batch_id, n, malformed)
        if max_rejects is not None and malformed > max_rejects * n:
            raise ValueError(f"{malformed} of {n} lines of batch {batch_id} are malformed")

    def write(batch: DataFrame, batch_id: int) -> None:
        label = batch_label(batch, batch_id)
        with kept(batch) if counted or on_error == "reject" else nullcontext(batch) as rows:
            if counted:
                count(rows, batch_id)
            whole = rows if on_error == "keep" else rows.where(~F.col("malformed"))
            write_landed(whole, root, label, fmt, backlog)
            if on_error == "reject":
                write_landed(rows.where(F.col("malformed")), rejects, label, fmt, backlog)

    return each_batch(slotted, write, checkpoint)


def compact_days(spark: SparkSession, hourly: str, daily: str, days: Iterable[int], fmt: str = "parquet") -> int:
    """Move the lines of days from their hour folders into day folders.

    Each run writes one `move` folder per day, notes which landed folders it holds,
    and only then drops those.  A run that broke off before the note writes the
    same move again; one that broke off after it only drops what was noted.  Lines
    that land meanwhile or later wait for the next run.  Returns how many landed
    folders were moved; the lists on the driver hold one entry for each.
    """
    log = f"{daily}_moved"
    days = [d for d in sorted(set(days)) if files.exists(spark, f"{hourly}/landing_day={d}")]
    if not days:
        return 0
    keys = ["landing_day", "landing_hour", "batch"]
    # One listing of the folders serves both the list below and the copy.
    lines = landed_lines(spark, hourly, fmt).where(F.col("landing_day").isin(days))
    landed = {(d, int(hour.partition("=")[2]), batch.partition("=")[2]) for d in days
              for hour in files.children(spark, f"{hourly}/landing_day={d}") if hour.startswith("landing_hour=")
              for batch in files.children(spark, f"{hourly}/landing_day={d}/{hour}") if batch.startswith("batch=")}
    notes = []
    if files.exists(spark, log):
        notes = spark.read.schema(_MOVED).parquet(log).where(F.col("landing_day").isin(days)).collect()
    noted = {tuple(r[k] for k in keys) for r in notes} & landed
    todo = sorted(landed - noted)
    if todo:
        moves = {d: 1 + max((r["move"] for r in notes if r["landing_day"] == d), default=-1) for d in days}
        move = F.create_map(*[F.lit(x) for pair in moves.items() for x in pair])[F.col("landing_day")]
        if noted:
            folder = F.concat_ws("/", *keys)
            lines = lines.where(~folder.isin(["/".join(map(str, n)) for n in sorted(noted)]))
        rows = lines.select("value", "landing_hour", "landing_day", move.alias("move"))
        # The scan already packs small files into full tasks, and a task of one day
        # writes one file.  Only several days at once need a shuffle to keep it so.
        if len(days) > 1:
            rows = rows.hint("rebalance", F.col("landing_day"))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "zstd").partitionBy("landing_day", "move").parquet(daily))
        note = spark.createDataFrame([(d, h, b, moves[d]) for d, h, b in todo], _MOVED)
        note.coalesce(1).write.mode("append").partitionBy("landing_day").parquet(log)
    for day, hour, batch in landed:
        files.delete(spark, f"{hourly}/landing_day={day}/landing_hour={hour}/batch={batch}")
    return len(todo)


def compact_day(spark: SparkSession, hourly: str, daily: str, day: int, fmt: str = "parquet") -> int:
    return compact_days(spark, hourly, daily, [day], fmt)
