"""What the streaming writers share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from topicflow.session import run_dir
from topicflow.sinks import files

BatchWriter = Callable[[DataFrame, int], None]


def batch_label(frame: DataFrame, batch_id: int) -> str:
    """Names a batch for ever: the query's id lives in its checkpoint, so a batch
    that is run again has the same label, and a new query never reuses one."""
    query_id = frame.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query_id:
        raise RuntimeError("only inside a streaming batch")
    return f"{query_id}-{batch_id}"


@contextmanager
def kept(frame: DataFrame) -> Iterator[DataFrame]:
    """Keep a batch for several writes; a block lost with its executor is recomputed
    from the batch's own offsets."""
    frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield frame
    finally:
        frame.unpersist()


@contextmanager
def staged(frame: DataFrame, spark: SparkSession) -> Iterator[DataFrame]:
    """Write a batch to the shared folder for several writes, and read it in the session of the tables.

    A stateful operator has a metric for each of its partitions, which every task sends to the
    driver, also the tasks of each later step that reads a kept batch: partitions squared, every time.
    So only the one step that runs the operator pays that.  What follows is planned anew by size, which a
    stateful stream's own session does not do.
    """
    path = run_dir(spark, "batch")
    try:
        frame.write.parquet(path)
        yield spark.read.schema(frame.schema).parquet(path)
    finally:
        files.delete(spark, path)


def each_batch(frame: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    return frame.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[int]:
    """Queries that start inside get two state partitions for each core, if the session has more shuffle partitions.

    Each is loaded and committed in every batch, however little there is in it, and all tell of themselves to the
    driver (see `staged`).  A checkpoint keeps the number that its query was first started with.
    """
    setting = "spark.sql.shuffle.partitions"
    before = int(spark.conf.get(setting))
    n = min(before, 2 * spark.sparkContext.defaultParallelism)
    spark.conf.set(setting, n)
    try:
        yield n
    finally:
        spark.conf.set(setting, before)


_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
# One bounded memory for all state partitions of an executor.  Counting the rows would cost a read before each write.
_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKSDB}.boundedMemoryUsage": "true",
    f"{_ROCKSDB}.trackTotalNumberOfRows": "false",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in files beside a bounded memory, whatever the session's own store.

    Spark's default store holds every row of state on the heap, twice while a batch changes it, and the state of
    a query that ended until the next maintenance.  A checkpoint keeps the store that its query was first started with.
    """
    before = {setting: spark.conf.get(setting, None) for setting in _ON_DISK}
    try:
        for setting, value in _ON_DISK.items():
            spark.conf.set(setting, value)
        yield
    finally:
        for setting, value in before.items():
            if value is None:
                spark.conf.unset(setting)
            else:
                spark.conf.set(setting, value)


def run_available(writer: DataStreamWriter, spark: SparkSession | None = None, on_disk: bool = False) -> StreamingQuery:
    """Process everything there is, then stop.  With a session, a new query has `state_partitions`, and `on_disk` its state there."""
    with state_partitions(spark) if spark is not None else nullcontext(), state_on_disk(spark) if on_disk else nullcontext():
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
