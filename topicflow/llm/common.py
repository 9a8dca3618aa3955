"""Shared by the operators: code shipping, written stages, bounded Arrow slices."""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from topicflow.session import run_dir
from topicflow.sinks import files

# Bytes of text that one numpy step works on; a longer row is a step of its own.
SLICE_BYTES = 2 << 20

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark application (as `--py-files` would)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="code-"), "topicflow_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("topicflow", os.path.relpath(path, package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


class Scratch:
    """Written tables of one run below the shared folder: they cut lineage and survive lost executors.

    Tables dropped by name go at once; the rest goes when the driver exits, as a
    result that is still to be computed may read it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = run_dir(spark, label)
        atexit.register(self.close)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, name: str, rows: DataFrame, codec: str = "snappy") -> DataFrame:
        rows.write.mode("overwrite").parquet(self.path(name), compression=codec)
        return self.spark.read.schema(rows.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            files.delete(self.spark, self.path(name))

    def close(self) -> None:
        if self.spark.sparkContext._jsc is not None:
            files.delete(self.spark, self.root)


def texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A string column without nulls (null: empty), with 64-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return pc.fill_null(column, "") if column.null_count else column


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Cut a `texts` column (or bytes with 64-bit offsets) into runs of rows of about max_bytes: (first row, rows)."""
    import numpy as np

    if len(column):
        for row, stop in runs(np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8), max_bytes):
            yield row, column.slice(row, stop - row)


def runs(offsets, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about max_bytes, by where each row begins (one more at the end): first row, and the row after the last."""
    import numpy as np

    n, row = len(offsets) - 1, 0
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + max_bytes, side="right")) - 1
        stop = min(n, max(stop, row + 1))
        yield row, stop
        row = stop
