"""Plain dumps of a frame for a look at its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dump(frame: DataFrame, path: str, fmt: str = "json") -> None:
    """Write rows as `json`, `csv`, or `text` (one tuple-like line per row)."""
    if fmt == "text":
        frame = frame.select(F.struct(*frame.columns).cast("string").alias("value"))
    elif fmt not in ("json", "csv"):
        raise ValueError(f"no dump format {fmt}")
    frame.write.mode("overwrite").format(fmt).save(path)
