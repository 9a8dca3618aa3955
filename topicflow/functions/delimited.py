"""Delimited text lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_or_empty(cell: Column) -> Column:
    return F.coalesce(cell.cast("string"), F.lit(""))


def tab_line(*cells: Column) -> Column:
    """Tab-joined cells; a null cell stays as an empty cell, so columns never shift."""
    return F.concat_ws("\t", *[text_or_empty(c) for c in cells])


def comma_list(items: Column) -> Column:
    return F.array_join(items, ",")
