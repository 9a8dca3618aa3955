"""One JSON object per line, read strictly.

The functions take column names: each expression is one piece of SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def read_objects(lines: DataFrame, line: str, schema: str) -> DataFrame:
    """Add `_parsed`, the line read as the first element of an array, and `obj`.

    A bare parse stops at the closing brace and accepts whatever follows.  Inside
    an array the parser must meet a comma next, and the array must end with one
    more element, whose `timestamp_ms` is the line's own hash (see `is_whole`).  A
    line cannot spell that, so trailing or glued text is caught by the same, single
    parse.  `schema` needs a string field `timestamp_ms`.  NaN and Infinity are
    accepted, single-quoted strings are not.

    The result passes through a one-element explode.  Filters cannot be pushed
    below a generator, so the JSON is read once per line however many predicates
    and columns are taken from it.
    """
    parsed = F.expr(
        f"explode_outer(array(from_json(concat('[', {line}, ',{{\"timestamp_ms\":\"', xxhash64({line}), '\"}}]'), "
        f"'array<{schema}>', "
        "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'true'))))")
    return lines.select("*", parsed.alias("_parsed")).withColumn("obj", F.expr("get(_parsed, 0)"))


def is_whole(line: str) -> Column:
    """True if the line is one JSON object and nothing else."""
    return F.expr("coalesce(size(_parsed) = 2 and obj is not null "
                  f"and get(_parsed, 1).timestamp_ms = cast(xxhash64({line}) as string) and endswith(rtrim({line}), '}}'), false)")


def has_keys(line: str, keys: Sequence[str]) -> Column:
    """True if every key is present, also with a null value.

    A non-null field proves its key; the key list of the line is only built for
    lines where some field is null.
    """
    proved = " and ".join(f"obj.{key} is not null" for key in keys)
    wanted = ", ".join(f"'{key}'" for key in keys)
    listed = f"size(array_intersect(json_object_keys({line}), array({wanted}))) = {len(keys)}"
    return F.expr(f"case when {proved} then true else coalesce({listed}, false) end")


def list_or_empty(items: Column, element: str = "string") -> Column:
    return F.coalesce(items, F.array().cast(f"array<{element}>"))


def without_nulls(items: Column) -> Column:
    return F.filter(items, lambda x: x.isNotNull())
