"""Top lists.  Ties are broken by topic, so a list is the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicflow.schema import GRAIN_SLOT, LEVEL_KEYS, TOP_K

# Spark cuts each group to the limit before the shuffle up to this rank.
_EARLY_CUT = 1000
_SALTS = 64


def ranking() -> list:
    return [F.col("count").desc(), F.col("topic")]


def top_per(counts: DataFrame, keys: list[str], k: int = TOP_K) -> DataFrame:
    """The k most frequent topics of each key.

    Every task first cuts its share of a group to k rows, so a group that holds
    most of the rows never reaches one task as a whole.  Beyond Spark's own limit
    for that cut, a salted round does the same.
    """
    def cut(frame: DataFrame, by: list) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*ranking()))
        return frame.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")

    if k > _EARLY_CUT:
        salted = counts.withColumn("_salt", F.pmod(F.xxhash64("topic"), F.lit(_SALTS)))
        counts = cut(salted, [*keys, "_salt"]).drop("_salt")
    return cut(counts, keys)


def top_topics(trends: DataFrame, level: str, grain: str, k: int = TOP_K) -> DataFrame:
    return top_per(trends, [GRAIN_SLOT[grain], *LEVEL_KEYS[level]], k)


def first_by_count(counts: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k most frequent rows of an already selected slot and place."""
    return counts.orderBy(*ranking()).limit(k)
