"""Connected components of a table of links, as written tables only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import Scratch, ship

_AT_ONCE = 500_000  # links that a task contracts at a time


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among these nodes, contracted: (node, smallest node of its component) for all others."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[:len(a)], place[len(a):]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        root = root[root]
        if (root == before).all():
            break
    rest = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[rest], nodes[root[rest]]


def _contract(links: DataFrame, tasks: int) -> DataFrame:
    def run(batches):
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            waiting.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            if sum(len(a) for a, _ in waiting) >= _AT_ONCE:
                waiting = [_stars(*map(np.concatenate, zip(*waiting)))]
                # Stars that do not shrink further go out; only a task beside others may have so many.
                if len(waiting[0][0]) >= 2 * _AT_ONCE:
                    yield _batch(*waiting.pop())
        if waiting:
            yield _batch(*_stars(*map(np.concatenate, zip(*waiting))))

    return links.coalesce(tasks).mapInArrow(run, "a long, b long")


def _batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def components(links: DataFrame, folder: Scratch, name: str) -> DataFrame:
    """(id, component) of every node with a link to a smaller one; component is the smallest node reached.

    Tasks contract about _AT_ONCE links each to stars; the stars of one task are components.
    While there are more tasks, large-star and small-star rounds follow (every node links its
    larger neighbours, then its smaller ones, to the smallest) until nothing changes.  Minima are
    pre-aggregated and joined back, so that a node with very many links is no single task's group.
    """
    ship(links.sparkSession)
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    tasks = -(-links.count() // _AT_ONCE) or 1
    stars = folder.save(f"{name}-0", _contract(links, tasks))
    turn = 0
    while tasks > 1:
        # Once every node has one link and no smallest node has a smaller one, all is done.
        nodes = stars.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"))
        now = nodes.agg(F.count(F.lit(1)), F.sum(F.when(F.col("low") < F.col("high"), 1).otherwise(0))).first()
        chained = stars.select(F.col("b").alias("a")).join(stars.select("a"), "a", "left_semi").limit(1).count() if not now[1] else 1
        if not now[1] and not chained:
            break
        turn += 1
        both = stars.union(stars.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        large = folder.save(f"{name}-{turn}l", _contract(large, tasks))
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.greatest("b", "low").alias("a"), F.least("b", "low").alias("b"))
        small = small.union(low.select("a", F.col("low").alias("b")))
        stars = folder.save(f"{name}-{turn}", _contract(small, tasks))
        folder.drop(f"{name}-{turn}l", f"{name}-{turn - 1}")
    # The last turn left one row for each node, though some tasks may have written it twice.
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).distinct() if tasks > 1 else (
        stars.select(F.col("a").alias("id"), F.col("b").alias("component")))
