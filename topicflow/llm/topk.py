"""Exact top-k by inner product: sorted lists read in order, no random access until few rows are left.

`vectors` turns components into integers, floor(256 * x).  `index` writes shards of at most SHARD
vectors; a shard holds, for every dimension, its vectors in the order of that component.  A query
reads each list from the end that its own component favours, all to the same depth.  Of a vector
it knows the components read so far; any other lies between the last value read there and the
far end of the list.  So every vector has a lower and an upper bound of its score, and one that
no list has shown yet has the same upper bound as all others like it.  Reading stops when such outsiders
cannot qualify and few seen ones still may; the scores of these are then resolved.  Bounds are compared with the k-th best
score of the task so far, or the k-th best lower bound of the shard.

Queries come in blocks of about QUERIES, each broadcast, read by all shards, and its best rows written
before the next.  A task gives at most k rows for each query, and a window ranks those.

Vectors that are null, or hold a null or a component that is not finite, take no part, nor do rows
without an id, nor vectors so large that scores might not fit 64 bits (length * component ** 2 of 2 ** 62).
Rows that share an id count once, with the vector that is greatest as an array.  Vectors of different lengths
are not compared; those of no components score 0 with each other.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicflow.llm.common import Scratch, ship

SHARD = 4096
SPREAD = 16
QUERIES = 2048
# Depths at which bounds are compared, as parts of what is left of a list when outsiders cannot qualify any more.
_LOOKS = (1 / 3, 2 / 3, 1)
# Part of a shard that may be left to be resolved.
_FEW = 1 / 8


def vectors(rows: DataFrame, vec_id: str, embedding: str, scale: int = 256) -> DataFrame:
    """vec_id and the integer vector `v`, one row for each id."""
    x = F.col(embedding)
    limit = F.sqrt(F.lit(2.0 ** 62) / F.greatest(F.size(x), F.lit(1)))
    fits = F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double") * scale) < limit - 1, F.lit(False)) & ~F.isnan(c.cast("double")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    good = rows.where(F.col(vec_id).isNotNull() & x.isNotNull() & fits)
    return good.select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v")).groupBy("vec_id").agg(F.max("v").alias("v"))


def _shard(ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """One row: ids, vectors, and for each dimension the places of its vectors by rising component."""
    order = np.argsort(v, axis=0, kind="stable").astype(np.int32).T
    cells = [np.ascontiguousarray(x).tobytes() for x in (ids, v, order)]
    return pa.RecordBatch.from_arrays([pa.array([v.shape[1]], pa.int32()), *(pa.array([c], pa.binary()) for c in cells)], ["dims", "ids", "v", "lists"])


def index(found: DataFrame, folder: Scratch, shard: int = SHARD) -> DataFrame:
    """Shards of `vectors`, written."""
    spark = found.sparkSession
    ship(spark)
    # A file holds up to SPREAD shards, fewer where that would leave cores idle.
    many = math.ceil(found.count() / shard)
    parts = max(1, math.ceil(many / SPREAD), min(many, 4 * spark.sparkContext.defaultParallelism))

    def run(batches: Iterator[pa.RecordBatch]):
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def take(dims: int, least: int):
            ids, v = (np.concatenate(x) for x in zip(*waiting.pop(dims)))
            while len(ids) >= least and len(ids):
                yield _shard(ids[:shard], v[:shard])
                ids, v = ids[shard:], v[shard:]
            if len(ids):
                waiting[dims] = [(ids, v)]

        for batch in batches:
            ids, column = batch.column("vec_id").to_numpy(), batch.column("v")
            size = np.diff(column.offsets.to_numpy())
            for dims in np.unique(size).tolist():
                own = column.filter(pa.array(size == dims)).flatten().to_numpy().reshape(int((size == dims).sum()), dims)
                waiting.setdefault(dims, []).append((ids[size == dims], own))
                yield from take(dims, shard)
        for dims in list(waiting):
            yield from take(dims, 1)

    return folder.save("shards", found.repartition(parts, "vec_id").mapInArrow(run, "dims int, ids binary, v binary, lists binary"))


class Shard:
    """One shard; `best` finds a query's candidates with their exact scores."""

    def __init__(self, dims: int, ids: bytes, v: bytes, lists: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.v = np.frombuffer(v, np.int64).reshape(len(self.ids), dims)
        self.lists = np.frombuffer(lists, np.int32).reshape(dims, len(self.ids))
        # Components in list order, from either end; both are views of one sorted array.
        self.up = np.take_along_axis(self.v.T, self.lists.astype(np.int64), axis=1).astype(float)
        self.read = 0  # entries of lists, for tests

    def best(self, q: np.ndarray, query_id: int, k: int, least: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Vectors (places) that may be among the k best, and their scores; `least` is a score that k others have.

        Whoever ties with the k-th score stays: ids decide later.
        """
        n, dims = self.v.shape
        own = np.flatnonzero(self.ids == query_id)
        if dims == 0 or not q.any() or n <= k + len(own):
            places = np.delete(np.arange(n), own)
            return places, self.v[places] @ q
        high, low = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        weight = q.astype(float)

        def outsiders(depth: int) -> float:
            return float((self.up[high, n - depth] * weight[high]).sum() + (self.up[low, depth - 1] * weight[low]).sum())

        # Outsiders cannot qualify from this depth on; half a list if no score is known yet.
        start = n // 2 if least is None else bisect.bisect_left(range(1, n), True, key=lambda t: outsiders(t) < least) + 1
        worst = np.concatenate([self.up[high, 0] * weight[high], self.up[low, -1] * weight[low]])
        for part in _LOOKS:
            depth = min(n, max(1, start + math.ceil((n - start) * part)))
            # Each list from its favourable end.
            gain = np.concatenate([self.up[high, n - depth:] * weight[high, None], self.up[low, :depth] * weight[low, None]])
            at = np.concatenate([self.lists[high, n - depth:], self.lists[low, :depth]]).ravel()
            last = np.concatenate([gain[:len(high), 0], gain[len(high):, -1]])
            self.read += at.size
            # Doubles hold these sums to a part in 10**12; `slack` covers what they round.
            slack = 1e-9 * (float(np.abs(last).sum()) + float(np.abs(worst).sum())) + 1e-6
            upper = np.bincount(at, (gain - last[:, None]).ravel(), n) + float(last.sum())
            upper[own] = -math.inf
            bar = -math.inf if least is None else float(least)
            left = np.flatnonzero(upper >= bar - slack)
            if len(left) > max(k, n * _FEW):
                lower = np.bincount(at, (gain - worst[:, None]).ravel(), n) + float(worst.sum())
                lower[own] = -math.inf
                bar = max(bar, float(np.partition(lower, n - k)[n - k]) - slack)
                left = np.flatnonzero(upper >= bar - slack)
            if depth == n or (float(last.sum()) < bar - slack and len(left) <= max(k, n * _FEW)):
                return left, self.v[left] @ q
        raise AssertionError("the last look reads all")


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search(shards: DataFrame, queries: DataFrame, k: int, folder: Scratch, block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of `queries` (as of `vectors`) the k best of all other ids."""
    spark = shards.sparkSession
    ship(spark)
    queries = folder.save("queries", queries)
    blocks = max(1, math.ceil(queries.count() / block))
    schema = "query_id long, vec_id long, score long"
    done = []
    for b in range(blocks):
        # At most about `block` vectors: ids are spread over the blocks by hash.
        rows = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()
        column = rows.column("v").combine_chunks()
        held = spark.sparkContext.broadcast((rows.column("vec_id").to_numpy(), column.offsets.to_numpy(), column.values.to_numpy()))

        def run(batches, held=held):
            query_ids, at, values = held.value
            best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for batch in batches:
                for dims, *cells in zip(*(c.to_pylist() for c in batch.columns)):
                    shard = Shard(dims, *cells)
                    for j in np.flatnonzero(np.diff(at) == dims).tolist():
                        ids, scores = best.get(j, (np.empty(0, np.int64), np.empty(0, np.int64)))
                        bar = int(scores[-1]) if len(ids) == k else None
                        places, found = shard.best(values[at[j]:at[j + 1]], int(query_ids[j]), k, bar)
                        best[j] = _top(np.append(ids, shard.ids[places]), np.append(scores, found), k)
            if best:
                which = np.repeat(np.array(list(best)), [len(ids) for ids, _ in best.values()])
                ids, scores = (np.concatenate(x) for x in zip(*best.values()))
                yield pa.RecordBatch.from_arrays([pa.array(query_ids[which]), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"])

        done.append(folder.save(f"best-{b}", shards.mapInArrow(run, schema)))
        held.unpersist()
    found = done[0]
    for more in done[1:]:
        found = found.union(more)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(rows: DataFrame, vec_id: str, embedding: str, is_query: Column, k: int, folder: Scratch) -> DataFrame:
    """`search` over a table whose rows are candidates; those for which `is_query` holds (a condition on vec_id) are queries too."""
    found = folder.save("vectors", vectors(rows, vec_id, embedding))
    return search(index(found, folder), found.where(is_query), k, folder)
