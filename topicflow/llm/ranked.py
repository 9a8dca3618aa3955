"""Ranked lexical search: best-first intervals of documents over range-maximum tables.

Terms are runs of digits, letters (A-Z lower-cased) and all characters beyond ASCII.  With N documents
that have a term, L terms in all, n in a document, df documents that hold a term and tf occurrences in one,

    w = floor(1000 * ln((2 N + 2) / (2 df + 1)))        m = 10 + (90 n N) div L
    impact = w * ((1000000000 tf) div (1000 tf + 8 m))  score = sum of the impacts of an item's terms

Items come in blocks of about BLOCK characters; the terms of a block, at most half as many as it has characters, are broadcast.
A scan of the documents writes segments of about SEGMENT bytes of text: per segment, for each of the block's terms,
the places and frequencies of the documents that hold it, and the lengths of these.  Document frequencies and
totals are sums over segments.  Each segment is then searched: every posting list has a sparse
table of the places of its range maxima.  The interval of all documents is split at the document of greatest impact, which
is scored; the two rests wait with the sum of their terms' range maxima as bound, and the
intervals of the highest bounds go next, AT_ONCE of them in a numpy step.  Intervals of at most LEAF documents are scored document by
document.  What is bound below the k-th best score of the task so far is left.  A task gives at most k rows for
each item, and a window ranks those.

A document is a row with a doc_id; repeated rows are documents of their own.  Null and empty texts have no terms; such documents do
not count.  Rows without a doc_id are left out.  Rows of an item that share an item_id are one item with all their terms; an
item_id may be null.  Items without a known term, and empty tables, give no rows.  Very long texts are segments of their
own.  Other columns are not read.  Terms are compared by a 64-bit hash of their bytes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicflow.llm import words
from topicflow.llm.common import Scratch, ship, slices, texts

BLOCK = 4 << 20
SEGMENT = 16 << 20
LEAF = 64
AT_ONCE = 64

_SEGMENT = "n_docs long, n_terms long, doc_ids binary, lengths binary, terms array<int>, df array<int>, places binary, tfs binary"


def _items(rows: DataFrame) -> tuple[list, list[np.ndarray]]:
    """The ids of a block's items and the hashes of their terms, each once."""
    ids: list = []
    found: dict = {}
    for batch in rows.toArrow().to_batches():
        own = words.split(texts(batch.column("text")), words.ALNUM, lower=True)
        hashes = own.hashes()
        for r, key in enumerate(batch.column("item_id").to_pylist()):
            if key not in found:
                ids.append(key)
            found.setdefault(key, []).append(hashes[own.first[r]:own.first[r + 1]])
    return ids, [np.unique(np.concatenate(found[key])) for key in ids]


def segments(docs: DataFrame, terms, size: int = SEGMENT) -> DataFrame:
    """Posting lists of the given terms (a broadcast, sorted array of hashes), one row for each segment."""

    def build(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        ids, lengths, place, term, tf = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(term.astype(np.int64) * max(1, len(ids)) + place, kind="stable")
        term, place, tf = term[order], place[order], tf[order]
        # Documents that hold one of the terms, in order.
        held = np.unique(place)
        distinct, df = np.unique(term, return_counts=True)
        binary = lambda x, kind: pa.array([np.ascontiguousarray(x, kind).tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays([
            pa.array([int((lengths > 0).sum())]), pa.array([int(lengths.sum())]), binary(ids[held], np.int64), binary(lengths[held], np.int64),
            pa.array([distinct.tolist()], pa.list_(pa.int32())), pa.array([df.tolist()], pa.list_(pa.int32())),
            binary(np.searchsorted(held, place), np.int32), binary(tf, np.int32),
        ], ["n_docs", "n_terms", "doc_ids", "lengths", "terms", "df", "places", "tfs"])

    def run(batches):
        known = terms.value
        parts, n, waiting = [], 0, 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for row, part in slices(texts(batch.column("text"))):
                own = words.split(part, words.ALNUM, lower=True)
                hashes = own.hashes()
                at = np.minimum(np.searchsorted(known, hashes), max(0, len(known) - 1))
                hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
                keys, tf = np.unique(own.rows()[hit] * max(1, len(known)) + at[hit], return_counts=True)
                place, term = np.divmod(keys, max(1, len(known)))
                parts.append((ids[row:row + len(part)], own.counts, place + n, term.astype(np.int32), tf))
                n, waiting = n + len(part), waiting + part.nbytes
                if waiting >= size:
                    yield build(parts)
                    parts, n, waiting = [], 0, 0
        if parts:
            yield build(parts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SEGMENT)


class Postings:
    """The posting lists of a segment with their impacts; range maxima come from sparse tables built on first use."""

    def __init__(self, row: dict, weights: np.ndarray, n: int, total: int):
        self.ids = np.frombuffer(row["doc_ids"], np.int64)
        self.terms = np.array(row["terms"], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(row["df"])]).astype(np.int64)
        self.places = np.frombuffer(row["places"], np.int32).astype(np.int64)
        tf = np.frombuffer(row["tfs"], np.int32).astype(np.int64)
        m = 10 + (90 * np.frombuffer(row["lengths"], np.int64) * n) // total
        self.impacts = np.repeat(weights[self.terms], row["df"]) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[self.places]))
        self._tables: dict[int, list[np.ndarray]] = {}

    def table(self, term: int) -> list[np.ndarray]:
        """Level j, entry i: where the greatest impact of the postings i .. i + 2 ** j - 1 of this list is."""
        if term not in self._tables:
            own = self.impacts[self.begin[term]:self.begin[term + 1]]
            levels, width = [np.arange(len(own))], 1
            while 2 * width <= len(own):
                left, right = levels[-1][:len(own) - 2 * width + 1], levels[-1][width:][:len(own) - 2 * width + 1]
                levels.append(np.where(own[left] >= own[right], left, right))
                width *= 2
            self._tables[term] = levels
        return self._tables[term]

    def of(self, wanted: np.ndarray) -> np.ndarray:
        """Which lists of this segment belong to these terms."""
        return np.flatnonzero(np.isin(self.terms, wanted, assume_unique=True))


class Search:
    """One item in one segment."""

    def __init__(self, postings: Postings, lists: np.ndarray):
        self.postings = postings
        own = [slice(postings.begin[t], postings.begin[t + 1]) for t in lists]
        self.docs = len(postings.ids)
        self.places = np.concatenate([postings.places[s] for s in own])
        self.impacts = np.concatenate([postings.impacts[s] for s in own])
        size = np.array([s.stop - s.start for s in own])
        self.first = np.cumsum(size) - size
        # Places made unique by their list: one search finds a place in every list.
        self.offset = np.arange(len(lists)) * (self.docs + 1)
        self.keys = self.places + np.repeat(self.offset, size)
        # All lists' tables side by side, each level as long as the postings.
        deep = max(1, int(size.max()).bit_length())
        self.tables = np.zeros((deep, len(self.places)), np.int32)
        for t, begin in zip(lists, self.first):
            for j, level in enumerate(postings.table(t)):
                self.tables[j, begin:begin + len(level)] = level + begin

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For intervals low .. high - 1: the sum of the lists' greatest impacts, and the document of the greatest."""
        left = np.searchsorted(self.keys, low[:, None] + self.offset)
        right = np.searchsorted(self.keys, high[:, None] + self.offset)
        some = right > left
        level = np.frexp((right - left).astype(float))[1] - 1
        level[~some] = 0
        last = len(self.places) - 1
        a = self.tables[level, np.minimum(left, last)]
        b = self.tables[level, np.clip(right - (1 << level), 0, last)]
        best = np.where(self.impacts[a] >= self.impacts[b], a, b)
        value = np.where(some, self.impacts[best], 0)
        greatest = value.argmax(axis=1)
        return value.sum(axis=1), self.places[best[np.arange(len(low)), greatest]]

    def scores(self, docs: np.ndarray) -> np.ndarray:
        keys = docs[:, None] + self.offset
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.impacts[at], 0).sum(axis=1)

    def leaves(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All documents of the intervals that hold a term, and their scores."""
        left = np.searchsorted(self.keys, low[:, None] + self.offset)
        right = np.searchsorted(self.keys, high[:, None] + self.offset)
        at = words.ragged(left.ravel(), (right - left).ravel())
        docs, which = np.unique(self.places[at], return_inverse=True)
        sums = np.zeros(len(docs), np.int64)
        np.add.at(sums, which, self.impacts[at])
        return docs, sums

    def best(self, k: int, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k best of these and of the segment's documents with a score above 0; ties to the smaller id."""
        low, high = np.zeros(1, np.int64), np.full(1, self.docs)
        bound, split = self.bounds(low, high)
        while len(low):
            bar = scores[-1] if len(scores) == k else 1
            order = np.argsort(-bound, kind="stable")
            order = order[bound[order] >= bar]
            low, high, bound, split = low[order], high[order], bound[order], split[order]
            now, small = slice(0, AT_ONCE), high[:AT_ONCE] - low[:AT_ONCE] <= LEAF
            found, sums = self.leaves(low[now][small], high[now][small])
            cut = split[now][~small]
            found, sums = np.append(found, cut), np.append(sums, self.scores(cut))
            new_low = np.concatenate([low[now][~small], cut + 1])
            new_high = np.concatenate([cut, high[now][~small]])
            some = new_high > new_low
            new_low, new_high = new_low[some], new_high[some]
            new_bound, new_split = self.bounds(new_low, new_high)
            low, high = np.append(low[AT_ONCE:], new_low), np.append(high[AT_ONCE:], new_high)
            bound, split = np.append(bound[AT_ONCE:], new_bound), np.append(split[AT_ONCE:], new_split)
            ids, scores = top(np.append(ids, self.postings.ids[found[sums > 0]]), np.append(scores, sums[sums > 0]), k)
        return ids, scores


def top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _search_block(docs: DataFrame, items: DataFrame, k: int, folder: Scratch, label: str) -> DataFrame:
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType
    ids, hashes = _items(items)
    terms = np.unique(np.concatenate([np.empty(0, np.uint64), *hashes]))
    numbers = [np.searchsorted(terms, h) for h in hashes]
    shared = spark.sparkContext.broadcast(terms)
    found = folder.save(f"segments-{label}", segments(docs, shared))
    shared.unpersist()
    n, total = found.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    # At most one row for each term of the block.
    counted = found.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy("x.terms").agg(F.sum("x.df").alias("df")).collect()
    df = np.zeros(len(terms), np.int64)
    df[[r.terms for r in counted]] = [r.df for r in counted]
    n, total = int(n or 0), int(total or 0)
    held = spark.sparkContext.broadcast((ids, numbers, weights(df, n), n, max(1, total)))

    def run(batches):
        ids, numbers, weight, n, total = held.value
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                postings = Postings(batch.slice(i, 1).to_pylist()[0], weight, n, total)
                for j, wanted in enumerate(numbers):
                    lists = postings.of(wanted)
                    if len(lists):
                        best[j] = Search(postings, lists).best(k, *best.get(j, (np.empty(0, np.int64), np.empty(0, np.int64))))
        if best:
            which = np.repeat(list(best), [len(x) for x, _ in best.values()]).tolist()
            doc_ids, scores = (np.concatenate(x) for x in zip(*best.values()))
            keys = pa.array([ids[j] for j in which])
            yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), keys, pa.array(doc_ids), pa.array(scores)], ["item", "item_id", "doc_id", "score"])

    done = folder.save(f"best-{label}", found.mapInArrow(run, f"item int, item_id {kind.simpleString()}, doc_id long, score long"))
    held.unpersist()
    folder.drop(f"segments-{label}")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    return done.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int, folder: Scratch, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents (doc_id, text) of each item (item_id, text)."""
    ship(docs.sparkSession)
    docs = docs.where(F.col("doc_id").isNotNull())
    items = folder.save("items", items.select("item_id", F.coalesce("text", F.lit("")).alias("text")))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / block))
    # Items are spread over the blocks by hash; a block is collected, and is `block` characters or one long item.
    spread = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    done = [_search_block(docs, items.where(spread == b), k, folder, str(b)) for b in range(blocks)]
    found = done[0]
    for more in done[1:]:
        found = found.union(more)
    return found
