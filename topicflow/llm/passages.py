"""Substring dedup: passages of WINDOW words that an earlier document has too are cut out.

An FM-index per shard does the matching.  Shards are made by content: a window belongs to
its minimiser, the smallest hash of the GRAM-word grams in it, so that equal windows meet in
one shard wherever they come from, and no document is streamed through all shards.
Neighbouring windows of one minimiser form a segment.

1. Every document is cut into segments.  Minimisers that occur in one document only are
   dropped, and with them nearly all unique text.
2. Equal segments are counted once, under the smallest doc_id that has them.
3. A shard indexes its distinct segments and streams them through backward search; the
   matching statistics give every window of WINDOW words the smallest document that has it.
   A minimiser of very many segments is dealt to several shards by the hash of the window.
4. What a segment's windows found goes back to all its occurrences, and each document drops
   the words of windows that a smaller doc_id has.

Windows are judged on the input, never on what is left.  Words are compared by 64-bit
hashes.  Null texts have no words.  A row without a doc_id is neither smaller nor larger than
others and stays whole; rows with equal doc_id do not remove each other's words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm import words
from topicflow.llm.common import Scratch, ship, slices, texts
from topicflow.llm.fmindex import FMIndex

WINDOW = 50
GRAM = 8
RUN = 256  # windows of a segment at most
SHARD_WORDS = 1 << 19  # words of a shard's distinct segments

_SEGMENT = "mini long, doc_id long, start int, n int, segment long"


def _minimisers(hashes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The smallest gram hash in each window of words."""
    low = words.gram_hashes(hashes, gram)
    width, reach = window - gram + 1, 1
    if len(low) < width:
        return low[:0]
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def _segments(own: words.Words, hashes: np.ndarray, window: int, gram: int):
    """Row, first word, number of windows, minimiser and hash of the words of every segment."""
    low = _minimisers(hashes, window, gram)
    at = np.flatnonzero(own.valid(window)[:len(low)])
    if not len(at):
        none = np.empty(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    rows, low = own.rows()[at], low[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (low[1:] != low[:-1]) | (rows[1:] != rows[:-1])
    begin = np.flatnonzero(fresh)
    place = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    begin = np.flatnonzero(place % RUN == 0)
    n = np.diff(np.append(begin, len(at)))
    start = at[begin]
    return rows[begin], start, n, low[begin], words.range_hashes(hashes, start, start + n + window - 1)


def _cut(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for row, part in slices(texts(batch.column("text"))):
                own = words.split(part, words.NOT_SPACE)
                rows, start, n, mini, segment = _segments(own, own.hashes(), window, gram)
                yield pa.RecordBatch.from_arrays([
                    pa.array(mini.view(np.int64)), ids.take(pa.array(rows + row)),
                    pa.array((start - own.first[rows]).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(segment.view(np.int64)),
                ], ["mini", "doc_id", "start", "n", "segment"])

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, _SEGMENT)


def _payload(docs: DataFrame, shards: int, window: int) -> DataFrame:
    """The words of the listed segments, dealt to shards; a segment whose minimiser has `parts`
    over 1 is cut into windows, dealt by their hash."""

    def run(batches):
        for batch in batches:
            listed = batch.column("segments").to_pylist()
            for row, part in slices(texts(batch.column("text"))):
                own = words.split(part, words.NOT_SPACE)
                hashes, counts = own.hashes(), own.counts
                out: list[tuple] = []
                for r in range(len(part)):
                    base = own.first[r]
                    for s in listed[row + r]:
                        a, n = base + s["start"], s["n"]
                        if s["start"] + n + window - 1 > counts[r]:
                            continue
                        own_words = hashes[a:a + n + window - 1]
                        # Another row of the same doc_id may have these places but not these words.
                        if words.gram_hashes(own_words, len(own_words)).view(np.int64)[0] != s["segment"]:
                            continue
                        mini = np.array([s["mini"]]).view(np.uint64)
                        to = np.zeros(n, np.uint64)
                        if s["parts"] > 1:
                            to = words.gram_hashes(own_words, window) % np.uint64(s["parts"])
                        begin = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
                        shard = (words.mix(mini + words.mix(to[begin])) % np.uint64(shards)).astype(np.int64)
                        for lo, hi, dealt in zip(begin.tolist(), [*begin[1:].tolist(), n], shard.tolist()):
                            out.append((dealt, s["mini"], s["segment"], s["doc_id"], lo, own_words[lo:hi + window - 1].tobytes()))
                columns = list(zip(*out)) or [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["shard", "mini", "segment", "doc_id", "first", "words"])

    return docs.mapInArrow(run, "shard long, mini long, segment long, doc_id long, first int, words binary")


def _matched(window: int):
    def run(shard: pa.Table) -> pa.Table:
        """Index one shard and stream its segments: runs of windows with the smallest document of each."""
        shard = shard.combine_chunks()
        column = shard.column("words").chunk(0).cast(pa.large_binary())
        ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        symbols = np.frombuffer(column.buffers()[2], np.uint64)[ends[0] // 8:ends[-1] // 8]
        lengths = np.diff(ends) // 8
        index = FMIndex(symbols, lengths, shard.column("doc_id").to_numpy(), window)
        _, low = index.matching(symbols, lengths)
        sequence = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(symbols)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = np.flatnonzero(place <= lengths[sequence] - window)
        low, sequence, place = low[at], sequence[at], place[at]
        begin = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (sequence[1:] != sequence[:-1])]))
        n = np.diff(np.append(begin, len(at)))
        own = pa.array(sequence[begin])
        return pa.table({
            "mini": shard.column("mini").take(own), "segment": shard.column("segment").take(own),
            "offset": pa.array((shard.column("first").to_numpy()[sequence[begin]] + place[begin]).astype(np.int32)),
            "windows": pa.array(n.astype(np.int32)), "low": pa.array(low[begin]),
        })

    return run


def _kept(docs: DataFrame, keep: list[str], window: int) -> DataFrame:
    """Drop the covered words: kept_text, n_words, n_removed."""
    added = [T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]

    def run(batches):
        for batch in batches:
            found = batch.column("__found")
            for row, part in slices(texts(batch.column("__text"))):
                own = words.split(part, words.NOT_SPACE)
                counts = own.counts
                removed = np.zeros(len(own.start), bool)
                some = found.slice(row, len(part))
                if some.null_count < len(some):
                    hashes = own.hashes()
                    for r, runs in enumerate(some.to_pylist()):
                        if not runs:
                            continue
                        start = np.array([s["start"] for s in runs])
                        n = np.array([s["n"] for s in runs]) + window - 1
                        fits = start + n <= counts[r]
                        start, n = start[fits] + own.first[r], n[fits]
                        same = words.range_hashes(hashes, start, start + n).view(np.int64) == np.array([s["segment"] for s in runs])[fits]
                        a = start[same] + np.array([s["offset"] for s in runs])[fits][same]
                        b = a + np.array([s["windows"] for s in runs])[fits][same] + window - 1
                        edge = np.zeros(counts[r] + 1, np.int64)
                        np.add.at(edge, a - own.first[r], 1)
                        np.add.at(edge, b - own.first[r], -1)
                        removed[own.first[r]:own.first[r + 1]] = np.cumsum(edge[:-1]) > 0
                rows = own.rows()
                start, end, left = own.start[~removed], own.end[~removed], np.bincount(rows[~removed], minlength=len(part))
                # Each kept word with one byte after it, which becomes the space; none after the last of a row.
                size = end - start + 1
                data = own.data[words.ragged(start, size)]
                last = np.cumsum(size) - 1
                data[last] = 0x20
                drop = np.zeros(len(data), bool)
                row_last = np.cumsum(left)[left > 0] - 1
                drop[last[row_last]] = True
                ends = np.concatenate([[0], np.cumsum(np.bincount(rows[~removed], size, len(part)).astype(np.int64) - (left > 0))])
                kept = pa.Array.from_buffers(pa.large_string(), len(part), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[~drop]))])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(row, len(part)) for c in keep), kept.cast(pa.string()), pa.array(counts, pa.int64()), pa.array(counts - left, pa.int64())],
                    [*keep, *(f.name for f in added)])

    chosen = [docs.schema[c] for c in keep]
    return docs.mapInArrow(run, T.StructType(chosen + added))


def remove_repeats(docs: DataFrame, folder: Scratch, keep: list[str] | None = None, window: int = WINDOW, gram: int = GRAM,
                   shard_words: int = SHARD_WORDS) -> DataFrame:
    """Columns `keep` (all) with kept_text (the kept words, one space between), n_words and n_removed.

    docs has doc_id and text; a column named like a result is replaced.
    """
    ship(docs.sparkSession)
    gram = min(gram, window)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    segments = folder.save("segments", _cut(plain, window, gram))
    repeated = segments.groupBy("mini").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    occurrences = folder.save("occurrences", segments.join(repeated.select("mini"), "mini", "left_semi"))
    folder.drop("segments")
    distinct = occurrences.groupBy("mini", "segment").agg(F.min(F.struct("doc_id", "start", "n")).alias("first"))
    distinct = folder.save("distinct", distinct.select("mini", "segment", "first.*"))
    load = distinct.groupBy("mini").agg(F.sum(F.col("n") + window - 1).alias("load"))
    total = load.agg(F.sum("load")).first()[0] or 0
    # A cut segment takes a whole window of words for each of its windows.
    crowded = load.where(F.col("load") > shard_words).select("mini", F.ceil(F.col("load") * gram / shard_words).cast("int").alias("parts"))
    listed = distinct.join(crowded, "mini", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    listed = listed.groupBy("doc_id").agg(F.collect_list(F.struct("mini", "segment", "doc_id", "start", "n", "parts")).alias("segments"))
    shards = int(-(-total // shard_words)) or 1
    # A row that is repeated gives its words once.
    versions = plain.join(listed.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id", F.xxhash64("text")).agg(F.first("text").alias("text"))
    payload = _payload(versions.join(listed, "doc_id").select("text", "segments"), shards, window)
    matched = folder.save("matched", payload.groupBy("shard").applyInArrow(
        _matched(window), "mini long, segment long, offset int, windows int, low long"))
    found = (occurrences.join(matched, ["mini", "segment"]).where("low < doc_id")
             .groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "segment", "offset", "windows")).alias("__found")))
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("kept_text", "n_words", "n_removed")]
    whole = docs.select(*keep, F.col("doc_id").cast("long").alias("__id"), F.col("text").alias("__text"))
    joined = whole.join(found.withColumnRenamed("doc_id", "__id"), "__id", "left")
    return _kept(joined, keep, window)


def cut_passages(docs: DataFrame, folder: Scratch, window: int = WINDOW) -> DataFrame:
    """Documents without repeated passages; a text that loses nothing stays as it is, a document
    that loses every word goes."""
    clean = [c for c in docs.columns if c not in ("kept_text", "n_words", "n_removed")]
    done = remove_repeats(docs.select(*clean), folder, window=window)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return done.where("n_removed = 0 or n_removed < n_words").withColumn("text", text).select(*clean)
