"""Benchmark decontamination: a broadcast hash set of test n-grams against windows of training words.

Words are lower-cased (A-Z) runs of digits, a-z and non-ASCII characters.  A window
is 13 consecutive words of an item, or the whole of a shorter item.  Document windows
are looked up by hash, and every hit is verified word by word, by 64-bit hashes of the words,
before it counts.

The set is broadcast in blocks of bounded size, one scan per block: one block up to
BLOCK_CHARS of item text, more beyond.  Of several blocks one is alive at a time: what a
scan finds is written before the next block is collected.  Documents never shuffle.

Null texts have no words; an item without words has no window; an item without an id
counts as the item with the empty id; repeated rows are judged one by one.  Extra
columns pass through; one named like the result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm import words
from topicflow.llm.common import Scratch, ship, slices, texts

WINDOW = 13
BLOCK_CHARS = 8_000_000  # characters of item text in one broadcast block

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),  # [from, to) in words, merged, in order
    T.StructField("items", T.ArrayType(T.StringType())),  # ids of the items found, sorted as text
])
_FOUND_ARROW = pa.struct([
    ("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int32()))), ("items", pa.list_(pa.string())),
])


class Grams:
    """The windows of one block of items, as sorted hashes by window length."""

    def __init__(self, ids: list[str], items: list[str], window: int):
        own = words.split(texts(pa.array(items, pa.string())), words.ALNUM, lower=True)
        hashes, counts, rows = own.hashes(), own.counts, own.rows()
        self.ids = np.array(ids, object)
        self.by_length = {}
        self.low: dict[int, tuple[np.ndarray, np.uint64]] = {}  # made by each worker
        for n in sorted({min(window, int(c)) for c in counts if c}):
            # Whole items if shorter than a window, else every window of them.
            at = np.flatnonzero(own.valid(n) & (counts[rows] >= window if n == window else counts[rows] == n))
            keys = words.gram_hashes(hashes, n)[at]
            order = np.argsort(keys, kind="stable")
            keys, at = keys[order], at[order]
            distinct, begin = np.unique(keys, return_index=True)
            # The words themselves, to verify hits; and all items that have this window.
            self.by_length[n] = distinct, hashes[at[begin][:, None] + np.arange(n)], np.append(begin, len(keys)), rows[at]

    def _likely(self, n: int) -> tuple[np.ndarray, np.uint64]:
        """A table of the low hash bits; it keeps nearly all windows from the binary search."""
        if n not in self.low:
            distinct = self.by_length[n][0]
            mask = np.uint64((1 << max(16, int(len(distinct) * 16).bit_length())) - 1)
            table = np.zeros(int(mask) + 1, bool)
            table[(distinct & mask).astype(np.int64)] = True
            self.low[n] = table, mask
        return self.low[n]

    def hits(self, hashes: np.ndarray, valid) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length: window starts that hit, and for these the run of `items` rows."""
        for n, (distinct, sequences, begin, rows) in self.by_length.items():
            grams = words.gram_hashes(hashes, n)
            if not len(grams):
                continue
            low, mask = self._likely(n)
            at = np.flatnonzero(low[(grams & mask).astype(np.int64)])
            at = at[valid(n)[at]]
            slot = np.minimum(np.searchsorted(distinct, grams[at]), len(distinct) - 1)
            same = distinct[slot] == grams[at]
            at, slot = at[same], slot[same]
            for lo in range(0, len(at), 100_000):
                a, s = at[lo:lo + 100_000], slot[lo:lo + 100_000]
                exact = (hashes[a[:, None] + np.arange(n)] == sequences[s]).all(axis=1)
                a, s = a[exact], s[exact]
                yield n, a, begin[s], begin[s + 1], rows


def _scan(column: pa.Array, grams: Grams, before: list | None) -> pa.Array:
    out = []
    for first, part in slices(texts(column)):
        own = words.split(part, words.ALNUM, lower=True)
        hashes, rows = own.hashes(), own.rows()
        size = len(hashes)
        edge = np.zeros(size + 1, np.int64)
        pairs = [np.empty((0, 2), np.int64)]
        for n, at, lo, hi, item_rows in grams.hits(hashes, own.valid):
            np.add.at(edge, at, 1)
            np.add.at(edge, at + n, -1)
            many = hi - lo
            pairs.append(np.stack([np.repeat(rows[at], many), item_rows[words.ragged(lo, many)]], axis=1))
        # A window never crosses rows, so covered runs are cut where a row ends.
        covered = np.cumsum(edge[:size]) > 0
        begins = covered.copy()
        begins[1:] &= ~covered[:-1]
        cuts = own.first[(own.first > 0) & (own.first < size)]
        begins[cuts] = covered[cuts]
        run_from = np.flatnonzero(begins)
        ends = covered.copy()
        ends[:-1] &= ~covered[1:]
        ends[cuts - 1] = covered[cuts - 1]
        run_to = np.flatnonzero(ends) + 1
        spans: dict[int, list] = {}
        for r, a, b, base in zip(rows[run_from].tolist(), run_from.tolist(), run_to.tolist(),
                                 own.first[rows[run_from]].tolist()):
            spans.setdefault(r, []).append([a - base, b - base])
        items: dict[int, set] = {}
        for r, i in np.unique(np.concatenate(pairs), axis=0).tolist():
            items.setdefault(r, set()).add(grams.ids[i])
        for r, n in enumerate(own.counts.tolist()):
            found = {"n_words": n, "spans": spans.get(r, []), "items": sorted(items.get(r, ()))}
            if before is not None and before[first + r]["spans"]:
                found = _joined(found, before[first + r])
            out.append(found)
    return pa.array(out, _FOUND_ARROW)


def _joined(a: dict, b: dict) -> dict:
    """Hits of two blocks of items in one document."""
    merged: list[list[int]] = []
    for lo, hi in sorted(a["spans"] + b["spans"]):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    return {"n_words": a["n_words"], "spans": merged, "items": sorted(set(a["items"]) | set(b["items"]))}


def find(docs: DataFrame, items: DataFrame, out: str = "found", text: str = "text", keep: list[str] | None = None,
         window: int = WINDOW, block_chars: int = BLOCK_CHARS, folder: Scratch | None = None) -> DataFrame:
    """Documents with a struct of their words, hit spans and found items.

    `keep` names the columns to carry along (all).  `items` has item_id and text.  `folder` takes the
    written scans of several blocks; with one block nothing is written.
    """
    spark = docs.sparkSession
    ship(spark)
    keep = [c for c in (docs.columns if keep is None else keep) if c != out]
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"),
                        F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // block_chars) or 1
    found = docs.select(*keep, F.col(text).alias("__text"))
    if blocks > 1 and folder is None:
        folder = Scratch(spark, "leaks")
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        grams = spark.sparkContext.broadcast(Grams([r.id for r in part], [r.text for r in part], window))
        found = _pass(found, grams, keep, out, block)
        if block + 1 < blocks:
            found = folder.save(f"block-{block}", found)
            grams.destroy()
            if block:
                folder.drop(f"block-{block - 1}")
    return found.drop("__text")


def _pass(docs: DataFrame, grams, keep: list[str], out: str, block: int) -> DataFrame:
    schema = T.StructType([f for f in docs.schema.fields if f.name != out] + [T.StructField(out, FOUND)])

    def run(batches):
        for batch in batches:
            before = batch.column(out).to_pylist() if block else None
            columns = [batch.column(c) for c in batch.schema.names if c != out]
            names = [c for c in batch.schema.names if c != out]
            yield pa.RecordBatch.from_arrays([*columns, _scan(batch.column("__text"), grams.value, before)], [*names, out])

    return docs.mapInArrow(run, schema)


def n_hit(found: Column) -> Column:
    """Words inside hit spans."""
    return F.aggregate(found["spans"], F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def contaminated(found: Column) -> Column:
    """The contamination rule: at least a twentieth of the words are hit."""
    return (n_hit(found) > 0) & (20 * n_hit(found) >= found["n_words"])


def drop_documents(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    found = find(docs, items, out="__found", text=text, window=window)
    return found.where(~contaminated(F.col("__found"))).select(*docs.columns)


def cut_spans(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """All documents, the words of hit spans (and what is between these) cut out of their text."""
    found = find(docs, items, out="__found", text=text, window=window)

    @F.pandas_udf(T.StringType())
    def cut(column, hit):
        done = []
        for value, row in zip(column, hit["spans"]):
            if value is None or not len(row):
                done.append(value)
                continue
            own = words.split(texts(pa.array([value])), words.ALNUM, lower=True)
            raw, parts, at = value.encode(), [], 0
            for lo, hi in row:
                parts.append(raw[at:own.start[lo]])
                at = own.end[hi - 1]
            done.append(b"".join([*parts, raw[at:]]).decode())
        import pandas as pd

        return pd.Series(done, dtype=object)

    return found.withColumn(text, cut(F.col(text), F.col("__found"))).select(*docs.columns)
