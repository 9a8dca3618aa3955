"""Spelling variants: words that differ by one letter, found by PartEnum signatures over letter multisets.

A word is a maximal run of letters (A-Z lower-cased, U+00C0 to U+00FF) of a document.  Where `divisor` divides the unsigned
crc32 of `<doc_id>:<run>`, the run loses the letter at crc32 % length.  The vocabulary has the distinct results of
at least `letters` letters and `least` occurrences.

A word's letters are a binary vector: one place for each first, second, ... occurrence of a letter.  One replaced letter
leaves words of equal length at Hamming distance 2 (or 0 for a letter by itself), one inserted or deleted
letter at distance 1.  PartEnum deals the places out to parts by hash and enumerates the parts that may differ: two of
SAME parts for equal lengths, one of NEXT parts for lengths that differ by one.  What is left of two near words is
equal for one choice at least; its hash, with the lengths, is a signature.  The letter that differs also lies in one half of the
word, so the other half is equal, and is hashed into the signature.  Signatures are joined on equality; every pair
is then verified by its edit distance, so hashes decide nothing and no near pair is lost.

Two words that share a signature share a half in order and most letters of the other: there
are few of them for each word, whatever the corpus.  No group of words is gathered; the join spreads over signatures.

Null and empty texts have no words.  Rows without a doc_id count with their runs unchanged.  Repeated rows count as
often as they occur.  An empty table gives no words.  Texts of any length are taken whole.  Other columns are not read.
Runs of a slice of text are told apart by a 64-bit hash of their bytes.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm import words
from topicflow.llm.common import Scratch, ship, slices, texts

SAME = 5
NEXT = 4
# Counts a task holds before it passes them on.
HELD = 400_000
_ZEROS = 64  # bytes of a run whose crc32 comes from a table; of longer ones it is computed

U64 = np.uint64


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def runs(column: pa.Array) -> words.Words:
    """Runs of letters, lower-cased.  U+00C0 to U+00FF are the two bytes C3 80 to C3 BF."""
    letters = np.zeros(256, bool)
    letters[0x61:0x7B] = True
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    # Bytes that are no letters become spaces; C3 and the byte after it stay.
    data = words.LOWER[raw]
    lead = data == 0xC3
    keep = letters[data] | lead
    keep[1:] |= lead[:-1]
    data = np.where(keep, data, np.uint8(0x20))
    clean = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(np.ascontiguousarray(offsets - offsets[0])), pa.py_buffer(data))
    return words.split(clean, words.NOT_SPACE)


def _shifts(prefixes: list[bytes]) -> np.ndarray:
    """For every length l < _ZEROS and prefix: what the prefix adds, by xor, to the crc32 of l bytes after it."""
    state = np.array([zlib.crc32(p) for p in prefixes], np.uint32) ^ np.uint32(0xFFFFFFFF)
    plain = np.uint32(0xFFFFFFFF)
    out = np.empty((_ZEROS, len(prefixes)), np.uint32)
    for length in range(_ZEROS):
        out[length] = state ^ plain
        state = _CRC[state & np.uint32(0xFF)] ^ (state >> np.uint32(8))
        plain = _CRC[plain & np.uint32(0xFF)] ^ (plain >> np.uint32(8))
    return out


def shorten(run: str, h: int) -> str:
    k = h % len(run)
    return run[:k] + run[k + 1:]


def vocabulary(docs: DataFrame, letters: int = 6, least: int = 5, divisor: int = 199) -> DataFrame:
    """word, n."""
    ship(docs.sparkSession)

    def flush(held: dict[str, int]) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return batch

    def run(batches):
        held: dict[str, int] = {}

        def add(word: str, n: int) -> None:
            if len(word) >= letters:
                held[word] = held.get(word, 0) + n

        for batch in batches:
            keys = batch.column("key")
            for row, part in slices(texts(batch.column("text"))):
                own = runs(part)
                if not len(own.start):
                    continue
                _, first, which = np.unique(own.hashes(), return_index=True, return_inverse=True)
                raw, size = own.data.tobytes(), own.end - own.start
                spelled = [raw[a:b] for a, b in zip(own.start[first].tolist(), own.end[first].tolist())]
                prefixes = [None if x is None else f"{x}:".encode() for x in keys.slice(row, len(part)).to_pylist()]
                crc = np.array([zlib.crc32(w) for w in spelled], np.uint32)
                rows = own.rows()
                h = crc[which] ^ _shifts([p or b"" for p in prefixes])[np.minimum(size, _ZEROS - 1), rows]
                for i in np.flatnonzero(size >= _ZEROS).tolist():
                    h[i] = zlib.crc32(spelled[which[i]], zlib.crc32(prefixes[rows[i]] or b""))
                cut = (h % divisor == 0) & np.array([p is not None for p in prefixes])[rows]
                for i in np.flatnonzero(cut).tolist():
                    add(shorten(spelled[which[i]].decode(), int(h[i])), 1)
                counts = np.bincount(which[~cut], minlength=len(spelled))
                # A letter is at most two bytes, so shorter runs need no decoding.
                for w, n in zip(spelled, counts.tolist()):
                    if n and len(w) >= letters:
                        add(w.decode(), n)
                if len(held) > HELD:
                    yield flush(held)
        yield flush(held)

    rows = docs.select(F.col("doc_id").cast("string").alias("key"), "text")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _parts(letters: np.ndarray, parts: int) -> np.ndarray:
    """Of words of one length (a matrix of code points): a hash of the letters of each part, as a sum."""
    rows = np.sort(letters, axis=1)
    fresh = np.ones(rows.shape, bool)
    fresh[:, 1:] = rows[:, 1:] != rows[:, :-1]
    place = np.arange(rows.shape[1])
    occurrence = place - np.maximum.accumulate(np.where(fresh, place, 0), axis=1)
    h = words.mix((rows.astype(U64) << U64(32)) + occurrence.astype(U64) + U64(parts))
    part = (h >> U64(40)) % U64(parts)
    return np.stack([np.where(part == k, words.mix(h), U64(0)).sum(axis=1, dtype=U64) for k in range(parts)], axis=1)


def _spelling(letters: np.ndarray) -> np.ndarray:
    """A hash of the words, letter by letter."""
    place = np.arange(letters.shape[1], dtype=U64)
    return words.mix(words.mix((letters.astype(U64) << U64(32)) + place).sum(axis=1, dtype=U64))


# Sides of a signature: both words of equal length; the shorter and the longer word.
_EQUAL, _SHORTER, _LONGER = 0, 1, 2


def signatures(letters: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(side, a signature of every word) for words of one length."""
    length = letters.shape[1]
    out = []

    def add(side: int, short: int, parts: np.ndarray, choose: int, half: int) -> None:
        total = parts.sum(axis=1, dtype=U64)
        # The half before or after the letter that differs, as long in both words.
        halves = (_spelling(letters[:, :half]), _spelling(letters[:, length - half:]))
        for number, left_out in enumerate(itertools.combinations(range(parts.shape[1]), choose)):
            rest = words.mix(total - parts[:, list(left_out)].sum(axis=1, dtype=U64) + U64(number * 4096 + short * 2 + (choose == 2)))
            out.extend((side, words.mix(rest + h * U64(2 * k + 3))) for k, h in enumerate(halves))

    add(_EQUAL, length, _parts(letters, SAME), 2, length // 2)
    by_next = _parts(letters, NEXT)
    add(_SHORTER, length, by_next, 1, length // 2)
    add(_LONGER, length - 1, by_next, 1, (length - 1) // 2)
    return out


def _signed(found: DataFrame) -> DataFrame:
    """word, n, side, signature."""

    def run(batches):
        for batch in batches:
            column = texts(batch.column("word"))
            spelled, n = column.to_pylist(), batch.column("n").to_numpy()
            size = np.array([len(w) for w in spelled], np.int64)
            for length in np.unique(size).tolist():
                own = np.flatnonzero(size == length)
                letters = np.frombuffer("".join(spelled[i] for i in own.tolist()).encode("utf-32-le"), "<u4").reshape(-1, length)
                for side, keys in signatures(letters):
                    yield pa.RecordBatch.from_arrays([
                        column.take(pa.array(own)).cast(pa.string()), pa.array(n[own]), pa.array(np.full(len(own), side, np.int8)), pa.array(keys.view(np.int64)),
                    ], ["word", "n", "side", "signature"])

    return found.mapInArrow(run, "word string, n long, side byte, signature long")


def near(found: DataFrame, folder: Scratch) -> DataFrame:
    """a, a_n, b, b_n: all pairs of near words of a vocabulary (word, n), once each."""
    signed = folder.save("signatures", _signed(found))
    a = signed.where(F.col("side") != _LONGER).select("signature", F.col("word").alias("a"), F.col("n").alias("a_n"), (F.col("side") == _EQUAL).alias("equal"))
    b = signed.where(F.col("side") != _SHORTER).select("signature", F.col("word").alias("b"), F.col("n").alias("b_n"), (F.col("side") == _EQUAL).alias("equal"))
    pairs = a.join(b, ["signature", "equal"]).where(~F.col("equal") | (F.col("a") < F.col("b")))
    # The distance counts code points.
    return pairs.where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").distinct()


def group(docs: DataFrame, folder: Scratch, letters: int = 6, least: int = 5, divisor: int = 199, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n.

    The form of a word is its near word of largest n (ties: the smallest) if that n is `ratio` times the
    word's own or more.  `root` follows the forms to the last.
    """
    found = folder.save("vocabulary", vocabulary(docs, letters, least, divisor))
    pairs = folder.save("near", near(found, folder))
    folder.drop("signatures")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).union(pairs.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    has = -F.col("best.less") >= ratio * F.col("n")
    forms = folder.save("forms", found.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("best.other")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n")))
    return forms.join(roots(forms, folder, ratio), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(forms: DataFrame, folder: Scratch, ratio: int) -> DataFrame:
    """word, root of the words that have a form: ways double until none grows.

    n grows by `ratio` at every step and has 63 bits, so there are few rounds.
    """
    ways = forms.where("form is not null").select("word", F.col("form").alias("root"))
    for turn in itertools.count():
        ways = folder.save(f"ways-{turn}", ways)
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = ways.join(on, "root", "left")
        if turn and longer.where("further is not null").isEmpty():
            return ways
        ways = longer.select("word", F.coalesce("further", "root").alias("root"))
