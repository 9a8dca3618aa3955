"""Vectorised words over Arrow text buffers.

Separators are ASCII, so words are found on UTF-8 bytes: no Python string is made
for a word.  A word is identified by a 64-bit hash of its bytes and its length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
_K0, _K1, _K2 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_R = 0xD6E8FEB86659FD93
_LONG = 64  # bytes of a word that the vector loop hashes; a longer word adds one xxhash of the whole

# byte -> is part of a word
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, bool)  # digits, a-z and all bytes of non-ASCII characters, after lower-casing
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], U64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(30))) * _K1
    h = (h ^ (h >> U64(27))) * _K2
    return h ^ (h >> U64(31))


@dataclass
class Words:
    """Words of some rows: byte spans into `data`, and the first word of each row (one more at the end)."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def valid(self, n: int) -> np.ndarray:
        """Whether n words from here are in one row."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.start))
        return left >= n


def split(column: pa.Array, inside: np.ndarray, lower: bool = False) -> Words:
    """Words of a `texts` column (no nulls): maximal runs of bytes marked in `inside`."""
    rows = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, rows + 1, column.offset * 8) if rows else np.zeros(1, np.int64)
    size = int(offsets[-1] - offsets[0])
    data = np.zeros(size + 8, np.uint8)
    if size:
        raw = np.frombuffer(column.buffers()[2], np.uint8, size, int(offsets[0]))
        data[:size] = LOWER[raw] if lower else raw
    offsets = offsets - offsets[0]
    mark = inside[data[:size]]
    before = np.empty(size, bool)
    before[1:] = mark[:-1]
    after = np.empty(size, bool)
    after[:-1] = mark[1:]
    if size:
        before[0] = after[-1] = False
        cuts = offsets[(offsets > 0) & (offsets < size)]
        before[cuts] = False
        after[cuts - 1] = False
    start = np.flatnonzero(mark & ~before)
    end = np.flatnonzero(mark & ~after) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; `data` is padded by 8 bytes."""
    view = np.ndarray((len(data) - 7,), "<u8", buffer=data.data, strides=(1,))
    n = end - start
    h = n.astype(U64) * _K0
    live, at, left = None, start, n
    for _ in range(_LONG // 8):
        c = view[at] & _MASK[np.minimum(left, 8)]
        if live is None:
            h = (h ^ c) * _K1
            h ^= h >> U64(32)
        else:
            g = (h[live] ^ c) * _K1
            h[live] = g ^ (g >> U64(32))
        more = left > 8
        if not more.any():
            break
        live = np.flatnonzero(more) if live is None else live[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(n > _LONG):
        h[i] ^= U64(xxhash.xxh64_intdigest(data[start[i]:end[i]].tobytes()))
    return mix(h)


_powers = np.ones(1, U64)
_inverse = np.ones(1, U64)


def _sums(h: np.ndarray) -> np.ndarray:
    """Prefix sums of the entries times the powers of a fixed odd number."""
    global _powers, _inverse
    m = len(h)
    if len(_powers) < m + 1:
        r = np.full(max(m + 1, 1 << 18), U64(_R))
        r[0] = 1
        _powers = np.cumprod(r, dtype=U64)
        r[1:] = U64(pow(_R, -1, 1 << 64))
        _inverse = np.cumprod(r, dtype=U64)
    sums = np.zeros(m + 1, U64)
    np.cumsum(h * _powers[:m], dtype=U64, out=sums[1:])
    return sums


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive entries of h, rows not looked at; shorter by n - 1."""
    if len(h) < n:
        return np.empty(0, U64)
    sums = _sums(h)
    return mix((sums[n:] - sums[:-n]) * _inverse[:len(h) - n + 1] + U64(n))


def range_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs h[start:end]; equal to those of `gram_hashes`."""
    sums = _sums(h)
    return mix((sums[end] - sums[start]) * _inverse[start] + (end - start).astype(U64))


class Sorted:
    """Where hashes stand among sorted ones.  They are evenly spread, so their first bits tell the place but for a few steps."""

    def __init__(self, keys: np.ndarray):
        self.n = len(keys)
        bits = max(1, self.n.bit_length())
        self.shift = U64(64 - bits)
        self.begin = np.searchsorted(keys >> self.shift, np.arange(1 << bits, dtype=U64)).astype(np.int32)
        self.keys = np.append(keys, U64(0xFFFFFFFFFFFFFFFF))

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each; the number of keys for those not among them."""
        at = self.begin[h >> self.shift]
        live = np.flatnonzero(self.keys[at] < h)
        while len(live):
            at[live] += 1
            live = live[self.keys[at[live]] < h[live]]
        at[self.keys[at] != h] = self.n
        return at


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices of several runs, one after another: start[i], start[i] + 1, ..."""
    total = int(length.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(total) + np.repeat(start - (ends - length), length)
