"""An FM-index over sequences of symbols: a wavelet matrix of the Burrows-Wheeler transform.

Suffixes are sorted by their first DEPTH symbols (prefix doubling), which orders all
patterns of up to DEPTH - 1 symbols.  Queries run side by side, one lane each.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


_BLOCK = 9  # words of bits in a block, as a power of two: what precedes a word in its block fits 16 bits


class Bits:
    """A bit vector with the number of ones before any place: a whole number for each block, 16 bits for each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        before = np.cumsum(ones) - ones
        self.blocks = before[::1 << _BLOCK]
        self.before = (before - np.repeat(self.blocks, 1 << _BLOCK)[:len(before)]).astype(np.uint16)

    def rank(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        below = (U64(1) << (i & 63).astype(U64)) - U64(1)
        return self.blocks[word >> _BLOCK] + self.before[word] + np.bitwise_count(self.words[word] & below)


class FMIndex:
    """Sequences of 64-bit symbols, each with a number (`owner`); patterns of up to `threshold` symbols."""

    def __init__(self, sequences: np.ndarray, lengths: np.ndarray, owners: np.ndarray, threshold: int):
        self.threshold = threshold
        self.alphabet = np.unique(sequences)
        # Symbol 0 ends each sequence.
        ends = np.cumsum(lengths + 1)
        self.size = n = int(ends[-1])
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends - 1] = False
        text[inside] = np.searchsorted(self.alphabet, sequences) + 1
        ranks, order = [text], None
        reach = 1
        while reach <= threshold:
            shifted = np.zeros(n, np.int64)
            shifted[:n - reach] = ranks[-1][reach:] + 1
            key = ranks[-1] * (int(shifted.max()) + 1) + shifted
            order = np.argsort(key)
            key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            ranks.append(rank)
            reach *= 2
        # Common prefix of neighbours in the order, from the ranks of 2^k symbols; more than `threshold` counts as that.
        self.common = np.full(n + 1, -1, np.min_scalar_type(-threshold - 1))
        a, b, same = order[:-1], order[1:], np.zeros(n - 1, np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            x, y = a + same, b + same
            fits = (x < n) & (y < n)
            fits[fits] = ranks[k][x[fits]] == ranks[k][y[fits]]
            same += fits.astype(np.int64) << k
        self.common[1:n] = np.minimum(same, threshold)
        del ranks
        last = text[order - 1]  # of the first suffix: the end of the last sequence, also symbol 0
        counts = np.bincount(text, minlength=len(self.alphabet) + 1)
        first = np.cumsum(counts) - counts
        # Wavelet matrix, highest bit first; `base` turns a walk to the last level into a place in the order.
        self.levels = []
        column = last
        at = np.zeros(len(counts), np.int64)
        symbols = np.arange(len(counts))
        for shift in range(max(1, len(self.alphabet).bit_length()) - 1, -1, -1):
            bit = (column >> shift) & 1
            level = Bits(bit)
            zeros = n - int(bit.sum())
            self.levels.append((shift, level, zeros))
            at = self._down(level, zeros, (symbols >> shift) & 1, at)
            column = np.concatenate([column[bit == 0], column[bit == 1]])
        self.base = first - at
        # Groups of suffixes that share `threshold` symbols, and the smallest owner of each.
        breaks = np.flatnonzero(self.common[:n] < threshold)
        owner = np.repeat(owners, lengths + 1)
        self.group_low = np.minimum.reduceat(owner[order], breaks)
        self.breaks = np.append(breaks, n)

    @property
    def nbytes(self) -> int:
        parts = [self.common, self.alphabet, self.base, self.breaks, self.group_low]
        return sum(p.nbytes for p in parts) + sum(level.words.nbytes + level.before.nbytes + level.blocks.nbytes for _, level, _ in self.levels)

    @staticmethod
    def _down(level: Bits, zeros: int, bit: np.ndarray, at: np.ndarray) -> np.ndarray:
        ones = level.rank(at)
        return np.where(bit == 1, zeros + ones, at - ones)

    def codes(self, symbols: np.ndarray) -> np.ndarray:
        """Symbols as numbers from 1; 0 for those that do not occur."""
        place = np.minimum(np.searchsorted(self.alphabet, symbols), len(self.alphabet) - 1)
        return np.where(self.alphabet[place] == symbols, place + 1, 0)

    def extend(self, code: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the suffixes that begin with `code` and go on as those in [lo, hi)."""
        both, codes = np.concatenate([lo, hi]), np.concatenate([code, code])
        for shift, level, zeros in self.levels:
            both = self._down(level, zeros, (codes >> shift) & 1, both)
        both += self.base[codes]
        return both[:len(lo)], both[len(lo):]

    def widen(self, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All suffixes that share the first `depth` symbols with those in [lo, hi)."""
        lo, hi = lo.copy(), hi.copy()
        for d in np.unique(depth):
            breaks = self.breaks if d == self.threshold else np.append(np.flatnonzero(self.common[:self.size] < d), self.size)
            some = depth == d
            lo[some] = breaks[np.searchsorted(breaks, lo[some], side="right") - 1]
            hi[some] = breaks[np.searchsorted(breaks, hi[some])]
        return lo, hi

    def count(self, pattern: np.ndarray) -> int:
        """How often a pattern of up to `threshold` symbols occurs."""
        lo, hi = np.array([0]), np.array([self.size])
        for code in self.codes(np.asarray(pattern))[::-1]:
            lo, hi = self.extend(np.array([code]), lo, hi)
            if not code or hi[0] <= lo[0]:
                return 0
        return int(hi[0] - lo[0])

    def matching(self, queries: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of the queries, one after another: for every place the length of the
        longest match that begins there, up to `threshold`, and where that is reached the smallest
        owner of such a match, else the largest integer."""
        begin = np.cumsum(lengths) - lengths
        codes = self.codes(queries)
        length = np.zeros(len(queries), np.int64)
        owner = np.full(len(queries), np.iinfo(np.int64).max)
        lo, hi = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.size, np.int64)
        matched = np.zeros(len(lengths), np.int64)
        order = np.argsort(-lengths, kind="stable")
        sizes = -lengths[order]
        for step in range(int(lengths.max(initial=0))):
            # Lanes that still have symbols, each at its own place from the right.
            live = order[:np.searchsorted(sizes, -step)]
            at = begin[live] + lengths[live] - 1 - step
            code = codes[at]
            a, b, d = lo[live], hi[live], matched[live]
            x, y = self.extend(code, a, b)
            failed = (y <= x) | (code == 0)
            while failed.any():
                f = np.flatnonzero(failed)
                stuck = f[(d[f] == 0) | (code[f] == 0)]
                x[stuck], y[stuck], d[stuck] = 0, self.size, -1
                f = f[(d[f] > 0)]
                if len(f):
                    # The next shorter match with more suffixes.
                    d[f] = np.maximum(np.maximum(self.common[a[f]], self.common[b[f]]), 0)
                    a[f], b[f] = self.widen(a[f], b[f], d[f])
                    x[f], y[f] = self.extend(code[f], a[f], b[f])
                failed = np.zeros(len(live), bool)
                failed[f] = y[f] <= x[f]
            d += 1
            long = np.flatnonzero(d > self.threshold)
            if len(long):
                d[long] = self.threshold
                x[long], y[long] = self.widen(x[long], y[long], d[long])
            lo[live], hi[live], matched[live] = x, y, d
            length[at] = d
            whole = d == self.threshold
            owner[at[whole]] = self.group_low[np.searchsorted(self.breaks, x[whole], side="right") - 1]
        return length, owner
