"""Encode each distinct piece of text once.

Both tokenizers cut text at white space, so a text's ids are the ids of its pieces one
after another.  Pieces are told apart by a 64-bit hash; those not seen before go to
the tokenizers library, and numpy puts the ids of all pieces together.  A worker keeps
the pieces it knows up to a bounded number; the bound has no effect on results.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from topicflow.llm import words

CACHE_IDS = 4_000_000  # ids of known pieces that a worker keeps
_AT_ONCE = 4_000  # pieces given to the library in one call

Spans = Callable[[pa.Array], words.Words]


def bare_words(column: pa.Array) -> words.Words:
    """Pieces for tokenizers that drop white space: the words between ASCII white space."""
    return words.split(column, words.NOT_SPACE)


def spaced_words(column: pa.Array) -> words.Words:
    """Pieces for tokenizers that keep white space: a run of ASCII white space with what follows.

    The split pattern never matches across the point where white space begins.  A text with
    other Unicode white space is one piece, as such a run may begin before the ASCII one.
    """
    own = words.split(column, ~words.NOT_SPACE)
    size, offsets = int(own.offsets[-1]), own.offsets
    filled = np.flatnonzero(np.diff(offsets))
    cuts = own.start
    odd = _other_spaces(own.data[:size])
    if len(odd):
        rows = np.unique(np.searchsorted(offsets, odd, side="right") - 1)
        whole = np.zeros(len(offsets), bool)
        whole[rows] = True
        cuts = cuts[~whole[np.searchsorted(offsets, cuts, side="right") - 1]]
    start = np.unique(np.concatenate([offsets[filled], cuts]))
    end = np.append(start[1:], size)[:len(start)]
    return words.Words(own.data, offsets, start, end, np.searchsorted(start, offsets))


def _other_spaces(data: np.ndarray) -> np.ndarray:
    """Where Unicode white space beyond ASCII begins: U+0085 A0 1680 2000-200A 2028 2029 202F 205F 3000."""
    if len(data) < 2:
        return np.empty(0, np.int64)
    lead = (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))
    at = np.flatnonzero(lead[:-1])
    a, b = data[at], data[at + 1]
    c = data[np.minimum(at + 2, len(data) - 1)]
    two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    general = (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    rest = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | (
        (a == 0xE3) & (b == 0x80) & (c == 0x80))
    return at[two | general | rest]


class PieceEncoder:
    """A tokenizer over Arrow texts; `spans` finds the pieces."""

    def __init__(self, tokenizer: Tokenizer, spans: Spans):
        self.tokenizer, self.spans = tokenizer, spans
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.place = np.empty(0, np.int64)  # of a key, in begin
        self.begin = np.zeros(1, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        ids, counts = [self.ids], []
        for lo in range(0, len(pieces), _AT_ONCE):
            done = [e.ids for e in self.tokenizer.encode_batch_fast(pieces[lo:lo + _AT_ONCE], add_special_tokens=False)]
            counts += map(len, done)
            ids.append(np.fromiter((i for one in done for i in one), np.uint32))
        place = np.arange(len(keys)) + len(self.begin) - 1
        self.ids = np.concatenate(ids)
        self.begin = np.append(self.begin, self.begin[-1] + np.cumsum(counts, dtype=np.int64))
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.place = np.insert(self.place, at, place)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a `texts` column, one after another, and the number of ids of each row."""
        own = self.spans(column)
        ids, counts = self.pieces(own)
        sums = np.concatenate([[0], np.cumsum(counts)])
        return ids, sums[own.first[1:]] - sums[own.first[:-1]]

    def pieces(self, own: words.Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after another, and the number of ids of each piece."""
        if not len(own.start):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        distinct, sample, which = np.unique(own.hashes(), return_index=True, return_inverse=True)
        if len(self.ids) > CACHE_IDS:
            self._forget()
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        new = sample[~known]
        if len(new):
            raw = own.data.tobytes()
            pieces = [raw[a:b].decode() for a, b in zip(own.start[new].tolist(), own.end[new].tolist())]
            self._learn(distinct[~known], pieces)
            at = np.searchsorted(self.keys, distinct)
        place = self.place[at][which]
        counts = self.begin[place + 1] - self.begin[place]
        return self.ids[words.ragged(self.begin[place], counts)], counts


_encoders: dict[tuple[str, str], PieceEncoder] = {}


def encoder(source: str, spans: Spans) -> PieceEncoder:
    """This worker's encoder for a tokenizer's JSON; it outlives the task."""
    key = (source, spans.__name__)
    if key not in _encoders:
        # Spark runs a task on each core; threads of the library's own would only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders.clear()
        _encoders[key] = PieceEncoder(Tokenizer.from_str(source), spans)
    return _encoders[key]
