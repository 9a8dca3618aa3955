"""Byte-level BPE encoding and decoding from a file of merge ranks.

The ranks become a tokenizer of the tokenizers library: each byte is written as one
printable character (the byte-to-character table), and a merge is every split of a
token into two known tokens.  Decoding reads the same table backwards.  Tokens may
hold parts of a character, so bytes are joined before they are read as UTF-8.

Null texts are empty and have no ids; repeated rows and extra columns stay as they are.
An input column named like a result is replaced.
"""

from __future__ import annotations

import base64
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm import units, words
from topicflow.llm.common import ship, slices, texts


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if visible Latin-1, else the next from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def tokenizer_json(ranks: dict[bytes, int], pattern: str) -> str:
    """The tokenizer as JSON: its size is that of the vocabulary."""
    shown = byte_characters()
    text = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.__getitem__):
        pairs = [(token[:i], token[i:]) for i in range(1, len(token))]
        merges += [[text[a], text[b]] for a, b in pairs if a in ranks and b in ranks]
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False},
        ]},
        "post_processor": None, "decoder": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False,
                                            "use_regex": False},
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
                  "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": True,
                  "vocab": {text[t]: r for t, r in ranks.items()}, "merges": merges},
    })


class ByteTable:
    """The bytes of each id, by way of the characters that stand for them."""

    def __init__(self, source: str):
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        vocab = json.loads(source)["model"]["vocab"]
        size = max(vocab.values()) + 1
        tokens = [b""] * size
        for token, i in vocab.items():
            tokens[i] = bytes(byte_of[c] for c in token)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[words.ragged(self.begin[ids], self.length[ids])]

    def character_offsets(self, ids: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The character in which each token begins; `data` are the decoded bytes."""
        begin = np.cumsum(self.length[ids]) - self.length[ids]
        started = np.cumsum((data & 0xC0) != 0x80)
        return (started[begin] - 1).astype(np.int32)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", offsets: bool = False,
           keep: list[str] | None = None) -> DataFrame:
    """Add `ids`: little-endian unsigned 32-bit integers, as bytes; with `offsets`, `starts`
    too, the character in which each token begins (signed 32-bit, as bytes)."""
    spark = docs.sparkSession
    ship(spark)
    added = [T.StructField("ids", T.BinaryType())] + [T.StructField("starts", T.BinaryType())] * offsets
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("ids", "starts")]
    chosen = docs.select(*keep, F.col(text).alias("__text"))
    json_text = tokenizer_json(read_ranks(ranks_path), pattern)
    source = spark.sparkContext.broadcast(json_text)
    shared = spark.sparkContext.broadcast(ByteTable(json_text) if offsets else None)

    def run(batches):
        encoder, table = units.encoder(source.value, units.spaced_words), shared.value
        for batch in batches:
            whole = texts(batch.column("__text"))
            for row, part in slices(whole):
                ids, counts = encoder.encode(part)
                out = [batch.column(c).slice(row, len(part)) for c in keep] + [packed(ids, counts)]
                if offsets:
                    starts = [table.character_offsets(one, table.decode(one)) for one in np.split(ids, np.cumsum(counts)[:-1])]
                    out.append(pa.array([s.tobytes() for s in starts], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, [*keep, *(f.name for f in added)])

    schema = T.StructType([chosen.schema[c] for c in keep] + added)
    return chosen.mapInArrow(run, schema)


def packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column: the 4-byte values of each row."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * 4
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.large_binary(), len(counts), buffers).cast(pa.binary())


def decode(docs: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Add `decoded`: the bytes that the ids stand for.  Null ids decode to nothing."""
    spark = docs.sparkSession
    ship(spark)
    keep = [c for c in (docs.columns if keep is None else keep) if c != "decoded"]
    chosen = docs.select(*keep, F.coalesce(F.col(ids), F.lit(b"")).alias("__ids"))
    shared = spark.sparkContext.broadcast(ByteTable(tokenizer_json(read_ranks(ranks_path), pattern)))

    def run(batches):
        table = shared.value
        for batch in batches:
            whole = batch.column("__ids").cast(pa.large_binary())
            for row, part in slices(whole):
                ends = np.frombuffer(part.buffers()[1], np.int64, len(part) + 1, part.offset * 8) // 4
                own = np.frombuffer(part.buffers()[2] or b"", np.uint32)[ends[0]:ends[-1]]
                data = table.decode(own)
                size = np.concatenate([[0], np.cumsum(table.length[own])])[ends - ends[0]]
                buffers = [None, pa.py_buffer(size.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
                out = pa.Array.from_buffers(pa.large_binary(), len(part), buffers).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(row, len(part)) for c in keep), out], [*keep, "decoded"])

    schema = T.StructType([chosen.schema[c] for c in keep] + [T.StructField("decoded", T.BinaryType())])
    return chosen.mapInArrow(run, schema)
