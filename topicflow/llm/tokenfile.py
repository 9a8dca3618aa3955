"""Token ids in files of fixed-width packed bits.

A file holds blocks of ids, each id in the fewest bits that the vocabulary needs, then
an index: the ids and first tokens of its documents, the byte offset of every block.
A block starts on a whole byte, so any run of tokens is read from the blocks that
hold it, and numpy unpacks a block in a few vector steps.

    magic | blocks | doc ids (int64) | null flags (uint8) | first tokens (int64, one more) | block offsets (int64)
    | JSON footer | footer length (uint32) | magic

Writing: documents are sorted by id over the cluster, each task encodes and writes its
range under a name of its own, and the rows that come back name the files that count;
a task that is run again leaves no trace in them.  The files and their numbers of ids
are listed in a manifest, from which every file knows how many ids come before it.

Order: ascending doc_id, null ids first, then by text.  Null texts are empty: only the
end id.  Repeated rows are written as often as they come.  Other columns are not stored.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from topicflow.llm import units
from topicflow.llm.common import Scratch, ship, slices, texts

MAGIC = b"TOKBITS1"
BLOCK = 1 << 16  # ids in a block, a multiple of 8
FILE_IDS = 64 << 20  # a task goes on in a new file beyond this


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in `bits` bits each, lowest bit first; the last byte is filled up with zeros."""
    n = -(-len(ids) // 8)
    rows = np.zeros((n, 8), np.uint64)
    rows.reshape(-1)[:len(ids)] = ids
    out = np.zeros((n, bits), np.uint8)
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        value = rows[:, k] << np.uint64(shift)
        for j in range(-(-(shift + bits) // 8)):
            out[:, byte + j] |= (value >> np.uint64(8 * j)).astype(np.uint8)
    return out.tobytes()[:-(-len(ids) * bits // 8)]


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    n = -(-count // 8)
    rows = np.zeros(n * bits, np.uint8)
    rows[:len(data)] = np.frombuffer(data, np.uint8)
    rows = rows.reshape(n, bits)
    out = np.empty((n, 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        value = np.zeros(n, np.uint64)
        for j in range(-(-(shift + bits) // 8)):
            value |= rows[:, byte + j].astype(np.uint64) << np.uint64(8 * j)
        out[:, k] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:count]


class TokenWriter:
    """Writes one file; holds less than a block of ids and the document index."""

    def __init__(self, stream, bits: int):
        self.stream, self.bits = stream, bits
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.doc_ids: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.blocks = [len(MAGIC)]
        stream.write(MAGIC)

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        self.doc_ids.append(doc_ids)
        self.nulls.append(nulls)
        self.counts.append(counts)
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK:
            ready = np.concatenate(self.waiting)
            stop = len(ready) - len(ready) % BLOCK
            for lo in range(0, stop, BLOCK):
                self._block(ready[lo:lo + BLOCK])
            self.waiting, self.n_waiting = [ready[stop:]], len(ready) - stop

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.stream.write(data)
        self.blocks.append(self.blocks[-1] + len(data))

    def close(self) -> dict:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        doc_ids = np.concatenate([np.empty(0, np.int64), *self.doc_ids])
        first = np.concatenate([[0], np.cumsum(np.concatenate([np.empty(0, np.int64), *self.counts]))])
        self.stream.write(doc_ids.astype("<i8").tobytes())
        self.stream.write(np.concatenate([np.empty(0, np.uint8), *self.nulls]).astype(np.uint8).tobytes())
        self.stream.write(first.astype("<i8").tobytes())
        self.stream.write(np.array(self.blocks, "<i8").tobytes())
        footer = {"bits": self.bits, "block": BLOCK, "n_docs": len(doc_ids), "n_ids": self.n_ids, "index": self.blocks[-1],
                  "n_blocks": len(self.blocks) - 1}
        raw = json.dumps(footer).encode()
        self.stream.write(raw + struct.pack("<I", len(raw)) + MAGIC)
        return footer


class TokenFile:
    """Random access to one file: an open stream and its index."""

    def __init__(self, stream, size: int):
        self.stream = stream
        tail = self._at(size - 12, 12)
        if tail[4:] != MAGIC:
            raise ValueError("not a token file")
        (length,) = struct.unpack("<I", tail[:4])
        footer = json.loads(self._at(size - 12 - length, length))
        self.bits, self.block, self.n_ids, n = footer["bits"], footer["block"], footer["n_ids"], footer["n_docs"]
        raw = self._at(footer["index"], size - 12 - length - footer["index"])
        self.doc_ids = np.frombuffer(raw, "<i8", n)
        self.nulls = np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool)
        self.first = np.frombuffer(raw, "<i8", n + 1, 9 * n)
        self.blocks = np.frombuffer(raw, "<i8", footer["n_blocks"] + 1, 9 * n + 8 * (n + 1))

    def _at(self, offset: int, length: int) -> bytes:
        self.stream.seek(offset)
        return self.stream.read(length)

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop of the file, from the blocks that hold them."""
        if start >= stop:
            return np.empty(0, np.uint32)
        lo, hi = start // self.block, (stop - 1) // self.block
        data = self._at(int(self.blocks[lo]), int(self.blocks[hi + 1] - self.blocks[lo]))
        begin = lo * self.block
        count = min(self.n_ids, (hi + 1) * self.block) - begin
        return unpack(data, count, self.bits)[start - begin:stop - begin]

    def document(self, i: int) -> np.ndarray:
        return self.tokens(int(self.first[i]), int(self.first[i + 1]))

    def documents(self, max_ids: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
        """Runs of whole documents of about max_ids ids: (first document, after the last, their ids)."""
        row, n = 0, len(self.doc_ids)
        while row < n:
            stop = int(np.searchsorted(self.first, self.first[row] + max_ids, side="right")) - 1
            stop = min(n, max(stop, row + 1))
            yield row, stop, self.tokens(int(self.first[row]), int(self.first[stop]))
            row = stop


def open_file(path: str) -> TokenFile:
    filesystem, name = pafs.FileSystem.from_uri(path)
    return TokenFile(filesystem.open_input_file(name), filesystem.get_file_info(name).size)


def write(docs: DataFrame, tokenizer_path: str, folder: Scratch, end_id: int = 1, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode doc_id and text into files; returns the manifest: a row per file, with `before`,
    the number of ids in all files before it."""
    spark = docs.sparkSession
    ship(spark)
    tokenizer = Tokenizer.from_file(tokenizer_path)
    bits = max(1, (tokenizer.get_vocab_size(with_added_tokens=True) - 1).bit_length(), end_id.bit_length())
    source = spark.sparkContext.broadcast(tokenizer.to_str())
    target = folder.path("files")
    filesystem, name = pafs.FileSystem.from_uri(target)
    filesystem.create_dir(name, recursive=True)

    def run(batches):
        encoder = units.encoder(source.value, units.bare_words)
        filesystem, _ = pafs.FileSystem.from_uri(target)
        part, seq = TaskContext.get().partitionId(), 0
        done, writer, stream, path = [], None, None, None

        def close():
            footer = writer.close()
            stream.close()
            done.append((part, seq, path, footer["n_docs"], footer["n_ids"]))

        for batch in batches:
            doc_ids = batch.column("doc_id").cast(pa.int64())
            whole = texts(batch.column("text"))
            for row, column in slices(whole):
                ids, counts = encoder.encode(column)
                ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
                if writer is not None and writer.n_ids >= file_ids:
                    close()
                    writer, seq = None, seq + 1
                if writer is None:
                    path = f"{target}/{part:06d}-{seq:04d}-{uuid.uuid4().hex}.tok"
                    stream = filesystem.open_output_stream(pafs.FileSystem.from_uri(path)[1], compression=None)
                    writer = TokenWriter(stream, bits)
                own = doc_ids.slice(row, len(column))
                writer.add(own.fill_null(0).to_numpy(), own.is_null().to_numpy(zero_copy_only=False), ids, counts + 1)
        if writer is not None:
            close()
        names = ["part", "seq", "path", "n_docs", "n_ids"]
        columns = list(zip(*done)) or [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # The hash only splits a doc_id that very many rows share.
    spread = rows.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    manifest = folder.save("manifest", spread.mapInArrow(run, "part int, seq int, path string, n_docs long, n_ids long"))
    # One row per file.
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))


def read(manifest: DataFrame, extra: dict) -> DataFrame:
    """Documents of all listed files: doc_id, start (ids before it over all files), n_tokens and
    what the functions of `extra` make of each document's ids: {name: (Spark type, Arrow type, function)}."""
    ship(manifest.sparkSession)
    functions = [(name, kind, make) for name, (_, kind, make) in extra.items()]

    def run(batches):
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                tokens = open_file(path)
                for lo, hi, ids in tokens.documents():
                    first = tokens.first[lo:hi + 1]
                    cut = (first - first[0]).tolist()
                    made = [pa.array([make(ids[a:b]) for a, b in zip(cut, cut[1:])], kind) for _, kind, make in functions]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(tokens.doc_ids[lo:hi], pa.int64(), mask=tokens.nulls[lo:hi]),
                        pa.array(first[:-1] + before, pa.int64()), pa.array(np.diff(first), pa.int64()), *made,
                    ], ["doc_id", "start", "n_tokens", *extra])

    schema = "doc_id long, start long, n_tokens long" + "".join(f", {n} {kind}" for n, (kind, _, _) in extra.items())
    # A task for each file, whatever the size of the manifest.
    files = manifest.select("path", "before").repartitionByRange(max(1, manifest.count()), "path")
    return files.mapInArrow(run, schema)
