"""WARC archives with an index of their own.

Writing: each task writes gzip-compressed archives, one member per record, under names of
its own, and returns where every record is: file, offset, length, URL and digest.  That
index is a table; files that no row of it names (of a task that was run again) do not count.

Reading: the selected rows of the index are sorted by file and offset and dealt out by their
bytes; near ranges are read at once, up to a bounded size, and each record is parsed from its
own range.

Of pages with equal payloads of at least MIN_REVISIT bytes the one with the largest page_id
is written whole; the others are revisit records that refer to it.  Null html is an empty
payload, a null url leaves its header out.  A page without an id never is the one referred
to, unless all are; repeated rows of the largest id are all written whole.  Other columns are
not stored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import Scratch, ship

MIN_REVISIT = 1000
FILE_BYTES = 256 << 20  # a task goes on in a new archive beyond this
READ_BYTES = 16 << 20  # archived bytes for one reading task
RANGE_BYTES = 4 << 20  # bytes read at once, but for a longer record
GAP_BYTES = 64 << 10  # unwanted bytes that are read rather than skipped
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "page_id long, url string, digest string, file string, offset long, length long"


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _number(name: str) -> int | None:
    text = name.removeprefix("<urn:x-page:").removesuffix(">")
    return None if text == "none" else int(text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record; a revisit keeps the HTTP header but not the payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    else:
        block += payload
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """page_id, record_type, refers_to, payload_digest, payload_bytes and payload (None for a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "page_id": _number(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": _number(fields["WARC-Refers-To"]) if kind == "revisit" else None, "payload": payload if kind == "response" else None,
    }


def write(pages: DataFrame, folder: Scratch, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Archive page_id, url and html; returns the index."""
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("size", F.octet_length("html"))
    kept = (rows.where(F.col("size") >= min_revisit).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
            .where("n > 1 and keeper is not null").select("digest", "keeper"))
    revisit = F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("page_id"))
    rows = rows.join(kept, "digest", "left").withColumn("revisit", revisit).select("page_id", "url", "html", "digest", "keeper", "revisit")
    target = folder.path("archives")
    filesystem, name = pafs.FileSystem.from_uri(target)
    filesystem.create_dir(name, recursive=True)

    def run(batches):
        filesystem, name = pafs.FileSystem.from_uri(target)
        stream, file, at = None, None, 0
        for batch in batches:
            places = []
            columns = [batch.column(c) for c in ("page_id", "url", "html", "digest", "keeper", "revisit")]
            for row in zip(*((x.as_py() for x in c) for c in columns)):
                page_id, url, html, digest, keeper, again = row
                if stream is None or at > FILE_BYTES:
                    if stream is not None:
                        stream.close()
                    file, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    stream = filesystem.open_output_stream(f"{name}/{file}", compression=None)
                data = gzip.compress(record(page_id, url, html.encode(), digest, keeper, again), LEVEL, mtime=0)
                stream.write(data)
                places.append((file, at, len(data)))
                at += len(data)
            files, offsets, lengths = list(zip(*places)) or ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), batch.column("digest"), pa.array([f"{target}/{f}" for f in files], pa.string()),
                 pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], ["page_id", "url", "digest", "file", "offset", "length"])
        if stream is not None:
            stream.close()

    # An archive is closed when its task's rows are all out, so the index is written before any record is read.
    return folder.save("index", rows.mapInArrow(run, _INDEX))


def _ranges(rows: list[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """Sorted (file, offset, length) in runs that one read fetches."""
    run: list[tuple[str, int, int]] = []
    for row in rows:
        file, offset, length = row
        if run and (file != run[0][0] or offset - (run[-1][1] + run[-1][2]) > GAP_BYTES or offset + length - run[0][1] > RANGE_BYTES):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def read(index: DataFrame, payload: bool = False) -> DataFrame:
    """The records of these index rows: page_id, payload_bytes, payload_digest, record_type, refers_to, and on demand the payload."""
    ship(index.sparkSession)
    total = index.agg(F.sum("length")).first()[0] or 0
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if payload:
        kinds["payload"] = pa.binary()
        schema += ", payload binary"

    def run(batches):
        opened: dict = {}
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            for near in _ranges(rows):
                file, begin = near[0][0], near[0][1]
                if file not in opened:
                    for other in opened.values():
                        other.close()
                    filesystem, name = pafs.FileSystem.from_uri(file)
                    opened = {file: filesystem.open_input_file(name)}
                opened[file].seek(begin)
                data = opened[file].read(near[-1][1] + near[-1][2] - begin)
                found = [parse(zlib.decompress(data[o - begin:o - begin + n], 31)) for _, o, n in near]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in found], k) for c, k in kinds.items()], list(kinds))

    # Near rows stay together, and every task reads about as much.
    dealt = index.select("file", "offset", "length").repartitionByRange(int(-(-total // READ_BYTES)) or 1, "file", "offset")
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(run, schema)
