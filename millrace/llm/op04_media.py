"""Media columns: content-addressed payloads in tar shards.

Each task writes the payloads of its rows to tar shards in the shared folder, equal payloads once,
and gives each row the digest, shard, offset and length. A digest that several tasks stored keeps
one address, the least, for all its rows; payloads are never shuffled. Range reads at that address
then fill the columns: the header alone gives the dimensions, the whole form gives digests and
features.

A payload is a text's UTF-8 bytes, filled up with spaces to a positive multiple of 192. It is
stored losslessly as a PNG image of 8-bit grey samples, 192 to a row.

A task that runs again writes shards under new names, and only rows of the attempt that counts
reach the index, so that a lost executor leaves unused files at worst. Shards are as durable as
spark.checkpoint.dir, which Python must reach through pyarrow's file systems (local paths, hdfs
and object stores).

Cases: a null or empty text is 192 spaces, n_bytes 0; equal texts share all values; texts that
only differ in spaces at their end may share a payload, but not n_bytes; null ids and repeated
rows each get their row; an empty table writes no shard and gives no rows. Memory holds the
longest payload twice and, in a task, one digest a distinct payload of its own rows.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import durable, pick, shared_dir

# Of the contract, the row width and the filling byte; of the PNG format, the
# signature, the header's length and the colour type of grey.
WIDTH, FILL = 192, b" "
SIGNATURE, HEADER_BYTES, GREY = b"\x89PNG\r\n\x1a\n", 33, 0

SHARD_BYTES = 256 << 20
TAIL = 16
OPEN_SHARDS = 8
ROWS_AT_ONCE = 64

INDEX = "doc_id bigint, n_bytes bigint, digest string, shard string, at bigint, length bigint"


def payload_of(text: str | None) -> bytes:
    data = (text or "").encode()
    return data.ljust(max(1, -(-len(data) // WIDTH)) * WIDTH, FILL)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    height = len(payload) // WIDTH
    rows = np.zeros((height, WIDTH + 1), np.uint8)  # each row begins with filter type 0
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(height, WIDTH)
    header = struct.pack(">IIBBBBB", WIDTH, height, 8, GREY, 0, 0, 0)
    body = zlib.compress(rows.tobytes(), 6)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", body) + _chunk(b"IEND", b"")


def read_header(head: bytes) -> tuple[int, int]:
    """Width and height from the first HEADER_BYTES of a stored form."""
    if head[:8] != SIGNATURE or head[12:16] != b"IHDR":
        raise ValueError("not a stored payload")
    width, height, depth, colour = struct.unpack(">IIBB", head[16:26])
    if (depth, colour) != (8, GREY):
        raise ValueError("not 8-bit grey samples")
    return width, height


def from_png(stored: bytes) -> bytes:
    width, height = read_header(stored[:HEADER_BYTES])
    at, data = HEADER_BYTES, []
    while at < len(stored):
        (n,) = struct.unpack(">I", stored[at : at + 4])
        kind, body = stored[at + 4 : at + 8], stored[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack(">I", stored[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("a stored payload is damaged")
        if kind == b"IDAT":
            data.append(body)
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("an unknown row filter")
    return rows[:, 1:].tobytes()


def features(payload: bytes) -> str:
    """Rows, sum, distinct values and counts in eight bands of the samples."""
    samples = np.frombuffer(payload, np.uint8)
    counts = np.bincount(samples, minlength=256)
    bands = ",".join(map(str, counts.reshape(8, 32).sum(axis=1)))
    total = int((counts * np.arange(256)).sum())
    return f"rows={len(samples) // WIDTH};sum={total};values={np.count_nonzero(counts)};bands={bands}"


class _Shards:
    """Tar shards that one task writes, one after the other."""

    def __init__(self, folder: str) -> None:
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.out = self.tar = None
        self.name = ""

    def add(self, digest: str, data: bytes) -> tuple[str, int, int]:
        if self.tar is None or self.tar.offset > SHARD_BYTES:
            self.close()
            self.name = f"shard-{uuid.uuid4().hex}.tar"
            self.fs.create_dir(self.folder, recursive=True)
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}")
            self.tar = tarfile.open(fileobj=self.out, mode="w|")
        entry = tarfile.TarInfo(f"{digest}.png")
        entry.size = len(data)
        start = self.tar.offset + len(entry.tobuf(self.tar.format, self.tar.encoding, self.tar.errors))
        self.tar.addfile(entry, io.BytesIO(data))
        return self.name, start, len(data)

    def close(self) -> None:
        if self.tar is not None:
            self.tar.close()
            self.out.close()
            self.tar = self.out = None


def store(docs: DataFrame, folder: str) -> DataFrame:
    """Writes the shards, and gives an index row a row of docs: INDEX."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("digest", pa.string()),
         ("shard", pa.string()), ("at", pa.int64()), ("length", pa.int64())]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, known = _Shards(folder), {}
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                text = text.as_py() or ""
                payload = payload_of(text)
                digest = hashlib.sha256(payload).hexdigest()
                if digest not in known:
                    known[digest] = shards.add(digest, to_png(payload))
                rows.append((doc.as_py(), len(text.encode()), digest, *known[digest]))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
            if rows:
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        shards.close()

    # The index is stored before anything reads it: the shards it names are then complete.
    return durable(pick(docs, "doc_id", "text").mapInArrow(write, INDEX))


def addresses(index: DataFrame) -> DataFrame:
    """One address for each digest."""
    return index.groupBy("digest").agg(
        F.min(F.struct("shard", "at", "length")).alias("a")
    ).select("digest", "a.shard", "a.at", "a.length")


def _ranges(batches: Iterator[pa.RecordBatch], folder: str, header_only: bool):
    """(batch, stored bytes of each row or their header) for rows of addresses."""
    fs, root = pafs.FileSystem.from_uri(folder)
    handles: OrderedDict[str, pa.NativeFile] = OrderedDict()
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part, found = batch.slice(start, ROWS_AT_ONCE), []
            for shard, at, length in zip(*(part[c].to_pylist() for c in ("shard", "at", "length"))):
                if shard not in handles:
                    handles[shard] = fs.open_input_file(f"{root}/{shard}")
                    if len(handles) > OPEN_SHARDS:
                        handles.popitem(last=False)[1].close()
                found.append(handles[shard].read_at(HEADER_BYTES if header_only else length, at))
            yield part, found


def header_columns(located: DataFrame, folder: str) -> DataFrame:
    """located (digest, shard, at, length) with width and height, by reading headers only."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, heads in _ranges(batches, folder, True):
            sizes = [read_header(h) for h in heads]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(pa.array([s[i] for s in sizes], pa.int64()) for i in (0, 1))],
                names=[*part.schema.names, "width", "height"],
            )

    return located.mapInArrow(
        read, "digest string, shard string, at bigint, length bigint, width bigint, height bigint"
    )


DECODED = (
    "digest string, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, "
    "media_bytes bigint, media_sha256 string, feature string"
)


def decoded_columns(located: DataFrame, folder: str) -> DataFrame:
    """digest and what the whole stored form gives, read back from the shards."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, stored in _ranges(batches, folder, False):
            rows = []
            for data in stored:
                payload = from_png(data)
                rows.append(
                    (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-TAIL:]),
                     len(data), hashlib.sha256(data).hexdigest(), features(payload))
                )
            yield pa.RecordBatch.from_arrays(
                [part["digest"], *(pa.array(c) for c in zip(*rows))],
                names=[c.split()[0] for c in DECODED.split(", ")],
            )

    return located.mapInArrow(read, DECODED)


def media(docs: DataFrame) -> DataFrame:
    """A row per row of docs: doc_id, n_bytes, the columns of DECODED, shard, at, width, height."""
    folder = shared_dir(docs.sparkSession)
    index = store(docs, folder)
    # Neighbours in a shard are read by the same task, in their order.
    located = addresses(index).repartitionByRange("shard", "at").sortWithinPartitions("shard", "at")
    located = durable(located)
    headers = header_columns(located, folder).drop("length")
    found = headers.join(decoded_columns(located, folder), "digest")
    return index.select("doc_id", "n_bytes", "digest").join(found, "digest", "left").select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes",
        "media_sha256", "feature", "shard", "at", "width", "height",
    )
