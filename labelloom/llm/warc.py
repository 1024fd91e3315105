"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some whole records, and a seek table in a skippable
frame at its end (the Zstandard seekable format). A record is found by its bundle, its frame and its offset within the
decompressed frame, so reading one record costs the seek table and one frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.session import new_path, stage

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
#: Fixed values of the seekable format: skippable frame, seek table footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = (
    "page_id long, record_id string, bundle string, frame int, frame_offset long, frame_bytes long, "
    "record_offset long, record_bytes long"
)
#: Frames that a task reads; they are unpacked one at a time.
FRAMES_A_TASK = 64
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC 1.1 record. A revisit holds the HTTP head only, whose Content-Length is that of the full payload."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=URI_SAFE)}")
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


URI_SAFE = "".join(chr(c) for c in range(0x21, 0x7F) if chr(c) not in '"<>\\^`{|}')


def parse(data: memoryview, start: int) -> tuple[dict[str, str], memoryview, int]:
    """Header fields, block and end of the record at ``start``."""
    raw = bytes(data[start : start + 65536])
    if (stop := raw.find(b"\r\n\r\n")) < 0:  # a very long address
        raw = bytes(data[start:])
        stop = raw.find(b"\r\n\r\n")
    version, *lines = raw[:stop].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no record at {start}")
    fields = dict(line.split(": ", 1) for line in lines)
    begin = start + stop + 4
    end = begin + int(fields["Content-Length"])
    return fields, data[begin:end], end + 4


class BundleWriter:
    """Writes records of one task into bundles. Each attempt of a task has files of its own, named in its index."""

    def __init__(self, folder: str, frame_bytes: int):
        self.folder, self.frame_bytes = folder, frame_bytes
        self.fs, self.path = pa.fs.FileSystem.from_uri(folder)
        self.sink, self.rows, self.pending, self.size = None, [], [], 0
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, page_id, data: bytes) -> None:
        if self.sink is None:
            self.fs.create_dir(self.path, recursive=True)
            name = f"{uuid.uuid4().hex}.warc.zst"
            self.bundle, self.frames, self.written = f"{self.folder}/{name}", [], 0
            self.sink = self.fs.open_output_stream(f"{self.path}/{name}", compression=None)
        self.pending.append((page_id, data))
        self.size += len(data)
        if self.size >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if not self.pending:
            return
        plain = b"".join(d for _, d in self.pending)
        packed = self.packer.compress(plain)
        offset = 0
        for page_id, data in self.pending:
            name = f"<urn:page:{'' if page_id is None else page_id}>"
            self.rows.append((page_id, name, self.bundle, len(self.frames), self.written, len(packed), offset, len(data)))
            offset += len(data)
        self.sink.write(packed)
        self.frames.append((len(packed), len(plain)))
        self.written += len(packed)
        self.pending, self.size = [], 0
        if self.written >= BUNDLE_BYTES:
            self.close()

    def close(self) -> None:
        self.flush()
        if self.sink is None:
            return
        body = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.sink.close()
        self.sink = None

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in INDEX.split(", ")]
        columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def seek_table(file) -> list[tuple[int, int, int]]:
    """(offset, bytes, decompressed bytes) of each frame, from the end of a bundle."""
    end = file.size()
    file.seek(end - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    file.seek(end - 9 - count * entry)
    table, offset = [], 0
    raw = file.read(count * entry)
    for k in range(count):
        packed, plain = struct.unpack_from("<II", raw, k * entry)
        table.append((offset, packed, plain))
        offset += packed
    return table


def page_of(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def described(data: memoryview, start: int) -> tuple:
    """The RECORDS columns of the record at ``start``."""
    fields, block, _ = parse(data, start)
    raw = bytes(block)
    head, _, payload = raw.partition(b"\r\n\r\n")
    length = int(head.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or digest_of(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    refers_to = page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), length, digest, kind, refers_to


def read_frame(bundle: str, frame: int) -> bytes:
    fs, path = pa.fs.FileSystem.from_uri(bundle)
    with fs.open_input_file(path) as file:
        offset, packed, plain = seek_table(file)[frame]
        file.seek(offset)
        return zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain)


def write_archives(
    pages: DataFrame, folder: str | None = None, date: datetime | None = None, frame_bytes: int = FRAME_BYTES
) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) and return the index of the records (INDEX).

    The payload is the html in UTF-8, a null html is an empty payload. Of the records with equal payloads the one with
    the largest page_id is a response, and the others revisit it; rows that repeat the largest page_id are responses
    too. Null page_ids come before all others; where a payload has only those, all are responses. Null addresses leave
    out the field. An empty table gives an empty index. Other columns are not read.

    ``folder`` must be reachable by all executors (default: a new one below the shared folder). Files of a lost task
    attempt stay there, but no index row names them. Equal payloads meet as digests only, and a payload that a third of
    the pages share is reduced before the shuffle.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    stamp = (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    shared = (
        rows.groupBy("digest")
        .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("digest", "last")
    )
    shared = stage(shared, "payloads")  # its size is known then, and decides the kind of join
    marked = rows.join(shared, "digest", "left").select(
        "page_id", "url", "payload", F.expr("if(page_id <=> last, null, last)").alias("refers_to")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(folder, frame_bytes)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64).to_pydict()
                for page_id, url, payload, refers_to in zip(*part.values(), strict=True):
                    writer.add(page_id, record(page_id, url, payload, digest_of(payload), refers_to, stamp))
            yield writer.batch()
        writer.close()
        yield writer.batch()

    return stage(marked.mapInArrow(write, INDEX), "warc-index")


def read_archives(index: DataFrame) -> DataFrame:
    """Read the records that ``index`` names (RECORDS), frame by frame; digests of responses are checked.

    Each index row gives one record: a task fetches a frame by its bundle's seek table and cuts it at the offsets. The index is
    far smaller than what it names, so frames are dealt by their number and not by its size: FRAMES_A_TASK to a task, or
    fewer if that leaves cores idle. An empty index gives no records.
    """
    count = index.select("bundle", "frame").distinct().count()
    cores = index.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(count, max(cores, count // FRAMES_A_TASK)))
    frames = index.repartition(tasks, "bundle", "frame").groupBy("bundle", "frame").agg(F.sort_array(F.collect_list("record_offset")).alias("offsets"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for row in batch.to_pylist():
                data = memoryview(read_frame(row["bundle"], row["frame"]))
                columns = zip(*[described(data, offset) for offset in row["offsets"]], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
                )

    return frames.mapInArrow(read, RECORDS)
