"""WARC records in seekable Zstandard bundles.

A bundle is a row of independent frames, each some records long, and a skippable frame at the end
with the seek table: the sizes of all frames. The index maps a record's id to its bundle, its frame
and its offset inside the decompressed frame, so one record costs one frame.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.llm import files
from veritally.session import written


@dataclass(frozen=True)
class Bundles:
    frame_bytes: int = 1 << 20
    bundle_bytes: int = 1 << 28
    level: int = 3
    #: Payloads from this size on are stored once.
    least_revisit: int = 1000
    date: str = "2026-01-01T00:00:00Z"


# Fixed values of the seekable format: the skippable frame's magic and the footer's.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "<urn:veritally:page:{}>"


def record_types(pages: DataFrame, how: Bundles) -> DataFrame:
    """``pages`` with payload_bytes, payload_digest and refers_to (NULL for responses).

    Of equal payloads the record with the largest id is the response; rows that repeat that id are
    responses too. Records without an id revisit it like others.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    hashed = pages.select("page_id", "url", "html", F.octet_length(payload).cast("long").alias("payload_bytes"),
                          F.sha1(payload).alias("payload_digest"))
    shared = hashed.where(f"payload_bytes >= {how.least_revisit}").groupBy("payload_digest", "payload_bytes").agg(
        F.max("page_id").alias("largest"), F.count("*").alias("n")).where("n > 1 AND largest IS NOT NULL")
    shared = written(shared.selectExpr("payload_digest AS _digest", "payload_bytes AS _bytes", "largest"))
    typed = hashed.join(shared, F.expr("payload_digest = _digest AND payload_bytes = _bytes"), "left")
    return typed.selectExpr("page_id", "url", "html", "payload_bytes", "payload_digest",
                            "IF(page_id IS DISTINCT FROM largest, largest, NULL) AS refers_to")


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP head and leaves the payload out."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {ID.format('' if page_id is None else page_id)}", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
    ]
    if url:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Refers-To: {ID.format(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}


def parse(frame: bytes, at: int) -> tuple[dict, int]:
    """The record at an offset, and the offset after it."""
    middle = frame.index(b"\r\n\r\n", at)
    head = _headers(frame[at:middle])
    size = int(head["content-length"])
    block = frame[middle + 4:middle + 4 + size]
    http_end = block.index(b"\r\n\r\n")
    http, payload = _headers(block[:http_end]), block[http_end + 4:]

    def page(name: str) -> int | None:
        digits = head.get(name, "").rpartition(":")[2].rstrip(">")
        return int(digits) if digits else None

    if head["warc-type"] == "response":
        digest = hashlib.sha1(payload).hexdigest()
        if len(payload) != int(http["content-length"]):
            raise ValueError("a payload is cut")
    else:
        digest = base64.b32decode(head["warc-payload-digest"].partition(":")[2]).hex()
    return {"page_id": page("warc-record-id"), "payload_bytes": int(http["content-length"]), "payload_digest": digest,
            "record_type": head["warc-type"], "refers_to": page("warc-refers-to"), "payload": payload}, middle + 8 + size


class Writer:
    """Frames of one bundle; closing it appends the seek table."""

    def __init__(self, folder: str, how: Bundles):
        self.path, self.stream = files.create(folder, ".warc.zst")
        self.packer, self.how = zstandard.ZstdCompressor(level=how.level), how
        self.held, self.size, self.frames, self.written = [], 0, [], 0

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset in it) of the record."""
        place = len(self.frames), self.size
        self.held.append(data)
        self.size += len(data)
        if self.size >= self.how.frame_bytes:
            self.end_frame()
        return place

    def end_frame(self):
        if self.held:
            packed = self.packer.compress(b"".join(self.held))
            self.stream.write(packed)
            self.frames.append((len(packed), self.size))
            self.written += len(packed)
            self.held, self.size = [], 0

    def close(self):
        self.end_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.stream.close()


class Reader:
    """Random access to the frames of a bundle by its seek table."""

    def __init__(self, path: str):
        self.file = files.open_for_reading(path)
        size = self.file.size()
        self.file.seek(size - 9)
        count, _, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        self.file.seek(size - 9 - 8 * count)
        sizes = list(struct.iter_unpack("<II", self.file.read(8 * count)))
        self.frames, at = [], 0
        for packed, plain in sizes:
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, plain = self.frames[k]
        self.file.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=plain)

    def record(self, k: int, offset: int) -> dict:
        return parse(self.frame(k), offset)[0]

    def close(self):
        self.file.close()


INDEX = "path string, page_id long, frame int, offset long"


def write_bundles(pages: DataFrame, folder: str, how: Bundles = Bundles()) -> DataFrame:
    """Write a record per row; returns the written index (path, page_id, frame, offset).

    NULL html is an empty payload, a NULL url leaves its header out. Of extra columns nothing is read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, rows = None, []

        def done():
            bundle.close()
            ids, frames, offsets = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([bundle.path] * len(rows)), pa.array(ids, pa.int64()), pa.array(frames, pa.int32()),
                 pa.array(offsets, pa.int64())], names=["path", "page_id", "frame", "offset"])

        for batch in batches:
            for r in batch.to_pylist():
                bundle = bundle or Writer(folder, how)
                payload = (r["html"] or "").encode("utf-8", "surrogatepass")
                data = record(r["page_id"], r["url"], payload, r["payload_digest"], r["refers_to"], how.date)
                rows.append((r["page_id"], *bundle.add(data)))
                if bundle.written >= how.bundle_bytes:
                    yield done()
                    bundle, rows = None, []
        if bundle:
            yield done()

    return written(record_types(pages, how).mapInArrow(write, INDEX))


RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "frame int, offset long")


def read_bundles(index: DataFrame) -> DataFrame:
    """All records of the indexed bundles, read frame by frame through the seek tables."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                bundle = Reader(path)
                for k in range(len(bundle.frames)):
                    frame, at, rows = bundle.frame(k), 0, []
                    while at < len(frame):
                        found, after = parse(frame, at)
                        del found["payload"]
                        rows.append(found | {"frame": k, "offset": at})
                        at = after
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                bundle.close()

    paths = written(index.select("path").distinct())
    return paths.repartition(max(1, paths.count()), "path").mapInArrow(read, RECORDS)


def archive(pages: DataFrame, how: Bundles = Bundles()) -> DataFrame:
    """Write the bundles and return what reading them back gives."""
    return read_bundles(write_bundles(pages, files.new_folder(pages.sparkSession, "warc"), how))
