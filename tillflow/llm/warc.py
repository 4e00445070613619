"""WARC records in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding whole WARC
records up to about ``frame_bytes``, and a footer: a skippable frame with the
seekable format's table (compressed and decompressed size of every frame, the
frame count and its magic number). Any reader of concatenated frames reads a
bundle; a seeking reader fetches the footer, then one frame. The index maps a
record id to (bundle, frame, offset within the decompressed frame, length).

Bundles are rows of a binary column in a table under the shared folder, so they
live in any store that Spark writes to, and each task writes bounded bundles of
its own; a retried task writes them again. ``export_bundles`` copies them out as
``.warc.zst`` files where executors share a mounted folder.

Payload rule: of records with equal payloads of at least ``least_bytes`` bytes,
the one with the largest page_id is the response and the others revisit it. The
choice is a grouped maximum (combined map-side) joined back on the digest, where
the join can split a payload that a third of the pages share.

Edge cases: a null html is an empty payload. Rows whose page_id is null are
responses, and none revisits them. Rows that repeat the largest page_id of a payload are all
responses. A null url is left out of the record. Extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.runtime import scratch_table, ship

SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    least_bytes: int = 0
    frame_bytes: int = 256 << 10
    bundle_bytes: int = 8 << 20
    level: int = 3
    date: str = "1970-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> tuple[str, bytes]:
    """(record id, WARC/1.1 record): a response, or a revisit of page ``refers_to`` without the payload.

    The HTTP Content-Length of either is the full payload's, which is all that a revisit keeps of it besides the digest.
    """
    rid = record_id(page_id)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{rid}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{record_id(refers_to)}>", f"WARC-Profile: {PROFILE}"]
    block = http + payload if refers_to is None else http
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return rid, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class BundleWriter:
    """Collects records into frames; ``close`` gives the bundle's bytes and its index."""

    def __init__(self, p: Archive):
        import zstandard

        self.p, self.zstd = p, zstandard.ZstdCompressor(level=p.level, write_content_size=True)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.open_bytes = self.bytes = 0
        self.index: list[tuple[str, int, int, int]] = []

    def add(self, rid: str, record: bytes) -> None:
        self.index.append((rid, len(self.frames), self.open_bytes, len(record)))
        self.open.append(record)
        self.open_bytes += len(record)
        if self.open_bytes >= self.p.frame_bytes:
            self._flush()

    def _flush(self) -> None:
        if self.open:
            frame = self.zstd.compress(b"".join(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), self.open_bytes))
            self.bytes += len(frame)
            self.open, self.open_bytes = [], 0

    def close(self) -> tuple[bytes, list[tuple[str, int, int, int]]]:
        self._flush()
        table = b"".join(struct.pack("<II", c, d) for c, d in self.sizes)
        footer = table + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(footer)) + footer, self.index


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(compressed offset, compressed size, decompressed size) of every frame, from the footer alone."""
    count, flags, magic = struct.unpack_from("<IBI", bundle, len(bundle) - 9)
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    start = len(bundle) - 9 - count * entry
    out, at = [], 0
    for k in range(count):
        c, d = struct.unpack_from("<II", bundle, start + k * entry)
        out.append((at, c, d))
        at += c
    return out


def read_frame(bundle: bytes, frame: tuple[int, int, int]) -> bytes:
    import zstandard

    at, size, plain = frame
    return zstandard.ZstdDecompressor().decompress(bundle[at:at + size], max_output_size=plain)


def read_record(bundle: bytes, frame: int, offset: int, length: int) -> bytes:
    """One record by its index entry: decompresses its frame only."""
    return read_frame(bundle, seek_table(bundle)[frame])[offset:offset + length]


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def parse_records(data: bytes) -> Iterator[Record]:
    """The WARC records of a decompressed frame."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        version, *fields = data[at:stop].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError("not a WARC record")
        headers = dict(f.split(": ", 1) for f in fields)
        size = int(headers["Content-Length"])
        block = data[stop + 4:stop + 4 + size]
        cut = block.index(b"\r\n\r\n")
        http = dict(f.split(": ", 1) for f in block[:cut].decode().split("\r\n")[1:])
        yield Record(headers, http, block[cut + 4:])
        at = stop + 4 + size + 4


def write_bundles(pages: DataFrame, p: Archive = Archive()) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html).

    Returns the stored table ``(bundle_id, content binary, records array<struct<record_id, frame, offset, length>>)``.
    """
    ship(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).alias("html")) \
        .withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html"))
    # written first, so that the join can split a payload that a third of the pages share
    newest = scratch_table(rows.filter(F.col("size") >= p.least_bytes).groupBy("digest", "size").agg(F.max("page_id").alias("newest")), "newest")
    told = rows.join(newest, ["digest", "size"], "left").select(
        "page_id", "url", "html", F.when(F.col("page_id") < F.col("newest"), F.col("newest")).alias("refers_to"))

    def run(batches):
        writer = BundleWriter(p)

        def done():
            content, index = writer.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), pa.array([content], pa.binary()),
                 pa.array([[{"record_id": r, "frame": f, "offset": o, "length": n} for r, f, o, n in index]],
                          pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()),
                                              ("length", pa.int64())])))], ["bundle_id", "content", "records"])

        for batch in batches:
            for page, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                writer.add(*make_record(page, url, html.encode(), refers, p.date))
                if writer.bytes >= p.bundle_bytes:
                    yield done()
                    writer = BundleWriter(p)
        if writer.index:
            yield done()

    schema = ("bundle_id string, content binary, "
              "records array<struct<record_id:string,frame:int,offset:bigint,length:bigint>>")
    return scratch_table(told.mapInArrow(run, schema), "bundles")


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Parse every record of the bundles: ``(page_id, record_type, payload_bytes, payload_digest, refers_to, url, bundle_id, frame)``.

    A response's size and digest are computed from its payload; a revisit's come from its headers.
    """
    ship(bundles.sparkSession)
    schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                        ("bundle_id", pa.string()), ("frame", pa.int32())])

    def page(uri: str | None) -> int | None:
        return int(uri[len("<urn:page:"):-1]) if uri and uri.startswith("<urn:page:") else None

    def run(batches):
        for batch in batches:
            for bundle_id, content in zip(batch.column("bundle_id").to_pylist(), batch.column("content").to_pylist()):
                for k, frame in enumerate(seek_table(content)):
                    rows = []
                    for r in parse_records(read_frame(content, frame)):
                        h = r.headers
                        whole = h["WARC-Type"] == "response"
                        rows.append((page(h["WARC-Record-ID"]), h["WARC-Type"],
                                     len(r.payload) if whole else int(r.http["Content-Length"]),
                                     payload_digest(r.payload) if whole else h["WARC-Payload-Digest"].removeprefix("sha1:"),
                                     page(h.get("WARC-Refers-To")), h.get("WARC-Target-URI"), bundle_id, k))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return bundles.select("bundle_id", "content").mapInArrow(
        run, "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, url string, "
             "bundle_id string, frame int")


def record_index(bundles: DataFrame) -> DataFrame:
    """``(record_id, bundle_id, frame, offset, length)`` of every record."""
    return bundles.select("bundle_id", F.explode("records").alias("r")).select("r.record_id", "bundle_id", "r.frame", "r.offset", "r.length")


def export_bundles(bundles: DataFrame, folder: str) -> DataFrame:
    """Copy bundles to ``folder``/<bundle_id>.warc.zst on a file system that every executor mounts; ``(path, bytes)``.

    Each file is written under another name and then renamed, so a retried task leaves whole files only.
    """
    def run(batches):
        for batch in batches:
            paths, sizes = [], []
            for name, content in zip(batch.column("bundle_id").to_pylist(), batch.column("content").to_pylist()):
                os.makedirs(folder, exist_ok=True)
                path = os.path.join(folder, f"{name}.warc.zst")
                part = f"{path}.{uuid.uuid4().hex}"
                with open(part, "wb") as f:
                    f.write(content)
                os.replace(part, path)
                paths.append(path)
                sizes.append(len(content))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "bytes"])

    return bundles.select("bundle_id", "content").mapInArrow(run, "path string, bytes long")
