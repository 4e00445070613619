import base64
import hashlib
import io
import os
import random
import tempfile

import pytest
import zstandard

from tests.llm.helpers import prose
from tillflow.llm.warc import (Archive, BundleWriter, export_bundles, parse_records, payload_digest, read_bundles, read_frame, read_record,
                               record_index, seek_table, write_bundles)

SCHEMA = "page_id long, url string, html string, payload_digest string, digest string, newest long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def corpus():
    rng = random.Random(1)
    rows = [(k, f"http://h/{k}", prose(rng, rng.choice([3, 50, 2000]))) for k in range(60)]
    rows += [(100 + k, None, "same é\r\n\r\nbody") for k in range(40)] + [(200, "u", None), (201, "u", ""), (202, "a\r\nb", "WARC/1.1\r\n\r\n")]
    rows += [(300, "u", "twice"), (300, "u", "twice"), (None, "u", "same é\r\n\r\nbody"), (301, "u", "x" * 700_000)]
    return rows


def brute(rows, least):
    newest = {}
    for page, _, html in rows:
        if page is not None:
            newest[html or ""] = max(newest.get(html or "", page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        other = newest.get(html or "") if page is not None and len(data) >= least else None
        revisit = other is not None and page < other
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response",
                    other if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("p", [Archive(), Archive(least_bytes=10, frame_bytes=2000, bundle_bytes=5000)])
def test_round_trip(spark, p):
    rows = corpus()
    bundles = write_bundles(pages(spark, rows), p)
    got = read_bundles(bundles).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, p.least_bytes)


def test_bundles_are_plain_zstandard_and_seekable(spark):
    bundles = write_bundles(pages(spark, corpus()), Archive(frame_bytes=4000, bundle_bytes=20_000))
    content = {r.bundle_id: bytes(r.content) for r in bundles.collect()}
    for data in content.values():
        frames = seek_table(data)
        whole = b"".join(read_frame(data, f) for f in frames)
        # any reader of concatenated frames sees the same bytes (the footer is a skippable frame)
        assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == whole
        assert sum(1 for _ in parse_records(whole)) > 0
    for r in record_index(bundles).collect():
        record = read_record(content[r.bundle_id], r.frame, r.offset, r.length)
        assert record.startswith(b"WARC/1.1\r\n") and f"<{r.record_id}>".encode() in record and record.endswith(b"\r\n\r\n")
        assert len(list(parse_records(record))) == 1
    folder = tempfile.mkdtemp(prefix="tillflow-warc-")
    for r in export_bundles(bundles, folder).collect():
        assert os.path.getsize(r.path) == r.bytes and open(r.path, "rb").read() == content[os.path.basename(r.path)[:-9]]


def test_seek_table_layout():
    w = BundleWriter(Archive(frame_bytes=1))
    w.add("a", b"one")
    w.add("b", b"three")
    data, index = w.close()
    assert [f[2] for f in seek_table(data)] == [3, 5] and index == [("a", 0, 0, 3), ("b", 1, 0, 5)]
    assert data[-4:] == bytes.fromhex("b1ea928f") and data[-9:-5] == (2).to_bytes(4, "little")
    with pytest.raises(ValueError):
        seek_table(b"0123456789")


def test_payload_digest_and_empty_table(spark):
    assert payload_digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert read_bundles(write_bundles(pages(spark, []))).collect() == []


def test_a_payload_of_a_third_of_the_pages_is_split(spark):
    rng = random.Random(3)
    rows = [(k, rng.randbytes(100).hex(), "hot payload") if k % 3 == 0 else (k, "u", f"{k}") for k in range(3000)]
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        bundles = write_bundles(pages(spark, rows).repartition(16), Archive(least_bytes=1))
        got = read_bundles(bundles).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, 1)
    assert bundles.count() > 8       # one per task: the hot payload is not in one of at most 8 shuffle partitions
