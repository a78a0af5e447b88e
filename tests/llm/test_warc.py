"""Archives written and read back."""

from __future__ import annotations

import base64
import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from runtrace.llm import warc as op
from runtrace.sources.staging import stage

PAGES = [
    (5, "http://a/ü x\r\nWARC-Type: fake", "<p>é</p>"), (3, None, "<p>é</p>"), (9, "http://b", None), (2, "http://c", ""), (7, "http://d", "x" * 600_000),
    (8, "http://e", "line\r\n\r\nWARC/1.1\r\n\r\n"), (None, "http://f", "<p>é</p>"), (3, "http://g", "<p>é</p>"), (None, "http://h", "alone"), (11, "u", "y"),
]


def _expected(pages, least=0):
    first = {}
    for i, _, html in pages:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    for i, _, html in pages:
        raw = (html or "").encode()
        origin = first.get(html or "") if len(raw) >= least else None
        again = origin is not None and origin != i
        yield i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", origin if again else None


@pytest.mark.parametrize("least, frame, bundle", [(0, op.FRAME_BYTES, op.BUNDLE_BYTES), (0, 500, 900), (100, 1, 1)])
def test_round_trip(spark, least, frame, bundle):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumns({"size": F.lit("mine"), "first": F.lit(1)})
    bundles = stage(op.write_bundles(pages, least, frame, bundle), "warc-test")
    rows = op.read_bundles(bundles).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=str) == sorted(_expected(PAGES, least), key=str)
    html = {i: (h or "").encode() for i, _, h in PAGES}
    assert all(bytes(r.payload) == html[r.page_id] for r in rows if r.record_type == "response" and r.page_id is not None)
    one = op.read_bundles(bundles, [op.urn(7)]).collect()
    assert [r.page_id for r in one] == [7] and len(one[0].payload) == 600_000


def test_bundles_are_plain_zstandard_with_a_seek_table(spark):
    writer = op.BundleWriter(frame_bytes=50)
    records = [b"r%d" % i * 9 for i in range(20)]
    for i, r in enumerate(records):
        writer.add(str(i), r)
    archive = writer.finish()
    with zstandard.ZstdDecompressor().stream_reader(archive, read_across_frames=True) as reader:
        assert reader.read() == b"".join(records)
    assert struct.unpack("<I", archive[-4:])[0] == op.SEEKABLE
    reader = op.BundleReader(archive)
    assert [reader.record(i["frame"], i["offset"], i["length"]) for i in writer.index] == records


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert op.read_bundles(op.write_bundles(pages)).count() == 0
