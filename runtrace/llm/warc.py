"""WARC archives as seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding whole records, followed by a skippable frame with the
seek table (sizes of all frames) and its footer. An index names, for each record, its frame and its place in the
unpacked frame, so that one record is read by unpacking one frame. Bundles are rows (`bundle`, `archive`, `index`), which
the caller stores in a folder that executors share; a lost task writes the same bundles again.

Null html is empty. Of records with equal payloads of `min_bytes` or more the one with the smallest id is a response, the
others are revisits of it; rows that repeat this smallest id are responses too. A null id is larger than any other; where all
are null, all are responses. Null urls leave the header out. An empty table gives no bundles.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the seekable format and of WARC 1.1.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The tables have no time of capture.
DATE = "1970-01-01T00:00:00Z"
FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 16 * 1024 * 1024

_INDEX = "array<struct<record_id:string,frame:int,offset:int,length:int>>"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def _page_of(name: str) -> int | None:
    number = name.strip("<>").removeprefix("urn:page:")
    return int(number) if number else None


def make_record(page_id, url, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """One record; a revisit keeps the size and the digest of the payload it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{urn(page_id)}>",
             f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url))
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{urn(refers_to)}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    return "\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload isn't the one that was written")
    return {"page_id": _page_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload": payload,
            "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": _page_of(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None}


class BundleWriter:
    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.frames, self.sizes, self.index, self.open, self.length, self.frame_bytes = [], [], [], [], 0, frame_bytes
        self.pack = zstandard.ZstdCompressor(level=level).compress

    def add(self, record_id: str, record: bytes) -> None:
        if self.length and self.length + len(record) > self.frame_bytes:
            self.close_frame()
        self.index.append({"record_id": record_id, "frame": len(self.frames), "offset": self.length, "length": len(record)})
        self.open.append(record)
        self.length += len(record)

    def close_frame(self) -> None:
        if self.open:
            self.frames.append(self.pack(b"".join(self.open)))
            self.sizes.append((len(self.frames[-1]), self.length))
            self.open, self.length = [], 0

    def finish(self) -> bytes:
        self.close_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join([*self.frames, struct.pack("<II", SKIPPABLE, len(table)), table])


class BundleReader:
    """Frames by number, found through the seek table at the end of an archive."""

    def __init__(self, archive: bytes):
        n, flags, magic = struct.unpack("<IBI", archive[-9:])
        if magic != SEEKABLE or flags:
            raise ValueError("no seek table")
        entries = struct.iter_unpack("<II", archive[len(archive) - 9 - 8 * n: len(archive) - 9])
        self.archive, self.places, at = archive, [], 0
        for packed, unpacked in entries:
            self.places.append((at, packed, unpacked))
            at += packed
        self.unpack, self.last = zstandard.ZstdDecompressor().decompress, (-1, b"")

    def record(self, frame: int, offset: int, length: int) -> bytes:
        if self.last[0] != frame:
            at, packed, unpacked = self.places[frame]
            self.last = frame, self.unpack(self.archive[at: at + packed], max_output_size=unpacked)
        return self.last[1][offset: offset + length]


def with_first_copies(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Each page with its payload and, where an earlier page has the same, that page's id.

    Ids are grouped by digest with a partial minimum, so one payload on many pages is one row for each task.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"size": F.length("payload"), "sha1": F.unhex(F.sha1("payload"))})
    ids = rows.where(F.col("size") >= min_bytes).groupBy("sha1", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    joined = rows.join(ids.where("n > 1").select("sha1", "size", "first"), ["sha1", "size"], "left")
    earlier = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "size", "sha1", earlier.alias("refers_to"),
                         F.when(earlier.isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"))


def write_bundles(pages: DataFrame, min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Archives of all pages: bundle (a name), archive (binary), index."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, size, bundle = TaskContext.get().partitionId(), 0, 0, BundleWriter(frame_bytes)

        def row():
            name = f"{part:06d}-{number:06d}"
            return pa.RecordBatch.from_pylist(
                [{"bundle": name, "archive": bundle.finish(), "index": bundle.index}],
                schema=pa.schema([("bundle", pa.string()), ("archive", pa.binary()), ("index", pa.list_(pa.struct(
                    [("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int32()), ("length", pa.int32())])))]))

        for batch in batches:
            for page, url, n, sha1, first, payload in zip(*(c.to_pylist() for c in batch.columns)):
                record = make_record(page, url, payload, n, base64.b32encode(sha1).decode(), first)
                bundle.add(urn(page), record)
                size += len(record)
                if size >= bundle_bytes:
                    yield row()
                    number, size, bundle = number + 1, 0, BundleWriter(frame_bytes)
        if bundle.index:
            yield row()

    rows = with_first_copies(pages, min_bytes).select("page_id", "url", "size", "sha1", "refers_to", "payload")
    return rows.mapInArrow(work, f"bundle string, archive binary, index {_INDEX}")


_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
_RECORD_DDL = "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_bundles(bundles: DataFrame, record_ids: list[str] | None = None, with_payload: bool = True) -> DataFrame:
    """Records of stored bundles; with a list of record ids, only the frames that hold them are unpacked."""
    wanted = None if record_ids is None else set(record_ids)

    def work(batches):
        for batch in batches:
            for archive, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                places = [i for i in index if wanted is None or i["record_id"] in wanted]
                reader = BundleReader(archive) if places else None
                for first in range(0, len(places), 500):
                    found = [parse_record(reader.record(i["frame"], i["offset"], i["length"])) for i in places[first:first + 500]]
                    for r in found if not with_payload else ():
                        r["payload"] = None
                    yield pa.RecordBatch.from_pylist(found, schema=_RECORD)

    rows = bundles.select("archive", "index")
    if wanted is not None:
        rows = rows.where(F.exists("index", lambda i: i["record_id"].isin(sorted(wanted))))
    return rows.mapInArrow(work, _RECORD_DDL)
