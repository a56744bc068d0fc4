"""Seekable Zstandard bundles of WARC records.

Records are grouped into independent Zstandard frames; a bundle is its frames
and a footer, the seek table of the public seekable format (a skippable frame
that lists compressed and decompressed size of each frame).  An index maps each
record to bundle, frame and offset within the decompressed frame, so one record
is read by decompressing one frame.

Bundles are rows (bundle, data) of a table that Spark writes to the shared
folder, so its commit protocol deals with lost executors and any file system
serves; ``export`` writes them as files.  A bundle holds the records of one part
of a task's rows, up to about ``BUNDLE_BYTES``.

Of pages with equal payloads, that with the largest id is a response record and
the others are revisit records without payload that name it and carry digest
and length of the full payload.  Null payload: empty.  Null id: never the one
referred to, unless all are null; then all are responses.  Repeated rows of the
largest id are all responses.  No pages: no bundles.  Other columns don't matter.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.llm.common import mapped, split_join, stored

FRAME_BYTES, BUNDLE_BYTES, LEVEL = 256 << 10, 8 << 20, 3
#: Of the public formats (fixed values).
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def base32(sha: str) -> str:
    """Bare upper-case base32 of a hexadecimal SHA-1."""
    return base64.b32encode(bytes.fromhex(sha)).decode()


def header(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit if refers_to is given."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", " ".join(url.split()))] if url else []),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        *([("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("X-Payload-Length", str(len(payload)))] if revisit else []),
        ("Content-Type", "text/html"),
        ("Content-Length", str(len(body))),
    ]
    return header(fields) + body + b"\r\n\r\n"


class Bundle:
    """Collects records into frames."""

    def __init__(self) -> None:
        self.frames: list[bytes] = []
        self.table: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.held = self.size = 0
        self.index: list[tuple[int | None, int, int, int]] = []
        self.codec = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, page_id: int | None, data: bytes) -> None:
        if self.held and self.held + len(data) > FRAME_BYTES:
            self.flush()
        self.index.append((page_id, len(self.frames), self.held, len(data)))
        self.open.append(data)
        self.held += len(data)

    def flush(self) -> None:
        if self.open:
            frame = self.codec.compress(b"".join(self.open))
            self.frames.append(frame)
            self.table.append((len(frame), self.held))
            self.size += len(frame)
            self.open, self.held = [], 0

    def bytes(self) -> bytes:
        self.flush()
        entries = b"".join(struct.pack("<II", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each frame, from the footer."""
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    out, at = [], 0
    for k in range(n):
        packed, plain = struct.unpack_from("<II", data, len(data) - 9 - width * (n - k))
        out.append((at, packed, plain))
        at += packed
    return out


def frame(data: bytes, at: tuple[int, int, int]) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data[at[0] : at[0] + at[1]], max_output_size=at[2])


def parsed(data: bytes, at: int = 0) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header, payload) of the records of a decompressed frame."""
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        yield at, fields, data[end + 4 : end + 4 + n]
        at = end + 8 + n


def planned(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """id, url, payload, digest (SHA-1, hexadecimal), refers_to. Payloads are moved once, by id; the groups of equal ones are found on digests."""
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    small = rows.select("id", "digest")
    repeated = small.groupBy("digest").agg(F.max("id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 and refers_to is not null").drop("n")
    revisits = split_join(small, repeated, "digest").where(~F.col("id").eqNullSafe(F.col("refers_to"))).select(F.coalesce("id", F.lit(-1)).alias("key"), F.col("id").isNull().alias("none"), F.col("digest").alias("of"), "refers_to").distinct()
    on = (F.coalesce(rows["id"], F.lit(-1)) == revisits["key"]) & (rows["id"].isNull() == revisits["none"]) & (rows["digest"] == revisits["of"])
    return rows.join(revisits.hint("shuffle_hash"), on, "left").select("id", "url", "payload", "digest", "refers_to")


def bundled(plan: DataFrame) -> DataFrame:
    """Rows (bundle, data, records); records: id, frame, offset, length of each record, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: Bundle | None = None

        def out(b: Bundle) -> pa.RecordBatch:
            data = b.bytes()
            entries = [{"id": i, "frame": f, "offset": o, "length": n} for i, f, o, n in b.index]
            kind = pa.list_(pa.struct([("id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))
            return pa.RecordBatch.from_arrays([pa.array([hashlib.sha1(data).hexdigest()]), pa.array([data], pa.binary()), pa.array([entries], kind)], ["bundle", "data", "records"])

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                made = made or Bundle()
                made.add(page_id, record(page_id, url, payload, base32(digest), refers_to))
                if made.size + made.held >= BUNDLE_BYTES:
                    yield out(made)
                    made = None
        if made:
            yield out(made)

    return mapped(plan, run, "bundle string, data binary, records array<struct<id:bigint,frame:int,offset:bigint,length:bigint>>")


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes the archives of all pages to the shared folder; returns the table of bundles."""
    return stored(bundled(planned(pages, id_col, url_col, payload_col)), "warc")


def index(bundles: DataFrame) -> DataFrame:
    """id, bundle, frame, offset within the decompressed frame, length."""
    return bundles.select("bundle", F.inline("records")).select("id", "bundle", "frame", "offset", "length")


def fetch(data: bytes, frame_no: int, offset: int) -> tuple[dict[str, str], bytes]:
    """Header and payload of one record, from its one frame."""
    _, fields, payload = next(parsed(frame(data, seek_table(data)[frame_no]), offset))
    return fields, payload


def indexed(data: bytes, entries: list[dict]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and payload of each index entry of a bundle, each frame decompressed once. Raises if an entry isn't where and what the index says, or if records of a frame have none."""
    table, entries = seek_table(data), sorted(entries, key=lambda x: (x["frame"], x["offset"]))
    for number, of_frame in itertools.groupby(entries, key=lambda x: x["frame"]):
        plain, upto = frame(data, table[number]), 0
        for x in of_frame:
            _, fields, payload = next(parsed(plain, x["offset"]))
            if x["offset"] != upto or number_of(fields["WARC-Record-ID"]) != x["id"]:
                raise ValueError(f"the index has {x}, the frame {fields['WARC-Record-ID']} after {upto}")
            upto += x["length"]
            yield fields, payload
        if upto != len(plain):
            raise ValueError(f"frame {number} goes on after its last indexed record")
    if {x["frame"] for x in entries} != set(range(len(table))):
        raise ValueError("a frame has no index entry")


def number_of(urn: str | None) -> int | None:
    return None if urn is None or urn.endswith(":none>") else int(urn[len("<urn:page:") : -1])


def read(bundles: DataFrame) -> DataFrame:
    """One row per record, fetched from the archives through the index: page_id, url, payload_bytes, payload_digest, record_type, refers_to. Digests of responses are checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, entries in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for fields, payload in indexed(data.as_py(), entries.as_py()):
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    revisit = fields["WARC-Type"] == "revisit"
                    if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"{fields['WARC-Record-ID']}: the payload's digest differs")
                    rows.append((number_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), int(fields["X-Payload-Length"]) if revisit else len(payload), digest, fields["WARC-Type"], number_of(fields.get("WARC-Refers-To"))))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return mapped(bundles.select("data", "records"), run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def export(bundles: DataFrame, folder: str) -> DataFrame:
    """Writes each bundle as <folder>/<bundle>.warc.zst, for folders that all executors mount; returns bundle, path, bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = f"{folder}/{name}.warc.zst"
                part = f"{path}.{os.getpid()}.part"
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, path)  # a second attempt writes the same bytes
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([path]), pa.array([len(data)], pa.int64())], ["bundle", "path", "bytes"])

    return mapped(bundles.select("bundle", "data"), run, "bundle string, path string, bytes long")
