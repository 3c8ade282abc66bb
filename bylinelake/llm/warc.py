"""WARC archives as seekable Zstandard bundles.

A bundle holds records in independent frames and ends in a skippable frame with a seek table (compressed and plain size of
each frame), so a record is read by decompressing one frame only. Bundles are rows with a binary column, written and read
by Spark, so they may lie in any store; `index` maps each record to its frame and its place within the frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import salted_lookup, shared_dir

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 23
#: Fixed values of the Zstandard seekable format: skippable-frame magic and seek-table footer magic.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1

BUNDLE_SCHEMA = "bundle_id string, content binary, index array<struct<record_id:string,page_id:bigint,frame:int,offset:bigint,length:bigint>>"


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>"


def write_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        start = stop + 4
        end = start + int(headers["Content-Length"])
        yield headers, data[start:end]
        at = end + 4


def page_record(page_id, row: str, url: str | None, payload: bytes, kind: str, refers_to, digest: str) -> tuple[str, bytes]:
    """The record of one page: a response with its payload, or a revisit with the profile and target of the response."""
    name = record_id(row)
    headers = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if url:
        headers.append(("WARC-Target-URI", "".join(c for c in url if c >= " ")))
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "revisit":
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-Id", str(refers_to))]
        payload = b""
    headers.append(("Content-Type", "application/http; msgtype=response"))
    return name, write_record(headers, http + payload)


class Bundler:
    """Groups records into frames and frames into a bundle."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = 3):
        import zstandard

        self.zstd, self.most = zstandard.ZstdCompressor(level=level, write_content_size=True), frame_bytes
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open, self.index, self.bytes = bytearray(), [], 0

    def add(self, name: str, page_id, record: bytes) -> None:
        if self.open and len(self.open) + len(record) > self.most:
            self.close_frame()
        self.index.append({"record_id": name, "page_id": page_id, "frame": len(self.frames), "offset": len(self.open), "length": len(record)})
        self.open += record

    def close_frame(self) -> None:
        frame = self.zstd.compress(bytes(self.open))
        self.frames.append(frame)
        self.sizes.append((len(frame), len(self.open)))
        self.bytes += len(frame)
        self.open = bytearray()

    def content(self) -> bytes:
        if self.open:
            self.close_frame()
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + 9) + entries + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)


def seek_table(content: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame, from the footer."""
    n, flags, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    each = 12 if flags & 0x80 else 8
    at, table, start = len(content) - 9 - n * each, [], 0
    for i in range(n):
        size, plain = struct.unpack_from("<II", content, at + i * each)
        table.append((start, size, plain))
        start += size
    return table


def read_frame(content: bytes, frame: int) -> bytes:
    import zstandard

    start, size, plain = seek_table(content)[frame]
    return zstandard.ZstdDecompressor().decompress(content[start : start + size], max_output_size=plain)


def read_one(content: bytes, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Random access by an index entry: one frame is decompressed."""
    return next(read_records(read_frame(content, frame)[offset : offset + length]))


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _payload(col: Column) -> Column:
    return F.coalesce(col, F.lit("")).cast("binary")


def bundles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """One row a bundle (BUNDLE_SCHEMA). Payloads of min_bytes or more that occur again are revisits of the largest id.

    A null html is an empty payload. Rows that repeat the largest id are all responses; null ids are responses if their
    payload has no other id. No page lies in two bundles; an empty table gives no bundle; other columns are left out.
    """
    import pyarrow as pa

    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    digest = F.concat(F.sha1(_payload(F.col("html"))), F.length(_payload(F.col("html"))).cast("string"))
    target = rows.filter(F.length(_payload(F.col("html"))) >= min_bytes).select(digest.alias("payload"), "page_id").groupBy("payload").agg(F.max("page_id").alias("target"), F.count("*").alias("n")).filter("n > 1 AND target IS NOT NULL").drop("n")
    decided = salted_lookup(rows.withColumn("payload", digest), target, "payload", "page_id").drop("payload")

    def run(parts):
        from pyspark import TaskContext

        pid, made, now = TaskContext.get().partitionId(), 0, None

        def flush():
            nonlocal now, made
            content = now.content()
            row = pa.RecordBatch.from_pylist([{"bundle_id": f"{pid:06d}-{made:06d}", "content": content, "index": now.index}], schema=schema)
            now, made = None, made + 1
            return row

        entry = pa.struct([("record_id", pa.string()), ("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])
        schema, seen = pa.schema([("bundle_id", pa.string()), ("content", pa.binary()), ("index", pa.list_(entry))]), 0
        for batch in parts:
            for page, url, html, goal in zip(*(batch.column(c) for c in ("page_id", "url", "html", "target"))):
                page, goal, payload = page.as_py(), goal.as_py(), (html.as_py() or "").encode()
                revisit = goal is not None and page != goal
                now = now or Bundler(frame_bytes)
                name, record = page_record(page, f"{page}/{pid}/{seen}", url.as_py(), payload, "revisit" if revisit else "response", goal, _digest(payload))
                now.add(name, page, record)
                seen += 1
                if now.bytes + len(now.open) >= bundle_bytes:
                    yield flush()
        if now:
            yield flush()

    return decided.mapInArrow(run, BUNDLE_SCHEMA)


def read_bundles(archives: DataFrame) -> DataFrame:
    """One row a record of the bundles: page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, url.

    A response's digest and length are computed from the payload that is read; a mismatch with its headers is an error.
    """
    import pyarrow as pa

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string"

    def run(parts):
        kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("url", pa.string())])
        for batch in parts:
            for content in batch.column("content"):
                content, rows = content.as_py(), []
                for frame in range(len(seek_table(content))):
                    for head, block in read_records(read_frame(content, frame)):
                        digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"])
                        if head["WARC-Type"] == "response":
                            payload = block[block.index(b"\r\n\r\n") + 4 :]
                            if (_digest(payload), len(payload)) != (digest, size):
                                raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its headers")
                        number = lambda name: int(head[name]) if name in head else None  # noqa: B023, E731
                        rows.append({"page_id": number("X-Page-Id"), "payload_bytes": size, "payload_digest": digest, "record_type": head["WARC-Type"], "refers_to": number("X-Refers-To-Page-Id"), "record_id": head["WARC-Record-ID"], "url": head.get("WARC-Target-URI")})
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return archives.select("content").mapInArrow(run, schema)


def write_bundles(pages: DataFrame, path: str | None = None, **options) -> str:
    """Write the bundles of pages as a Parquet table of archives and return its path (in the shared folder by default)."""
    path = path or f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    # stored bytes are compressed already; a few bundles a row group keep readers' memory small
    bundles(pages, **options).write.option("compression", "none").option("parquet.block.size", 4 * BUNDLE_BYTES).parquet(path)
    return path
