"""WARC archives as seekable Zstandard bundles.

A bundle is one file: independent Zstandard frames of some records each, a skippable frame with the record index
(per record: its identifier, its frame and its offset in that frame), and the footer seek table of the
seekable format (per frame its compressed and decompressed size). Any Zstandard decoder reads a bundle; a reader of one
record decompresses one frame. Bundles are written by Spark's text sink, a row a file, through whatever file system the folder is in
and with its commit protocol.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_documents, join_dealt, shared_dir, written

# Fixed values of the seekable format.
SKIPPABLE_SEEK_TABLE, SKIPPABLE_INDEX = 0x184D2A5E, 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1
#: The seek table's last three bytes, EA 92 8F, as the text that the sink puts at the end of a row.
LAST = b"\xea\x92\x8f".decode()
#: Uncompressed bytes after which a frame ends, and compressed bytes after which a bundle ends.
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 4 << 20
ENTRY = "<QII?"  # of the index: page id (as u64), frame, offset in the decompressed frame, whether the id is null


def classified(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page_id, url, html, payload_digest (hex SHA-1), payload_bytes, refers_to (null for responses).

    Among equal payloads of at least `least` bytes all but those of the largest page_id refer to it. Only digests that occur
    twice are joined back; a common payload's rows meet that one row in many tasks, not in one. Null html is an empty payload; rows with
    null ids stay responses.
    """
    body = F.coalesce("html", F.lit("")).cast("binary")
    p = as_documents(pages, "page_id", "url", "html")
    p = p.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(body).alias("payload_digest"), F.octet_length(body).cast("long").alias("payload_bytes"))
    twice = (
        p.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
        .where("n > 1")
    )
    refers_to = F.when(F.col("response_id") > F.col("page_id"), F.col("response_id"))
    met = join_dealt(p, written(twice, "repeated-payloads"), ["payload_digest"], "n", F.col("page_id"), "left")
    return met.withColumn("refers_to", refers_to).drop("response_id")


def record(page_id: int | None, url: str | None, html: str | None, digest: str, size: int, refers_to: int | None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC/1.1 record: an HTTP response with the payload, or a revisit with its headers alone."""
    payload = (html or "").encode() if refers_to is None else b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    target = "".join(c for c in url or "" if c not in "\r\n")
    head = f"WARC/1.1\r\nWARC-Type: {'response' if refers_to is None else 'revisit'}\r\nWARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>\r\nWARC-Date: {date}\r\nWARC-Target-URI: {target}\r\nWARC-Payload-Digest: sha1:{digest}\r\n"
    if refers_to is not None:
        head += f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:{refers_to}>\r\n"
    head += f"Content-Type: application/http;msgtype=response\r\nContent-Length: {len(http) + len(payload)}\r\n\r\n"
    return head.encode() + http + payload + b"\r\n\r\n"


def bundle(frames: list[bytes], sizes: list[int], index: list[tuple[int, int, int, bool]]) -> bytes:
    """The file of compressed frames with their decompressed sizes and the record index."""
    entries = b"".join(struct.pack(ENTRY, *e) for e in index)
    extra = struct.pack("<II", SKIPPABLE_INDEX, len(entries)) + entries
    table = b"".join(struct.pack("<II", len(f), n) for f, n in zip([*frames, extra], [*sizes, 0], strict=True))
    foot = struct.pack("<IBI", len(frames) + 1, 0, SEEKABLE_MAGIC)
    return b"".join([*frames, extra, struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table) + len(foot)), table, foot])


def write_warc(pages: DataFrame, least: int = 1000, level: int = 3, date: str = "1970-01-01T00:00:00Z") -> str:
    """Writes a record for every row, dated alike (pages hold no date), and returns the folder of bundles. An empty table gives no bundle."""
    folder = shared_dir(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=level)
        frames: list[bytes] = []
        sizes: list[int] = []
        index: list[tuple[int, int, int, bool]] = []
        open_: list[bytes] = []
        held = size = 0

        def close() -> None:
            nonlocal held, size
            frames.append(pack.compress(b"".join(open_)))
            sizes.append(held)
            size += len(frames[-1])
            open_.clear()
            held = 0

        def emit() -> pa.RecordBatch:
            nonlocal size
            data = bundle(frames, sizes, index)
            for x in (frames, sizes, index):
                x.clear()
            size = 0
            return pa.RecordBatch.from_arrays([pa.array([data[: -len(LAST.encode())]], pa.binary())], names=["value"])

        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                for row in zip(*(c.to_pylist() for c in batch.slice(a, 256).columns), strict=True):
                    index.append(((row[0] or 0) & (2**64 - 1), len(frames), held, row[0] is None))
                    open_.append(record(*row, date))
                    held += len(open_[-1])
                    if held >= FRAME_BYTES:
                        close()
                    if size >= BUNDLE_BYTES:
                        yield emit()
        if open_:
            close()
        if frames:
            yield emit()

    rows = classified(pages, least).select("page_id", "url", "html", "payload_digest", "payload_bytes", "refers_to")
    rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("lineSep", LAST).text(folder)
    return folder


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """Offset, compressed and decompressed size of each frame, from the footer."""
    n, flags, magic = struct.unpack_from("<IBI", data, len(data) - 9)
    if magic != SEEKABLE_MAGIC or flags & 0x80:
        raise ValueError("not a seekable bundle of this kind")
    at, out = 0, []
    for size, whole in struct.iter_unpack("<II", data[len(data) - 9 - 8 * n : len(data) - 9]):
        out.append((at, size, whole))
        at += size
    return out


def entries(data: bytes) -> list[tuple[int | None, int, int]]:
    """Page id, frame and offset in the frame of each record, from the bundle's index."""
    at, size, _ = seek_table(data)[-1]
    if struct.unpack_from("<I", data, at)[0] != SKIPPABLE_INDEX:
        raise ValueError("the bundle has no record index")
    signed = lambda i: i - (1 << 64) if i >> 63 else i
    return [(None if null else signed(i), number, start) for i, number, start, null in struct.iter_unpack(ENTRY, data[at + 8 : at + size])]


def frame(data: bytes, number: int) -> bytes:
    """One decompressed frame, found by the seek table."""
    at, size, whole = seek_table(data)[number]
    out = zstandard.ZstdDecompressor().decompress(data[at : at + size], max_output_size=max(1, whole)) if whole else b""
    if len(out) != whole:
        raise ValueError("damaged frame")
    return out


def parsed(data: bytes, at: int) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of the record at an offset of a decompressed frame."""
    end = data.index(b"\r\n\r\n", at)
    fields = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
    block = data[end + 4 : end + 4 + int(fields["Content-Length"])]
    cut = block.index(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in block[:cut].decode().split("\r\n")[1:])
    return fields, http, block[cut + 4 :]


def _id(urn: str | None) -> int | None:
    text = urn[len("<urn:page:") : -1] if urn else ""
    return int(text) if text else None


def read_warc(spark, folder: str, with_payload: bool = True) -> DataFrame:
    """page_id, url, record_type, payload_digest, payload_bytes, refers_to, file, frame, at (offset in the frame) and, if asked for, payload of all records.

    A revisit's payload is empty; its digest and bytes are those of the payload it stands for.
    """
    schema = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, file string, frame int, at long" + ", payload binary" * with_payload
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()][: len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data, now, open_, rows = content.as_buffer().to_pybytes(), -1, b"", []
                for _, number, at in entries(data):
                    if number != now:
                        now, open_ = number, frame(data, number)
                    warc, http, payload = parsed(open_, at)
                    if warc["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != warc["WARC-Payload-Digest"].removeprefix("sha1:"):
                        raise ValueError(f"damaged record in {name}, frame {number}, at {at}")
                    row = (_id(warc["WARC-Record-ID"]), warc["WARC-Target-URI"], warc["WARC-Type"], warc["WARC-Payload-Digest"].removeprefix("sha1:"), int(http["Content-Length"]), _id(warc.get("WARC-Refers-To")), name, number, at, payload)
                    rows.append(row[: len(names)])
                    if len(rows) >= 512:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "content").mapInArrow(run, schema)


def write_index(spark, folder: str) -> str:
    """Reads all records back and writes a row of each but its payload (page_id, file, frame, at and what its headers say) as Parquet beside the bundles; returns its folder."""
    index = f"{folder}-index"
    read_warc(spark, folder, with_payload=False).write.parquet(index)
    return index
