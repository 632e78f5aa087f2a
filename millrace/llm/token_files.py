"""Length-delimited binary records of token ids: framed, checksummed files and a separate offset index.

File: the 8 bytes of MAGIC, then frames. Frame, little-endian:
    u64 length of the payload | u32 masked crc32 of these 8 bytes | payload | u32 masked crc32 of the payload
Payload: i64 document id | u8 1 if that id is null | u8 bytes of an id (2 or 4) | u64 ids before it in its part | the ids.
A checksum is masked by rotating it right by 15 bits and adding a constant, so that checksums of checksums stay sound.
The last byte of a file is a newline: files are written by Spark's text sink, a row a file, through whatever file
system the folder is in and with its commit protocol; so lost tasks leave nothing behind.

Parts hold ascending ranges of doc_id, files of a part and frames of a file ascend too.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import as_documents, shared_dir, slices
from .pieces import COMMON, PieceIds, runs

MAGIC = b"MRTOKEN1"
HEAD, BODY = "<QI", "<qBBQ"
HEAD_SIZE, BODY_SIZE = struct.calcsize(HEAD), struct.calcsize(BODY)
#: A file ends with the frame that takes it beyond this.
FILE_BYTES = 4 << 20


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


class Library:
    """Ids of whole texts by a tokenizer file: the library encodes every distinct piece of the split pattern, texts are joined from pieces.

    Merges never cross pieces, so this gives the ids of the text. Pieces of a space and letters go to the library joined, as
    the pattern parts them again at each space; the bytes of ids tell which piece they are of. Texts that hold the
    string of an added token go to the library as they are.
    """

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks use the cores already
        self.library = Tokenizer.from_file(path)
        self.added = [str(t.content) for t in self.library.get_added_tokens_decoder().values()]
        # In byte-level vocabularies each character of a token stands for one byte.
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)
        self.common = pattern == COMMON
        self.ids = PieceIds(pattern, self.encode)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after another, and their numbers."""
        whole = np.array([p[0] == " " and p[1:].isalpha() for p in pieces], bool) if self.common else np.zeros(len(pieces), bool)
        joined, alone = np.flatnonzero(whole), np.flatnonzero(~whole)
        size = np.zeros(len(pieces), np.int64)
        found = []
        for k in range(0, len(joined), 4000):
            own = joined[k : k + 4000]
            text = "".join([pieces[i] for i in own.tolist()])
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            data = np.frombuffer(text.encode(), np.uint8)
            ends = np.append(np.flatnonzero(data == 32)[1:], len(data))  # a space begins each piece and is nowhere else
            size[own] = np.diff(np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1, prepend=0)
            found.append(ids)
        each = [e.ids for e in self.library.encode_batch_fast([pieces[i] for i in alone.tolist()], add_special_tokens=False)]
        size[alone] = [len(x) for x in each]
        first = np.cumsum(size) - size
        out = np.zeros(int(size.sum()), np.uint32)
        for own, ids in ((joined, np.concatenate(found) if found else out[:0]), (alone, np.fromiter(chain.from_iterable(each), np.uint32))):
            out[runs(first[own], size[own])] = ids
        return out, size

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's begin (n + 1). Null counts as empty."""
        if not any(pc.any(pc.match_substring(column, a)).as_py() for a in self.added):
            return self.ids.texts(column)
        each = [np.array(self.library.encode(t, add_special_tokens=False).ids if t else [], np.uint32) for t in column.to_pylist()]
        return np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])


_encoders: dict[tuple[str, str], Library] = {}


def encoded(docs: DataFrame, path: str, pattern: str, end_id: int, cuts: list[int]) -> DataFrame:
    """doc_id, part (see part_of) and ids (binary: u8 width 2 or 4, then the ids) of every whole text, with end_id after each."""
    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, pattern) not in _encoders:
            _encoders[path, pattern] = Library(path, pattern)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                flat, begin = _encoders[path, pattern].texts(part.column("text"))
                rows = []
                for a, b in zip(begin[:-1], begin[1:], strict=True):
                    ids = np.append(flat[a:b], np.uint32(end_id))
                    rows.append(b"\x02" + ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else b"\x04" + ids.astype("<u4").tobytes())
                of = part_of(part.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False), np.array(cuts, np.int64), rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(of), pa.array(rows, pa.binary())], names=out.names)

    return as_documents(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text").mapInArrow(run, out)


#: Where null ids stand in the order of ids.
NULL_ID = -(1 << 63)


def part_of(ids: np.ndarray, cuts: np.ndarray, rows: list[bytes]) -> np.ndarray:
    """The part of each row: the number of cuts at or below its id. An id that is k cuts has k parts, over which its rows are dealt by their bytes, so that they are the same whenever a task is repeated."""
    low, high = (np.searchsorted(cuts, ids, side) for side in ("left", "right"))
    out = high.copy()
    for k in np.flatnonzero(high - low > 1).tolist():
        out[k] = low[k] + 1 + zlib.crc32(rows[k]) % (high[k] - low[k])
    return out.astype(np.int32)


def ranges(docs: DataFrame, parts: int) -> list[int]:
    """At most parts - 1 ascending boundaries that split doc_id into ranges of about as many rows; reads that column only. An id with more rows than a range comes several times."""
    q = [k / parts for k in range(1, parts)]
    at = docs.agg(F.percentile_approx(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), q, max(10_000, 4 * parts))).first()[0] if q else None
    return sorted(at or ())


def write_token_files(docs: DataFrame, path: str, pattern: str, end_id: int = 0, parts: int | None = None) -> str:
    """Writes the framed ids of all documents in ascending doc_id order (nulls first, repeated ids by part and bytes); returns the folder.

    Null and empty texts give frames of the end id alone; other columns are ignored; an empty table gives no frame.
    """
    spark = docs.sparkSession
    cuts = ranges(docs, parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = encoded(docs, path, pattern, end_id, cuts)
    rows = rows.repartitionById(len(cuts) + 1, "part").sortWithinPartitions("doc_id", "ids")
    folder = shared_dir(spark, "token-files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, buffer, size = 0, [MAGIC], 0
        emit = lambda: pa.RecordBatch.from_arrays([pa.array([b"".join(buffer)], pa.binary())], names=["value"])
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                width = ids[0]
                payload = struct.pack(BODY, doc_id or 0, doc_id is None, width, before) + ids[1:]
                length = struct.pack("<Q", len(payload))
                buffer += [length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))]
                before += (len(ids) - 1) // width
                size += len(payload)
                if size >= FILE_BYTES:
                    yield emit()
                    buffer, size = [MAGIC], 0
        if len(buffer) > 1:
            yield emit()

    files = rows.select("doc_id", "ids").mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    files.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(folder)
    return folder


def frames(data: bytes) -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """Of each frame of a file: offset, document id, ids before it in its part, ids. Raises on any damage."""
    if data[:8] != MAGIC or data[-1:] != b"\n":
        raise ValueError("not a token file")
    at, end = 8, len(data) - 1
    while at < end:
        yield at, *frame_at(data, at)
        at += HEAD_SIZE + struct.unpack_from("<Q", data, at)[0] + 4


def frame_at(data: bytes, at: int) -> tuple[int | None, int, np.ndarray]:
    """Document id, ids before it in its part and ids of the frame at an offset."""
    length, crc = struct.unpack_from(HEAD, data, at)
    if masked(data[at : at + 8]) != crc:
        raise ValueError(f"damaged length at {at}")
    payload = data[at + HEAD_SIZE : at + HEAD_SIZE + length]
    if len(payload) != length or masked(payload) != struct.unpack_from("<I", data, at + HEAD_SIZE + length)[0]:
        raise ValueError(f"damaged payload at {at}")
    doc_id, null, width, before = struct.unpack_from(BODY, payload)
    return None if null else doc_id, before, np.frombuffer(payload, f"<u{width}", offset=BODY_SIZE)


def _part():
    """The number of the task that wrote a file, which is that of its range of doc_id."""
    return F.regexp_extract("file", r"part-(\d+)-", 1).cast("int")


def _files(spark, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "content")


def write_index(spark, folder: str, derive=None, schema: str = "") -> str:
    """Reads every frame once, checks it, and writes the offset index beside the files; returns its folder.

    A row is a frame: file, at (byte offset), size (bytes), doc_id, n_tokens, before, and what derive makes of its ids (columns of schema).
    """
    fields = "file string, at long, size long, doc_id long, n_tokens long, before long" + (f", {schema}" if schema else "")
    names = T._parse_datatype_string(fields).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = [
                    (name, at, HEAD_SIZE + BODY_SIZE + ids.nbytes + 4, doc_id, len(ids), before, *(derive(ids) if derive else ()))
                    for at, doc_id, before, ids in frames(data.as_buffer().to_pybytes())
                ]
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:6]), *(pa.array(c) for c in columns[6:])], names=names)

    index = f"{folder}-index"
    _files(spark, folder).mapInArrow(run, fields).write.parquet(index)
    return index


def starts(spark, index: str) -> DataFrame:
    """part, base: ids of all parts before each part, from the index. A row a part, so the running sum is over a few rows."""
    parts = spark.read.parquet(index).withColumn("part", _part()).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_token_files(spark, folder: str) -> DataFrame:
    """file, at, doc_id, before and ids of every frame, its checksums checked."""
    fields = "file string, at long, doc_id long, before long, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for at, doc_id, before, ids in frames(data.as_buffer().to_pybytes()):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([at]), pa.array([doc_id], pa.int64()), pa.array([before]), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))], names=["file", "at", "doc_id", "before", "ids"])

    return _files(spark, folder).mapInArrow(run, fields)


def with_starts(frames_: DataFrame, index: str) -> DataFrame:
    """Adds start: the ids of all documents before, over all parts."""
    base = starts(frames_.sparkSession, index)
    return frames_.withColumn("part", _part()).join(base, "part").withColumn("start", F.col("base") + F.col("before")).drop("part", "base", "before")
