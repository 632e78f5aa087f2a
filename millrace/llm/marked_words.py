"""SentencePiece by a table of distinct marked words: each word with its whitespace markers is segmented once, ids are joined back by position.

A marked word is a run of markers (blanks or U+2581) and what follows up to the next run. Where no piece of a BPE model has a marker behind another
character, no merge reaches over the start of a marked word, so the segmentation of a text is that of its marked words one after another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor
from sentencepiece.sentencepiece_model_pb2 import ModelProto, TrainerSpec

from .common import Spans, as_documents, slices, text_buffers
from .pieces import PieceIds, runs

MARKER = "▁"
#: Bytes of distinct marked words that a worker remembers, with one slice more; beyond them the table starts anew.
TABLE_BYTES = 48 << 20
#: Bytes of text whose words are looked up at once; a longer text alone.
SLICE = 1 << 20


def crosses(piece: str) -> bool:
    """Whether a marker stands behind another character in the piece."""
    return MARKER in piece.lstrip(MARKER)


def starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where marked words begin in texts of UTF-8 bytes between offsets (n + 1), of which each begins with a marker unless empty."""
    n = len(data)
    blank = data == 32
    mark = np.zeros(n, bool)  # begins of U+2581
    if n > 2:
        mark[:-2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
    behind = np.zeros(n + 1, bool)  # of a marker's last byte
    behind[1:] = blank
    behind[np.flatnonzero(mark) + 3] = True
    first = (blank | mark) & ~behind[:n]
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(first)


class WordTable(PieceIds):
    """Ids of texts from ids of marked words. Words are found by hash and compared byte by byte; encode takes them as bytes."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = 1_500_000, most_bytes: int = TABLE_BYTES):
        super().__init__(MARKER, encode, most)
        self.most_bytes = most_bytes

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, one after another, and where each text's begin (n + 1). Null counts as empty."""
        data, offsets = text_buffers(column)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        full = offsets[:-1] < offsets[1:]
        data = np.insert(data, offsets[:-1][full], 32)  # the marker that every text gets
        offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        a = starts(data, offsets)
        if not len(a):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self.slots >= self.most or self.text_bounds[self.slots] > self.most_bytes:
            self.forget()
        b = np.append(a[1:], len(data))
        spans = Spans(data)

        def parts(k: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
            size = b[k] - a[k]
            joined, cut = data[runs(a[k], size)], np.concatenate([[0], np.cumsum(size)]).tolist()
            raw = joined.tobytes()
            return [raw[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)], joined, size

        h, back = np.unique(spans.hashes(a, b), return_inverse=True)
        one = np.zeros(len(h), np.int64)  # a word of each hash
        one[back] = np.arange(len(back))
        slot = self.known(h, spans, a[one], b[one], lambda k: parts(one[k]))[back]
        like = one[back]
        odd = np.flatnonzero(~spans.same(a, b, spans, a[like], b[like]))
        if len(odd):
            slot[odd] = self.take_up(*parts(odd))
        begin = self.bounds[slot]
        size = self.bounds[slot + 1] - begin
        stop = np.concatenate([[0], np.cumsum(size)])
        return self.pool[runs(begin, size)], stop[np.searchsorted(a, offsets)]


class Segmenter:
    """Encodes and decodes as the library does with a model. by_words: whether texts are put together from marked words; else whole texts go to the library."""

    def __init__(self, path: str):
        self.model = SentencePieceProcessor(model_file=path)
        m = ModelProto.FromString(self.model.serialized_model_proto())
        spec = m.normalizer_spec
        plain = not spec.precompiled_charsmap and spec.add_dummy_prefix and not spec.remove_extra_whitespaces and spec.escape_whitespaces
        merges = m.trainer_spec.model_type == TrainerSpec.BPE and not m.trainer_spec.treat_whitespace_as_suffix
        # Unknown characters side by side become one id, over a word's start too, unless they fall back to bytes.
        self.by_words = bool(plain and merges and m.trainer_spec.byte_fallback and not any(crosses(p.piece) for p in m.pieces))
        # Behind a line feed a marker alone gets no second one from the library.
        self.lone = self.model.encode("\n ")[len(self.model.encode("\n")) :]
        self.table = WordTable(self.words)

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of marked words, one after another, and their numbers. The library puts a marker before what it gets, so the word's first one is taken off."""
        rest = [w[1:] if w[0] == 32 else w[3:] for w in words]
        ids = [x or self.lone for x in self.model.encode(rest, num_threads=1)]
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64)

    def encode(self, texts: pa.Array) -> list[list[int]]:
        """Ids of whole texts; null counts as empty."""
        if not self.by_words:
            return [self.model.encode(x or "") for x in texts.to_pylist()]
        flat, begin = self.table.texts(texts)
        flat = flat.tolist()
        return [flat[a:b] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]


_segmenters: dict[str, Segmenter] = {}


def segmenter(path: str) -> Segmenter:
    """The worker's segmenter for a model file."""
    if path not in _segmenters:
        _segmenters[path] = Segmenter(path)
    return _segmenters[path]


Derive = Callable[[list[int], str], tuple]


def encode_documents(docs: DataFrame, path: str, end_id: bool = True, derive: Derive | None = None, schema: str = "", with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens and token_ids of every whole text, closed by the model's end id unless end_id is false; with derive, also its columns (schema) from ids and decoded text.

    Null and empty texts have the end id alone; ids of any value, null or repeated, pass row by row; other columns are ignored; an empty table gives an
    empty one. A text of any length is segmented whole. path is read on each worker (the installed model).
    """
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("token_ids", T.ArrayType(T.IntegerType(), False))] * with_ids
    fields += list(T._parse_datatype_string(schema).fields) if schema else []
    out = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = segmenter(path)
        close = [s.model.eos_id()] if end_id else []
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids = [x + close for x in s.encode(part.column("text"))]
                columns = [part.column("doc_id"), pa.array(list(map(len, ids)), pa.int64())]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                if derive:
                    columns += [pa.array(x) for x in zip(*map(derive, ids, s.model.decode(ids, num_threads=1)), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return as_documents(docs, "doc_id", "text").mapInArrow(run, out)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text (decoded) of token_ids, as the library decodes them; a null list decodes to an empty text. An id that the model lacks is an error."""
    out = T.StructType([T.StructField("doc_id", encoded.schema["doc_id"].dataType), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = segmenter(path).model
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                texts = [model.decode(x) if x else "" for x in part.column("token_ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], names=out.names)

    rows = as_documents(encoded, "doc_id", "token_ids").withColumn("token_ids", F.filter("token_ids", lambda x: x.isNotNull()))
    return rows.mapInArrow(run, out)


__all__ = ["Segmenter", "WordTable", "decode_documents", "encode_documents", "segmenter", "starts"]
