"""Byte-level BPE in linear time: backtracking from longest matches over an Aho-Corasick automaton."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import as_documents, slices
from .pieces import PieceIds

#: Entries of a worker's memory of token pairs; beyond it the memory starts anew.
PAIRS = 1_000_000


class Codec:
    """Encodes as the merges of a rank file do, and decodes.

    A text is split by pattern; a piece that is a token is that token. Any other piece is covered from the
    left by the longest token that is compatible with the one before it, with shorter tokens tried next
    and the last token given up when none fits; a position once given up is never entered again. Two tokens are
    compatible if merging their joint bytes yields just these two; answers are remembered.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.trie = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.trie.add_word(token.decode("latin-1"), (len(token), rank))
        self.trie.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.own: dict[int, bool] = {}
        self.pieces = PieceIds(pattern, self.encode_pieces)

    def merged(self, data: bytes) -> list[int]:
        """The definition: merge the adjacent pair of least rank, the leftmost of equals, until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min(((self.ranks.get(parts[i] + parts[i + 1], 1 << 60)), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def reachable(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token; others stand only as whole pieces."""
        if token not in self.own:
            self.own[token] = self.merged(self.bytes_of[token]) == [token]
        return self.own[token]

    def compatible(self, left: int, right: int) -> bool:
        key = (left, right)
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return known

    def encode_bytes(self, data: bytes) -> list[int]:
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        n = len(data)
        at: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (size, token) in self.trie.iter(data.decode("latin-1")):
            at[end + 1 - size].append((size, token))
        open_ = bytearray(b"\x01") * (n + 1)
        out: list[tuple[int, int, int]] = []  # token, its start, the next shorter choice at its start
        pos = choice = 0
        while pos < n:
            options, left = at[pos], out[-1][0] if out else None
            for k in range(choice, len(options)):
                size, token = options[len(options) - 1 - k]  # matches come shortest first
                if open_[pos + size] and self.reachable(token) and (left is None or self.compatible(left, token)):
                    out.append((token, pos, k + 1))
                    pos, choice = pos + size, 0
                    break
            else:
                if not out:
                    raise ValueError("the vocabulary lacks single bytes")
                open_[pos] = 0
                _, pos, choice = out.pop()
        return [t for t, _, _ in out]

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after another, and their numbers."""
        ids = [self.encode_bytes(p.encode()) for p in pieces]
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of whole texts; null counts as empty."""
        flat, begin = self.pieces.texts(texts)
        return [flat[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for a rank file (lines of base64 token and rank) and a split pattern."""
    if (path, pattern) not in _codecs:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}
        _codecs[path, pattern] = Codec(ranks, pattern)
    return _codecs[path, pattern]


Derive = Callable[[np.ndarray, bytes], tuple]


def encode_documents(docs: DataFrame, path: str, pattern: str, derive: Derive | None = None, schema: str = "", with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens and token_ids of every whole text; with derive, also its columns (schema) from ids and decoded bytes.

    Null and empty texts have no tokens; ids of any value, null or repeated, pass row by row; other
    columns are ignored; an empty table gives an empty one. path is read on each worker (the installed vocabulary).
    """
    kind = docs.schema["doc_id"].dataType
    fields = [T.StructField("doc_id", kind), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("token_ids", T.ArrayType(T.IntegerType(), False))] * with_ids
    fields += list(T._parse_datatype_string(schema).fields) if schema else []
    out = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids = c.encode(part.column("text"))
                sizes = np.array([len(x) for x in ids], np.int64)
                columns = [part.column("doc_id"), pa.array(sizes)]
                if with_ids:
                    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                    flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(flat)))
                if derive:
                    columns += [pa.array(x) for x in zip(*(derive(x, c.decode(x)) for x in ids), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return as_documents(docs, "doc_id", "text").mapInArrow(run, out)


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes (decoded) of token_ids; a null list decodes to nothing."""
    out = T.StructType([T.StructField("doc_id", encoded.schema["doc_id"].dataType), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                data = [b"".join(map(c.bytes_of.__getitem__, x or ())) for x in part.column("token_ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(data, pa.binary())], names=out.names)

    return as_documents(encoded, "doc_id", "token_ids").mapInArrow(run, out)


__all__ = ["Codec", "codec", "decode_documents", "encode_documents"]
