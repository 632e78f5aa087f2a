"""Shared folders, written intermediates and vectorised word hashing for the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.files import Files

#: Bytes of text handled at once by a Python worker; a longer single text is handled alone.
SLICE_BYTES = 4 << 20


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir; only a local session may do without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/millrace/{name}-{uuid.uuid4().hex}"
    if _scratch:
        _scratch[-1].append(path)
    return path


#: Paths handed out within each open scratch, the innermost last.
_scratch: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What operators write to the shared folder within is removed at the end, whether it succeeds or not. Results are lazy: write or collect them within.

        with scratch(spark):
            near_duplicates(docs).write.parquet(path)
    """
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            Files(spark).remove(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes df as Parquet to the shared folder and reads it back."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of a batch of rows on its way to a Python worker; batches would else be bounded by their number of rows alone.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by BATCH_BYTES, unless the session has a bound of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, BATCH_BYTES)


def as_documents(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra columns can't clash with an operator's own."""
    small_batches(df.sparkSession)
    return df.select(*(F.col(f"`{c}`") for c in columns))


def unused(df: DataFrame, name: str) -> str:
    """A column name made from `name` that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Keys that are dealt over several tasks each have at least one in so many of all rows, so they are fewer than that and can be broadcast.
HEAVY = 1000


def join_dealt(rows: DataFrame, known: DataFrame, keys: list[str], count: str, spread: Column, how: str = "inner") -> DataFrame:
    """rows joined with known (a row a key; `count`: the rows of each) on keys, a heavy key's rows in as many tasks as its share of all rows asks for.

    spread: what a key's rows are dealt by. Heavy keys are those with more than one row in HEAVY; what rows are told of them is broadcast.
    """
    total = known.agg(F.sum(count)).first()[0] or 0
    salts = F.ceil(F.col(count) * HEAVY / F.lit(max(total, 1))).cast("int")
    heavy = known.where(F.col(count) * HEAVY > total).select(*keys, salts.alias("__salts"))  # fewer than HEAVY
    dealt = rows.join(F.broadcast(heavy), keys, "left").withColumn("__salt", F.coalesce(F.pmod(F.xxhash64(spread), F.col("__salts")).cast("int"), F.lit(0))).drop("__salts")
    every = known.withColumn("__salt", F.explode(F.when(F.col(count) * HEAVY > total, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(F.lit(0)))))
    return dealt.join(every.drop(count), [*keys, "__salt"], how).drop("__salt")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once: a lambda variable stands for it, where the optimizer would repeat the expression."""
    return F.get(F.transform(F.array(value), body), 0)


def _local_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, to): the least node of each node's component, over all edges (src, dst) that come: labels sink along edges and jump to their own labels."""
    parts = list(batches)
    if not parts:
        return
    src, dst = (pa.chunked_array([p.column(k) for p in parts]) for k in (0, 1))
    nodes = pc.unique(pa.chunked_array([*src.chunks, *dst.chunks])).sort()
    a, b = (pc.index_in(c, nodes).to_numpy().astype(np.int64) for c in (src, dst))
    label = np.arange(len(nodes))
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for ends in (a, b):
            np.minimum.at(new, label[ends], low)  # only roots are hooked, so that nodes of one root stay together
        while not (jumped := new[new] == new).all():
            new[~jumped] = new[new[~jumped]]
        label = new
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    for k in range(0, len(nodes), 10_000):
        yield pa.RecordBatch.from_arrays([nodes[k : k + 10_000], nodes.take(pa.array(label[k : k + 10_000]))], names=["node", "to"])


#: Edges of a contracted graph that one task finishes, unless a caller says otherwise.
LOCAL_EDGES = 200_000


def connected_components(edges: DataFrame, name: str = "components", local_edges: int | None = None) -> DataFrame:
    """(node, component): the least node reachable over edges (src, dst), for every node of an edge.

    Each round every node joins the neighbour (or itself) of least random priority and the graph
    is contracted, so rounds grow with the logarithm of the nodes whatever the shape. Once at most local_edges edges are left, one
    task finishes; this parameter bounds that task and never the result, and with 0 the rounds go on to the end.
    Nulls and loops are ignored. No row of the graph reaches the driver.
    """
    local_edges = LOCAL_EDGES if local_edges is None else local_edges
    e = edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL")
    e = written(e.where("src <> dst").distinct(), name)
    kind = e.schema["src"].dataType
    levels: list[DataFrame] = []
    while left := e.count():
        if left <= local_edges:
            out = T.StructType([T.StructField("node", kind), T.StructField("to", kind)])
            levels.append(e.coalesce(1).mapInArrow(_local_components, out))
            break
        seed = F.lit(len(levels))
        both = e.union(e.select("dst", "src")).union(e.select("src", "src")).union(e.select("dst", "dst"))
        best = both.groupBy(F.col("src").alias("node")).agg(
            F.min(F.struct(F.xxhash64(seed, "dst").alias("h"), F.col("dst").alias("to"))).alias("m")
        )
        step = written(best.select("node", F.col("m.to").cast(kind).alias("to")), name)
        levels.append(step)
        a, b = (step.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to")) for c in ("src", "dst"))
        e = e.join(a, "src").join(b, "dst").select(F.col("src_to").alias("src"), F.col("dst_to").alias("dst"))
        e = written(e.where("src <> dst").distinct(), name)
    if not levels:
        return e.select(F.col("src").alias("node"), F.col("src").alias("component"))
    out = levels[0].select("node", F.col("to").alias("root"))
    if left and len(levels) == 1:  # one task has found the least nodes
        return written(out.withColumnRenamed("root", "component"), name)
    for step in levels[1:]:
        up = step.select(F.col("node").alias("root"), "to")
        out = out.join(up, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    out = written(out, name)
    least = out.groupBy("root").agg(F.min("node").alias("component"))
    return out.join(least, "root").select("node", "component")


# Words: maximal runs of bytes that are digits, a-z (A-Z lower-cased) or above 0x7F.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_IS_WORD = _WORD[_LOWER]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


#: The bytes of an eight that belong to a span of which so many are left.
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
#: Spans of more bytes go one by one.
_ALONE = 4096


class Spans:
    """A byte buffer whose parts [start, end) are hashed and compared by whole arrays, eight bytes of each at a time."""

    def __init__(self, data: np.ndarray):
        self.data = np.zeros(len(data) + 8, np.uint8)
        self.data[: len(data)] = data

    def eights(self) -> np.ndarray:
        """The eight bytes from each position on, as numbers; a view."""
        return np.ndarray((len(self.data) - 7,), "<u8", self.data, 0, (1,))

    def bytes_at(self, start: int, end: int) -> bytes:
        return self.data[start:end].tobytes()

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes. They only tell spans apart; equal ones are compared where it matters (`same`)."""
        every, size = self.eights(), end - start
        h = mixed(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        h = mixed(h ^ (every[start] & _KEEP[np.minimum(size, 8)]))
        live = np.flatnonzero((size > 8) & (size <= _ALONE))
        at, left = start[live] + 8, size[live] - 8
        while len(live):
            h[live] = mixed(h[live] ^ (every[at] & _KEEP[np.minimum(left, 8)]))
            on = left > 8
            live, at, left = live[on], at[on] + 8, left[on] - 8
        for k in np.flatnonzero(size > _ALONE).tolist():
            h[k] = int.from_bytes(hashlib.blake2b(self.data[start[k] : end[k]], digest_size=8).digest(), "little")
        return h

    def same(self, start: np.ndarray, end: np.ndarray, other: Spans, other_start: np.ndarray, other_end: np.ndarray) -> np.ndarray:
        """Whether spans hold the same bytes as those of another buffer, one by one."""
        size = end - start
        out = size == other_end - other_start
        a, b = self.eights(), other.eights()
        live = np.flatnonzero(out & (size <= _ALONE))
        x, y, left = start[live], other_start[live], size[live]
        while len(live):
            unlike = ((a[x] ^ b[y]) & _KEEP[np.minimum(left, 8)]) != 0
            out[live[unlike]] = False
            on = ~unlike & (left > 8)
            live, x, y, left = live[on], x[on] + 8, y[on] + 8, left[on] - 8
        for k in np.flatnonzero(out & (size > _ALONE)).tolist():
            out[k] = np.array_equal(self.data[start[k] : end[k]], other.data[other_start[k] : other_end[k]])
        return out


class Words:
    """The words of consecutive texts in one byte buffer: start, end, hash and text number of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, prefix: int = 0):
        """offsets: n + 1 byte positions of n texts. prefix: also hash that many first bytes of each word."""
        offsets = np.asarray(offsets, np.int64)
        base = int(offsets[0])
        data, offsets = data[base : int(offsets[-1])], offsets - base
        n = len(data)
        self.spans = Spans(_LOWER[data])
        is_word = np.zeros(n + 1, bool)
        is_word[:n] = _IS_WORD[data]
        first = np.empty(n + 1, bool)
        first[0], first[1:] = True, is_word[1:] != is_word[:-1]
        first[offsets] = True  # a word never spans two texts
        at = np.flatnonzero(first)
        run = is_word[at[:-1]] if len(at) else np.zeros(0, bool)
        self.start, self.end = at[:-1][run], at[1:][run]
        self.text = np.searchsorted(offsets, self.start, "right") - 1
        self.counts = np.bincount(self.text, minlength=len(offsets) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.hash = self.spans.hashes(self.start, self.end)
        if prefix:
            self.prefix_hash = self.spans.hashes(self.start, np.minimum(self.end, self.start + prefix))

    def word(self, k: int) -> bytes:
        return self.spans.bytes_at(self.start[k], self.end[k])

    def joined(self) -> list[bytes]:
        """The words of each text with a blank after each."""
        data = self.spans.data[:-8].copy()
        keep = _WORD[data]
        between = np.delete(self.start, self.first[:-1][self.counts > 0]) - 1  # the byte before a word that another one precedes
        keep[between], data[between] = True, 32
        size = np.bincount(self.text, self.end - self.start, len(self.counts)).astype(np.int64) + np.maximum(self.counts - 1, 0)
        cut = np.concatenate([[0], np.cumsum(size)]).tolist()
        data = data[keep].tobytes()
        return [data[a:b] + b" " if a < b else b"" for a, b in zip(cut[:-1], cut[1:], strict=True)]


class Lexicon:
    """Numbers from 1 of the distinct words of consecutive texts. Words are grouped by hash and then compared; words of one hash but other bytes get numbers of their own."""

    def __init__(self, w: Words):
        self.w = w
        self.hash, back = np.unique(w.hash, return_inverse=True)
        self.one = np.zeros(len(self.hash), np.int64)  # a word of each hash
        self.one[back[::-1]] = np.arange(len(back))[::-1]
        self.of = back + 1
        self.others: dict[bytes, int] = {}
        like = self.one[back]
        for k in np.flatnonzero(~w.spans.same(w.start, w.end, w.spans, w.start[like], w.end[like])).tolist():
            self.of[k] = self.others.setdefault(w.word(k), len(self.hash) + 1 + len(self.others))

    def find(self, other: Words) -> np.ndarray:
        """The numbers of other words, -1 for those that aren't here."""
        out = np.full(len(other.hash), -1, np.int64)
        if not len(self.hash):
            return out
        at = np.minimum(np.searchsorted(self.hash, other.hash), len(self.hash) - 1)
        some = np.flatnonzero(self.hash[at] == other.hash)
        like = self.one[at[some]]
        same = other.spans.same(other.start[some], other.end[some], self.w.spans, self.w.start[like], self.w.end[like])
        out[some[same]] = at[some[same]] + 1
        for k in some[~same].tolist():
            out[k] = self.others.get(other.word(k), -1)
        return out


def _places(w: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of each n-word shingle, the words' end of its text, and where each text's shingles begin. A text of fewer than n words, but not none, has one of all its words."""
    size = np.where(w.counts >= n, w.counts - n + 1, (w.counts > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(size)])
    text = np.repeat(np.arange(len(size)), size)
    return np.arange(int(begin[-1])) - begin[text] + w.first[text], w.first[text + 1], begin


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles of each text, and where each text's begin (n_texts + 1 positions)."""
    at, last, begin = _places(w, n)
    h = np.zeros(len(at), np.uint64)
    for k in range(n if len(at) else 0):
        inside = at + k < last
        h = h * np.uint64(0xD6E8FEB86659FD93) + np.where(inside, w.hash[np.minimum(at + k, len(w.hash) - 1)], np.uint64(0x5851F42D4C957F2D))
    return mixed(h), begin


def gram_numbers(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """As grams, with numbers that are equal just for shingles of the same words."""
    at, last, begin = _places(w, n)
    of = Lexicon(w).of
    width = int(of.max(initial=0)) + 1
    number, top = np.zeros(len(at), np.int64), 1
    for k in range(n if len(at) else 0):
        if top * width >= 1 << 63:
            number = np.unique(number, return_inverse=True)[1]
            top = int(number.max()) + 1
        number = number * width + np.where(at + k < last, of[np.minimum(at + k, len(of) - 1)], 0)
        top *= width
    return number, begin


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def give_back() -> None:
    """Returns freed memory to the system; workers live on between tasks."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
    pa.default_memory_pool().release_unused()


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about limit bytes of text each, one row at least."""
    _, offsets = text_buffers(batch.column(column))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b
    give_back()
