"""Benchmark decontamination: suffix arrays over shards of training texts, searched for every test suffix.

A shard holds whole documents of about SLICE_BYTES bytes (a longer document is its own shard). Its word suffixes are
sorted by prefix doubling; each suffix of each test item narrows its interval of the array word by word with
binary search, which gives its longest verbatim match, the places of it and of its first words. Shards
live and die within a task, so a lost executor costs only its tasks. Words are numbered by their bytes, so that matches are verbatim.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, Lexicon, Words, as_documents, slices, small_batches, text_buffers

#: Bytes of test texts in one broadcast; a larger benchmark is broadcast in several blocks, one of them in memory at a time.
BLOCK_BYTES = 8 << 20


class Items:
    """One block of test items: their words, and of each word position the words left in its item and the window's length."""

    def __init__(self, ids: list, texts: list[str], window: int):
        data, offsets = text_buffers(pa.array(texts, pa.large_string()))
        w = Words(data, offsets)
        self.ids, self.words, self.item = ids, w, w.text
        self.pos = np.arange(len(w.start)) - w.first[w.text]
        self.left = w.counts[w.text] - self.pos
        self.window = np.minimum(window, w.counts)[w.text]
        self.longest = int(w.counts.max(initial=0))


class Blocks:
    """The test items in broadcasts of packed texts, each of at most BLOCK_BYTES of text or one item; a worker unpacks one at a time and keeps it only if there is no other."""

    def __init__(self, benchmark: DataFrame, window: int):
        sc = benchmark.sparkSession.sparkContext
        pack = lambda ids, texts: sc.broadcast(zlib.compress(pickle.dumps((ids, texts)), 1))
        self.window, self.only, self.packed = window, None, []
        ids, texts, size = [], [], 0
        for row in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
            if texts and size + len(row[1]) > BLOCK_BYTES:
                self.packed.append(pack(ids, texts))
                ids, texts, size = [], [], 0
            ids.append("" if row[0] is None else str(row[0]))
            texts.append(row[1])
            size += len(row[1])
        self.packed.append(pack(ids, texts))

    def __iter__(self) -> Iterator[Items]:
        for p in self.packed:
            items = self.only or Items(*pickle.loads(zlib.decompress(p.value)), self.window)
            self.only = items if len(self.packed) == 1 else None
            yield items


class SuffixArray:
    """Word suffixes of consecutive texts in sorted order, exact to `depth` words; a suffix ends with its text."""

    def __init__(self, w: Words, depth: int):
        self.lexicon = Lexicon(w)
        n = len(w.hash)
        self.rank = np.concatenate([self.lexicon.of, [0]])  # 0: past the text's end
        stop = w.first[w.text + 1] if n else np.zeros(0, np.int64)
        self.stop = np.append(stop, n)
        at, rank, size = np.arange(n), self.rank, 1
        while n and size < depth:
            bits = int(rank.max()).bit_length()
            key, steps = rank[:n].copy(), max(2, min(63 // bits, 4))
            for k in range(1, steps):
                key <<= bits
                key |= np.where(at + k * size < stop, rank[np.minimum(at + k * size, n)], 0)
            order = np.argsort(key)
            new = np.concatenate([[True], np.diff(key[order]) != 0])
            rank = np.zeros(n + 1, np.int64)
            rank[order] = np.cumsum(new)
            size *= steps
            if new.all():
                break
        self.order = np.argsort(rank[:n], kind="stable")

    def word_at(self, place: np.ndarray, step: int) -> np.ndarray:
        """The rank of the word `step` after the suffix's start, 0 past its end."""
        p = self.order[place]
        q = p + step
        return np.where(q < self.stop[p], self.rank[np.minimum(q, len(self.rank) - 1)], 0)

    def bound(self, lo: np.ndarray, hi: np.ndarray, step: int, want: np.ndarray) -> np.ndarray:
        """The first place in [lo, hi) whose word at `step` is at least `want`, by binary search."""
        lo, hi = lo.copy(), hi.copy()
        while len(open_ := np.flatnonzero(lo < hi)):
            mid = (lo[open_] + hi[open_]) // 2
            less = self.word_at(mid, step) < want[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        return lo

    def search(self, items: Items) -> dict[str, np.ndarray]:
        """Of every test suffix: longest match, one place of it, and the interval of those matching its window."""
        m = len(items.item)
        out = {k: np.zeros(m, np.int64) for k in ("longest", "place", "lo", "hi")}
        if not m or not len(self.order):
            return out
        want = np.append(self.lexicon.find(items.words), -1)
        live = np.flatnonzero(want[:m] > 0)
        lo, hi = np.zeros(len(live), np.int64), np.full(len(live), len(self.order))
        step = 0
        while len(live):
            w = want[live + step]
            lo, hi = self.bound(lo, hi, step, w), self.bound(lo, hi, step, w + 1)
            hi = np.where(w > 0, hi, lo)
            on = lo < hi
            live, lo, hi = live[on], lo[on], hi[on]
            step += 1
            out["longest"][live] = step
            out["place"][live] = self.order[lo]
            full = items.window[live] == step
            out["lo"][live[full]], out["hi"][live[full]] = lo[full], hi[full]
            on = items.left[live] > step
            live, lo, hi = live[on], lo[on], hi[on]
        return out


def _spread(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All whole numbers of the intervals, one after another."""
    size = hi - lo
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)


def _hits(w: Words, sa: SuffixArray, items: Items, found: dict[str, np.ndarray], cover: np.ndarray) -> np.ndarray:
    """Adds window occurrences to cover (+1 at starts, -1 after ends); distinct (text, item) pairs as text * n_items + item."""
    some = np.flatnonzero(found["lo"] < found["hi"])
    pairs = []
    for k in range(0, len(some), 4096):
        part = some[k : k + 4096]
        lo, hi = found["lo"][part], found["hi"][part]
        size, item = hi - lo, items.item[part]
        bulk = np.cumsum(size) // (1 << 20)  # about a million occurrences at once
        for b in np.unique(bulk):
            own = bulk == b
            place = sa.order[_spread(lo[own], hi[own])]
            length = np.repeat(items.window[part][own], size[own])
            np.add.at(cover, place, 1)
            np.add.at(cover, place + length, -1)
            pairs.append(np.unique(w.text[place] * len(items.ids) + np.repeat(item[own], size[own])))
    return np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per document: n_words, n_hit (words inside a window's occurrence), spans [start, end) of hit words, items and the longest match.

    A window is `window` consecutive words of an item; an item of fewer words, but not none, is one window. items are
    the distinct item_ids as sorted strings (null as ''). Null and empty texts have no words; null or repeated ids pass row
    by row; other columns are ignored; with an empty benchmark nothing is hit.
    """
    held = Blocks(benchmark, window)
    out = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("longest", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                w = Words(*text_buffers(part.column("text")))
                n = part.num_rows
                cover, longest, names = np.zeros(len(w.hash) + 1, np.int64), np.zeros(n, np.int64), [set() for _ in range(n)]
                sa = None
                for items in held:
                    if sa is None or depth < items.longest:  # noqa: F821
                        depth = items.longest
                        sa = SuffixArray(w, depth)
                    found = sa.search(items)
                    matched = np.flatnonzero(found["longest"])
                    np.maximum.at(longest, w.text[found["place"][matched]], found["longest"][matched])
                    for text, item in zip(*np.divmod(_hits(w, sa, items, found, cover), max(1, len(items.ids))), strict=True):
                        names[text].add(items.ids[item])
                hit = np.cumsum(cover)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                cut = w.first[np.flatnonzero(np.isin(w.first, np.flatnonzero(hit)))]  # hits of two texts may touch
                inner = np.setdiff1d(cut, edge)
                edge = np.sort(np.concatenate([edge, inner, inner]))
                starts, ends = edge[::2], edge[1::2]
                owner = w.text[starts] if len(starts) else np.zeros(0, np.int64)
                spans: list[list] = [[] for _ in range(n)]
                for t, a, b in zip(owner.tolist(), starts.tolist(), ends.tolist(), strict=True):
                    spans[t].append([a - int(w.first[t]), b - int(w.first[t])])
                n_hit = np.bincount(w.text[hit], minlength=n) if len(hit) else np.zeros(n, np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(w.counts.astype(np.int64)), pa.array(n_hit.astype(np.int64)), pa.array(longest), pa.array([sorted(x) for x in names], pa.list_(pa.string())), pa.array(spans, pa.list_(pa.list_(pa.int64())))], names=out.names)

    return as_documents(docs, "doc_id", "text").mapInArrow(run, out)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Of every test suffix with a match of at least `window` words: item_id, item_pos, the longest match's length, and a place (doc_id, doc_pos).

    Of equally long matches the least doc_id's first one counts.
    """
    held = Blocks(benchmark, window)
    kind = docs.schema["doc_id"].dataType
    out = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("item_pos", T.LongType()), T.StructField("length", T.LongType()), T.StructField("doc_id", kind), T.StructField("doc_pos", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                w = Words(*text_buffers(part.column("text")))
                for items in held:
                    sa = SuffixArray(w, items.longest)
                    found = sa.search(items)
                    k = np.flatnonzero(found["longest"] >= window)
                    text = w.text[found["place"][k]]
                    yield pa.RecordBatch.from_arrays([pa.array([items.ids[i] for i in items.item[k]], pa.string()), pa.array(items.pos[k].astype(np.int64)), pa.array(found["longest"][k]), part.column("doc_id").take(pa.array(text)), pa.array((found["place"][k] - w.first[text]).astype(np.int64))], names=out.names)

    rows = as_documents(docs, "doc_id", "text").mapInArrow(run, out)
    best = F.min(F.struct((-F.col("length")).alias("l"), "doc_id", "doc_pos")).alias("b")
    return rows.groupBy("item_id", "item_pos").agg(best).select("item_id", "item_pos", (-F.col("b.l")).alias("length"), "b.doc_id", "b.doc_pos")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents no word of which is hit, with all their columns, in one pass and without a shuffle.

    Column types and order stay; null texts stay.
    """
    held = Blocks(benchmark, window)
    small_batches(docs.sparkSession)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = names.index("text")
        for batch in batches:
            for part in slices(batch.rename_columns([str(i) for i in range(batch.num_columns)]), str(k), SLICE_BYTES):
                w = Words(*text_buffers(part.column(k)))
                bad, sa, depth = np.zeros(part.num_rows, bool), None, -1
                for items in held:
                    if sa is None or depth < items.longest:
                        depth = items.longest
                        sa = SuffixArray(w, depth)
                    found = sa.search(items)
                    cover = np.zeros(len(w.hash) + 1, np.int64)
                    bad[_hits(w, sa, items, found, cover) // max(1, len(items.ids))] = True
                yield part.filter(pa.array(~bad)).rename_columns(names)

    return docs.mapInArrow(run, docs.schema)
