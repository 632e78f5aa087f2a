"""Hard negatives by bit-sliced integer products.

Components are integers; a shard of rows holds their two's complement bit-planes as machine words. An anchor's inner product with all
rows is built up plane by plane, the most significant first, as popcounts of the rows' planes under the anchor's own planes. After a plane
with weight 2^j what is left of a row adds between 2^j - 1 times the anchor's negative and 2^j - 1 times its positive components, so
each score lies in an interval; rows whose intervals can't qualify any more are dropped and the next plane is read for the others only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_documents, written
from .grid import meet, packed

#: Rows of a shard, anchors of a block, and bytes of either's components at most.
SHARD_ROWS, BLOCK_ROWS, MOST_BYTES = 8192, 1024, 8 << 20
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class Planes:
    """Two's complement bit-planes of rows of integers, the sign's first; words[k] holds plane k of each row, 64 components a word."""

    def __init__(self, words: np.ndarray):
        self.words, self.count = words, len(words)
        self.weights = np.array([(-1 if k == 0 else 1) << (self.count - 1 - k) for k in range(self.count)], np.int64)

    @classmethod
    def of(cls, x: np.ndarray) -> Planes:
        n, d = x.shape
        count = int(max(x.max(initial=0), ~x.min(initial=0), 0)).bit_length() + 1
        wide = -(-max(d, 1) // 64) * 64
        bits = np.zeros((n, wide), np.uint8)
        words = np.empty((count, n, wide // 64), "<u8")
        for k in range(count):
            bits[:, :d] = (x >> (count - 1 - k)) & 1
            words[k] = np.packbits(bits, axis=1, bitorder="little").view("<u8")
        return cls(words)

    @classmethod
    def read(cls, data: bytes, n: int, dim: int) -> Planes:
        return cls(np.frombuffer(data, "<u8").reshape(-1, n, -(-max(dim, 1) // 64)))


class Anchor:
    """An anchor's planes, and the sums of its negative and of its positive components."""

    def __init__(self, planes: Planes, row: int, x: np.ndarray):
        self.words, self.weights = planes.words[:, row], planes.weights
        self.below, self.above = int(np.minimum(x, 0).sum()), int(np.maximum(x, 0).sum())

    def with_plane(self, words: np.ndarray) -> np.ndarray:
        """Inner products with rows of bits."""
        out = np.zeros(len(words), np.int64)
        for w, own in zip(self.weights.tolist(), self.words, strict=True):
            if own.any():
                out += w * np.bitwise_count(words & own).sum(1, dtype=np.int64)
        return out


class Wanted:
    """Windows of scores, least to most, of which each takes its k highest rows. floor: scores under which a window takes no more."""

    def __init__(self, least: np.ndarray, most: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.least, self.most, self.k = least, most, k
        self.floor = least if floor is None else np.maximum(least, floor)

    def open(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Rows whose score, between low and high, may still be among those that a window takes."""
        out = (high >= self.floor.min(initial=_HIGH)) & (low <= self.most.max(initial=_LOW))
        if len(low) <= self.k or int(high[0]) - int(low[0]) > int(self.most.max()) - int(self.least.min()):
            return out  # intervals are wider than the windows: no row lies in one for certain
        some = np.zeros(len(low), bool)
        for least, most, floor in zip(self.least.tolist(), self.most.tolist(), self.floor.tolist(), strict=True):
            sure = low[(low >= least) & (high <= most)]
            if len(sure) >= self.k:
                floor = max(floor, int(np.partition(sure, len(sure) - self.k)[len(sure) - self.k]))
            some |= (high >= floor) & (low <= most)
        return out & some


def scored(planes: Planes, anchor: Anchor, rows: np.ndarray, wanted: Wanted) -> tuple[np.ndarray, np.ndarray]:
    """Rows that may be taken, and their whole scores: all that are taken are among them."""
    score = np.zeros(len(rows), np.int64)
    for k, weight in enumerate(planes.weights.tolist()):
        if not len(rows):
            break
        words = planes.words[k]
        score += weight * anchor.with_plane(words if len(rows) == len(words) else words[rows])
        left = abs(weight) - 1
        keep = wanted.open(score + left * anchor.below, score + left * anchor.above)
        rows, score = rows[keep], score[keep]
    return rows, score


def usable(table: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """id, label (long) and v (longs): floor(scale * x) of the components of rows that take part."""
    t = as_documents(table, id_col, vec_col, label_col)
    t = t.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    t = t.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(finite)
    return t.withColumn("v", F.transform("v", lambda c: F.floor(c * F.lit(float(scale))).cast("long")))


class Best:
    """For each window of each anchor of a block its k best (score, id) so far."""

    def __init__(self, k: int):
        self.k, self.of = k, {}

    def floor(self, key: tuple) -> int:
        """The score under which the window takes no more."""
        held = self.of.get(key, ())
        return held[-1][0] if len(held) >= self.k else _LOW

    def add(self, key: tuple, scores: np.ndarray, ids: np.ndarray) -> None:
        top = np.lexsort((ids, -scores))[: self.k]
        new = list(zip(scores[top].tolist(), ids[top].tolist(), strict=True))
        self.of[key] = sorted([*self.of.get(key, ()), *new], key=lambda x: (-x[0], x[1]))[: self.k]


def sliced(part: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """A shard as it is kept: rows in order of label, their components as bit-planes."""
    order = np.argsort(part["label"], kind="stable")
    return {"id": part["id"][order], "label": part["label"][order], "v": Planes.of(part["v"][order]).words}


class Block:
    """The anchors of a packed row, and the positives of each if it has them: (rank, score, id) by the anchor's place."""

    def __init__(self, row: dict):
        self.part, dim = row["b_part"], row["b_dim"]
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("b_id", "b_label"))
        x = np.frombuffer(row["b_v"], np.int64).reshape(row["b_n"], dim)
        self.planes = Planes.of(x)
        self.anchors = [Anchor(self.planes, j, own) for j, own in enumerate(x)]
        self.positives: dict[int, list[tuple[int, int, int]]] = {}
        for p in row.get("b_positives") or ():
            self.positives.setdefault(p["pos"], []).append((p["rank"], p["score"], p["id"]))


FOUND = "part long, pos int, which int, anchor_id long, positive_id long, positive_score long, score long, id long"


def best_rows(met: DataFrame, k: int, share: float | None = None) -> DataFrame:
    """FOUND: of the anchor at pos in block `part` the k best rows (score, id) in each of its windows, by task.

    Without a share there is one window, over all rows of the anchor's label but those of its own id; else there is one for each of its positives,
    from that share of the positive's score up to all of it, over the rows of other labels.
    """

    def flushed(block: Block | None, best: Best) -> Iterator[pa.RecordBatch]:
        rows = []
        for (pos, which), held in best.of.items():
            of = next(((i, s) for r, s, i in block.positives.get(pos, ()) if r == which), (None, None))
            rows += [(block.part, pos, which, int(block.ids[pos]), *of, score, i) for score, i in held]
        if rows:
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in FOUND.split(", ")])

    def cell(block: Block, row: dict, best: Best) -> None:
        own, ids = (np.frombuffer(row[c], np.int64) for c in ("s_label", "s_id"))
        planes = Planes.read(row["s_v"], row["s_n"], row["s_dim"])
        if planes.count + block.planes.count + max(row["s_dim"], 1).bit_length() > 62:
            raise ValueError("components are too large: inner products would not fit 64 bits")
        for pos, anchor in enumerate(block.anchors):
            lo, hi = np.searchsorted(own, block.labels[pos], "left"), np.searchsorted(own, block.labels[pos], "right")
            if share is None:
                windows, rows = [(0, _LOW, _HIGH)], np.arange(lo, hi)
                rows = rows[ids[rows] != block.ids[pos]]
            else:
                windows = [(r, -(-round(100 * share) * s // 100), s) for r, s, _ in block.positives.get(pos, ()) if s >= 0]
                rows = np.concatenate([np.arange(lo), np.arange(hi, len(own))])
            if not windows or not len(rows):
                continue
            which, least, most = (np.array(c) for c in zip(*windows, strict=True))
            floor = np.array([best.floor((pos, w)) for w in which.tolist()])
            rows, score = scored(planes, anchor, rows, Wanted(least, most, k, floor))
            for w, a_least, a_most in windows:
                taken = (score >= a_least) & (score <= a_most)
                if taken.any():
                    best.add((pos, w), score[taken], ids[rows[taken]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best = None, Best(k)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if block is None or row["b_part"] != block.part:
                    yield from flushed(block, best)
                    block, best = Block(row), Best(k)
                cell(block, row, best)
        yield from flushed(block, best)

    return met.mapInArrow(run, FOUND)


def top(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("part", "pos", "which").orderBy(F.col("score").desc(), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(anchors: DataFrame, table: DataFrame, id_col: str, vec_col: str, label_col: str, positives: int = 5, negatives: int = 5, share: float = 0.8, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score: hard negatives of each anchor and each of its positives.

    A component x counts as floor(scale * x); a score is the inner product with the anchor, higher first, ties by smaller id. An anchor's positives are its
    first rows of the same label and another id; a positive's negatives are the first rows of another label whose score is at least `share`
    (in whole hundredths) and at most all of the positive's; a positive of negative score has none.
    Rows with a null id, label or vector, or a null or non-finite component, take no part. Every row counts for itself, repeated
    ones too. Vectors meet only vectors of their dimension; empty ones have the score 0 among themselves. An inner product that may not fit 64 bits is an error.
    Every anchor meets every row, in blocks; nothing is approximated.
    """
    rows, asked = usable(table, id_col, vec_col, label_col, scale), usable(anchors, id_col, vec_col, label_col, scale)
    shards = packed(rows, SHARD_ROWS, MOST_BYTES, "shards", sliced)
    n = max(1, asked.count())
    blocks = packed(asked.repartition(-(-n // BLOCK_ROWS), "id", "v"), BLOCK_ROWS, MOST_BYTES, "anchors")
    first = top(best_rows(meet(shards, blocks), positives), positives).select("part", F.struct("pos", "rank", "score", "id").alias("p"))
    # A block has its anchors times so many positives at most.
    held = written(blocks.join(first.groupBy("part").agg(F.collect_list("p").alias("positives")), "part"), "positives")
    found = top(best_rows(meet(shards, held), negatives, share), negatives)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


__all__ = ["Anchor", "Planes", "Wanted", "mine", "scored"]
