"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform) of a unit vector is hashed to its nearest signed axis. Each
shard of vectors has its own tables; the stated queries meet the shards in blocks and probe in every table of a
shard the axes nearest to them, best first over all tables. What they collect is ordered by the sum, over all tables, of the query's
coordinate along the row's axis; the best share of that is ranked by exact distances of the original vectors. A shard gives
each query its k best, so what is shuffled is k rows a query and shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_documents
from .grid import meet, packed



@dataclass(frozen=True)
class Settings:
    """Parameters of a search. Bounds of what is ranked: with probes and ranked at 1.0 every row is, and the search is exact."""

    tables: int = 16
    #: The share of the axes of all tables that a query probes.
    probes: float = 0.05
    #: The share of a shard, and the rows at least, that are ranked by exact distances.
    ranked: float = 0.05
    ranked_rows: int = 1000


#: Vectors of a shard and queries of a block, at most, and bytes of their doubles, so that neither grows with the dimension.
SHARD_ROWS, SHARD_BYTES, BLOCK_ROWS, BLOCK_BYTES = 32_768, 32 << 20, 8_192, 8 << 20
#: Components of the queries that are probed at once.
PROBED = 1 << 14


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """A pseudo-random rotation of rows, padded with zeros to a power of two."""
    n, d = x.shape
    size = 1 << max(0, (d - 1)).bit_length()
    signs = np.random.default_rng(seed).choice(np.array([-1, 1], np.float32), (3, size, 1)) * np.float32(size**-0.5)
    out = np.empty((n, size), np.float32)
    for k in range(0, n, 1024):  # vectors as columns, so many that they stay in the processor's cache
        part = np.zeros((size, min(1024, n - k)), np.float32)
        part[:d] = x[k : k + 1024].T
        for s in signs:
            part *= s
            h = 1
            while h < size:
                y = part.reshape(size // (2 * h), 2, h, -1)
                low = y[:, 0] - y[:, 1]
                y[:, 0] += y[:, 1]
                y[:, 1] = low
                h *= 2
        out[k : k + 1024] = part.T
    return out


def signed_axes(x: np.ndarray) -> np.ndarray:
    """The nearest signed axis of each row: its number, plus the dimension if negative."""
    at = np.abs(x).argmax(1)
    return at + x.shape[1] * (x[np.arange(len(x)), at] < 0)


class Shard:
    """Distinct vectors of a shard, each with the least k + 1 of its distinct ids, and their tables."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, settings: Settings | None = None):
        self.settings = s = settings or Settings()
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        _, first, back = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_index=True, return_inverse=True)
        self.x = x[first].astype(np.float64)
        by = np.argsort(back, kind="stable")
        again = (back[by[1:]] == back[by[:-1]]) & (ids[by[1:]] == ids[by[:-1]])  # rows of equal id and vector are one
        by = by[np.concatenate([[True], ~again])]
        begin = np.searchsorted(back[by], np.arange(len(first) + 1))
        # More ids of a vector than the k + 1 least never reach the k nearest of a query, itself left out.
        self.ids = [ids[by[a : min(b, a + k + 1)]] for a, b in zip(begin[:-1], begin[1:], strict=True)]
        unit = self.x / np.linalg.norm(self.x, axis=1, keepdims=True)
        self.tables = []
        self.axes = np.zeros((len(self.x), s.tables), np.int32)  # numbered over all tables
        for t in range(s.tables):
            axis = signed_axes(rotated(unit, t))
            order = np.argsort(axis, kind="stable")
            width = 2 << max(0, (x.shape[1] - 1)).bit_length()
            self.axes[:, t] = axis + t * width
            self.tables.append((order, np.searchsorted(axis[order], np.arange(width + 1))))

    def probe(self, q: np.ndarray) -> Iterator[np.ndarray]:
        """For each query the rows to rank: the best of those that share a probed axis in some table."""
        s = self.settings
        unit = q / np.linalg.norm(q, axis=1, keepdims=True)
        turned = [rotated(unit, t) for t in range(s.tables)]
        scores = np.concatenate([np.concatenate([r, -r], axis=1) for r in turned], axis=1)
        width = scores.shape[1] // s.tables
        probes, most = max(1, round(s.probes * scores.shape[1])), max(s.ranked_rows, round(s.ranked * len(self.x)))
        best = np.argpartition(-scores, probes - 1, axis=1)[:, :probes]
        for score, row in zip(scores, best, strict=True):
            hit = np.zeros(len(self.x), bool)
            for t, axis in zip(*np.divmod(row, width), strict=True):
                order, begin = self.tables[t]
                hit[order[begin[axis] : begin[axis + 1]]] = True
            seen = np.flatnonzero(hit)
            if len(seen) > most:
                near = score[self.axes[seen]].sum(1)
                seen = seen[np.argpartition(-near, most - 1)[:most]]
            yield seen


def least_of_ids(shard: Shard, q_id: int, v: np.ndarray, found: np.ndarray, k: int) -> list[tuple[float, int]]:
    """(distance, id) of the k nearest distinct ids but q_id of the found rows, each with its nearest vector; fewer if they have fewer."""
    d = np.sqrt(((shard.x[found] - v) ** 2).sum(1))
    most = k + 1
    while True:
        near = np.flatnonzero(d <= np.partition(d, most - 1)[most - 1]) if len(d) > most else np.arange(len(d))
        best: dict[int, float] = {}
        for x, r in zip(d[near].tolist(), found[near].tolist(), strict=True):
            for i in shard.ids[r].tolist():
                if i != q_id and (i not in best or x < best[i]):
                    best[i] = x
        if len(best) >= k or len(near) == len(d):
            return sorted((x, i) for i, x in best.items())[:k]
        most *= 2  # the nearest vectors share ids


def nearest(shard: Shard, q_ids: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
    """(query id, vector id, distance) of the k nearest distinct ids found in the shard; all its rows are ranked for a query that collects fewer than k."""
    for q_id, v, rows in zip(q_ids.tolist(), q, shard.probe(q), strict=True):
        best = least_of_ids(shard, q_id, v, rows, k) if len(rows) > k else []
        if len(best) < k:  # too few: rank the whole shard
            best = least_of_ids(shard, q_id, v, np.arange(len(shard.x)), k)
        yield from ((q_id, i, x) for x, i in best)


def usable(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id and v (doubles) of the vectors that take part: not null, not zero, every component finite; null ids are left out."""
    t = as_documents(table, id_col, vec_col).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return t.where(F.col("id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda c: c != 0))


def search(queries: DataFrame, table: DataFrame, id_col: str, vec_col: str, k: int = 10, settings: Settings | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance) of the k nearest found of each query, its own id left out; ties to smaller ids.

    Vectors null, zero or with null or non-finite components take no part. Queries with fewer than k candidates get them all. Repeated
    ids count once, with the nearest of their vectors. Vectors meet only queries of their dimension. Settings(probes=1.0, ranked=1.0) is exact.
    """
    vectors, asked = usable(table, id_col, vec_col), usable(queries, id_col, vec_col)
    shards = packed(vectors, SHARD_ROWS, SHARD_BYTES, "vectors")
    n = max(1, asked.count())
    blocks = packed(asked.repartition(-(-n // BLOCK_ROWS), "id", "v"), BLOCK_ROWS, BLOCK_BYTES, "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                (ids, x), (q_ids, q) = ((np.frombuffer(row[f"{p}_id"], np.int64), np.frombuffer(row[f"{p}_v"], np.float64).reshape(row[f"{p}_n"], -1)) for p in "sb")
                if row["s_part"] != held:
                    held, shard = row["s_part"], Shard(ids, x, k, settings)
                some = max(1, PROBED // row["s_dim"])
                for a in range(0, len(q_ids), some):
                    found = list(nearest(shard, q_ids[a : a + some], q[a : a + some], k))
                    columns = list(zip(*found, strict=True)) or [()] * 3
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=["query_id", "vec_id", "score"])

    found = meet(shards, blocks).mapInArrow(run, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
