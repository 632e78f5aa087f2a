"""A stated query set against all rows, in blocks: both sides are packed into rows of bounded size, and each block of queries meets each shard once.

The cells are dealt over tasks by an ordinary join on a block's and a shard group's number, so that no query passes the driver, nothing is broadcast
whatever the number of queries, and a lost task is done again from the written tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, written
from .pieces import runs

#: Shards that share a copy of a block, at most.
TOGETHER = 8


def packed(rows: DataFrame, most: int, most_bytes: int, name: str, seal: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]] | None = None) -> DataFrame:
    """(part, dim, n, one binary column for each of rows) of consecutive rows with vectors v of one dimension; written.

    Columns but v must be longs, v an array of longs or doubles without nulls. A packed row holds at most `most` rows and most_bytes of v; a longer vector alone.
    seal: what is packed instead of the arrays of a packed row.
    """
    small_batches(rows.sparkSession)
    names = [c for c in rows.columns if c != "v"]
    kind = np.int64 if isinstance(rows.schema["v"].dataType.elementType, T.LongType) else np.float64
    out = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("n", T.IntegerType()), *(T.StructField(c, T.BinaryType()) for c in [*names, "v"])])

    def emit(held: dict[int, list[dict]], all_of: bool) -> Iterator[pa.RecordBatch]:
        for d in list(held):
            size = max(1, min(most, most_bytes // (8 * max(d, 1))))
            if not all_of and sum(len(x["v"]) for x in held[d]) < size:
                continue
            whole = {c: np.concatenate([x[c] for x in held[d]]) for c in [*names, "v"]}
            n = len(whole["v"])
            last = n if all_of else n - n % size
            for a in range(0, last, size):
                b = min(a + size, last)
                part = {c: x[a:b] for c, x in whole.items()}
                part = seal(part) if seal else part
                yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([b - a], pa.int32()), *(pa.array([part[c].tobytes()], pa.binary()) for c in [*names, "v"])], names=out.names)
            held[d] = [{c: x[last:] for c, x in whole.items()}]
        if all_of:
            held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict]] = {}
        for batch in batches:
            v = batch.column("v")
            size = v.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            begin, flat = np.cumsum(size) - size, v.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
            for d in np.unique(size).tolist():
                own = np.flatnonzero(size == d)
                part = {c: batch.column(c).to_numpy(zero_copy_only=False)[own] for c in names}
                held.setdefault(d, []).append(part | {"v": flat[runs(begin[own], size[own])].reshape(len(own), d)})
            yield from emit(held, sum(x["v"].nbytes for parts in held.values() for x in parts) > 4 * most_bytes)
        yield from emit(held, True)

    return written(rows.mapInArrow(run, out).select(F.monotonically_increasing_id().alias("part"), "*"), name)


def meet(shards: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every block with every shard of its dimension, once: b_* and s_* columns, dealt over tasks that each take whole cells."""
    spark = shards.sparkSession
    n_shards, n_blocks = max(1, shards.count()), max(1, blocks.count())
    wide = spark.sparkContext.defaultParallelism
    groups = max(-(-n_shards // TOGETHER), min(n_shards, -(-2 * wide // n_blocks)))
    tasks = min(n_blocks * groups, max(4 * wide, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = lambda n: F.pmod(F.xxhash64("part"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    named = lambda t, p: t.select("block", "grp", *(F.col(c).alias(f"{p}_{c}") for c in t.columns if c not in ("block", "grp")))
    s = named(shards.withColumn("grp", dealt(groups)).withColumn("block", every(n_blocks)), "s")
    b = named(blocks.withColumn("block", dealt(n_blocks)).withColumn("grp", every(groups)), "b")
    # The same partitioning on both sides, so that the join adds no exchange and small cells aren't put into one task.
    s, b = (x.repartition(tasks, "block", "grp") for x in (s, b))
    return s.join(b.hint("merge"), ["block", "grp"]).where("s_dim = b_dim").drop("block", "grp")


__all__ = ["meet", "packed"]
