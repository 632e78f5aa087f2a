"""Hard negatives against brute force."""

import random

import duckdb
import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from millrace.llm import grid, hard_negatives, queries  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

SF = "/root/testdata/sf0.001"


def brute(anchors, rows, positives=5, negatives=5, share=80, scale=256):
    def usable(t):
        return [(i, c, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v, c in t if None not in (i, v, c) and all(x is not None and np.isfinite(x) for x in v)]

    out, rows = [], usable(rows)
    for i, c, v in usable(anchors):
        met = sorted((-sum(a * b for a, b in zip(v, w)), j, d) for j, d, w in rows if len(w) == len(v))
        for s, p, _ in [x for x in met if x[2] == c and x[1] != i][:positives]:
            taken = [x for x in met if x[2] != c and share * -s <= 100 * -x[0] <= 100 * -s][:negatives]
            out += [(i, p, k + 1, j, -s, -t) for k, (t, j, _) in enumerate(taken)]
    return sorted(out)


def rows_of(rng, n, dims, labels, spread):
    return [(rng.randrange(n), [rng.gauss(0, spread) for _ in range(rng.choice(dims))], rng.choice(labels)) for _ in range(n)]


@pytest.mark.parametrize("seed, n, dims, labels, spread, small", [(1, 400, [8], [0, 1, 2], 0.3, True), (2, 300, [3, 70, 129], [0, None], 1.0, True), (3, 300, [2], [0, 1], 0.02, False), (4, 200, [5], [1], 0.3, False)])
def test_mine(spark, monkeypatch, seed, n, dims, labels, spread, small):
    rng = random.Random(seed)
    if small:  # many shards and blocks
        monkeypatch.setattr(hard_negatives, "SHARD_ROWS", 37)
        monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 7)
    rows = rows_of(rng, n, dims, labels, spread)
    rows += rows[:40]  # repeated rows
    rows += [(i, rows[7][1], 1) for i in range(n, n + 30)]  # ties
    rows += [(5, None, 1), (6, [], 1), (7, [], 0), (8, [None] * 8, 0), (9, [float("nan")] * 8, 1), (10, [float("inf")] * 8, 1), (None, [0.1] * 8, 1), (11, [0.0] * 8, 1), (12, [-1.0, 1.0], 0)]
    table = spark.createDataFrame([(i, v, c, "x", i) for i, v, c in rows], "id int, v array<float>, label int, b_part string, score int").repartition(3)
    anchors = [r for r in rows if r[0] is not None and r[0] % 10 == 0]
    got = hard_negatives.mine(table.where("id % 10 = 0"), table, "id", "v", "label")
    want = brute(anchors, rows)
    assert len(want) > 20 or len(set(labels)) == 1
    assert sorted(map(tuple, got.collect())) == want


def test_empty(spark):
    none = spark.createDataFrame([], "id long, v array<float>, label int")
    assert hard_negatives.mine(none, none, "id", "v", "label").collect() == []
    one = spark.createDataFrame([(1, [1.0], 0)], "id long, v array<float>, label int")
    assert hard_negatives.mine(one, one, "id", "v", "label").collect() == []
    huge = spark.createDataFrame([(1, [1e12], 0), (2, [1e12], 0), (3, [1e12], 1)], "id long, v array<double>, label int")
    with pytest.raises(Exception, match="too large"):
        hard_negatives.mine(huge, huge, "id", "v", "label").collect()


def test_planes():
    r = np.random.default_rng(1)
    for d in (0, 1, 63, 64, 65, 200):
        x = r.integers(-300, 300, (20, d))
        p = hard_negatives.Planes.of(x)
        bits = np.unpackbits(p.words.view(np.uint8), axis=2, bitorder="little")[:, :, :d].astype(np.int64)
        assert ((bits * p.weights[:, None, None]).sum(0) == x).all()
        back = hard_negatives.Planes.read(p.words.tobytes(), 20, d)
        assert (back.words == p.words).all() and (back.weights == p.weights).all()
    assert hard_negatives.Planes.of(np.array([[-4, 3]])).count == 3


def test_rows_are_dropped_before_the_last_plane():
    r = np.random.default_rng(2)
    x = r.integers(-256, 256, (5000, 64))
    planes, seen = hard_negatives.Planes.of(x), []
    a = hard_negatives.Anchor(hard_negatives.Planes.of(x[:1]), 0, x[0])
    own = a.with_plane
    a.with_plane = lambda words: seen.append(len(words)) or own(words)
    rows, score = hard_negatives.scored(planes, a, np.arange(5000), hard_negatives.Wanted(np.array([-(1 << 63)]), np.array([(1 << 63) - 1]), 5))
    exact = x @ x[0]
    assert (score == exact[rows]).all() and set(np.argsort(-exact, kind="stable")[:5]) <= set(rows.tolist())
    assert seen[0] == 5000 and seen[-1] < 200


def test_grid_meets_once(spark):
    t = spark.range(100).selectExpr("id", "id AS other", "transform(sequence(1, 1 + id % 2), x -> double(x)) AS v").repartition(4)
    shards, blocks = grid.packed(t, 9, 1 << 20, "a"), grid.packed(t.where("id % 3 = 0"), 4, 24, "b")
    assert shards.agg(F.sum("n"), F.max("n")).first()[0] == 100 and shards.agg(F.max("n")).first()[0] == 9
    met = grid.meet(shards, blocks).select("s_part", "b_part").collect()
    pairs = [(s.part, b.part) for s in shards.collect() for b in blocks.collect() if s.dim == b.dim]
    assert sorted(map(tuple, met)) == sorted(pairs) and blocks.agg(F.max(F.col("n") * F.col("dim"))).first()[0] <= 3


def test_op12_columns(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in queries.table(spark, SF, "embeddings").collect()]
    got = queries.op12_hard_negatives(spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(map(tuple, got.collect()))
    assert got == brute([r for r in rows if r[0] % 100 == 0], rows)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert got == sorted(con.sql(queries.ORACLES["op12_hard_negatives"]).fetchall())
