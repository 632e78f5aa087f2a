"""Joins on containment against brute force, and their plans."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import containment
from millrace.sources import sitemap


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("size", [1, 3, 4])
def test_containing(spark, size):
    rng = random.Random(size)
    word = lambda low, high: "".join(rng.choices("ab가나😀/%", k=rng.randint(low, high)))
    texts = [(i, word(0, 14)) for i in range(300)] + [(300, None), (301, ""), (302, "x" * 20_000 + "가나가"), (7, "aab"), (7, "aab")]
    names = [(i, word(1, 5)) for i in range(60)] + [(60, None), (61, ""), (62, "zzz"), (63, "가나가"), (63, "가나가"), (64, "가나가")]
    t, n = spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame(names, "pos int, name string")
    got = containment.containing(t, n, "text", "name", size)
    want = sorted((i, x, p, y) for i, x in texts for p, y in names if x and y and y in x)
    assert got.columns == ["id", "text", "pos", "name"] and sorted(map(tuple, got.collect())) == want and len(want) > 300
    assert containment.containing(t, n.where("pos = 61"), "text", "name", size).collect() == []
    assert containment.containing(t.limit(0), n, "text", "name", size).collect() == [] == containment.containing(t, n.limit(0), "text", "name", size).collect()


def test_grams(spark):
    rows = spark.createDataFrame([("abab",), ("가나😀",), ("ab",), ("",), (None,)], "t string")
    assert [r[0] for r in rows.select(containment.grams(F.col("t"), 3)).collect()] == [["aba", "bab"], ["가나😀"], [], [], []]


@pytest.mark.parametrize("heads", [1000, 2])
def test_lengths_of_runs(spark, monkeypatch, heads):
    """Whole names as runs, and runs of long names, with and without a filter by their beginnings."""
    monkeypatch.setattr(containment, "HEADS", heads)
    assert containment.run_sizes([9, 4, 7]) == [4, 7, 9] and containment.run_sizes([2, 3, 4, 5, 8, 11, 16], 6) == [2, 4, 8, 16]
    rng = random.Random(heads)
    texts = [(i, "".join(rng.choices("ab가😀", k=60))) for i in range(200)]
    cuts = [(i % 200, rng.randrange(30), rng.choice((2, 3, 5, 7, 8, 11, 13, 16, 20, 25))) for i in range(300)]
    names = [(k, texts[i][1][at : at + n]) for k, (i, at, n) in enumerate(cuts)] + [(k, "ab가" * 4) for k in (300, 301)]
    t, n = spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame(names, "pos int, name string")
    want = sorted((i, x, p, y) for i, x in texts for p, y in names if y in x)
    for most in (1, 8, 20):
        assert sorted(map(tuple, containment.containing(t, n, "text", "name", most).collect())) == want and len(want) > 300


def test_work_grows_with_the_names(spark):
    """A name meets the texts it stands in and no others, though all names and texts have their short runs in common; rows that ask for the same meet them once."""
    name = lambda c: F.concat(F.lit("Customer#"), F.lpad((c % 500).cast("string"), 9, "0"), F.lit("/"))
    entries = spark.range(3000).select(F.concat(F.lit("https://t/entry/"), name(F.col("id")), F.lit("2026")).alias("url"), F.lit(0).alias("source_pos"), F.col("id").alias("loc_pos"))
    seed = spark.range(1000).select(F.col("id").cast("int").alias("seed_pos"), name(F.col("id")).alias("university"), F.lit(2026).alias("year"))
    got = sitemap.sitemap_candidates(seed, entries, 3)
    assert sorted((r.seed_pos, r["rank"]) for r in got.collect()) == [(i, k) for i in range(1000) for k in (1, 2, 3)]
    rows, todo = [], [got._jdf.queryExecution().executedPlan().executedPlan()]
    while todo:
        node = todo.pop()
        if "Join" in node.nodeName():
            rows.append(node.metrics().apply("numOutputRows").value())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())] + ([node.plan()] if "QueryStage" in node.nodeName() else [])
    assert sorted(rows) == [3000, 3000]


def test_candidates_have_keys(spark):
    """No nested loop at any size; a name with the rarest run of all is looked up by it."""
    entries = spark.range(2000).select(F.concat(F.lit("https://t/entry/대학교"), F.col("id"), F.lit("-2026")).alias("url"), F.lit(0).alias("source_pos"), F.col("id").alias("loc_pos"))
    seed = spark.range(1000).select(F.col("id").cast("int").alias("seed_pos"), F.concat(F.lit("대학교"), F.col("id"), F.lit("-")).alias("university"), F.lit(2026).alias("year"))
    for limit in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            got = sitemap.sitemap_candidates(seed, entries, 3)
            assert sorted((r.seed_pos, r.url) for r in got.collect()) == sorted((i, f"https://t/entry/대학교{i}-2026") for i in range(1000))
            assert not any(x in plan(got) for x in ("NestedLoop", "Cartesian")) and ("SortMergeJoin" in plan(got)) == (limit == "-1")
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
