"""Edge cases of the training-data operators, against brute force on small tables."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

from millrace.llm import ann, bpe, common, decontaminate, licenses, line_dedup, ngram_join, pieces, queries, token_files, toxicity, url_filter, warc  # noqa: E402
from millrace.llm.common import connected_components, written  # noqa: E402

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "long ago the farm stood there and " * 4000


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def documents(spark, rows):
    """Rows (doc_id, text[, source]) as documents with columns whose names clash with operators' own."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    d = spark.createDataFrame(full, DOCS)
    for name in ("fp", "id", "keys", "hash", "text_hash", "pos", "gone", "score", "component", "n", "w", "part"):
        d = d.withColumn(name, F.lit(1))
    return d


ODD = [(1, None), (2, ""), (3, "word"), (3, "word"), (None, "no id here at all"), (4, LONG), (5, "\n \t \u3000"), (6, "日本語 ünïcode 😀 it's"), (7, "word")]


# --- components -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("local", [200_000, 20, 0])
def test_components(spark, monkeypatch, local):
    monkeypatch.setattr(common, "LOCAL_EDGES", local)
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7), (None, 1)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {n: find(n) for n in list(parent)}
    words_ = spark.createDataFrame([(str(a), str(b)) for a, b in edges if a is not None], "src string, dst string")
    assert connected_components(words_).select("component").distinct().count() == len(set(got.values()))
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


# --- 1: n-gram Jaccard join --------------------------------------------------------------------------------------------


def near_brute(rows, n=5, threshold=0.8):
    def shingles(t):
        w = words(t)
        return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])

    sets = [shingles(t) for _, t in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) / len(a | sets[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    return links, [find(i) for i in range(len(rows))]


def near_rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(6):
        text = [rng.choice(vocabulary) for _ in range(rng.choice((30, 80, 200)))]
        for _ in range(12):
            t = list(text)
            for _ in range(rng.randrange(4)):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(t)))
    return rows + [(1000 + k, " ".join(rng.choice(vocabulary) for _ in range(50))) for k in range(20)]


def test_near_duplicates_match_brute_force(spark):
    rows = near_rows() + [(2000, "one two"), (2001, "One, TWO!"), (2002, "a b c d e f"), (2003, None), (2004, ""), (2005, "...")]
    links, roots = near_brute(rows)
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min(least.get(r, i), i)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_duplicates(documents(spark, rows)).collect()}
    assert got == {i: (least[r], n) for (i, _), r, n in zip(rows, roots, links)}


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """Groups cut into many blocks link as whole ones."""
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 3)
    rows = near_rows()
    links, _ = near_brute(rows)
    got = {r.doc_id: r.n_links for r in ngram_join.near_duplicates(documents(spark, rows)).collect()}
    assert got == {i: n for (i, _), n in zip(rows, links)}


def test_near_duplicates_odd_rows(spark):
    got = ngram_join.near_duplicates(documents(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = Counter((r.doc_id, r.class_id, r.n_links) for r in got)
    assert by[3, 3, 2] == 2 and by[7, 3, 2] == 1 and by[1, 1, 0] == 1 and by[None, None, 0] == 1
    assert ngram_join.near_duplicates(documents(spark, [])).count() == 0


def test_keep_one(spark):
    same = "this very text is here more than once"
    rows = [(1, same), (1, same), (2, same), (None, same), (3, "quite another text of six words"), (3, "a second text under one id"), (4, None), (5, "")]
    d = documents(spark, rows)
    got = ngram_join.keep_one(d)
    assert got.columns == d.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(1, same), (3, rows[4][1]), (3, rows[5][1]), (4, None), (5, "")])
    assert ngram_join.keep_one(documents(spark, [])).count() == 0


def test_common_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(9)] + [np.zeros(0, np.uint64)]
    want = [[len(np.intersect1d(a, b)) if i != j else None for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    got = ngram_join.common_counts(sets)
    assert all(got[i][j] == want[i][j] for i in range(10) for j in range(10) if i != j)


@pytest.mark.parametrize("parts", ["1", "7"])
def test_candidates_link_all_that_share_a_prefix(spark, parts):
    """Chains of neighbours, across partitions too, close to the components of shared keys."""
    rng = random.Random(4)
    rows = [(i, [rng.randrange(30) if rng.random() < 0.5 else rng.randrange(10**6) for _ in range(3)], [rng.randrange(4) for _ in range(3)]) for i in range(200)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        edges = ngram_join.candidates(spark.createDataFrame(rows, "id long, keys array<long>, rests array<long>"))
        got = {r.node: r.component for r in connected_components(edges).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    parent = list(range(200))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    owners = {}
    for i, keys, _ in rows:
        for k in keys:
            owners.setdefault(k, []).append(i)
    for own in owners.values():
        for i in own[1:]:
            a, b = sorted((find(i), find(own[0])))
            parent[b] = a
    linked = {i for own in owners.values() if len(set(own)) > 1 for i in own}
    assert got == {i: find(i) for i in linked}


def test_prefix_depth_reaches_recall():
    d = ngram_join.prefix_depth(0.8)
    assert 1 - (1 - 0.8**d) ** ngram_join.TREES >= ngram_join.RECALL > 1 - (1 - 0.8 ** (d + 1)) ** ngram_join.TREES


# --- 2: line dedup -------------------------------------------------------------------------------------------------------


def test_line_dedup(spark):
    boiler, near, short = "subscribe to our newsletter today", "only seven sites have this line of text", "menu"
    rows = [(k, f"{boiler}\nown text number {k} of this site\n{short}\n  {boiler}\t", f"s{k}") for k in range(10)]
    rows += [(100 + k, f"{near}\nand more text {k} that is its own", f"s{k}") for k in range(7)]
    rows += [(200, None, "s1"), (201, "", "s2"), (202, boiler, None), (202, boiler, None), (None, f"{boiler}\nx", "s3"), (203, "\n\n", "s4")]
    got = line_dedup.remove_boilerplate(documents(spark, rows))
    out = {(r.doc_id, r.text) for r in got.collect()}
    assert got.count() == len(rows)
    assert (0, f"{boiler}\nown text number 0 of this site\n{short}") in out  # the first occurrence stays
    assert all((k, f"own text number {k} of this site\n{short}") in out for k in range(1, 10))
    assert all((100 + k, f"{near}\nand more text {k} that is its own") in out for k in range(7))
    assert {(200, None), (201, ""), (202, ""), (None, "x"), (203, "\n\n")} <= out
    assert line_dedup.remove_boilerplate(documents(spark, [])).count() == 0


def test_line_dedup_native(spark):
    plan = line_dedup.remove_boilerplate(documents(spark, ODD))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_line_dedup_many_sites(spark):
    """Sketch decisions equal exact counts on both sides of the threshold."""
    rows = [(n * 1000 + k, f"line number {n} that stands on some sites", f"s{k}") for n in range(1, 60) for k in range(n % 20 + 1)]
    got = line_dedup.boilerplate(documents(spark, rows)).groupBy("hash").count().collect()
    assert sorted(r["count"] for r in got) == sorted(n % 20 + 1 for n in range(1, 60) if n % 20 + 1 >= line_dedup.MIN_SITES)


# --- 3: nearest neighbours ------------------------------------------------------------------------------------------------


def test_search_small_table_is_exact(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 8))
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(100 + k, rows[0][1]) for k in range(20)] + [(200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [1.0, None] + [0.0] * 6), (204, [float("inf")] + [1.0] * 7), (None, rows[1][1]), (5, rows[5][1])]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("rank", F.lit(1))
    got = ann.search(t.where("vec_id in (0, 3, 5, 105, 201)"), t, "vec_id", "embedding", k=10)
    valid = {}
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v):
            valid.setdefault(i, np.array(v, np.float32).astype(float))
    for q in (0, 3, 5, 105):
        want = sorted((float(np.sqrt(((v - valid[q]) ** 2).sum())), i) for i, v in valid.items() if i != q)[:10]
        have = [(r.score, r.vec_id) for r in sorted(got.where(F.col("query_id") == q).collect(), key=lambda r: r["rank"])]
        assert [i for _, i in have] == [i for _, i in want] if q in (0, 105) else len(set(i for _, i in have) & set(i for _, i in want)) >= 8
        assert [r["rank"] for r in sorted(got.where(F.col("query_id") == q).collect(), key=lambda r: r["rank"])] == list(range(1, 11))
    assert got.where("query_id = 201").count() == 0
    few = spark.createDataFrame(rows[:4], "vec_id long, embedding array<float>")
    assert ann.search(few.where("vec_id = 1"), few, "vec_id", "embedding").count() == 3
    assert ann.search(few.where("false"), few.where("false"), "vec_id", "embedding").count() == 0


def nearest_brute(rows, q, k=10):
    """[(distance, id)] of the k nearest ids but q, each with the nearest of its vectors to any of q's."""
    best = {}
    for _, v in (r for r in rows if r[0] == q):
        for i, x in rows:
            if i != q:
                d = float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum()))
                best[i] = min(best.get(i, d), d)
    return sorted((d, i) for i, d in best.items())[:k]


def test_search_repeated_ids(spark):
    """Rows of one id, equal or not, take one place of a shard's k; ids under the query's own vector aren't crowded out by its repeats."""
    x = np.random.default_rng(7).normal(size=(12, 8)).round(3)
    equal = [(i, x[i].tolist()) for i in range(12) for _ in range(11)] + [(50 + i, x[3].tolist()) for i in range(6)]
    unlike = [(i, (x[i] + j / 1024).tolist()) for i in range(12) for j in range(11)]
    hot = unlike + [(99, (x[5] + j / 4096).tolist()) for j in range(300)]
    for rows in (equal, unlike, hot):
        t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        for parts in (1, 3):
            got = ann.search(t.where("vec_id in (0, 3, 5)"), t.repartition(parts), "vec_id", "embedding", k=10).collect()
            for q in (0, 3, 5):
                have = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
                want = nearest_brute(rows, q)
                assert [r for r, _, _ in have] == list(range(1, 11))
                assert [i for _, i, _ in have] == [i for _, i in want] and np.allclose([d for _, _, d in have], [d for d, _ in want])


def test_nearest_ranks_the_shard_for_few_distinct_ids():
    """Many collected vectors of a few ids aren't enough."""
    rng = np.random.default_rng(3)
    axis = np.zeros(64)
    axis[0] = 1
    x = np.concatenate([axis + rng.normal(size=(400, 64)) / 1000, rng.normal(size=(8, 64))])
    ids = np.concatenate([np.arange(400) % 3, np.arange(100, 108)])  # with 1 and 2, ten ids but the query's own
    got = list(ann.nearest(ann.Shard(ids, x, 10), np.array([0]), axis[None], 10))
    want = nearest_brute([(0, axis.tolist())] + [(i, v) for i, v in zip(ids.tolist(), x.tolist()) if i], 0)
    assert [i for _, i, _ in got] == [i for _, i in want]


def test_search_recall(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    shard, q = ann.Shard(np.arange(4000), x, 10), x[::100].astype(float)
    found = Counter()
    d = np.sqrt(((q[:, None] - x[None].astype(float)) ** 2).sum(-1))
    truth = [[int(j) for j in np.argsort(r, kind="stable") if j != 100 * i][:10] for i, r in enumerate(d)]
    for i, v, _ in ann.nearest(shard, np.arange(0, 4000, 100), q, 10):
        found[v in truth[i // 100]] += 1
    assert found[True] / (found[True] + found[False]) >= 0.9


def test_search_can_be_exact(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 700)
    x = np.random.default_rng(8).normal(size=(3000, 16)).astype(np.float32)
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    asked = t.where("vec_id % 100 = 0")
    got = ann.search(asked, t, "vec_id", "embedding", 10, ann.Settings(probes=1.0, ranked=1.0)).collect()
    d = np.sqrt(((x[::100, None].astype(float) - x[None].astype(float)) ** 2).sum(-1))
    truth = {100 * i: [int(j) for j in np.argsort(r, kind="stable") if j != 100 * i][:10] for i, r in enumerate(d)}
    have = {q: [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] for q in truth}
    assert have == truth
    few = ann.search(asked, t, "vec_id", "embedding", 10, ann.Settings(tables=2, probes=0.01, ranked=0.01, ranked_rows=20)).collect()
    assert len(few) == 300 and {(r.query_id, r.vec_id) for r in few} != {(r.query_id, r.vec_id) for r in got}


def test_search_in_many_blocks(spark, monkeypatch):
    x = np.random.default_rng(6).normal(size=(30, 8))
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    whole = sorted(map(tuple, ann.search(t.where("vec_id % 5 = 0"), t, "vec_id", "embedding", k=4).collect()))
    monkeypatch.setattr(ann, "BLOCK_BYTES", 130)  # two vectors
    assert sorted(map(tuple, ann.search(t.where("vec_id % 5 = 0"), t, "vec_id", "embedding", k=4).collect())) == whole and len(whole) == 24


def test_rotation_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 48))
    assert np.allclose(np.linalg.norm(ann.rotated(x, 1), axis=1), np.linalg.norm(x, axis=1), rtol=1e-5)


# --- 4: URL filter --------------------------------------------------------------------------------------------------------


def test_url_filter(spark):
    pages = [
        (1, "http://bad.com/en/x", '<link rel="canonical" href="http://Other.org/c">'), (2, "HTTP://other.org/c#f", ""), (3, "http://third.org/z", "<meta http-equiv='refresh' content='0; url=//other.org/c'>"),
        (4, None, None), (5, "nourl", "x"), (6, "http://a.org/x/y", "<LINK href=good rel=canonical>"), (7, "http://a.org/x/good", None),
        (8, "http://example.com/en/7?x", "<link rel=canonical href='/en/z'>"), (9, "http://free.net/", '<link rel="canonical" href="http://example.com/en/7?x">'), (9, "http://free.net/", None), (10, "x://", ""), (11, "http://notcom/en/", ""), (12, "http://u@sub.COM?q=/en/", ""),
    ]
    t = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("best", F.lit(1)).withColumn("node", F.lit(1)).withColumn("verdict", F.lit(1))
    rules = [url_filter.Rule("block", "com", "/en/"), url_filter.Rule("allow", "example.com", "/en/7"), url_filter.Rule("block", "org", "/x/y")]
    got = {r.page_id: (r.host, r.path, r["rule"], r.verdict) for r in url_filter.judge(t, rules).collect()}
    assert got[1] == ("bad.com", "/en/x", "com/en/", "block") and got[2][3] == "block" and got[3][3] == "block"
    assert got[4] == ("", "", None, "allow") and got[5] == ("", "", None, "allow") and got[10] == ("", "", None, "allow")
    assert got[6][3] == "block" and got[7][3] == "block"
    assert got[8] == ("example.com", "/en/7", "example.com/en/7", "allow")
    assert got[9][3] == "allow"  # an allowed member outweighs
    assert got[11] == ("notcom", "/en/", None, "allow") and got[12] == ("u@sub.com", "", None, "allow")
    chain = spark.createDataFrame([(f"http://c.net/{k}", f"http://c.net/{k + 1}") for k in range(30)] + [("http://c.net/30", "http://bad.com/en/")], "src string, dst string")
    far = spark.createDataFrame([(1, "http://c.net/0", None)], "page_id long, url string, html string")
    assert url_filter.judge(far, rules, chain).first().verdict == "block"
    assert url_filter.judge(t.where("false"), rules).count() == 0
    assert url_filter.judge(t, []).where("verdict = 'block'").count() == 0


# --- 5: toxicity -----------------------------------------------------------------------------------------------------------


def toxic_rows(n=600):
    rng = random.Random(8)
    vocabulary = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        t, y = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 120))], int(rng.random() < 0.3)
        if y:
            t[rng.randrange(len(t))] = rng.choice(("idiotic", "stupidly", "moronic"))
        rows.append((i, " ".join(t)))
        labels.append((i, 1, y))
    return rows, labels


def test_toxicity_learns(spark):
    rows, labels = toxic_rows()
    d = documents(spark, rows + [(9000, None), (9001, ""), (9002, LONG), (None, "an idiotic word")])
    l = spark.createDataFrame(labels + [(1, 1, None), (None, 1, 1), (5, 1, labels[5][2])], "doc_id long, quality int, toxic int")  # noqa: E741
    model = toxicity.train(d, l, queries.LEARN, toxicity.Settings(sample=400))
    got = {r.doc_id: r for r in toxicity.score(d, model).collect()}
    assert len(got) == len(rows) + 4 and all(0 <= r.score <= 1 for r in got.values())
    held = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i].score >= 0.5) == bool(labels[i][2]) for i in held) / len(held) > 0.9
    for i, t in rows[:40] + [(9002, LONG)]:  # a text's score doesn't depend on its neighbours
        alone = model.scores(*toxicity.features(pa.array([t]), model.settings))[0]
        assert abs(alone - got[i].score) < 1e-5
    left = toxicity.remove_toxic(d, model)
    assert left.columns == d.columns and {r.doc_id for r in left.select("doc_id").collect()} == {i for i, r in got.items() if not r.toxic}
    assert toxicity.score(documents(spark, []), model).count() == 0


def test_toxicity_same_score_for_other_columns(spark):
    rows, labels = toxic_rows(100)
    model = toxicity.train(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "true", toxicity.Settings(sample=50, steps=100))
    a = {r.doc_id: r.score for r in toxicity.score(documents(spark, rows), model).collect()}
    b = {r.doc_id - 5: r.score for r in toxicity.score(documents(spark, [(i + 5, t) for i, t in rows]).withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("z")), model).collect()}
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-6 for i in a)


def test_toxicity_without_labels(spark):
    d = documents(spark, ODD)
    model = toxicity.train(d, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert toxicity.score(d, model).count() == len(ODD)


# --- 6: token files -----------------------------------------------------------------------------------------------------------


def test_token_files(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "FILE_BYTES", 2000)
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(("alpha", "Beta's", "γάμμα", "12", "--", "\n\n", "it'll")) for _ in range(rng.randrange(80)))) for i in rng.sample(range(1000), 120)] + [(2000, None), (2001, ""), (2002, LONG), (2003, "a<|endoftext|>b"), (5000, " x"), (5000, " x")]
    folder = token_files.write_token_files(documents(spark, rows), path, P.PATTERN, parts=3)
    index = token_files.write_index(spark, folder, lambda ids: (int(ids[-1]),), "last long")
    got = token_files.with_starts(spark.read.parquet(index), index).orderBy("start").collect()
    start = 0
    for (i, t), r in zip(sorted(rows, key=lambda r: r[0]), got, strict=True):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        assert (r.doc_id, r.start, r.n_tokens, r["last"]) == (i, start, len(ids), 0)
        start += len(ids)
    frames = {(r.file, r.at): (r.doc_id, r.ids) for r in token_files.read_token_files(spark, folder).collect()}
    assert {(r.file, r.at) for r in got} == set(frames)
    by_id = dict(rows)
    assert all(ids[:-1] == library.encode(by_id[i] or "", add_special_tokens=False).ids for i, ids in frames.values())
    one = got[7]  # a shuffled read: one frame by its offset
    data = open(f"{folder.removeprefix('file://')}/{one.file}", "rb").read()
    assert token_files.frame_at(data, one.at)[0] == one.doc_id
    damaged = bytearray(data)
    damaged[one.at + 40] ^= 1
    with pytest.raises(ValueError):
        token_files.frame_at(bytes(damaged), one.at)
    empty = token_files.write_token_files(documents(spark, []), path, P.PATTERN)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_null_ids_in_token_files(spark):
    folder = token_files.write_token_files(documents(spark, [(None, "x"), (-5, "y"), (3, "z")]), P.path("byte_bpe_50k.json"), P.PATTERN, parts=2)
    index = token_files.write_index(spark, folder)
    assert [r.doc_id for r in token_files.with_starts(spark.read.parquet(index), index).orderBy("start").collect()] == [None, -5, 3]


def test_split_common_is_the_pattern():
    import regex

    find, rng = regex.compile(P.PATTERN).findall, random.Random(2)
    parts = ["'", "s", "t", "re", "ve", "ll", "'s", "'re", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "a", "É", "日", "1", "²", "Ⅷ", "-", "!", "😀", "_", "'S", "\u200b", "\u0301"]
    for _ in range(4000):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(4))]
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        start = pieces.split_common(points, np.cumsum([0] + [len(t) for t in texts]))
        assert [whole[a:b] for a, b in zip(start, [*start[1:], len(whole)])] == [p for t in texts for p in find(t)]


# --- 7: license scan -----------------------------------------------------------------------------------------------------------


def test_license_scan(spark):
    rows = [
        (1, "This is under the MIT-License; see the GNU General Public License version 3 or later. MIT license"), (2, "mıt license permıt license"), (3, None), (4, ""), (5, "Apache\nLicense, Version 2.0!"),
        (6, "mit license mit license general public license"), (7, "x " * 50000 + "Apache license"), (8, "Mİt license and \u212aeep"), (9, "Creative Commons Attribution-NonCommercial 4.0 International"), (9, "SPDX-License-Identifier: MIT"),
    ]
    got = {r.doc_id: r for r in licenses.scan(documents(spark, rows[:9])).collect()}
    phrases = {tuple(p.split()): label for p, label in licenses.BASE.items()}
    for i, t in rows[:8]:
        w = words(t)
        want = sorted((k, label) for p, label in phrases.items() for k in range(len(w) - len(p) + 1) if tuple(w[k : k + len(p)]) == p)
        assert (got[i].n_words, [(b.start, b.label) for b in got[i].base]) == (len(w), want), i
        assert {label for _, label in want} <= set(got[i].labels) and 0 <= got[i].score <= 1
    assert "gpl-3.0-or-later" in got[1].labels and "gpl-3.0" not in got[1].labels  # contained in the longer detection
    assert "apache-2.0" in got[5].labels and got[9].labels == ["cc-by-nc-4.0"]
    assert licenses.scan(documents(spark, rows[9:])).first().labels == ["mit"]
    assert len(licenses.rules()) >= 200
    assert licenses.scan(documents(spark, [])).count() == 0
    assert not re.search("Python|Pandas|Arrow", licenses.scan(documents(spark, ODD))._jdf.queryExecution().toString())


def test_license_spellings(spark):
    """Versions glued to their v, short GNU names, and versions that don't exist."""
    want = {
        "GPLv3": ["gpl-3.0"], "GPLv2": ["gpl-2.0"], "GNU GPL v3": ["gpl-3.0"], "GNU GPLv2 or later": ["gpl-2.0-or-later"], "LGPLv2.1": ["lgpl-2.1"], "GNU LGPL v3 only": ["lgpl-3.0-only"], "the AGPL-3.0": ["agpl-3.0"],
        "GNU GPL": ["gpl"], "GNU LGPL license": ["lgpl"], "gnu agpl": ["agpl"], "GNU General Public License v2.0": ["gpl-2.0"], "GNU Lesser General Public License v2.1": ["lgpl-2.1"], "GPL license, version 3": ["gpl-3.0"],
        "Apache License v2.0": ["apache-2.0"], "Apache License, v 2": ["apache-2.0"], "Mozilla Public License v1.1": ["mpl-1.1"], "LaTeX Project Public License 1.3c": ["lppl-1.3c"],
        "General Public License version 2.1": ["gpl"], "Apache License 1.2": ["apache"], "xGPLv3": [], "GPLv3x": [],
    }
    got = licenses.scan(documents(spark, [(i, t) for i, t in enumerate(want)])).collect()
    assert {t: [d.label for d in r.detections] for t, r in zip(want, sorted(got, key=lambda r: r.doc_id))} == want  # labels also has the base phrases'
    labels = {r.label for r in licenses.rules()}
    assert {"gpl-3.0", "lgpl-2.1", "agpl-3.0", "fdl-1.3", "osl-2.1"} <= labels and not {"gpl-1.2", "gpl-2.1", "agpl-1.3", "lgpl-1.1", "fdl-3.0", "apache-3.0", "ms-pl-2.1"} & labels


def scan_brute(text):
    """(n_words, base, detections, labels, score) by Python's re, rule by rule."""
    words_ = WORD.findall(text or "")
    low = f" {' '.join(words(text))} " if words_ else " "
    found = []
    for r in licenses.rules():
        if f" {r.keyword}" in low:
            for m in re.finditer(f" (?:{r.pattern})(?= )", low):
                start = low[: m.start()].count(" ")
                found.append((start, -(start + m[0].count(" ")), r.priority, r.label))
    kept, far = [], -1
    for start, end, priority, label in sorted(found):
        if -end > far:
            far = -end
            kept.append((start, -end, priority, label))
    w = words(text)
    base = sorted((k, k + len(p.split()), label) for p, label in licenses.BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
    covered = {i for a, b, *_ in kept for i in range(a, b)} | {i for a, b, _ in base for i in range(a, b)}
    labels = sorted({x[-1] for x in kept} | {x[-1] for x in base})
    return len(w), [(a, label) for a, _, label in base], kept, labels, len(covered) / len(w) if w else 0.0


def test_license_scan_against_brute_force(spark):
    rng = random.Random(6)
    parts = ["mit", "MIT License", "apache", "license", "Version 2.0", "general public license", "GNU", "v3", "or later", "only", "cc", "by", "sa", "4.0", "Creative Commons", "Attribution", "share alike", "bsd", "3", "clause", "lesser", "affero", "SPDX-License-Identifier:", "public domain", "all rights reserved", "word", "the", "mozilla public license", "2", "1", "0", "international"]
    rows = [(i, rng.choice((" ", ", ", "\n")).join(rng.choice(parts) for _ in range(rng.randrange(40)))) for i in range(400)]
    got = {r.doc_id: r for r in licenses.scan(documents(spark, rows)).collect()}
    for i, t in rows:
        r, want = got[i], scan_brute(t)
        assert (r.n_words, [(b.start, b.label) for b in r.base], [tuple(d) for d in r.detections], r.labels) == want[:4], t
        assert abs(r.score - want[4]) < 1e-12


# --- 8: WARC --------------------------------------------------------------------------------------------------------------------


def test_warc(spark, monkeypatch):
    import zstandard

    monkeypatch.setattr(warc, "FRAME_BYTES", 3000)
    big, other = "<p>é</p>" * 300, "y" * 1000
    rows = [(1, "http://a/\r\nX: 1", big), (2, "u", big), (3, None, big), (4, "u", other), (5, "u", "x" * 999), (6, "u", "x" * 999), (7, "u", None), (8, "u", ""), (9, "u", other), (10, "u", LONG), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("refers_to", F.lit(1)).withColumn("n", F.lit(1))
    folder = warc.write_warc(pages.coalesce(2))
    got = warc.read_warc(spark, folder).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    refers = {1: 3, 2: 3, 4: 9}
    for i, _, h in rows:
        b, r = (h or "").encode(), by[i]
        assert (r.payload_bytes, r.payload_digest, r.refers_to) == (len(b), hashlib.sha1(b).hexdigest(), refers.get(i)), i
        assert r.record_type == ("revisit" if i in refers else "response") and bytes(r.payload) == (b"" if i in refers else b)
    index = spark.read.parquet(warc.write_index(spark, folder)).where("page_id = 9").first()
    data = open(f"{folder.removeprefix('file://')}/{index.file}", "rb").read()
    head, _, payload = warc.parsed(warc.frame(data, index.frame), index.at)
    assert payload == other.encode() and head["WARC-Record-ID"] == "<urn:page:9>"
    assert data[-4:] == struct.pack("<I", warc.SEEKABLE_MAGIC)
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()  # any decoder reads a bundle
    assert b"WARC-Record-ID: <urn:page:9>" in plain
    assert warc.read_warc(spark, warc.write_warc(pages.where("false"))).count() == 0


# --- 9: decontamination -----------------------------------------------------------------------------------------------------------


def contamination(docs, items, window=10):
    grams = {}
    for i, t in items:
        w = words(t)
        k = min(window, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            grams.setdefault(tuple(w[j : j + k]), set()).add("" if i is None else str(i))
    sizes = {len(g) for g in grams}
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                if (s := grams.get(tuple(w[j : j + k]))) is not None:
                    found |= s
                    hit.update(range(j, j + k))
        yield i, len(w), len(hit), sorted(found)


def decontamination_rows():
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice((3, 10, 14, 40))))) for k in range(12)] + [(50, None), (51, ""), (None, "the null item of a benchmark"), (52, "solo")]
    docs = []
    for i in range(60):
        t = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        if i % 3 == 0:
            w = words(rng.choice(items[:12])[1])
            at = rng.randrange(max(1, len(w) - 10))
            t[5:5] = w[at : at + rng.choice((9, 10, 25))]
        docs.append((i, "; ".join(t).upper()))
    return docs + [(100, None), (101, ""), (102, LONG), (103, "the NULL item of a benchmark"), (104, "solo"), (104, "solo solo"), (None, "a solo b")], items


@pytest.mark.parametrize("block", [8 << 20, 40])
def test_find_contamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs, items = decontamination_rows()
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in decontaminate.find_contamination(documents(spark, docs), b).collect())
    assert got == sorted((str(i), *rest) for i, *rest in contamination(docs, items))
    left = decontaminate.remove_contaminated(documents(spark, docs), b)
    clean = Counter(str(i) for i, _, n, _ in contamination(docs, items) if not n)
    assert Counter(str(r.doc_id) for r in left.collect()) == clean and left.columns == documents(spark, []).columns
    none = b.where("false")
    assert decontaminate.find_contamination(documents(spark, docs), none).where("n_hit > 0").count() == 0
    assert decontaminate.find_contamination(documents(spark, []), b).count() == 0


def test_longest_matches(spark):
    docs, items = decontamination_rows()
    got = decontaminate.longest_matches(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    texts = {str(i): words(t) for i, t in items if i is not None}
    by_doc = {}
    for i, t in docs:
        by_doc.setdefault(i, words(t))
    for r in got:
        w, d = texts[r.item_id][r.item_pos :], by_doc[r.doc_id][r.doc_pos :]
        assert w[: r.length] == d[: r.length]
        best = max(next((k for k in range(len(w)) if k >= len(x) - j or w[k] != x[j + k]), len(w)) for x in by_doc.values() for j in range(len(x)))
        assert r.length == best
    assert len(got) > 5


def test_touching_hits_of_two_texts(spark):
    got = decontaminate.find_contamination(documents(spark, [(1, "x solo"), (2, "solo y")]).coalesce(1), spark.createDataFrame([(1, "solo")], "item_id long, text string")).orderBy("doc_id").collect()
    assert [r.spans for r in got] == [[[1, 2]], [[0, 1]]]


# --- 10: BPE ------------------------------------------------------------------------------------------------------------------------


def test_bpe_matches_the_library(spark):
    import tiktoken

    c = bpe.codec(RANKS, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    rng = random.Random(11)
    texts = ["".join(rng.choice(("the", "ation", "  ", "\n", "é", "日本", "😀", "'s", "aaaaaaaa", "-----", "ß", "1234", "x", "A")) for _ in range(rng.randrange(30))) for _ in range(500)]
    texts += ["".join(chr(rng.choice((rng.randrange(97, 123), rng.randrange(0xC0, 0x180), rng.randrange(0x400, 0x450)))) for _ in range(60)) for _ in range(300)] + ["ab" * 20000, "a" * 20000, ""]
    for text, ids in zip(texts, c.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == library.encode_ordinary(text) and c.decode(ids) == text.encode()
    got = bpe.encode_documents(documents(spark, ODD), RANKS, P.PATTERN)
    assert Counter((r.doc_id, tuple(r.token_ids)) for r in got.collect()) == Counter((i, tuple(library.encode_ordinary(t or ""))) for i, t in ODD)
    assert Counter((r.doc_id, bytes(r.decoded)) for r in bpe.decode_documents(got, RANKS, P.PATTERN).collect()) == Counter((i, (t or "").encode()) for i, t in ODD)
    assert bpe.encode_documents(documents(spark, []), RANKS, P.PATTERN).count() == 0


def test_written_sets_lineage_free(spark):
    df = written(spark.range(10).withColumn("x", F.rand()), "t")
    assert df.collect() == df.collect()
