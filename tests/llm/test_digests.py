"""The registered queries' columns against libraries and brute force, on the smallest tables."""

import hashlib
import os
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

from millrace.llm import common, line_dedup, ngram_join, queries, toxicity, url_filter, warc  # noqa: E402
from millrace.llm.common import connected_components  # noqa: E402
from tests.llm.test_operators import documents, scan_brute, toxic_rows  # noqa: E402

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def rows_of(table, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{SF}/{table}.parquet'").fetchall()


@needs_tables
def test_op3_columns(spark):
    got = queries.op3_cross_polytope(spark, SF).collect()
    every = {i: np.array(v, float) for i, v in rows_of("embeddings", "vec_id, embedding")}
    by_query = {}
    for r in got:
        assert r.score == pytest.approx(float(np.sqrt(((every[r.query_id] - every[r.vec_id]) ** 2).sum())), rel=1e-12) and r.vec_id != r.query_id
        by_query.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    assert set(by_query) == {i for i in every if i % 100 == 0}
    found = 0
    for q, rows in by_query.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 11)) and [r[1:] for r in rows] == sorted(r[1:] for r in rows)
        truth = sorted((float(np.sqrt(((every[q] - v) ** 2).sum())), i) for i, v in every.items() if i != q)[:10]
        found += len({i for _, i in truth} & {r[2] for r in rows})
    assert found >= 0.9 * 10 * len(by_query)


@needs_tables
def test_op5_columns(spark):
    got = {r.doc_id: r for r in queries.op5_toxicity(spark, SF).collect()}
    docs = rows_of("documents", "doc_id, text")
    assert set(got) == {i for i, _ in docs}
    for i, _ in docs:
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1


@needs_tables
def test_op6_columns(spark):
    from tokenizers import Tokenizer

    library, start = Tokenizer.from_file(P.path("byte_bpe_50k.json")), 0
    got = sorted(queries.op6_token_files(spark, SF).collect(), key=lambda r: r.doc_id)
    for (i, text), r in zip(sorted(rows_of("documents", "doc_id, text")), got, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@needs_tables
def test_op7_columns(spark):
    got = {r.doc_id: r for r in queries.op7_license_scan(spark, SF).collect()}
    for i, text in rows_of("documents", "doc_id, text"):
        n, base, _, labels, score = scan_brute(text)
        starts = [a for a, _ in base]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(base), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in base})) and r.labels == ",".join(labels) and abs(r.score - score) < 1e-12


@needs_tables
def test_op10_columns(spark):
    import tiktoken

    from millrace.llm import bpe

    path = P.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.codec(path, P.PATTERN).ranks, special_tokens={})
    got = {r.doc_id: r for r in queries.op10_byte_bpe(spark, SF).collect()}
    for i, text in rows_of("documents", "doc_id, text"):
        ids, r = library.encode_ordinary(text or ""), got[i]
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest())


# --- the classifier ------------------------------------------------------------------------------------------------------


def small_model():
    s = toxicity.Settings(buckets=64, dim=5, filters=3, widths=(1, 2, 3), batch=4)
    m, r = toxicity.Model.new(s), np.random.default_rng(3)
    m.words[:-1], m.prefixes[:-1] = r.normal(size=(64, 5)), r.normal(size=(64, 5))
    m.biases = [r.normal(size=3).astype(np.float32) for _ in s.widths]
    return m


def forward(m, words, prefixes):
    """Logit of one text by loops, in double precision: a window may reach into padding behind the text, but begins at a word or right after the last one."""
    x = [m.words[a].astype(float) + m.prefixes[b] for a, b in zip(words, prefixes)] + [np.zeros(m.settings.dim)] * 3
    out, k = m.offset, 0
    for kernel, bias in zip(m.kernels, m.biases):
        for f in range(m.settings.filters):
            best = max(sum(float(x[p + j] @ kernel[j, :, f]) for j in range(len(kernel)) if p + j < len(x)) + float(bias[f]) for p in range(len(words) + 1))
            out += max(best, 0) * float(m.out[k])
            k += 1
    return out


def test_scores_are_the_convolution():
    m, r = small_model(), np.random.default_rng(4)
    texts = [(r.integers(0, 64, n).astype(np.int32), r.integers(0, 64, n).astype(np.int32)) for n in (0, 1, 2, 3, 17, 40)]
    first = np.concatenate([[0], np.cumsum([len(a) for a, _ in texts])])
    got = m.scores(np.concatenate([a for a, _ in texts]), np.concatenate([b for _, b in texts]), first)
    assert np.allclose(got, [1 / (1 + np.exp(-forward(m, a, b))) for a, b in texts], atol=1e-5)


def test_step_follows_the_gradient():
    """Changes of the kernels, biases and output weights against differences of the brute-force loss."""
    m, r = small_model(), np.random.default_rng(5)
    texts = [(r.integers(0, 64, n).astype(np.int32), r.integers(0, 64, n).astype(np.int32)) for n in (6, 9, 4, 12)]
    y = np.array([1, 0, 1, 0], np.float32)
    first = np.concatenate([[0], np.cumsum([len(a) for a, _ in texts])])

    def loss():
        z = np.array([forward(m, a, b) for a, b in texts])
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    wanted, places, eps = [], [], 1e-3
    for array in (m.out, *m.biases, *m.kernels):
        for at in list(np.ndindex(array.shape))[::4]:
            old = array[at]
            array[at] = old + eps
            up = loss()
            array[at] = old - eps
            wanted.append((up - loss()) / (2 * eps))
            array[at] = old
            places.append((array, at))
    names = ["out", *(f"bias{k}" for k in range(3)), *(f"kernel{k}" for k in range(3))]
    memory = {n: np.ones_like(a) for n, a in zip(names, (m.out, *m.biases, *m.kernels))}  # so that a change is rate * g / sqrt(1 + g * g)
    before = [a[at] for a, at in places]
    model = {id(a): (n, a.copy()) for n, a in zip(names, (m.out, *m.biases, *m.kernels))}
    m.step(np.concatenate([a for a, _ in texts]), np.concatenate([b for _, b in texts]), first, y, memory)
    after = {"out": m.out, **{f"bias{k}": m.biases[k] for k in range(3)}, **{f"kernel{k}": m.kernels[k] for k in range(3)}}
    change = np.array([b - after[model[id(a)][0]][at] for b, (a, at) in zip(before, places)]) / m.settings.rate
    g = change / np.sqrt(1 - change**2)
    assert np.allclose(g, wanted, atol=3e-3) and np.abs(g).max() > 0.01


def test_sample_is_bounded_by_bytes(spark, monkeypatch):
    rows, labels = toxic_rows(200)
    d, l = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")  # noqa: E741
    seen = []
    fit = toxicity.Model.fit
    monkeypatch.setattr(toxicity.Model, "fit", lambda self, texts, y: (seen.append(len(texts)), fit(self, texts, y)))
    toxicity.train(d, l, "true", toxicity.Settings(steps=10, epochs=1))
    toxicity.train(d, l, "true", toxicity.Settings(steps=10, epochs=1, sample_bytes=10_000))
    mean = np.mean([len(t) for _, t in rows])
    assert seen[0] == 160 and 0 < seen[1] <= 2 * 10_000 / mean * 1.3


def test_fitting():
    assert toxicity.fitting([(1, 50), (2, 5), (3, 6), (4, 5)], 10) == [2, 4]
    assert toxicity.fitting([(1, 50), (2, 30)], 10) == [2] and toxicity.fitting([], 10) == []


def test_long_labelled_texts_do_not_stop_learning(spark):
    """Texts beyond sample_bytes, alone or added up over one id, are passed over; labels without a document take no places."""
    rows, labels = toxic_rows(400)
    s = toxicity.Settings(sample_bytes=100_000, steps=300)
    first = {c: min((spark.range(1).select(F.xxhash64(F.lit(i).cast("long"))).first()[0], i) for i, _, t in labels if t == c)[1] for c in (0, 1)}
    text = dict(rows)
    for c, i in first.items():  # the least hash of each class
        text[i] = (text[i] + " ") * (200_000 // len(text[i]) + 1)
    long = [*text.items()] + [(rows[7][0], rows[7][1] * 20)] * 100
    d, l = documents(spark, long), spark.createDataFrame([*labels, *((10**9 + i, 0, 1) for i in range(8000))], "doc_id long, quality int, toxic int")  # noqa: E741
    model = toxicity.train(d, l, "true", s)
    got = {r.doc_id: r.score for r in toxicity.score(documents(spark, rows), model).collect()}
    right = np.mean([(got[i] >= 0.5) == (t == 1) for i, _, t in labels])
    assert right > 0.95


# --- names that clash, and graphs ------------------------------------------------------------------------------------------


def test_clashing_names(spark):
    names = ("__id", "__hash", "__gone", "id", "hash", "gone", "__lines", "__Removed", "salt", "first", "sites")
    rows = [(k, f"subscribe to our newsletter today\nown text number {k} of this site", f"s{k}") for k in range(10)]
    plain = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    d = plain
    for n in names:
        d = d.withColumn(n, F.lit("own"))
    got = line_dedup.remove_boilerplate(d, lines_col="n", removed_col="taken")
    assert got.columns == [*d.columns, "n", "taken"]
    have = {r.doc_id: (r.text, r.n, r.taken) for r in got.collect()}
    assert have == {i: (t, 2, 0) if i == 0 else (t.split("\n")[1], 2, 1) for i, t, _ in rows}
    assert all(r[n] == "own" for r in got.collect() for n in names)
    assert line_dedup.remove_boilerplate(d).columns == [c for c in d.columns if c not in ("__lines", "__Removed")] + ["__lines", "__removed"]
    kept = ngram_join.keep_one(d.union(d))
    assert kept.columns == d.columns and kept.count() == 10


def test_common_lines_are_dealt_over_tasks(spark):
    rows = [(k, f"the one line that is on every site\n{k} own", f"s{k % 9}") for k in range(200)]
    found = line_dedup.boilerplate(documents(spark, rows))
    assert found.where("is_first").count() == 1 and found.count() == 200


def graph(rng, n):
    edges = [(i, i + 1) for i in range(0, n // 4)] + [(n, k) for k in range(n, n + n // 4)]
    return edges + [(rng.randrange(2 * n, 3 * n), rng.randrange(2 * n, 3 * n)) for _ in range(n // 2)]


def components_of(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("local_edges", [None, 0, 500])
def test_components_of_larger_graphs(spark, local_edges):
    edges = [(a, b) for a, b in graph(random.Random(6), 4000) if a != b]
    random.Random(7).shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long"), local_edges=local_edges).collect()}
    assert got == components_of(edges)


@pytest.mark.parametrize("local_edges", [200_000, 0])
def test_url_filter_over_a_link_graph(spark, monkeypatch, local_edges):
    """Canonical links and refresh redirects among pages, rules on some of them; against union-find in Python, by both ways through the graph."""
    monkeypatch.setattr(common, "LOCAL_EDGES", local_edges)
    rng, n = random.Random(16), 400
    kinds = ["http://a{}.org/x", "http://b{}.com/en/x", "http://example.com/en/7{}", "http://c{}.net/de/y", "http://d{}.info/"]
    urls = [kinds[i % 5 if rng.random() < 0.3 else 4].format(i) for i in range(n)]
    pages, edges = [], []
    for i, u in enumerate(urls):
        html = "<html>"
        if rng.random() < 0.6:
            j = rng.randrange(n)
            html += f'<link rel="canonical" href="{urls[j]}">' if i % 2 else f'<meta http-equiv="refresh" content="0; url={urls[j]}">'
            edges.append((u, urls[j]))
        pages.append((i, u, html))
    got = {r.page_id: (r["rule"], r.verdict) for r in url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), queries.RULES).collect()}
    root = components_of(edges)
    rule_of = {}
    for u in urls:
        fits = [(len(r.host + r.path), r) for r in queries.RULES for host, path in [u.split("://")[1].split("/", 1)] if (host == r.host or host.endswith(f".{r.host}")) and f"/{path}".startswith(r.path)]
        rule_of[u] = max(fits, key=lambda x: x[0])[1] if fits else None
    said = {}
    for u in urls:
        if rule_of[u] and u in root:
            said.setdefault(root[u], set()).add(rule_of[u].verdict)
    want = {i: (rule_of[u].host + rule_of[u].path, rule_of[u].verdict) if rule_of[u] else (None, "block" if said.get(root.get(u)) == {"block"} else "allow") for i, u in enumerate(urls)}
    assert got == want
    assert sum(v == "block" and r is None for r, v in want.values()) > 10 and sum(len(s) == 2 for s in said.values()) >= 1


def test_url_filter_rules_are_those_of_the_contract(spark):
    rules = ["block com/en/", "allow example.com/en/7", "allow net/de/", "block example.net/de/8", "block org/es/"]
    assert [f"{r.verdict} {r.host}{r.path}" for r in queries.RULES] == rules
    urls = ["http://a.net/de/1", "http://example.net/de/7", "http://m.example.net/de/80", "http://a.net/fr/", "http://a.org/es/1", "http://b.example.com/en/71", "http://b.com/en/7"]
    got = url_filter.judge(spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], "page_id long, url string, html string"), queries.RULES)
    assert [(r["rule"], r.verdict) for r in got.orderBy("page_id").collect()] == [
        ("net/de/", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), (None, "allow"), ("org/es/", "block"), ("example.com/en/7", "allow"), ("com/en/", "block"),
    ]


def test_linked_pages_are_judged_as_in_their_sql(spark, tmp_path):
    """Four pages name one address: a verdict on net/de/ passes to the others, unless a page among them is allowed."""
    urls = ["http://a.net/de/1", "http://a.info/", "http://b.info/", "http://a.net/fr/", "http://b.net/de/1", "http://example.com/en/7", "http://c.info/", "http://d.info/"]
    spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.linked_pages_filter(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES['linked_pages_filter']}) ORDER BY page_id").fetchall()
    assert [tuple(r) for r in got.orderBy("page_id").collect()] == want
    assert [r[-1] for r in want] == ["block"] * 5 + ["allow"] * 3


def test_index_tells_null_ids_from_page_0(spark):
    rows = [(0, "u", "x"), (None, "u", "y"), (-3, "u", "z"), *((k, "u", "common " * 200) for k in range(10, 40))]
    folder = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1))
    found = []
    for name in os.listdir(folder.removeprefix("file://")):
        if name.startswith("part-"):
            data = open(f"{folder.removeprefix('file://')}/{name}", "rb").read()
            for i, number, at in warc.entries(data):
                head, _, _ = warc.parsed(warc.frame(data, number), at)
                assert head["WARC-Record-ID"] == f"<urn:page:{'' if i is None else i}>"
                found.append(i)
    assert sorted(found, key=str) == sorted((r[0] for r in rows), key=str)
    got = {r.page_id: r.refers_to for r in warc.read_warc(spark, folder).collect()}
    assert got == {i: 39 if i is not None and 10 <= i < 39 else None for i, _, _ in rows}
