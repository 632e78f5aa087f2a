"""The corpus pipeline against a brute-force version, stage by stage, and the registered queries on the smallest tables."""

import os
import random
import sys

import pytest

P = pytest.importorskip("public_tokenizers")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from millrace.llm import bpe, queries  # noqa: E402
from tests.llm.test_operators import contamination, near_brute  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with toxic ones, boilerplate, copies, near copies and leaks of a benchmark; also null and empty texts."""
    rng = random.Random(21)
    vocabulary = [f"term{i}" for i in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, prose(30)) for k in range(8)]
    docs, labels, marks = [], [], {}
    for i in range(700):
        text, kind = prose(rng.randrange(40, 120)), i % 10
        if kind == 1:
            words = text.split()
            words[rng.randrange(len(words))] = rng.choice(("scummy", "idiots"))
            text, marks[i] = " ".join(words), "toxic"
        elif kind == 2:
            text = f"subscribe to this very newsletter today\n{text}"
        elif kind == 3 and i > 20:
            text = docs[i - 10][1]
        elif kind == 4 and i > 20:
            words = docs[i - 20][1].split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif kind == 5:
            text = f"{text} {' '.join(rng.choice(items)[1].split()[3:20])} {prose(5)}"
        docs.append((i, text, rng.choice(("en", "de", None)), f"src{i % 23}", len(text)))
        if kind in (0, 1, 6, 7):
            labels.append((i, 1, int(kind == 1)))
    docs += [(1000, None, "en", "s", 0), (1001, "", None, None, 0), (1002, "word", "en", "s", 4)]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), marks, items


def lines_brute(rows):
    sites, first = {}, {}
    for r in rows:
        for k, line in enumerate((r.text or "").split("\n")):
            t = line.strip(" \t\r")
            if len(t) >= 20:
                sites.setdefault(t, set()).add(r.source)
                first[t] = min(first.get(t, (r.doc_id, k)), (r.doc_id, k))
    out = {}
    for r in rows:
        if r.text is None:
            out[r.doc_id] = None
            continue
        every = r.text.split("\n")
        kept = [x for k, x in enumerate(every) if len(sites.get(x.strip(" \t\r"), set()) - {None}) < 8 or first[x.strip(" \t\r")] == (r.doc_id, k)]
        if len(kept) == len(every) or "\n".join(kept).strip():
            out[r.doc_id] = "\n".join(kept)
    return out


def test_stages_against_brute_force(spark, tables):
    folder, marks, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before, outs = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        outs[name] = (before.collect(), stage(spark, before, folder).cache())
        before = outs[name][1]
        assert name == "byte_bpe" or before.schema.names == docs.schema.names

    rows, got = outs["toxicity"]
    left = {r.doc_id for r in got.collect()}
    caught = set(marks) - left
    assert len(caught) >= 0.95 * len(marks) and len({r.doc_id for r in rows} - left - set(marks)) <= 0.01 * len(rows)

    rows, got = outs["line_dedup"]
    assert {r.doc_id: r.text for r in got.collect()} == lines_brute(rows)
    assert all(r.n_chars == len(r.text or "") for r in got.collect())

    rows, got = outs["ngram_join"]
    _, roots = near_brute([(r.doc_id, r.text) for r in rows])
    least = {}
    for r, root in zip(rows, roots):
        least[root] = min(least.get(root, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in got.collect()) == sorted(least.values())

    rows, got = outs["decontamination"]
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, _, n, _ in contamination([(r.doc_id, r.text) for r in rows], items) if not n)

    import tiktoken

    rows, got = outs["byte_bpe"]
    c = bpe.codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    assert {r.doc_id: r.token_ids for r in got.collect()} == {r.doc_id: library.encode_ordinary(r.text or "") for r in rows}

    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/millrace"
    before = set(os.listdir(root))
    whole = corpus_pipeline.run(spark, folder)
    assert [x.rpartition("-")[0] for x in set(os.listdir(root)) - before] == ["stage-byte_bpe"]  # only the last result stays
    assert sorted((r.doc_id, r.token_ids) for r in whole.collect()) == sorted((r.doc_id, r.token_ids) for r in got.collect())


def test_pipeline_of_an_empty_table(spark, tables):
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_on_the_smallest_tables(spark, name):
    duckdb = pytest.importorskip("duckdb")
    got = queries.QUERIES[name](spark, SF)
    table = {"op3_cross_polytope": None, "op12_hard_negatives": None, "op4_url_filter": "pages", "linked_pages_filter": "pages", "op8_warc": "pages"}.get(name, "documents")
    have = [tuple(r) for r in got.select(*sorted(got.columns)).collect()]
    assert len(have) == spark.read.parquet(f"{SF}/{table}.parquet").count() if table else len(have) >= 50
    if name in queries.ORACLES:
        c = duckdb.connect()
        for f in os.listdir(SF):
            c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
        assert sorted(map(repr, have)) == sorted(map(repr, c.execute(f"SELECT {', '.join(sorted(got.columns))} FROM ({queries.ORACLES[name]})").fetchall()))
