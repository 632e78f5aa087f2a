"""Results that no hash decides, and the forest's adaptive prefixes."""

import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")

from millrace.llm import bpe, common, decontaminate, ngram_join, token_files  # noqa: E402
from tests.llm.test_operators import RANKS, contamination, decontamination_rows, documents, near_brute, words  # noqa: E402


# --- hashes never decide ------------------------------------------------------------------------------------------------


def thue_morse(n, a, b):
    """Words of this kind collide under every polynomial hash modulo a power of two."""
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


TWINS = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")


@pytest.fixture(params=[2**64 - 1, 7])
def hash_bits(request, monkeypatch):
    """Runs as they are, and with hashes of three bits, among which nearly all words collide."""
    whole = common.Spans.hashes
    monkeypatch.setattr(common.Spans, "hashes", lambda self, a, b: whole(self, a, b) & np.uint64(request.param))


def test_spans():
    data = np.frombuffer(b"abcdefgh-abcdefgh-abcdefgi-abc" + b"x" * 5000 + b"-" + b"x" * 5000 + b"-" + b"x" * 4999 + b"y", np.uint8)
    s = common.Spans(data)
    at = np.array([0, 9, 18, 27, 30, 5031, 10032])
    end = np.array([8, 17, 26, 30, 5030, 10031, 15032])
    h = s.hashes(at, end)
    assert h[0] == h[1] and h[4] == h[5] and len(set(h.tolist())) == 5
    for i in range(7):
        same = s.same(at, end, s, np.full(7, at[i]), np.full(7, end[i]))
        assert same.tolist() == [data[a:b].tobytes() == data[at[i] : end[i]].tobytes() for a, b in zip(at, end)]


def test_words_are_numbered_by_their_bytes(hash_bits):
    texts = [" ".join(TWINS), TWINS[1], "", "One two one TWO three", "three x" * 50, None]
    w = common.Words(*common.text_buffers(pa.array(texts)))
    flat = [x for t in texts for x in words(t)]
    assert [w.word(k).decode() for k in range(len(flat))] == flat
    assert [x.decode() for x in w.joined()] == ["".join(f"{x} " for x in words(t)) for t in texts]
    number = dict(zip(flat, common.Lexicon(w).of.tolist()))
    assert len(set(number.values())) == len(set(flat)) and [number[x] for x in flat] == common.Lexicon(w).of.tolist()
    other = common.Words(*common.text_buffers(pa.array(["two nowhere", TWINS[0]])))
    assert common.Lexicon(w).find(other).tolist() == [number["two"], -1, number[TWINS[0]]]
    n, begin = common.gram_numbers(w, 3)
    grams = [tuple(words(t)[i : i + 3]) for t in texts for i in range(max(len(words(t)) - 2, min(1, len(words(t)))))]
    assert len(grams) == len(n) and begin[-1] == len(n)
    assert len(set(zip(grams, n.tolist()))) == len(set(grams)) == len(set(n.tolist()))


def test_links_of_colliding_words(hash_bits):
    """Sets are compared by words: hashes alone would link texts that differ in half of their words."""
    rng = random.Random(12)
    rows = [[rng.choice(TWINS) if k % 2 else f"w{k}" for k in range(40)] for _ in range(8)] + [["a"], ["b"]]
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)] + [(20, " ".join([*TWINS] * 5)), (21, " ".join([*TWINS] * 6)), (22, " ".join([*TWINS[::-1]] * 5))]
    want, _ = near_brute(rows)
    n = len(rows)
    zero = np.zeros((n, ngram_join.TREES), np.uint64)  # all meet in every tree
    got, _ = ngram_join.compare(np.arange(n), np.ones(n, np.int64), np.full(n, -1), [f"{t} ".encode() for _, t in rows], zero, zero, 5, 0.8)
    assert got.tolist() == want


def test_twins_through_operators(spark):
    from tokenizers import Tokenizer

    rows = [(1, TWINS[0]), (2, TWINS[1]), (3, f"{TWINS[0]} x"), (4, " ".join(TWINS)), (5, TWINS[0])]
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_duplicates(documents(spark, rows)).collect()}
    assert got == {1: (1, 1), 2: (2, 0), 3: (3, 0), 4: (4, 0), 5: (1, 1)}
    items = spark.createDataFrame([(7, TWINS[1])], "item_id long, text string")
    hit = {r.doc_id: r.n_hit for r in decontaminate.find_contamination(documents(spark, rows).coalesce(1), items).collect()}
    assert hit == {1: 0, 2: 1, 3: 0, 4: 1, 5: 0}
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    folder = token_files.write_token_files(documents(spark, rows).coalesce(1), path, P.PATTERN)
    assert {r.doc_id: r.ids for r in token_files.read_token_files(spark, folder).collect()} == {i: library.encode(t, add_special_tokens=False).ids + [0] for i, t in rows}


def test_pieces_that_collide(hash_bits):
    import tiktoken
    from tokenizers import Tokenizer

    rng = random.Random(13)
    texts = [" ".join(rng.choice(("the", "nation", "é", "日本", "😀", "it's", "1234", *TWINS)) for _ in range(30)) for _ in range(40)] + [*TWINS, "", None]
    ranks = bpe.codec(RANKS, P.PATTERN).ranks
    c, library = bpe.Codec(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for _ in range(2):  # new pieces, then known ones
        assert [x.tolist() for x in c.encode(pa.array(texts))] == [library.encode_ordinary(t or "") for t in texts]
    path = P.path("byte_bpe_50k.json")
    mine, theirs = token_files.Library(path, P.PATTERN), Tokenizer.from_file(path)
    for most in (1_500_000, 3):  # the memory starts anew in between
        mine.ids.most = most
        for part in (texts, texts[::-1]):
            flat, begin = mine.texts(pa.array(part))
            assert [flat[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])] == [theirs.encode(t or "", add_special_tokens=False).ids for t in part]


def test_occurrences_of_colliding_words(hash_bits, spark):
    docs, items = decontamination_rows()
    w = common.Words(*common.text_buffers(pa.array([t for _, t in docs])))
    block = decontaminate.Items(["" if i is None else str(i) for i, t in items if t is not None], [t for _, t in items if t is not None], 10)
    sa = decontaminate.SuffixArray(w, block.longest)
    cover = np.zeros(len(w.hash) + 1, np.int64)
    found = {(int(t), block.ids[i]) for t, i in zip(*np.divmod(decontaminate._hits(w, sa, block, sa.search(block), cover), len(block.ids)))}
    assert found == {(k, item) for k, (_, _, _, ids) in enumerate(contamination(docs, items)) for item in ids}


# --- the forest's prefixes -------------------------------------------------------------------------------------------------


def forest(rows):
    w = common.Words(*common.text_buffers(pa.array(rows)))
    hashes, begin = ngram_join.distinct(*common.grams(w, 5))
    depth = ngram_join.prefix_depth(0.8)
    shared = ngram_join.shared_prefixes(*ngram_join.leaf_keys(hashes, begin, depth), depth)
    numbers, begin = ngram_join.distinct(*common.gram_numbers(w, 5))
    return [numbers[a:b] for a, b in zip(begin[:-1], begin[1:])], shared, depth


def test_prefixes_are_shortened_as_far_as_needed():
    """Close copies stop at whole labels, texts with links near the threshold or none go on to the shortest prefix; all links are found."""
    rng = random.Random(14)
    text = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    close = []
    for _ in range(40):
        t = list(text)
        t[rng.randrange(400)] = "x"
        close.append(" ".join(t))
    far = []
    base = [f"v{rng.randrange(10**6)}" for _ in range(400)]
    for _ in range(40):
        t = list(base)
        for k in rng.sample(range(400), 4):
            t[k] = "y"
        far.append(" ".join(t))
    alone = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) for _ in range(10)]
    rows = close + far + alone
    found, shared, shortest = forest(rows)
    link, depth = ngram_join.forest_links(found, shared, ~np.eye(len(rows), dtype=bool), 0.8, shortest, shortest + 2)
    assert set(depth[:40]) == {shortest + 2} and set(depth[80:]) == {shortest} and len(set(depth.tolist())) >= 2
    assert link.sum(1).tolist() == near_brute([(0, t) for t in rows])[0]


def test_pairs_that_never_meet_are_not_compared(monkeypatch):
    """A chain's ends lie together but share no prefix."""
    rng = random.Random(15)
    rows, t = [], [f"w{rng.randrange(10**6)}" for _ in range(300)]
    for _ in range(60):
        rows.append(" ".join(t))
        t = list(t)
        for k in rng.sample(range(300), 5):
            t[k] = f"w{rng.randrange(10**6)}"
    found, shared, shortest = forest(rows)
    asked = np.zeros(shared.shape, bool)
    counted = ngram_join.counted
    monkeypatch.setattr(ngram_join, "counted", lambda f, p: (asked.__ior__(p), counted(f, p))[1])
    link, _ = ngram_join.forest_links(found, shared, ~np.eye(60, dtype=bool), 0.8, shortest, shortest + 2)
    assert asked.sum() < 0.5 * 60 * 59 and not asked[0, 59]
    assert link.sum(1).tolist() == near_brute([(0, t) for t in rows])[0]


@pytest.mark.parametrize("together", [True, False])
def test_counted(together):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 80, 40)) for _ in range(30)]
    pairs = np.zeros((30, 30), bool)
    pairs[:, :] = together
    pairs[3, 9] = pairs[9, 3] = pairs[4, 20] = pairs[20, 4] = True
    np.fill_diagonal(pairs, False)
    got = ngram_join.counted(sets, pairs)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i, j in zip(*np.nonzero(pairs)))


def test_meetings(spark):
    rows = [(1, 0, [1, 2]), (1, 1, [2, 3]), (1, 2, [3]), (1, 3, [9]), (2, 0, [20]), (2, 1, [20])]
    got = ngram_join.meetings(spark.createDataFrame(rows, "grp long, block long, keys array<long>")).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0), (1, 0, 1), (1, 1, 1), (1, 1, 2), (1, 2, 2), (1, 3, 3), (2, 0, 0), (2, 0, 1), (2, 1, 1)]


# --- many rows of one id --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["null", "repeated"])
def test_near_duplicates_with_many_rows_of_one_id(spark, kind, monkeypatch):
    """Texts are fetched by id and hash: none is compared with the others of its id, and results are those of distinct ids."""
    rng = random.Random(9)
    base = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(1000)]
    texts = [t for b in base for t in (b, b + " more", b)] + [base[0]] * 1000
    seen = []
    whole = ngram_join.written
    monkeypatch.setattr(ngram_join, "written", lambda df, name: (out := whole(df, name), seen.append(out.count()) if name == "member-words" else None)[0])
    own = ngram_join.near_duplicates(documents(spark, list(enumerate(texts)))).select("text_hash", "n_links").collect()
    one = None if kind == "null" else 7
    got = ngram_join.near_duplicates(documents(spark, [(one, t) for t in texts]))
    got = got.select("text_hash", "n_links", "class_id").collect()
    assert sorted((r.text_hash, r.n_links) for r in got) == sorted(map(tuple, own)) and {r.class_id for r in got} == {one}
    assert len(seen) == 2 and seen[0] == seen[1] == 2000  # a text of each class, once


def test_token_files_deal_a_hot_id(spark):
    """An id with most rows takes several parts, ids ascend through the files, and starts count all ids before."""
    rng = random.Random(4)
    rows = [(7, f"text {i} " + "word " * rng.randrange(9)) for i in range(600)] + [(i, f"own {i}") for i in range(60)] + [(None, f"null {i}") for i in range(300)]
    rng.shuffle(rows)
    docs = documents(spark, rows)
    folder = token_files.write_token_files(docs, P.path("byte_bpe_50k.json"), P.PATTERN, parts=12)
    index = token_files.write_index(spark, folder)
    got = token_files.with_starts(spark.read.parquet(index), index).orderBy("start").collect()
    assert len(got) == len(rows) and [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    parts = {}
    for r in got:
        parts.setdefault(r.doc_id, Counter())[r.file.split("-")[1]] += 1
    assert len(parts[7]) >= 5 and len(parts[None]) >= 3 and max(parts[7].values()) < 300
    assert sorted(r.n_tokens for r in got) == sorted(len(x) + 1 for x in bpe_lengths(docs))


def bpe_lengths(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return [t.encode(r.text, add_special_tokens=False).ids for r in docs.collect()]


def test_part_of():
    cuts = np.array([-(1 << 63), -(1 << 63), 3, 5, 5, 5, 9])
    ids = np.array([-(1 << 63), -5, 3, 4, 5, 5, 6, 9, 10])
    got = token_files.part_of(ids, cuts, [b"%d" % k for k in range(9)])
    assert got[[1, 2, 3, 6, 7, 8]].tolist() == [2, 3, 3, 6, 7, 7] and got[0] in (1, 2) and all(4 <= x <= 6 for x in got[4:6])


# --- heavy keys, and what is left behind ------------------------------------------------------------------------------------


def test_join_dealt(spark, monkeypatch):
    monkeypatch.setattr(common, "HEAVY", 10)
    rng = random.Random(6)
    rows = [(rng.choice([1, 1, 1, 2, 2, *range(3, 60)]), i) for i in range(3000)]
    left = spark.createDataFrame(rows, "k int, i int")
    known = left.where("k % 2 = 1").groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("top"))
    top = {}
    for k, i in rows:
        top[k] = max(top.get(k, 0), i)
    for how in ("inner", "left"):
        got = common.join_dealt(left, known, ["k"], "n", F.col("i"), how)
        want = sorted((k, i, top[k] if k % 2 else None) for k, i in rows if k % 2 or how == "left")
        assert sorted(map(tuple, got.select("k", "i", "top").collect()), key=repr) == sorted(want, key=repr) and got.columns == ["k", "i", "top"]
    none = known.limit(0)
    assert common.join_dealt(left, none, ["k"], "n", F.col("i")).collect() == [] and common.join_dealt(left, none, ["k"], "n", F.col("i"), "left").count() == 3000


def test_scratch_removes_what_was_written(spark):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/millrace"
    os.makedirs(root, exist_ok=True)
    before = set(os.listdir(root))
    docs = documents(spark, [(i, f"w{i % 3} a b c d e f g h") for i in range(50)])
    with common.scratch(spark):
        got = ngram_join.near_duplicates(docs).collect()
        with common.scratch(spark):
            inner = common.written(docs, "inner")
            assert inner.count() == 50 and len(set(os.listdir(root)) - before) > 3
        assert not any(x.startswith("inner") for x in os.listdir(root))
    assert len(got) == 50 and set(os.listdir(root)) == before
    with pytest.raises(ZeroDivisionError), common.scratch(spark):
        common.written(docs, "lost")
        1 / 0
    assert set(os.listdir(root)) == before
