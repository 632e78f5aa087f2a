"""N-gram Jaccard join: a MinHash LSH forest finds candidates, the words themselves verify them exactly.

Texts of the same words form one class, so copies cost one row each. A class has a label in each tree: MinHash values in
order. The labels of all trees are sorted together by range partitioning, which is the forest's prefix tries laid out in
leaf order: labels that share a prefix are neighbours, and a much shared prefix spreads over as many tasks as it fills.
Chains of neighbours that share the shortest prefix of use (`prefix_depth`) only say which classes have to lie together: a
group is cut into blocks of bounded size, and two blocks meet in one task if classes of both share such a prefix.

There each class starts with its whole labels. Pairs that share them in some tree are verified by counting common shingles. From
the exact similarities found the class estimates its recall at this length, a partner at the threshold that wasn't met always
counted in; a class below the target shortens its prefix by a value and verifies the pairs that it meets
in addition, until the target is reached. So a class with many close copies stops at long prefixes and
one without any goes down to the shortest. A task gives a row per class: its number of linked documents and the least class
it is connected with. No pair is ever a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, as_documents, connected_components, gram_numbers, grams, mixed, slices, text_buffers, unused, written

SHINGLE, THRESHOLD = 5, 0.8
#: Trees of the forest, length of a label, and the recall that a pair at the threshold is to have.
TREES, LABEL, RECALL = 32, 8, 0.9999
#: A block of classes holds about so many shingles and classes at most.
BLOCK_SHINGLES, BLOCK_CLASSES = 200_000, 256
_SEEDS = np.random.default_rng(97).integers(0, 2**32, (2, TREES * LABEL), dtype=np.uint32)


def recall_at(similarity, depth, trees: int = TREES):
    """The probability that a pair shares a prefix of so many values in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def prefix_depth(threshold: float, trees: int = TREES, label: int = LABEL, recall: float = RECALL) -> int:
    """The longest prefix at which a pair of similarity `threshold` shares one in some tree with probability `recall`."""
    depth = label
    while depth > 1 and recall_at(threshold, depth, trees) < recall:
        depth -= 1
    return depth


def leaf_keys(shingles: np.ndarray, begin: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """In every tree, of sets between begin (n + 1) with a shingle at least: a 64-bit key of the label's first depth values, and the next two values, which order labels below the prefix."""
    n = len(begin) - 1
    s = (shingles >> np.uint64(32)).astype(np.uint32)
    keys, rest = np.zeros((n, TREES), np.uint64), np.zeros((n, TREES), np.uint64)
    at = 0
    while at < n:  # as many sets at once as stay in the processor's cache
        to = max(at + 1, int(np.searchsorted(begin, begin[at] + (1 << 16), "right")) - 1)
        part, first = s[begin[at] : begin[to]], begin[at:to] - begin[at]
        for t in range(TREES):
            key = np.full(to - at, t + 1, np.uint64)
            for k in range(min(LABEL, depth + 2)):
                seed = _SEEDS[:, t * LABEL + k]
                low = np.minimum.reduceat((part ^ seed[0]) * (seed[1] | np.uint32(1)), first)
                if k < depth:
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + low)
                else:
                    rest[at:to, t] = (rest[at:to, t] << np.uint64(32)) | low
            keys[at:to, t] = key
        at = to
    return keys, rest


def fingerprint(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def signatures(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, n (distinct shingles), fp (of the words; null without any), keys and rests (of labels, a tree each) of every row."""
    depth = prefix_depth(threshold)
    longs = T.ArrayType(T.LongType())
    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("text_hash", T.LongType()), T.StructField("n", T.LongType()), T.StructField("fp", T.BinaryType()), T.StructField("keys", longs), T.StructField("rests", longs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                w = Words(*text_buffers(part.column("text")))
                found, begin = distinct(*grams(w, shingle))
                size = np.diff(begin)
                some = size > 0
                ends = pa.array(np.concatenate([[0], np.cumsum(some * TREES)]).astype(np.int32))
                values = leaf_keys(found, np.append(begin[:-1][some], begin[-1]), depth)
                labels = [pa.ListArray.from_arrays(ends, pa.array(v.view(np.int64).ravel())) for v in values]
                fp = [fingerprint(x) if x else None for x in w.joined()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(size), pa.array(fp, pa.binary()), *labels], names=out.names)

    return as_documents(docs, "doc_id", "text").select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, out)


def distinct(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each set between begin (n + 1), and where these begin."""
    values, first = values.copy(), np.zeros(len(values), bool)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        values[a:b].sort()
    first[begin[:-1][np.diff(begin) > 0]] = True
    first[1:] |= values[1:] != values[:-1]
    return values[first], np.concatenate([[0], np.cumsum(first)])[begin]


def candidates(classes: DataFrame) -> DataFrame:
    """Edges (src, dst) between neighbours in the sorted forest that share a prefix, from classes (id, keys, rests)."""
    leaves = classes.select("id", F.explode(F.arrays_zip("keys", "rests")).alias("l")).select(F.col("l.keys").alias("key"), F.col("l.rests").alias("rest"), "id")
    leaves = leaves.repartitionByRange("key", "rest", "id").sortWithinPartitions("key", "rest", "id")
    names = ["src", "dst", "part", "side", "key"]

    def rows(src, dst, part=None, side=None, key=None) -> pa.RecordBatch:
        n = len(src)
        fill = lambda x, kind: pa.nulls(n, kind) if x is None else pa.array([x] * n, kind)
        return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.nulls(n, pa.int64()) if dst is None else pa.array(dst, pa.int64()), fill(part, pa.int32()), fill(side, pa.int32()), fill(key, pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Neighbours of a partition, and its first and last leaf, which may have neighbours in the next partitions."""
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, leaf = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            if last is None:
                yield rows(leaf[:1], None, part, 0, int(key[0]))
            else:
                key, leaf = np.append(last[0], key), np.append(last[1], leaf)
            same = np.flatnonzero((key[1:] == key[:-1]) & (leaf[1:] != leaf[:-1]))
            yield rows(leaf[same + 1], leaf[same])
            last = key[-1], leaf[-1]
        if last is not None:
            yield rows(last[1:], None, part, 1, int(last[0]))

    found = written(leaves.mapInArrow(run, "src long, dst long, part int, side int, key long"), "neighbours")
    ends = Window.orderBy("part", "side")  # two rows a partition
    across = found.where("part IS NOT NULL").withColumn("dst", F.lag("src").over(ends)).withColumn("before", F.lag("key").over(ends)).where("side = 0 AND before = key")
    return found.where("part IS NULL").select("src", "dst").unionByName(across.select("src", "dst"))


def common_counts(found: list[np.ndarray]) -> np.ndarray:
    """Numbers of common elements of all pairs of sets: elements in two sets are counted singly, others by products of 0-1 matrices."""
    m = len(found)
    out = np.zeros((m, m), np.float64)
    owner = np.repeat(np.arange(m), [len(s) for s in found])
    every = np.concatenate(found)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    size = np.diff(np.append(first, len(every)))
    two = first[size == 2]
    pair = np.bincount(owner[two] * m + owner[two + 1], minlength=m * m).reshape(m, m)
    out += pair + pair.T
    many = size > 2
    column = np.repeat(np.cumsum(many) - 1, size)[np.repeat(many, size)]
    row = owner[np.repeat(many, size)]
    width = max(1, (4 << 20) // m)
    for c in range(0, int(many.sum()), width):
        own = slice(np.searchsorted(column, c), np.searchsorted(column, c + width))
        x = np.zeros((m, min(width, int(many.sum()) - c)), np.float32)
        x[row[own], column[own] - c] = 1
        out += x @ x.T
    return out


def shared_prefixes(keys: np.ndarray, rests: np.ndarray, depth: int) -> np.ndarray:
    """Of all pairs: the longest prefix that they share in a tree, 0 below `depth`."""
    out = np.zeros((len(keys), len(keys)), np.int8)
    high = rests >> np.uint64(32)
    for t in range(keys.shape[1]):
        same = keys[:, t][:, None] == keys[:, t][None]
        longer = same & (high[:, t][:, None] == high[:, t][None])
        both = longer & (rests[:, t][:, None] == rests[:, t][None])
        np.maximum(out, same * np.int8(depth) + longer + both, out=out)
    return out


def counted(found: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Common elements of the pairs (a symmetric matrix says which); one by one if they are few."""
    out = np.zeros(pairs.shape)
    own = np.flatnonzero(pairs.any(1))
    if pairs.sum() <= 8 * len(own):
        for i, j in zip(*np.nonzero(np.triu(pairs)), strict=True):
            out[i, j] = out[j, i] = len(np.intersect1d(found[i], found[j], assume_unique=True))
    else:
        out[np.ix_(own, own)] = common_counts([found[i] for i in own])
    return out


def forest_links(found: list[np.ndarray], shared: np.ndarray, allowed: np.ndarray, threshold: float, shortest: int, longest: int, recall: float = RECALL) -> tuple[np.ndarray, np.ndarray]:
    """Links among sets, and the prefix length that each has come to. shared: the longest shared prefix of each pair; allowed: pairs that count.

    Pairs meet where the shorter prefix of both is shared. The recall of a set at its length is estimated from its links, each standing for
    1 / p links of its similarity where p is its chance to be met, and from one more at the threshold.
    """
    n = np.array([len(s) for s in found], np.float64)
    depth = np.full(len(n), longest)
    seen, like = np.zeros(allowed.shape, bool), np.zeros(allowed.shape)
    while True:
        new = allowed & ~seen & (shared >= np.minimum(depth[:, None], depth[None]))
        if new.any():
            common = counted(found, new)
            like[new] = (common / np.maximum(n[:, None] + n[None] - common, 1))[new]
            seen |= new
        link = like >= threshold
        least = recall_at(threshold, depth)
        stands = np.where(link, 1 / recall_at(np.where(link, like, 1.0), depth[:, None]), 0).sum(1)
        estimate = (link.sum(1) + 1) / (stands + 1 / least)
        short = (estimate < recall) & (depth > shortest)
        if not short.any():
            return link, depth
        depth[short] -= 1


def compare(ids: np.ndarray, copies: np.ndarray, side: np.ndarray, words: list[bytes], keys: np.ndarray, rests: np.ndarray, shingle: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each class: linked documents, and the least class it is connected with over links. side: -1 if all pairs count, else those of unlike sides."""
    w = Words(*text_buffers(pa.array(words, pa.large_binary())))
    numbers, begin = distinct(*gram_numbers(w, shingle))
    found = [numbers[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]
    allowed = ~np.eye(len(ids), dtype=bool)
    if side[0] >= 0:
        allowed &= side[:, None] != side[None]
    shortest = prefix_depth(threshold)
    link, _ = forest_links(found, shared_prefixes(keys, rests, shortest), allowed, threshold, shortest, min(LABEL, shortest + 2))
    links = link @ copies
    root = ids.copy()
    while True:
        low = np.minimum(root, np.where(link, root[None], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max))
        if (low == root).all():
            return links, root
        root = low


def verified(blocks: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """id, links and root of every class with links, from rows (grp, a, b, block, id, copies, words, keys, rests) that lie together by (grp, a, b)."""

    def done(rows: list[tuple], a: int, b: int) -> pa.RecordBatch:
        rows = list({r[1]: r for r in rows}.values())
        ids, copies = (np.array([r[k] for r in rows], np.int64) for k in (1, 2))
        side = np.array([r[0] if a != b else -1 for r in rows])
        keys, rests = (np.array([r[k] for r in rows]).view(np.uint64) for k in (4, 5))
        links, root = compare(ids, copies, side, [r[3] for r in rows], keys, rests, shingle, threshold)
        k = links > 0
        return pa.RecordBatch.from_arrays([pa.array(ids[k]), pa.array(links[k]), pa.array(root[k])], names=["id", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            c = {n: batch.column(n) for n in ("grp", "a", "b", "block", "id", "copies", "words", "keys", "rests")}
            plain = [c[n].to_pylist() for n in ("grp", "a", "b", "block", "id", "copies")]
            for i, (grp, a, b, *row) in enumerate(zip(*plain, strict=True)):
                if (grp, a, b) != now:
                    if len(rows) > 1:
                        yield done(rows, *now[1:])
                    now, rows = (grp, a, b), []
                rows.append((*row, c["words"][i].as_py(), *(c[n][i].values.to_numpy().copy() for n in ("keys", "rests"))))
        if len(rows) > 1:
            yield done(rows, *now[1:])

    return blocks.mapInArrow(run, "id long, links long, root long")


def in_blocks(members: DataFrame) -> DataFrame:
    """members (grp, id, n, keys) with blocks, the number of blocks of their group, and their own.

    Classes that share their first tree's prefix share a block, unless they are too many for one.
    """
    load = members.groupBy("grp").agg(F.sum("n").alias("s"), F.count("*").alias("m"))
    load = load.select("grp", F.greatest(F.ceil(F.col("s") / BLOCK_SHINGLES), F.ceil(F.col("m") / BLOCK_CLASSES)).cast("long").alias("blocks"))
    node = F.get("keys", 0)
    out = members.join(load, "grp")
    size = out.where("blocks > 1").groupBy(node.alias("node")).agg(F.sum("n").alias("s"), F.count("*").alias("m"))
    wide = size.where((F.col("s") > BLOCK_SHINGLES / 4) | (F.col("m") > BLOCK_CLASSES / 4)).select("node", F.lit(True).alias("wide"))
    out = out.withColumn("node", node).join(wide, "node", "left")
    return out.withColumn("block", F.expr("pmod(xxhash64(if(wide, id, node)), blocks)")).drop("node", "wide")


def meetings(members: DataFrame) -> DataFrame:
    """grp, a, b (a <= b): the pairs of blocks of which classes share a prefix, from members (grp, block, keys)."""
    at = members.select("grp", "block", F.explode("keys").alias("key")).distinct()
    pairs = at.select("key", "grp", F.col("block").alias("a")).join(at.select("key", F.col("block").alias("b")), "key")
    return pairs.where("a <= b").select("grp", "a", "b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, class_id, n_links and component (null without words) of every row.

    Links join documents whose sets of `shingle`-word shingles have a Jaccard similarity of `threshold` or more; words are
    A-Z lower-cased; a text of fewer words is one shingle, one without words (or null) links to none and is its own class. A class is a
    component over links, class_id its least doc_id (null if all are null). n_links counts the other rows linked to a row, copies included.
    Repeated rows are copies of each other; other columns are ignored.

    Prefixes shorten between LABEL values and prefix_depth(threshold): 8, 7 and 6 at 0.8; at 0.95 both are 8 and nothing is left to adapt. A class's recall is estimated
    from the partners that one pair of blocks shows it, not from all it has; the shortest prefix alone gives the recall that `RECALL` names.
    """
    rows = written(signatures(docs, shingle, threshold), "signatures")
    keyed = rows.where("fp IS NOT NULL")
    # A class's text is fetched by id and hash: many rows may share an id, or have none.
    text_hash = F.min_by("text_hash", F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    classes = keyed.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), text_hash.alias("rep_hash"), F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("n", "keys", "rests")))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    groups = connected_components(candidates(classes), "candidates")
    members = groups.join(classes.withColumnRenamed("doc_id", "rep"), F.col("node") == F.col("id")).withColumnRenamed("component", "grp").drop("node")
    members = _with_words(docs, in_blocks(members))
    some = members.drop("blocks", "n")
    one = some.where(members["blocks"] == 1).withColumn("a", F.lit(0).cast("long")).withColumn("b", F.lit(0).cast("long"))
    many = some.where(members["blocks"] > 1)
    ends = meetings(many.select("grp", "block", "keys")).withColumn("block", F.explode(F.array_distinct(F.array("a", "b"))))
    together = one.unionByName(many.join(ends, ["grp", "block"])).repartition("grp", "a", "b").sortWithinPartitions("grp", "a", "b", "id")
    found = written(verified(together, shingle, threshold), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = connected_components(found.select(F.col("id").alias("src"), F.col("root").alias("dst")), "duplicates")
    whole = classes.select("id", "fp", "doc_id", "copies").join(links, "id", "left").join(joined.select(F.col("node").alias("id"), "component"), "id", "left")
    whole = whole.withColumn("component", F.coalesce("component", "id"))
    least = whole.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    by_fp = whole.join(least, "component").select("fp", "class_id", "component", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.select("doc_id", "text_hash", "fp").join(by_fp, "fp", "left")
    alone = F.col("fp").isNull()
    return out.select("doc_id", "text_hash", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component")


def _with_words(docs: DataFrame, members: DataFrame) -> DataFrame:
    """members with the words of one of their texts each, written; the texts come from docs by doc_id and hash and are known by fingerprint."""
    d = as_documents(docs, "doc_id", "text").withColumn("hash", F.xxhash64("text"))
    names = ["grp", "id", "copies", "n", "blocks", "block", "keys", "rests"]
    # A merge join at every size: members grow with the documents, so that a broadcast would fit small inputs only.
    text = d.join(members.hint("merge"), (F.col("hash") == F.col("rep_hash")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("text", "fp", *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            ids = batch.column("id").to_pylist()
            again = [a == b for a, b in zip(ids, [last, *ids[:-1]], strict=True)]  # repeated rows come one after another
            last = ids[-1] if ids else last
            for part in slices(batch.filter(pa.array([not x for x in again], pa.bool_())), "text", 1 << 20):
                words = Words(*text_buffers(part.column("text"))).joined()
                keep = pa.array([i for i, (x, fp) in enumerate(zip(words, part.column("fp").to_pylist(), strict=True)) if fingerprint(x) == fp], pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(n).take(keep) for n in names), pa.array(words, pa.binary()).take(keep)], names=[*names, "words"])

    schema = T.StructType([*(text.schema[n] for n in names), T.StructField("words", T.BinaryType())])
    return written(text.mapInArrow(run, schema), "member-words")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, of its least doc_id, with all columns; of equal rows (id and text) one stays. Texts without words all stay."""
    found = written(near_duplicates(docs, shingle, threshold), "near-duplicates")
    keyed = found.where("component IS NOT NULL")
    gone = keyed.where(~F.col("doc_id").eqNullSafe(F.col("class_id")))
    # Of a class's rows with its id, that of least text hash stays: other texts may have the same id.
    heads = keyed.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    best = heads.groupBy("component").agg(F.min("text_hash").alias("best"), F.count("*").alias("n")).where("n > 1")
    more = heads.join(best, "component")
    gone = gone.select("doc_id", "text_hash").unionByName(more.where("text_hash <> best").select("doc_id", "text_hash")).distinct()
    repeated = more.where("text_hash = best").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "text_hash")
    id_, hash_ = unused(docs, "id"), unused(docs, "hash")
    on = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_))
    named = lambda t: t.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).hint("merge")
    if repeated.isEmpty():
        return docs.join(named(gone), on, "left_anti")
    once = docs.join(named(repeated), on, "left_semi").dropDuplicates(["doc_id", "text"])
    return docs.join(named(gone.unionByName(repeated)), on, "left_anti").unionByName(once)
