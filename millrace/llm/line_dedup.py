"""Line dedup by distinct-site spread, in built-in functions only.

Lines are known by two 64-bit hashes. One HyperLogLog sketch of sites per line merges by partial aggregation; a line whose estimate is
clear of the threshold is decided by it, one near the threshold by its exact number of distinct sites. A line on enough
sites is boilerplate: only its first occurrence (least doc_id, then position) stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_documents, bound, join_dealt, unused, written

#: Sites from which on a line is boilerplate, characters from which on a line can be, and the share around the threshold that is counted exactly.
MIN_SITES, MIN_CHARS, NEAR = 8, 20, 0.25
#: log2 of a sketch's registers: a relative error of about 2.5 %, a tenth of NEAR.
LOG_REGISTERS = 11
#: What a line is known by: with one hash alone, some of a trillion lines would be taken for each other.
LINE = ["hash", "hash2"]


def _key() -> list[Column]:
    """Equal for rows of equal id and text only; repeated ids of other texts are rows of their own."""
    return [F.col("doc_id"), F.xxhash64("text").alias("text_hash")]


def lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_hash, site, pos (from 0), hash and hash2 of every line of min_chars characters or more, blanks at its ends aside."""
    d = as_documents(docs, "doc_id", "text", "source").select(*_key(), F.col("source").alias("site"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    d = d.withColumn("line", F.btrim("line", F.lit(" \t\r"))).where(F.length("line") >= min_chars)
    return d.select("doc_id", "text_hash", "site", "pos", F.xxhash64("line").alias("hash"), F.xxhash64(F.lit(1), "line").alias("hash2"))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Occurrences (doc_id, text_hash, pos, hash, hash2) of lines on at least min_sites sites, and whether each is the first. A null site counts for none."""
    every = lines(docs, min_chars)
    estimate = F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS)))
    spread = every.groupBy(*LINE).agg(estimate.alias("sites"), F.count("*").alias("n")).where(F.col("sites") >= min_sites * (1 - NEAR))
    spread = written(spread, "line-spread")
    place = F.struct("doc_id", "pos")
    found = written(join_dealt(every, spread, LINE, "n", place), "line-occurrences")
    near = found.where(F.col("sites") < min_sites * (1 + NEAR))
    exact = near.groupBy(*LINE, "site").agg(F.lit(1).alias("one")).groupBy(*LINE).agg(F.count("site").alias("n")).where(F.col("n") >= min_sites)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash", "pos")).alias("first")
    firsts = found.groupBy(*LINE).agg(first, F.max("sites").alias("sites"), F.count("*").alias("n"))
    sure = firsts.where(F.col("sites") >= min_sites * (1 + NEAR))
    chosen = sure.unionByName(firsts.join(exact.select(*LINE), LINE, "left_semi")).select(*LINE, "first", "n")
    is_first = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_hash") == F.col("text_hash")) & (F.col("first.pos") == F.col("pos"))
    return join_dealt(found.drop("sites"), chosen, LINE, "n", place).select("doc_id", "text_hash", "pos", *LINE, is_first.alias("is_first"))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, lines_col: str = "__lines", removed_col: str = "__removed") -> DataFrame:
    """All rows and columns of docs with boilerplate lines taken from text, and two more: a row's lines before, and those taken.

    Rows without boilerplate keep their text unchanged; null texts stay null with no lines. Equal rows (id and text) fare alike. Columns
    of docs that have the name of lines_col or removed_col are replaced; any other names are free.
    """
    id_, hash_, gone_ = (unused(docs, n) for n in ("id", "hash", "gone"))
    gone = boilerplate(docs, min_sites, min_chars).where(~F.col("is_first"))
    gone = gone.groupBy(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).agg(F.collect_set("pos").alias(gone_))
    on = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_))

    def rest(x: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["gone"])
        return F.array_join(F.transform(kept, lambda i: F.get(x["lines"], i)), "\n")

    cut = bound(F.struct(F.split("text", "\n", -1).alias("lines"), F.col(gone_).alias("gone")), rest)
    n = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(F.split("text", "\n", -1))).cast("long")
    removed = F.when(F.col(gone_).isNull(), F.lit(0)).otherwise(F.size(gone_)).cast("long")
    own = [c for c in docs.columns if c.lower() not in (lines_col.lower(), removed_col.lower())]
    text = F.when(F.col(gone_).isNull(), F.col("text")).otherwise(cut).alias("text")
    return docs.join(gone, on, "left").select(*(text if c == "text" else F.col(f"`{c}`") for c in own), n.alias(lines_col), removed.alias(removed_col))
