"""The corpus pipeline: toxic documents go, boilerplate lines go, near copies go, contaminated documents go, the rest is encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, line_dedup, ngram_join, toxicity
from millrace.llm.common import scratch, shared_dir, unused
from millrace.llm.queries import LEARN, table
from millrace.sources.files import Files


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic by the threshold of their language; learned from labelled documents that aren't held out."""
    return toxicity.remove_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), LEARN))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines but for the first occurrence of each; those of which nothing else was left go. n_chars follows the text."""
    count, taken = unused(docs, "lines"), unused(docs, "removed")
    got = line_dedup.remove_boilerplate(docs, lines_col=count, removed_col=taken)
    emptied = (F.col(taken) > 0) & (F.btrim("text", F.lit(" \t\r\n")) == "")
    got = got.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        got = got.withColumn("n_chars", F.when(F.col(taken) > 0, size).otherwise(F.col("n_chars")))
    return got.select(*(F.col(f"`{c}`") for c in docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of least doc_id."""
    return ngram_join.keep_one(docs)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item occurs."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and token_ids of every whole text."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


#: Each takes (spark, docs, sf_dir); its result is written and read again as the next one's docs.
STAGES = [("toxicity", toxic), ("line_dedup", lines), ("ngram_join", near_copies), ("decontamination", contaminated), ("byte_bpe", encode)]

#: The classifier and the forest have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's result is written and read again; what a stage needed on the way, and the result before, are removed once it is."""
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        before, path = path, shared_dir(spark, f"stage-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            Files(spark).remove(before)
    return docs
