"""Paid requests: every answer is kept in a table as it comes, so that a request is paid for once.

A request is known by the digest of its prompt. The table has a row for each call that was answered: request, try, answer, error (null if the answer
parses). Each round of tries asks what the table lacks, a few requests a task, and a task's answers are visible as soon as that task is committed. What
a lost task or driver had in hand is all that is asked again; a call that itself failed leaves no row and is asked again by the next run. Where Spark
runs tasks twice on speculation, both call and one is kept: leave spark.speculation off for runs that pay.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.provider import Provider, ProviderError, parse_answer
from millrace.sources.tables import read_if_there

#: Requests of a task, about: what is asked again if it is lost.
PER_TASK = 4
LEDGER = "request string, try int, answer string, error string"
#: Hadoop's committer moves a task's files when the task ends, not when the job does, so that a failed job keeps what its tasks were paid for.
BY_TASK = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def request_of(prompt: Column) -> Column:
    return F.sha2(prompt.cast("binary"), 256)


def _letters(digest: str) -> Column:
    return F.lower(F.hex(digest))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row a request and try: where two tasks were paid for the same one after all, the lesser answer counts."""
    rows = read_if_there(spark, path, LEDGER)
    return rows.groupBy("request", "try").agg(F.min(F.struct("answer", "error")).alias("a")).select("request", "try", "a.answer", "a.error")


def _tried(spark: SparkSession, path: str, tries: int) -> DataFrame:
    """Of each request (its digest's bytes, half as long as their letters): n tries, the first valid answer of at most `tries`, all errors and the last. The ledger is shuffled once."""
    rows = read_if_there(spark, path, LEDGER).withColumn("request", F.unhex("request")).where(F.col("request").isNotNull())
    one = rows.repartition("request").groupBy("request", "try").agg(F.min(F.struct("answer", "error")).alias("a")).select("request", "try", "a.answer", "a.error")
    good = F.when(F.col("error").isNull() & (F.col("try") <= tries), F.col("try"))
    errors = F.transform(F.array_sort(F.collect_list(F.struct("try", "error"))), lambda x: x["error"])  # at most as many as there are tries
    return one.groupBy("request").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("error").isNull()).alias("good"), F.min_by("answer", good).alias("answer"), errors.alias("errors"), F.max_by("error", "try").alias("last")
    )


def open_requests(prompts: DataFrame, path: str, number: int) -> DataFrame:
    """request (bytes) and the text to send of the distinct prompts that are due for try `number`: asked number - 1 times, each time in vain. Earlier errors stand under the prompt."""
    asked = prompts.where(F.col("prompt").isNotNull()).select(F.unhex(request_of(F.col("prompt"))).alias("request"), "prompt").dropDuplicates(["request"])
    tried = _tried(prompts.sparkSession, path, number).select("request", "n", "good", "errors")
    due = asked.join(tried, "request", "left").where((F.coalesce("n", F.lit(0)) == number - 1) & (F.coalesce("good", F.lit(0)) == 0))
    return due.select("request", F.concat_ws("\n\n", F.array("prompt"), F.coalesce("errors", F.array().cast("array<string>"))).alias("text"))


def _called(due: DataFrame, number: int, provider: Provider, model: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for request, text in zip(batch["request"], batch["text"], strict=True):
                try:
                    answer = provider(text)
                except ProviderError:
                    continue  # not paid for
                error = None
                try:
                    parse_answer(answer, model)
                except ValueError as e:
                    error = str(e)
                rows.append((request, number, answer, error))
            yield pd.DataFrame(rows, columns=["request", "try", "answer", "error"])

    return due.mapInPandas(run, LEDGER)


def ask_all(prompts: DataFrame, provider: Provider, path: str, model: str = "extraction", tries: int = 2, per_task: int = PER_TASK) -> int:
    """Asks for every prompt (column prompt) that the ledger at `path` has no valid answer to, at most `tries` times over all runs; returns the answers added.

    An answer that doesn't parse is asked for again with its error under the prompt. Null prompts are not asked; equal ones are one request.
    """
    spark = prompts.sparkSession
    rows = lambda: read_if_there(spark, path, LEDGER).count()  # noqa: E731  (of the files' footers)
    before = rows()
    for number in range(1, tries + 1):
        due = open_requests(prompts, path, number)
        n = due.count()
        if not n:
            continue
        dealt = due.repartition(-(-n // per_task))  # in turn, in an order that a repeated task meets again
        _called(dealt.withColumn("request", _letters("request")), number, provider, model).write.mode("append").options(**BY_TASK).parquet(path)
    return rows() - before


def answers(prompts: DataFrame, path: str, tries: int = 2) -> DataFrame:
    """The rows of prompts with tries (answered calls so far), answer and error: the first valid answer; without one the last error, null if no call was answered."""
    tried = _tried(prompts.sparkSession, path, tries).select("request", F.col("n").alias("tries"), "answer", F.col("last").alias("error"))
    rows = prompts.withColumn("request", F.unhex(request_of(F.col("prompt")))).join(tried, "request", "left").withColumn("request", _letters("request"))
    return rows.withColumn("error", F.when(F.col("answer").isNull(), F.col("error"))).withColumn("tries", F.coalesce("tries", F.lit(0)))
