"""Joins on containment by an inverted index of runs of characters, for which a plain `contains` condition has no keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: So many lengths of names are indexed each by itself; of more only some are, and names between them are looked up by a run.
SIZES = 8
#: Characters that a run begins with, and how many such beginnings may tell where texts are cut. They bound a filter's size and never the result.
HEAD, HEADS = 3, 1000


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with a lambda variable for value, so that it is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def grams(text: Column, size: int) -> Column:
    """The distinct runs of `size` characters of a text; none for a shorter or null one."""
    return cut(text, [size])


def cut(text: Column, sizes: list[int], heads: list[str] | None = None) -> Column:
    """The distinct runs of a text that have one of the sizes (ascending), and begin with one of heads if given: these are of one length, at most the least size."""

    def runs(c: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(c) - sizes[0])
        if heads:
            at = F.filter(at, lambda i: F.concat(*(F.get(c, i + k) for k in range(len(heads[0])))).isin(heads))
        run = lambda n: lambda i: F.array_join(F.slice(c, i + 1, n), "")
        of = lambda a, n: F.transform(a if n == sizes[0] else F.filter(a, lambda i: i + n <= F.size(c)), run(n))
        return _bound(at, lambda a: F.array_distinct(F.concat(*(of(a, n) for n in sizes))))

    return F.when(F.length(text) >= sizes[0], _bound(F.split(text, ""), runs)).otherwise(F.array().cast("array<string>"))


def run_sizes(lengths: list[int], most: int = SIZES) -> list[int]:
    """The sizes of runs for names of these lengths: all lengths, where they are at most `most`; else the least one, and each next the first that is at least twice the one before."""
    lengths = sorted(lengths)
    if len(lengths) <= most:
        return lengths
    out: list[int] = []
    for n in lengths:
        if not out or n >= 2 * out[-1]:
            out.append(n)
    return out


def containing(texts: DataFrame, names: DataFrame, text: str, name: str, most: int = SIZES) -> DataFrame:
    """Rows of texts joined with the rows of names whose name stands in the text. Empty and null names and texts join with nothing.

    Texts are cut into runs without a shuffle, only where a run begins as some name's does, and runs meet names in a join that Spark broadcasts or
    shuffles by size and splits where a run is frequent. A name whose length is among the sizes of runs is its own run: it meets nothing but the texts it
    stands in, however many names there are. Others (see run_sizes) are looked up by the one of their runs that stands in the fewest texts, and verified;
    such a run has more than half of the name. The columns of both sides must differ.
    """
    names = names.where(F.length(name) > 0)
    lengths = sorted(r[0] for r in names.select(F.length(name)).distinct().collect())  # at most as many as the longest name has characters
    if not lengths:
        return texts.join(names, F.col(text) == F.col(name)).limit(0)
    sizes = run_sizes(lengths, most)
    own = names.select(F.col(name).alias("__name")).distinct()
    if sizes == lengths:
        runs = own.withColumn("__run", F.col("__name"))
    else:
        of_size = grams(F.col("__name"), sizes[0])
        for n in sizes[1:]:
            of_size = F.when(F.length("__name") < n, of_size).otherwise(grams(F.col("__name"), n))
        runs = own.select("__name", F.explode(of_size).alias("__run"))
    heads = [r[0] for r in runs.select(F.substring("__run", 1, min(HEAD, sizes[0]))).distinct().limit(HEADS + 1).collect()]
    indexed = texts.withColumn("__run", F.explode(cut(F.col(text), sizes, sorted(heads) if len(heads) <= HEADS else None)))
    if sizes == lengths:
        return indexed.join(names, F.col("__run") == F.col(name)).drop("__run")
    spread = indexed.select("__run").join(runs.select("__run").distinct(), "__run", "left_semi").groupBy("__run").agg(F.count("*").alias("n"))
    chosen = runs.join(spread, "__run").groupBy("__name").agg(F.min_by("__run", F.struct("n", "__run")).alias("__run"))
    asked = names.join(chosen, F.col(name) == F.col("__name")).drop("__name")
    return indexed.join(asked, "__run").where(F.contains(F.col(text), F.col(name))).drop("__run")
