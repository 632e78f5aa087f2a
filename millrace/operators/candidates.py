"""Trying candidates in order, and the waterfall over sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Candidates of a source that are tried, and the order of sources.
MOST = 3
MANUAL, SITEMAP, SEARCH = range(3)


def top_candidates(candidates: DataFrame, key: str = "seed_pos", order: str = "rank", most: int = MOST, by: tuple[str, ...] = ()) -> DataFrame:
    """The first `most` candidates of each key (and source, if named in `by`), by order. The limit is pushed below the shuffle."""
    n = F.row_number().over(Window.partitionBy(key, *by).orderBy(order))
    return candidates.withColumn("__n", n).where(F.col("__n") <= most).drop("__n")


def first_ok(attempts: DataFrame, key: str = "seed_pos", order: tuple[str, ...] = ("rank",)) -> DataFrame:
    """Of each key the attempt of flag ok that comes first; keys without one are absent. One aggregation, no sort."""
    ok = attempts.where(F.col("flag") == "ok")
    best = F.min_by(F.struct(*attempts.columns), F.struct(*order)).alias("b")
    return ok.groupBy(F.col(key).alias("__key")).agg(best).select("b.*")


def attempts_flag(status, error, verified):
    """Flag of an attempt: the fetch's status unless ok, extract_failed for an error, else ok or mismatch."""
    return F.when(status != "ok", status).when(error.isNotNull(), "extract_failed").when(verified, "ok").otherwise("mismatch")


def waterfall(seed: DataFrame, attempts: DataFrame, search: DataFrame) -> DataFrame:
    """The final state of every seed row, from recorded attempts (seed_pos, source, rank, url, flag) and search answers (seed_pos, answered).

    The first ok attempt by source and rank wins. Else the manual attempt's flag stays, or no_candidate without a manual url,
    or no_source if the search gave no answer either. `cached` is false for rows to try again: an unanswered search, or a transient flag.
    A seed row that search lacks was never searched, which happens only where an earlier source was ok.
    """
    names = {MANUAL: "manual", SITEMAP: "sitemap", SEARCH: "search"}
    tried = top_candidates(attempts, by=("source",))
    won = first_ok(tried, order=("source", "rank")).select("seed_pos", F.col("source").alias("w_source"), F.col("url").alias("w_url"))
    manual = attempts.where(F.col("source") == MANUAL).select("seed_pos", F.col("flag").alias("m_flag"))
    rows = seed.select("seed_pos", F.col("url").alias("seed_url")).join(won, "seed_pos", "left").join(manual, "seed_pos", "left")
    rows = rows.join(search.select("seed_pos", "answered"), "seed_pos", "left").withColumn("answered", F.coalesce("answered", F.lit(True)))
    ok = F.col("w_source").isNotNull()
    flag = F.when(ok, "ok").when(F.col("seed_url").isNotNull(), F.coalesce("m_flag", F.lit("no_source"))).when(F.col("answered"), "no_candidate").otherwise("no_source")
    discovery = F.lit("")
    for k, name in names.items():
        discovery = F.when(F.col("w_source") == k, name).otherwise(discovery)
    cached = ok | (F.col("answered") & ~flag.isin("fetch_failed", "extract_failed"))
    return rows.select("seed_pos", flag.alias("flag"), discovery.alias("discovery"), F.when(ok, F.col("w_url")).otherwise(F.col("seed_url")).alias("url"), cached.alias("cached"))


def remaining(rows: DataFrame, accepted: DataFrame, key: str = "seed_pos") -> DataFrame:
    """Rows without an accepted attempt: the next source is asked for these only."""
    return rows.join(accepted.select(key).distinct(), key, "left_anti")


def live_waterfall(rows: DataFrame, rounds, attempt, write) -> DataFrame:
    """The same with paid calls: each round asks its candidates for what is still unresolved, and is written before it is used.

    rounds: functions from unresolved rows to candidates (seed_pos, source, rank, url), called only when their turn comes;
    attempt: candidates to attempts; write: attempts to the same, read back from a table (without page text). Of each
    source the ranks follow one another, so no row pays for a candidate behind its first ok one.
    """
    done, left = None, rows
    for candidates in rounds:
        found = top_candidates(candidates(left), by=("source",))
        for rank in range(1, MOST + 1):
            now = found.where(F.col("rank") == rank)
            now = now if done is None else remaining(now, done.where(F.col("flag") == "ok"))
            if done is not None and now.isEmpty():
                break  # nor is there a candidate of a later rank
            now = write(attempt(now))
            done = now if done is None else done.unionByName(now)
        left = remaining(rows, done.where(F.col("flag") == "ok"))
    return done
