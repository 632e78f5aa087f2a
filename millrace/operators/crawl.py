"""A year's run: seed, candidates and attempts to records, the festivals table and the lineup table."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.keys import cache_slug
from millrace.functions.urls import BLOCKED_HOSTS, is_blocked
from millrace.operators.attempts import discovery_prompt, extracted, extraction_prompt, judged
from millrace.operators.cache import SEED_COLUMNS, keep_stale, probe, refreshed, to_write
from millrace.operators.candidates import MANUAL, SEARCH, SITEMAP, first_ok, live_waterfall, top_candidates, waterfall
from millrace.operators.festivals import build_festivals
from millrace.operators.lineup import build_lineup
from millrace.schemas import FESTIVAL_COLUMNS, LINEUP_COLUMNS, RECORD, SCHEMA_VERSION, SEARCHES
from millrace.sources.files import Files
from millrace.sources.mapping import load_mapping, mapping_frame
from millrace.sources.provider import Provider, ProviderError, parse_answer
from millrace.sources.seed import load_seed
from millrace.sources.sitemap import sitemap_candidates, sitemap_entries
from millrace.sources.tables import export_csv, read_store, update_store
from millrace.sources.web import fetch_pages, http_get, seen_hosts


def manual_candidates(seed: DataFrame) -> DataFrame:
    return seed.where(F.col("url").isNotNull()).select("seed_pos", F.lit(MANUAL).alias("source"), F.lit(1).alias("rank"), "url")


def search_candidates(seed: DataFrame, discovered: DataFrame) -> DataFrame:
    """Candidates of stored searches by slug and year; a null list is an unanswered search, an empty one found nothing."""
    rows = seed.withColumn("slug", cache_slug(F.col("university"), F.col("season"))).join(discovered, ["slug", "year"])
    return rows.select("seed_pos", F.lit(SEARCH).alias("source"), F.posexplode("candidates").alias("p", "url")).select("seed_pos", "source", (F.col("p") + 1).alias("rank"), "url")


def searched(seed: DataFrame, discovered: DataFrame) -> DataFrame:
    rows = seed.withColumn("slug", cache_slug(F.col("university"), F.col("season"))).join(discovered.select("slug", "year", "candidates"), ["slug", "year"], "left")
    return rows.select("seed_pos", F.col("candidates").isNotNull().alias("answered"))


def slugged(seed: DataFrame) -> DataFrame:
    """seed rows with slug, and leader: the first row (least seed_pos) of the same slug, year and url. The others share its record."""
    rows = seed.withColumn("slug", cache_slug(F.col("university"), F.col("season")))
    return rows.withColumn("leader", F.min("seed_pos").over(Window.partitionBy("slug", "year", "url")))


def to_search(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Of rows (with slug) whose slug and year have no known search, the first of each: a search is asked for once."""
    missing = rows.join(known.select("slug", "year"), ["slug", "year"], "left_anti")
    return missing.groupBy("slug", "year").agg(F.min_by(F.struct(*rows.columns), "seed_pos").alias("r")).select("r.*")


def shared(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The state (by seed_pos) of every row of `slugged`: its leader's, with the row's own seed columns."""
    own = rows.select("seed_pos", "leader", *(F.col(c).alias(f"__{c}") for c in SEED_COLUMNS))
    got = own.join(state.withColumnRenamed("seed_pos", "leader"), "leader")
    return got.select("seed_pos", *(F.col(f"__{c}").alias(c) if c in SEED_COLUMNS else F.col(c) for c in state.columns if c != "seed_pos"))


def fresh_records(state: DataFrame, names: list[str]) -> DataFrame:
    """Of each slug and year the last row (by seed_pos) that may be cached and wasn't a hit."""
    rows = to_write(state).where("NOT hit").select("seed_pos", *names)
    return rows.groupBy("slug", "year").agg(F.max_by(F.struct(*names), "seed_pos").alias("r")).select("r.*")


def fresh_searches(known: DataFrame, found: DataFrame) -> DataFrame:
    """Searches to keep: one a slug and year that isn't known; failed ones (null candidates) aren't kept."""
    return found.join(known.select("slug", "year"), ["slug", "year"], "left_anti").where("candidates IS NOT NULL").dropDuplicates(["slug", "year"])


def stored_records(state: DataFrame, cached: DataFrame) -> DataFrame:
    """The record table after a run: fresh records, and the cached ones of other slugs and years."""
    names = cached.columns
    fresh = fresh_records(state, names)
    return cached.join(fresh.select("slug", "year"), ["slug", "year"], "left_anti").select(*names).unionByName(fresh)


def stored_searches(known: DataFrame, found: DataFrame) -> DataFrame:
    """The table of searches after a run: one a slug and year, known ones first; failed ones (null candidates) aren't kept."""
    return known.where("candidates IS NOT NULL").dropDuplicates(["slug", "year"]).unionByName(fresh_searches(known, found))


def sitemap_as_candidates(found: DataFrame) -> DataFrame:
    return found.select("seed_pos", F.lit(SITEMAP).alias("source"), "rank", "url")


def records(seed: DataFrame, attempts: DataFrame, search: DataFrame, cached: DataFrame) -> DataFrame:
    """The final record of every seed row, with restored (from a stale success), answered and hit; positions kept in seed_pos.

    attempts: judged ones (seed_pos, source, rank, url, flag, poster_image_url, image_urls, extraction, published_at, date_warning).
    """
    detail = ["poster_image_url", "image_urls", "extraction", "published_at", "date_warning"]
    state = waterfall(seed, attempts, search)
    won = first_ok(top_candidates(attempts, by=("source",)), order=("source", "rank")).select("seed_pos", *(F.col(c).alias(f"w_{c}") for c in detail))
    own = attempts.where(F.col("source") == MANUAL).select("seed_pos", *(F.col(c).alias(f"m_{c}") for c in detail))
    rows = seed.select("seed_pos", "university", "campus", "region", "year", "latitude", "longitude", "season", F.col("url").alias("seed_url")).join(state, "seed_pos").join(won, "seed_pos", "left").join(own, "seed_pos", "left").join(search, "seed_pos", "left")
    rows = rows.withColumn("slug", cache_slug(F.col("university"), F.col("season")))
    picked = [F.when(F.col("flag") == "ok", F.col(f"w_{c}")).otherwise(F.col(f"m_{c}")).alias(c) for c in detail]
    names = cached.columns
    new = rows.select("seed_pos", "slug", F.lit(SCHEMA_VERSION).alias("schema_version"), "university", "campus", "region", "year", "latitude", "longitude", "seed_url", "url", "discovery", "flag", *picked, F.coalesce("answered", F.lit(True)).alias("answered"))
    known = probe(seed.withColumn("slug", cache_slug(F.col("university"), F.col("season"))), cached).select("seed_pos", "cached", "hit", "stale")
    both = new.join(known, "seed_pos")
    fresh = F.struct(*(F.col(c) for c in names))
    seed_side = {c: F.col(c) for c in ("campus", "region", "latitude", "longitude")}
    old = refreshed(F.col("cached"), seed_side)
    final = F.when(F.col("hit"), old).otherwise(keep_stale(fresh, F.when(F.col("stale"), old), F.col("flag")))
    out = both.select("seed_pos", "answered", "hit", (F.col("stale") & (F.col("flag") != "ok")).alias("restored"), final.alias("r"))
    return out.select("seed_pos", "answered", "hit", "restored", "r.*")


#: What a stored record or search is known by.
STORE_KEYS = ("slug", "year")


class OldLayout(RuntimeError):
    """The base folder holds files of an older layout, which a run would mix with its own."""


def discovered_now(rows: DataFrame, provider: Provider, blocked: tuple[str, ...] = BLOCKED_HOSTS) -> DataFrame:
    """slug, year, season and candidates of seed rows, each asked for once: null if the call or its answer failed, else the addresses in order without blocked hosts. Write it before using it twice."""
    asked = rows.select(cache_slug(F.col("university"), F.col("season")).alias("slug"), "year", "season", discovery_prompt(F.col("university"), F.col("year"), F.col("season")).alias("prompt"))

    def run(batches):
        for batch in batches:
            found = []
            for prompt in batch["prompt"]:
                try:
                    found.append([c["url"] for c in parse_answer(provider(prompt), "discovery")["candidates"]])
                except (ProviderError, ValueError):
                    found.append(None)
            out = batch[["slug", "year", "season"]].copy()
            out["candidates"] = pd.Series(found, index=out.index, dtype=object)
            yield out

    got = asked.mapInPandas(run, SEARCHES)
    return got.withColumn("candidates", F.filter("candidates", lambda u: ~is_blocked(u, blocked)))


def attempt(candidates: DataFrame, seed: DataFrame, get: Callable, provider: Provider, hosts: DataFrame | None = None) -> DataFrame:
    """Judged attempts of candidates (seed_pos, source, rank, url): fetch, prompt, answer, verification, and what was seen of the hosts. Page text isn't among the columns."""
    pages = fetch_pages(candidates, get, hosts)
    asked = seed.select("seed_pos", "university", "year", "season")
    rows = candidates.join(asked, "seed_pos").join(pages, "url")
    prompt = extraction_prompt(F.col("university"), F.col("year"), F.col("instagram_candidates"), F.col("body"))
    rows = rows.select("seed_pos", "source", "rank", "url", "status", "poster_image_url", "image_urls", "published_at", "university", "year", "season", "site", "asked_at", "robots", "body", prompt.alias("prompt"))
    return judged(extracted(rows, provider)).select("seed_pos", "source", "rank", "url", "flag", "poster_image_url", "image_urls", "extraction", "published_at", "date_warning", "site", "asked_at", "robots")


def run(spark: SparkSession, base: str, year: int, provider: Provider, get: Callable = http_get, sitemaps: DataFrame | None = None, limit: int | None = None, seed_dir: str | None = None, search: Provider | None = None) -> dict[str, int]:
    """One year from seed to festivals.csv and lineup.csv; returns flag counts.

    provider answers extractions, search the searches for addresses (provider too, if there is no other). Rows of the same slug, year and url
    are one request, whose record they share. Cached records answer for their rows; of the rest each round asks only what is unresolved and is written before it is used. Searches are
    kept unless they failed. Records, searches and attempts are Parquet under base; the two CSV files are written at the end.
    """
    files = Files(spark)
    for old in ("raw", "festivals.csv"):
        if files.exists(f"{base}/{old}"):
            raise OldLayout(f"{base} holds {old} of an older layout; move what is of one year to {base}/{year} first")
    seed = load_seed(spark, seed_dir or base, year, limit)
    names = mapping_frame(spark, load_mapping(os.path.join(base, "artist_mapping.json")))
    staging = f"{base}/.staging-{uuid.uuid4().hex}"  # beside the tables, where all executors write
    count = iter(range(1_000_000))

    def kept(df: DataFrame) -> DataFrame:
        path = f"{staging}/{next(count)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        return _run(spark, base, year, provider, search or provider, get, sitemaps, kept(slugged(seed)), names, kept)
    finally:
        files.remove(staging)


def _run(spark, base, year, provider, search, get, sitemaps, rows, names, kept) -> dict[str, int]:
    record_path, search_path = f"{base}/records", f"{base}/discovered"
    cached = kept(read_store(spark, record_path, RECORD).dropDuplicates(["slug", "year"]))
    known = kept(read_store(spark, search_path, SEARCHES).dropDuplicates(["slug", "year"]))
    seed = rows.where("seed_pos = leader")
    todo = kept(probe(seed, cached).where("NOT hit").select(*seed.columns))
    new = {"searches": spark.createDataFrame([], SEARCHES)}

    def by_sitemap(left: DataFrame) -> DataFrame:
        if sitemaps is None:
            return manual_candidates(left).where("false")
        return sitemap_as_candidates(sitemap_candidates(left, sitemap_entries(sitemaps)))

    def by_search(left: DataFrame) -> DataFrame:
        new["searches"] = kept(discovered_now(to_search(left, known), search))
        return search_candidates(left, known.unionByName(new["searches"]))

    rounds: list[DataFrame] = []  # what each has fetched: the next one goes on from it

    def next_round(c: DataFrame) -> DataFrame:
        return attempt(c, seed, get, provider, seen_hosts(*rounds) if rounds else None)

    def kept_round(df: DataFrame) -> DataFrame:
        rounds.append(kept(df))
        return rounds[-1]

    attempts = live_waterfall(todo, [manual_candidates, by_sitemap, by_search], next_round, kept_round)
    asked = todo.join(known.unionByName(new["searches"]).select("slug", "year", "candidates"), ["slug", "year"])
    own = kept(records(seed, attempts, asked.select("seed_pos", F.col("candidates").isNotNull().alias("answered")), cached))
    state = kept(shared(rows, own))
    if (n := state.count()) != (wanted := rows.count()):
        raise RuntimeError(f"{n} records for {wanted} seed rows")
    update_store(spark, record_path, RECORD, STORE_KEYS, fresh_records(own, cached.columns))
    update_store(spark, search_path, SEARCHES, STORE_KEYS, fresh_searches(known, new["searches"]))

    out = f"{base}/{year}"
    rows = state.withColumn("rec_id", F.col("seed_pos"))
    export_csv(build_festivals(rows, "rec_id"), f"{out}/festivals.csv", FESTIVAL_COLUMNS, ["rec_id"])
    export_csv(build_lineup(rows, names).withColumn("revealed", F.col("revealed").cast("string")), f"{out}/lineup.csv", LINEUP_COLUMNS, ["rec_id", "item_pos", "split_pos"])
    return {r[0]: r[1] for r in state.groupBy("flag").count().collect()}


def clear_cache(spark: SparkSession, base: str, year: int, slug: str, rediscover: bool = False) -> None:
    """Takes a slug's record of a year, and with rediscover its search, out of the stores; the same again changes nothing."""
    key = spark.createDataFrame([(slug, year)], "slug string, year int")
    for name, schema in (("records", RECORD), ("discovered", SEARCHES))[: 1 + rediscover]:
        path = f"{base}/{name}"
        if Files(spark).exists(path):
            update_store(spark, path, schema, STORE_KEYS, gone=key)
