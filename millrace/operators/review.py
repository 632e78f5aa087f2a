"""Tables for human review."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.keys import cache_slug, key_prefix
from millrace.schemas import ARTIST_COLUMNS, FESTIVAL_COLUMNS, LINEUP_COLUMNS
from millrace.sources.tables import read_table


def slug_map(seed: DataFrame) -> DataFrame:
    """prefix, slug: of each university-campus-year the slug of its first seed row."""
    prefix = F.concat_ws("-", "university", "campus", F.col("year").cast("string")).alias("prefix")
    return seed.groupBy(prefix).agg(F.min_by(cache_slug(F.col("university"), F.col("season")), "seed_pos").alias("slug"))


def with_slugs(festivals: DataFrame, slugs: DataFrame) -> DataFrame:
    """festivals with cache_slug, the host's name where no seed row has the key's prefix."""
    s = slugs.select(F.col("prefix").alias("__prefix"), F.col("slug").alias("__slug"))
    got = festivals.join(s, key_prefix(F.col("import_key")) == F.col("__prefix"), "left")
    return got.withColumn("cache_slug", F.coalesce("__slug", "host_name")).drop("__prefix", "__slug")


def visible(festivals: DataFrame, view: str = "problem") -> DataFrame:
    """problem: what isn't OK; search: what was found by sitemap or search; all."""
    if view == "problem":
        return festivals.where(F.col("flag") != "OK")
    return festivals.where(F.col("discovery").isin("SITEMAP", "SEARCH")) if view == "search" else festivals


def details(festivals: DataFrame, lineup: DataFrame) -> DataFrame:
    """Festivals with their lineup rows; empty keys join nothing."""
    return festivals.where("import_key <> ''").join(lineup, "import_key")


def lineup_counts(festivals: DataFrame, lineup: DataFrame) -> DataFrame:
    n = lineup.groupBy("import_key").agg(F.count("*").alias("n"))
    return festivals.join(n, "import_key", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def sorted_artists(artists: DataFrame) -> DataFrame:
    """Those to review first, else in file order."""
    return artists.orderBy(F.desc("needs_review"), "pos")


def load_review(spark: SparkSession, base: str, year: int, seed: DataFrame) -> dict[str, DataFrame]:
    """festivals (with cache_slug), lineup and artists as reviewed; tables that don't exist yet are empty."""
    out = os.path.join(base, str(year))
    festivals = read_table(spark, os.path.join(out, "festivals.csv"), FESTIVAL_COLUMNS)
    return {
        "festivals": with_slugs(festivals, slug_map(seed)), "lineup": read_table(spark, os.path.join(out, "lineup.csv"), LINEUP_COLUMNS),
        "artists": read_table(spark, os.path.join(base, "artists.csv"), ARTIST_COLUMNS),
    }


def flag_counts(df: DataFrame, column: str = "flag") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def month_counts(festivals: DataFrame) -> DataFrame:
    """Events by year and month, months as columns m00 to m12."""
    months = [f"{m:02d}" for m in range(13)]
    t = festivals.groupBy("year").pivot("month", months).agg(F.count(F.lit(1)))
    return t.select("year", *(F.coalesce(F.col(f"`{m}`"), F.lit(0)).alias(f"m{m}") for m in months))
