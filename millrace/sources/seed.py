"""The seed table: one row per event that is to be collected."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import blank_to_null, strip
from millrace.schemas import SEASON_MONTHS

REQUIRED = ("university", "campus", "region", "year", "url", "latitude", "longitude")


class SeedError(ValueError):
    """The seed would give wrong rows; the text says which."""


def seed_path(base: str, year: int) -> str:
    return f"{base.rstrip('/')}/universities-{year}.csv"


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Seed rows in file order (seed_pos), stripped; blank url and season are null, coordinates stay text. The season column may lack."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    if missing := [c for c in REQUIRED if c not in raw.columns]:
        raise SeedError(f"{path} lacks columns: {', '.join(missing)}")
    text = {c: strip(F.coalesce(F.col(c), F.lit(""))) for c in ("university", "campus", "region", "latitude", "longitude")}
    season = blank_to_null(F.col("season")) if "season" in raw.columns else F.lit(None).cast("string")
    rows = raw.select(*(e.alias(c) for c, e in list(text.items())[:3]), strip(F.col("year")).alias("year_text"), blank_to_null(F.col("url")).alias("url"), text["latitude"].alias("latitude"), text["longitude"].alias("longitude"), season.alias("season"), F.monotonically_increasing_id().cast("int").alias("seed_pos"))
    rows = rows.withColumn("year", F.col("year_text").try_cast("int"))
    if bad := [r[0] for r in rows.where("year IS NULL").select("year_text").take(5)]:
        raise SeedError(f"{path}: not a year: {bad}")
    return rows.select("university", "campus", "region", "year", "url", "latitude", "longitude", "season", "seed_pos")


def duplicate_keys(seed: DataFrame) -> DataFrame:
    """Keys that occur more than once; a null season is a value like others."""
    return seed.groupBy("university", "campus", "season").agg(F.count("*").alias("n")).where("n > 1")


def mixed_seasons(seed: DataFrame) -> DataFrame:
    """Universities some rows of which declare a season while others don't."""
    n = seed.groupBy("university").agg(F.count_if(F.col("season").isNull()).alias("without"), F.count_if(F.col("season").isNotNull()).alias("with"))
    return n.where("`without` > 0 AND `with` > 0")


def wrong_years(seed: DataFrame, year: int) -> DataFrame:
    return seed.where(F.col("year") != year).select("year").distinct()


def first_rows(seed: DataFrame, limit: int | None) -> DataFrame:
    """The first `limit` rows of the seed; 0 or none: all."""
    return seed.orderBy("seed_pos").limit(limit) if limit else seed


def load_seed(spark: SparkSession, base: str, year: int, limit: int | None = None) -> DataFrame:
    """The year's seed with its guards: a missing file, unknown or partial seasons, repeated keys and other years stop the run."""
    path = seed_path(base, year)
    if "://" not in path and not os.path.exists(path):
        there = sorted(f for f in (os.listdir(base) if os.path.isdir(base) else ()) if re.fullmatch(r"universities-\d+\.csv", f))
        raise SeedError(f"{path} is missing; there are: {', '.join(there) or 'none'}")
    seed = read_seed(spark, path)
    for rows, text in (
        (seed.where(~F.col("season").isin(*SEASON_MONTHS)).select("university", "season"), "unknown season"),
        (mixed_seasons(seed), "season declared for some rows only"),
        (duplicate_keys(seed), "repeated key"),
        (wrong_years(seed, year), f"year is not {year}"),
    ):
        if found := rows.take(5):
            raise SeedError(f"{text}: {[tuple(r) for r in found]}")
    return first_rows(seed, limit)
