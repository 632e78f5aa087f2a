"""Candidate addresses from sitemaps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.text import percent_decode, strip
from millrace.functions.urls import is_blocked
from millrace.operators.containment import containing


# The sitemaps that are read, in the order of their candidates.
SITEMAP_SOURCES = (
    "https://memogipost.tistory.com/sitemap.xml",
    "https://news.comingmoney.com/sitemap.xml",
    "https://schedule.comingmoney.com/sitemap.xml",
    "https://jcks100.com/sitemap.xml",
    "https://towbworld.tistory.com/sitemap.xml",
)


def read_sitemaps(spark: SparkSession, text: Callable[[str], str | None], sources: tuple[str, ...] = SITEMAP_SOURCES) -> DataFrame:
    """source_pos and xml of the sources, each read once by `text` (such as Fetcher().text); null where it failed."""
    return spark.createDataFrame([(i, text(url)) for i, url in enumerate(sources)], "source_pos int, xml string")


def sitemap_entries(sitemaps: DataFrame) -> DataFrame:
    """url, source_pos and loc_pos of the <loc> elements that are entries, from (source_pos, xml). A failed source has null xml and gives none.

    Not made distinct: the order of sources and places is the order of candidates. A sitemap may come in parts, one a row, ordered
    by a column part: its places are counted through all of them. Only sizes of parts are put in order for that.
    """
    locs = F.regexp_extract_all("xml", F.lit(r"(?s)<loc>(.*?)</loc>"), F.lit(1))
    found = sitemaps.where(F.col("xml").isNotNull())
    if "part" in sitemaps.columns:
        before = Window.partitionBy("source_pos").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        sizes = found.select("source_pos", "part", F.regexp_count("xml", F.lit(r"(?s)<loc>(.*?)</loc>")).alias("n"))
        starts = sizes.select("source_pos", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
        found = found.join(starts, ["source_pos", "part"]).select("source_pos", "start", F.posexplode(locs).alias("p", "loc")).withColumn("loc_pos", F.col("start") + F.col("p"))
    else:
        found = found.select("source_pos", F.posexplode(locs).alias("loc_pos", "loc"))
    return found.select("source_pos", "loc_pos", percent_decode(strip(F.col("loc"))).alias("url")).where(F.contains("url", F.lit("/entry/")))


def sitemap_candidates(seed: DataFrame, entries: DataFrame, most: int | None = None) -> DataFrame:
    """seed_pos, url and rank (from 1, in sitemap order) of entries whose address holds the university's name and the year, blocked hosts aside.

    Names are looked up in an index of the addresses' characters (`containing`), whatever their number; seed rows that ask for the same are looked up
    once. most: only so many of each seed row. A seed row without a name has no candidates.
    """
    s = seed.select("seed_pos", "university", F.col("year").cast("string").alias("year"))
    asked = s.select("university", "year").distinct()
    hit = containing(entries.where(~is_blocked(F.col("url"))), asked, "url", "university").where(F.contains("url", F.col("year")))
    got = ranked(hit, ["university", "year"], "source_pos", "loc_pos").select("university", "year", "url", "rank")
    return (got.where(F.col("rank") <= most) if most else got).join(s, ["university", "year"]).select("seed_pos", "url", "rank")


def ranked(df: DataFrame, key: str | list[str], *order: str) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
