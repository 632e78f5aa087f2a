"""The record cache: hits, stale successes, and what may be written back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.schemas import SCHEMA_VERSION

#: Columns that the seed always decides.
SEED_COLUMNS = ("campus", "region", "latitude", "longitude")


def same_request(seed_url: Column, record_url: Column, year: Column, record_year: Column) -> Column:
    return seed_url.eqNullSafe(record_url) & (year == record_year)


def probe(seed: DataFrame, records: DataFrame) -> DataFrame:
    """seed rows with the cached record of their slug and year: columns cached (the record), hit and stale.

    hit: this schema version, the same url (null equals null) and year, whatever the flag. stale: a success of the same request in an older
    version, kept for when the new attempt fails.
    """
    r = records.select("slug", "year", F.struct(*records.columns).alias("cached"))
    rows = seed.join(r, ["slug", "year"], "left")
    same = same_request(F.col("url"), F.col("cached.seed_url"), F.col("year"), F.col("cached.year"))
    hit = F.coalesce(F.col("cached").isNotNull() & (F.col("cached.schema_version") == SCHEMA_VERSION) & same, F.lit(False))
    stale = F.coalesce(F.col("cached").isNotNull() & ~hit & (F.col("cached.flag") == "ok") & same, F.lit(False))
    return rows.withColumn("hit", hit).withColumn("stale", stale)


def refreshed(record: Column, seed: dict[str, Column]) -> Column:
    """The record with the seed's columns of SEED_COLUMNS."""
    out = record
    for name in SEED_COLUMNS:
        out = out.withField(name, seed[name])
    return out


def keep_stale(new: Column, stale: Column, new_flag: Column) -> Column:
    """The old success where there is one and the new attempt isn't ok."""
    return F.when((new_flag != "ok") & stale.isNotNull(), stale).otherwise(new)


def to_write(rows: DataFrame) -> DataFrame:
    """Records for the cache: no transient failures, no rows restored from a stale success, no unanswered searches."""
    return rows.where(~F.col("flag").isin("fetch_failed", "extract_failed") & ~F.coalesce("restored", F.lit(False)) & F.coalesce("answered", F.lit(True)))
