"""Keys and labels derived from record fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def festival_month(start_date: Column) -> Column:
    """MM of a date YYYY-MM-DD, white space around it aside; 00 for anything else. The month's range isn't checked."""
    month = F.regexp_extract(strip(start_date), r"\A\d{4}-(\d{2})-\d{2}\z", 1)
    return F.when(F.coalesce(month, F.lit("")) == "", "00").otherwise(month)


def import_key(university: Column, campus: Column, year: Column, month: Column) -> Column:
    part = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat_ws("-", *(part(c) for c in (university, campus, year, month)))


def cache_slug(university: Column, season: Column) -> Column:
    """The university, with the season behind it if one is declared."""
    return F.concat_ws("-", university, season)


def key_prefix(key: Column) -> Column:
    """An import key without its month."""
    return F.regexp_replace(key, r"-[^-]*\z", "")


def month_label(start_date: Column) -> Column:
    month = F.regexp_extract(F.coalesce(start_date, F.lit("")), r"\A\d{4}-(\d{2})-", 1)
    return F.when(month == "", "월 미상").otherwise(F.concat(month.try_cast("int").cast("string"), F.lit("월")))
