"""Verification of extracted records against what was asked for. Unknown is not wrong."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.schemas import SEASON_MONTHS


def season_match(start_date: Column, season: Column) -> Column:
    """Whether the date's month lies in the season; true without season, date or readable month."""
    month = F.substring(start_date, 6, 2).try_cast("int")
    out = F.lit(True)
    for name, (low, high) in SEASON_MONTHS.items():
        out = F.when(season == name, month.between(low, high)).otherwise(out)
    return F.coalesce(out, F.lit(True))


def verify(found: Column, name: Column, year: Column, start_date: Column, university: Column, asked_year: Column, season: Column) -> Column:
    """Found, a name that holds the asked one or is held by it, no other year, and the season's month."""
    same = (name != "") & (F.contains(university, name) | F.contains(name, university))
    right_year = year.isNull() | (year == asked_year)
    return F.coalesce(found, F.lit(False)) & F.coalesce(same, F.lit(False)) & right_year & season_match(start_date, season)


def date_warning(published_at: Column, year: Column) -> Column:
    """A note if the first year 20xx in the published date is another than the asked one, else null."""
    own = F.regexp_extract(published_at, r"(20\d\d)", 1)
    note = F.concat(F.lit("출처 게시 연도 "), own, F.lit(" != 요청 연도 "), year.cast("string"))
    return F.when((own != "") & (own != year.cast("string")), note)
