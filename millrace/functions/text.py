"""Text expressions. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.schemas import SEASON_WORDS


def strip(c: Column) -> Column:
    """Without white space, Unicode's too, at both ends."""
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def blank_to_null(c: Column) -> Column:
    s = strip(c)
    return F.when(s != "", s)


def sanitize_cell(c: Column) -> Column:
    """Null as '', and a leading ' before text that a spreadsheet would take for a formula."""
    t = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(F.substring(t, 1, 1).isin("=", "+", "-", "@"), F.concat(F.lit("'"), t)).otherwise(t)


def truncate(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def json_slice(c: Column) -> Column:
    """From the first { to the last }, whatever stands around; null without such a part."""
    part = F.regexp_extract(c, r"(?s)(\{.*\})", 1)
    return F.when(part != "", part)


def percent_decode(c: Column) -> Column:
    """Percent escapes decoded, + kept; a malformed escape stays as it is, and text around it is decoded. Escapes that don't make UTF-8 give replacement characters."""
    sound = F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(F.replace(sound, F.lit("+"), F.lit("%2B"))), c)


def season_word(season: Column) -> Column:
    """The word that a prompt adds for a season, with its leading blank."""
    out = F.lit("")
    for name, word in SEASON_WORDS.items():
        out = F.when(season == name, word).otherwise(out)
    return out


def html_escape(c: Column) -> Column:
    out = c
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out
