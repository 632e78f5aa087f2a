"""URL expressions by regular expressions: parse_url throws on what real pages hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hosts whose pages can't be used, subdomains included, and the host whose pages are read on its mobile twin.
BLOCKED_HOSTS = ("namu.wiki", "google.com", "search.naver.com", "instagram.com", "youtube.com", "youtu.be")
FRAMED_HOST = "blog.naver.com"


def authority(url: Column) -> Column:
    return F.regexp_extract(url, r"\A(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def host(url: Column) -> Column:
    """Lower-case host without user and port."""
    return F.regexp_extract(F.lower(authority(url)), r"([^@:]*)(?::[^@]*)?\z", 1)


def is_blocked(url: Column, blocked: tuple[str, ...] = BLOCKED_HOSTS) -> Column:
    h = host(url)
    out = h.isin(*blocked)
    for b in blocked:
        out = out | F.endswith(h, F.lit(f".{b}"))
    return out


def readable_url(url: Column, framed: str = FRAMED_HOST) -> Column:
    """The address to read: a host that frames its text is replaced by its mobile one; only that very host."""
    at = framed.replace(".", r"\.")
    return F.regexp_replace(url, rf"\A([A-Za-z][A-Za-z0-9+.-]*://){at}(?=[/?#]|\z)", f"$1m.{framed}")


def safe_url(url: Column) -> Column:
    """http and https only, else ''."""
    return F.when(url.rlike(r"(?i)\Ahttps?://"), url).otherwise("")
