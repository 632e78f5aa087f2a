"""Live fetching: robots, one request at a time and host with a pause, two tries. Offline runs use a table of pages instead."""

from __future__ import annotations

import codecs
import http.client
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from urllib import request, robotparser
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.pages import parse_page
from millrace.functions.urls import authority, host, readable_url

AGENT = "millrace/0.1"
#: What a request may raise: refusals, addresses that are none, broken answers.
FAILURES = (OSError, ValueError, http.client.HTTPException)
PAUSE, TIMEOUT, TRIES = 3.0, 10, 2
FETCHED = "url string, status string, body string, poster_image_url string, image_urls array<string>, instagram_candidates array<string>, published_at string, error string"
#: What is known of an address's host (and port): when it was asked last, in seconds since 1970, and its robots file, '' if it has none.
HOST = "site string, asked_at double, robots string"


def http_get(url: str) -> tuple[bytes, str | None]:
    """Bytes and declared charset; raises OSError for refusals and statuses from 400 on."""
    with request.urlopen(request.Request(url, headers={"User-Agent": AGENT}), timeout=TIMEOUT) as r:
        return r.read(), r.headers.get_content_charset()


def decode(data: bytes, charset: str | None) -> str:
    """By the charset that the server declares, replacing what doesn't fit. Without one: by a byte order mark, as UTF-8, by what the document declares, as Korean; the first that fits."""
    if charset and _known(charset):
        return data.decode(charset, "replace")
    marked = next((name for mark, name in MARKS if data.startswith(mark)), None)
    said = DECLARED.search(data[:2048])
    names = [marked, "utf-8", said and _WIDER.get(said[1].decode().lower(), said[1].decode()), "cp949"]
    for name in names:
        if name and _known(name):
            try:
                return data.decode(name)
            except UnicodeDecodeError:
                continue
    return data.decode("utf-8", "replace")


#: Byte order marks, what a document's head says of its charset, and supersets that browsers read in place of a declared one.
MARKS = ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"))
DECLARED = re.compile(rb"""(?i)(?:charset|encoding)\s*=\s*["']?([a-z0-9_-]+)""")
_WIDER = {"euc-kr": "cp949", "ks_c_5601-1987": "cp949", "iso-8859-1": "cp1252", "shift_jis": "cp932", "gb2312": "gb18030"}


def _known(charset: str) -> bool:
    try:
        return bool(codecs.lookup(charset))
    except LookupError:
        return False


@dataclass
class Fetcher:
    """Robots files and last requests of hosts. The clock is the time of day, as other tasks go on from what one has seen (`known`)."""

    get: Callable[[str], tuple[bytes, str | None]] = http_get
    clock: Callable[[], float] = time.time
    sleep: Callable[[float], None] = time.sleep
    robots: dict = field(default_factory=dict)
    last: dict = field(default_factory=dict)

    def known(self, name: str, asked_at: float | None, robots: str | None) -> None:
        """Takes over what an earlier task has seen of a host."""
        if asked_at is not None:
            self.last[name] = max(asked_at, self.last.get(name, asked_at))
        if robots is not None and name not in self.robots:
            self.robots[name] = robots

    def wait(self, name: str) -> None:
        if name in self.last and (left := PAUSE - (self.clock() - self.last[name])) > 0:
            self.sleep(left)
        self.last[name] = self.clock()

    def allowed(self, url: str) -> bool:
        """By the host's robots file, read once; a missing or unreachable one forbids nothing."""
        name = urlparse(url).netloc
        if name not in self.robots:
            try:
                self.robots[name] = decode(*self.get(f"https://{name}/robots.txt"))
            except FAILURES:
                self.robots[name] = ""
        rules = robotparser.RobotFileParser()
        rules.parse(self.robots[name].splitlines())
        return not self.robots[name] or rules.can_fetch(AGENT, url)

    def text(self, url: str) -> str | None:
        """One try; None on any failure or refusal."""
        try:
            if not self.allowed(url):
                return None
            self.wait(urlparse(url).netloc)
            return decode(*self.get(url))
        except FAILURES:
            return None

    def page(self, url: str, read: str) -> dict:
        """status ok, fetch_failed or empty_body, and what the page tells. `read` is the address that is opened."""
        row = dict.fromkeys(x.split()[0] for x in FETCHED.split(", ")) | {"url": url, "status": "fetch_failed", "image_urls": [], "instagram_candidates": []}
        try:
            name = urlparse(read).netloc
            if not self.allowed(read):
                return row | {"error": "robots"}
        except ValueError as e:  # not an address at all
            return row | {"error": str(e)}
        for _ in range(TRIES):
            self.wait(name)
            try:
                html = decode(*self.get(read))
            except FAILURES as e:
                row["error"] = str(e) or type(e).__name__
                continue
            row |= parse_page(html, read)
            return row | {"status": "ok" if row["body"] else "empty_body", "error": None}
        return row


def fetch_pages(urls: DataFrame, get: Callable = http_get, hosts: DataFrame | None = None, make: Callable[[Callable], Fetcher] = Fetcher) -> DataFrame:
    """FETCHED and HOST rows of distinct urls. All of a host are in one task, which keeps the pause; write the result before using it twice.

    hosts: HOST rows of earlier rounds (`seen_hosts`): their pauses are kept through rounds and their robots files aren't read again.
    """
    todo = urls.select("url").distinct().withColumn("read", readable_url(F.col("url"))).withColumn("site", authority(F.col("read")))
    seen = hosts if hosts is not None else urls.sparkSession.createDataFrame([], HOST)
    todo = todo.join(seen.select("site", "asked_at", "robots"), "site", "left").repartition(host(F.col("read")))
    names = [x.split()[0] for x in f"{FETCHED}, {HOST}".split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = make(get)
        for batch in batches:
            rows = []
            for url, read, site, asked_at, robots in zip(*(batch[c] for c in ("url", "read", "site", "asked_at", "robots")), strict=True):
                f.known(site, None if pd.isna(asked_at) else float(asked_at), robots)
                row = f.page(url, read)
                rows.append(row | {"site": site, "asked_at": f.last.get(site), "robots": f.robots.get(site)})
            yield pd.DataFrame(rows, columns=names).astype({"asked_at": "float64"})

    return todo.mapInPandas(run, f"{FETCHED}, {HOST}")


def seen_hosts(*rounds: DataFrame) -> DataFrame:
    """HOST rows, one a host, from what rounds have fetched."""
    every = reduce(DataFrame.unionByName, (r.select("site", "asked_at", "robots") for r in rounds))
    return every.groupBy("site").agg(F.max("asked_at").alias("asked_at"), F.max("robots").alias("robots"))
