"""The jobs as registered queries: each runs its job twice into one new folder and returns what stands there then."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import page_intake, season_tables


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under spark.checkpoint.dir; only a local session may do without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="millrace-")
    return f"{root.rstrip('/')}/millrace/{name}-{uuid.uuid4().hex}"


def job1_page_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "page-intake")
    for _ in range(2):
        page_intake.run(spark, f"{sf_dir}/pages.parquet", f"{folder}/output", f"{folder}/checkpoint", {"blocked": ["example.org", "www.cheap-pills.example.com"]})
    return page_intake.read_state(spark, f"{folder}/output").drop("bucket", "as_of_batch", "as_of_rows")


def job2_season_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "season-tables")
    for _ in range(2):
        season_tables.run(spark, {n: f"{sf_dir}/{n}.parquet" for n in season_tables.INPUTS}, folder)
    got = season_tables.read_tables(spark, folder)
    return got.withColumns({"day": F.col("day").cast("long"), "order": F.col("order").cast("long"), "year": F.col("year").cast("long")})


QUERIES = {"job1_page_intake": job1_page_intake, "job2_season_tables": job2_season_tables}

ORACLES = {
    "job1_page_intake": r"""
WITH p AS (
    SELECT page_id, url, html, regexp_replace(regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1), '(?s)<(script|style)[^>]*>.*?</(script|style)>', '', 'g') AS inside,
        regexp_replace(regexp_extract(lower(url), '^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)', 1), '(^.*@)|(:[^@]*$)', '', 'g') AS host FROM pages
), t AS (
    SELECT *, array_to_string(list_filter(list_transform(string_split(regexp_replace(inside, '<[^>]+>', chr(10), 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10)) AS text,
        nullif(trim(regexp_extract(html, '<meta property="og:image" content="([^"]*)"', 1)), '') AS poster_url,
        list_filter(list_transform(regexp_extract_all(html, '<img\b[^>]*>'), lambda x: coalesce(nullif(regexp_extract(x, '\ssrc="\s*([^"]*?)\s*"', 1), ''), nullif(regexp_extract(x, '\sdata-src="\s*([^"]*?)\s*"', 1), ''))), lambda x: regexp_matches(x, '^https?://')) AS images,
        list_filter(list_transform(regexp_extract_all(html, '(?:^|[/."''\s])(?:www\.)?instagram\.com/([A-Za-z0-9_.]{2,30})', 1), lambda x: rtrim(lower(x), '.')), lambda x: NOT list_contains(['p', 'reel', 'reels', 'explore', 'accounts', 'stories', 'share'], x)
            AND NOT regexp_matches(x, '(^|\.)(js|css|json|png|jpg|jpeg|gif|svg|ico|html)$')) AS accounts,
        coalesce(nullif(regexp_extract(html, '<meta (?:property|name)="article:published_time" content="\s*([^"]*?)\s*"', 1), ''), nullif(regexp_extract(html, '<meta (?:property|name)="og:regDate" content="\s*([^"]*?)\s*"', 1), ''),
            nullif(regexp_extract(html, '<meta (?:property|name)="datePublished" content="\s*([^"]*?)\s*"', 1), ''), nullif(regexp_extract(html, '"datePublished"\s*:\s*"\s*([^"]*?)\s*"', 1), ''),
            nullif(regexp_extract(html, 'class="(?:blog_date|se_publishDate|article-date)"[^>]*>\s*([^<]*?)\s*<', 1), ''), nullif(regexp_extract(html, '<time[^>]*\sdatetime="\s*([^"]*?)\s*"', 1), ''), nullif(regexp_extract(html, '<time[^>]*>\s*([^<]*?)\s*<', 1), '')) AS published_at
    FROM p
), s AS (
    SELECT coalesce(nullif(trim(url), ''), 'page ' || page_id, '') AS address, page_id, url, host, CASE WHEN length(text) >= 100 THEN left(text, 8000) END AS body, CASE WHEN html IS NULL THEN 'fetch_failed' WHEN length(text) >= 100 THEN 'ok' ELSE 'empty_body' END AS flag,
        poster_url, published_at, nullif(regexp_extract(published_at, '(20\d\d)', 1), '') AS own_year,
        array_to_string(list_filter(images, lambda x, i: list_position(images, x) = i)[:5], '|') AS image_urls, array_to_string(list_filter(accounts, lambda x, i: list_position(accounts, x) = i), '|') AS handles FROM t
), best AS (SELECT *, count(*) OVER (PARTITION BY address) AS n_attempts FROM s QUALIFY row_number() OVER (PARTITION BY address ORDER BY flag = 'ok' DESC, page_id DESC NULLS LAST, md5(body) DESC NULLS LAST) = 1)
SELECT address, page_id, url, regexp_replace(url, '^([A-Za-z][A-Za-z0-9+.-]*://)blog\.naver\.com([/?#]|$)', '\1m.blog.naver.com\2') AS read_url, host, coalesce(regexp_matches(host, '(^|\.)(example\.org|www\.cheap-pills\.example\.com)$'), false) AS blocked, flag, length(body) AS n_chars, md5(body) AS body_md5,
    poster_url, image_urls, handles, published_at, CASE WHEN own_year <> '2026' THEN '출처 게시 연도 ' || own_year || ' != 요청 연도 2026' END AS date_warning, n_attempts FROM best
""",
    "job2_season_tables": """
WITH rec AS (
    SELECT o_orderkey AS rec_id, year(o_orderdate) AS year, strftime(o_orderdate, '%m') AS mm, n_name AS u, c_mktsegment AS campus, o_orderstatus AS st, o_orderpriority AS pr, o_orderdate AS d,
        o_orderstatus <> 'P' AND CASE c_custkey % 3 WHEN 0 THEN month(o_orderdate) BETWEEN 3 AND 6 WHEN 1 THEN month(o_orderdate) BETWEEN 9 AND 11 ELSE true END AS ok
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderdate IS NOT NULL
), item AS (
    SELECT rec_id, year, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_returnflag = 'A' AS secret, CASE WHEN l_linenumber <> 7 THEN ((l_linenumber - 1) // 3 + 1)::BIGINT END AS day,
        row_number() OVER (PARTITION BY rec_id ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag = 'A') AS pos FROM rec JOIN lineitem ON l_orderkey = rec_id WHERE ok
), part_of AS (SELECT *, unnest(CASE WHEN secret THEN [''] WHEN n % 3 = 0 THEN ['P' || p, 'S' || s] ELSE ['P' || p] END) AS raw, unnest(CASE WHEN NOT secret AND n % 3 = 0 THEN [0, 1] ELSE [0] END) AS sp FROM item),
l AS (
    SELECT rec_id, year, day, row_number() OVER (PARTITION BY rec_id, day ORDER BY pos, sp) AS "order", raw AS artist_raw, CASE WHEN secret THEN '' ELSE coalesce(p_name, raw) END AS artist_canonical, NOT secret AS revealed, p_name IS NOT NULL AS known
    FROM part_of LEFT JOIN (SELECT * FROM part WHERE p_partkey % 3 = 0) ON raw = 'P' || p_partkey
), a AS (SELECT year, artist_canonical, count(DISTINCT rec_id) AS n_festivals, count(*) AS n_rows, count(DISTINCT artist_raw) AS n_raw_names, NOT bool_or(known) AS needs_review FROM l WHERE revealed GROUP BY ALL)
SELECT rec_id, r.year, l.artist_canonical, u || '-' || campus || '-' || r.year || '-' || mm AS import_key, u AS host_name, pr AS name, strftime(d, '%Y-%m-%d') AS start_date, st || '|' || pr AS hashtags, 'order/' || rec_id AS source_url, 'MANUAL' AS discovery,
    CASE WHEN ok THEN 'OK' ELSE 'MISMATCH' END AS flag, day, "order", artist_raw, revealed, n_festivals, n_rows, n_raw_names, needs_review
FROM rec r LEFT JOIN l USING (rec_id) LEFT JOIN a ON a.year = r.year AND a.artist_canonical = l.artist_canonical
""",
}
