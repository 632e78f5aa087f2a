"""Queries over pages: text, links, images, handles, dates, candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import pages as P
from millrace.functions import readability, text, urls
from millrace.operators import candidates, review
from millrace.sources import sitemap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def signalled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with signals before their html that real festival pages have, made from page_id."""
    i = F.col("page_id").cast("string")
    day = F.concat(F.lit("2026-05-"), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0"))
    head = F.concat(
        F.when(F.col("page_id") % 4 == 0, F.concat(F.lit('<meta property="article:published_time" content=" '), day, F.lit('">'))).otherwise(""),
        F.when(F.col("page_id") % 4 <= 1, F.concat(F.lit('<script type="application/ld+json">{"@graph":[{"datePublished":"'), day, F.lit('T00:00"}]}</script>'))).otherwise(""),
        F.when(F.col("page_id") % 4 == 2, F.concat(F.lit('<span class="blog_date"> '), day, F.lit(" 게시</span>"))).otherwise(""),
        F.lit('<meta property="og:image" content="https://img.example/'), i, F.lit('.jpg">'),
        F.lit('<img src="https://img.example/a'), (F.col("page_id") % 3).cast("string"), F.lit('.png"><img data-src="https://img.example/b.png"><img src="/rel.png"><img src="https://img.example/b.png"><img src="https://img.example/c'), i, F.lit('.png">'),
        F.lit('<a href="https://www.instagram.com/Acc.'), i, F.lit('./"></a><a href="https://instagram.com/p/x"></a><script src="//instagram.com/embed.js"></script><a href="https://instagram.com/festa_'), (F.col("page_id") % 5).cast("string"), F.lit('"></a>'),
    )
    return pages(spark, sf_dir).select("page_id", "url", F.concat(head, "html").alias("html"))


SIGNALLED = """
SELECT page_id, url,
    CASE WHEN page_id % 4 = 0 THEN '<meta property="article:published_time" content=" 2026-05-' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') || '">' ELSE '' END
 || CASE WHEN page_id % 4 <= 1 THEN '<script type="application/ld+json">{"@graph":[{"datePublished":"2026-05-' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') || 'T00:00"}]}</script>' ELSE '' END
 || CASE WHEN page_id % 4 = 2 THEN '<span class="blog_date"> 2026-05-' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') || ' 게시</span>' ELSE '' END
 || '<meta property="og:image" content="https://img.example/' || page_id || '.jpg">'
 || '<img src="https://img.example/a' || (page_id % 3) || '.png"><img data-src="https://img.example/b.png"><img src="/rel.png"><img src="https://img.example/b.png"><img src="https://img.example/c' || page_id || '.png">'
 || '<a href="https://www.instagram.com/Acc.' || page_id || './"></a><a href="https://instagram.com/p/x"></a><script src="//instagram.com/embed.js"></script><a href="https://instagram.com/festa_' || (page_id % 5) || '"></a>'
 || html AS html FROM pages"""

BODY = """
WITH inner_html AS (SELECT page_id, regexp_replace(regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1), '(?s)<(script|style)[^>]*>.*?</(script|style)>', '', 'g') AS h FROM pages),
body AS (SELECT page_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(h, '<[^>]+>', chr(10), 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10)) AS t FROM inner_html)
"""


def page_body(spark, sf_dir):
    body = P.article_text(F.col("html"))
    return pages(spark, sf_dir).select("page_id", F.md5(body.cast("binary")).alias("body_md5"), F.length(body).cast("long").alias("n_chars"))


def page_main_text(spark, sf_dir):
    """The text that stands out from menus and links, of pages whose article element is an anonymous one."""
    html = F.replace(F.replace("html", F.lit("<article>"), F.lit("<div>")), F.lit("</article>"), F.lit("</div>"))
    text = readability.main_text(html)
    return pages(spark, sf_dir).select("page_id", F.size(readability.blocks(html)).cast("long").alias("n_blocks"), F.length(text).cast("long").alias("n_chars"), F.md5(text.cast("binary")).alias("text_md5"))


def page_flag_counts(spark, sf_dir):
    return review.flag_counts(pages(spark, sf_dir).select(P.page_flag(P.article_text(F.col("html"))).alias("flag")))


def page_host(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", urls.host(F.col("url")).alias("host"))


BLOCKED = ("example.org", "www.cheap-pills.example.com")


def blocked_pages(spark, sf_dir):
    return pages(spark, sf_dir).where(urls.is_blocked(F.col("url"), BLOCKED)).select("page_id", "url")


def page_links_top5(spark, sf_dir):
    links = F.slice(F.array_distinct(F.regexp_extract_all("html", F.lit(r'href="(/[^"]*)"'), F.lit(1))), 1, 5)
    return pages(spark, sf_dir).select("page_id", F.posexplode(links).alias("pos", "link")).select("page_id", F.col("pos").cast("long").alias("pos"), "link")


def host_rewrite(spark, sf_dir):
    host = urls.authority(F.col("url"))
    return pages(spark, sf_dir).select("page_id", urls.readable_url(F.regexp_replace("url", "://blog\\.", "://"), "ththan.example.net").alias("read_url"), host.alias("host"))


def safe_urls(spark, sf_dir):
    odd = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("javascript:"), "url")).otherwise(F.col("url"))
    return pages(spark, sf_dir).select("page_id", urls.safe_url(odd).alias("url"))


def html_escapes(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", F.md5(text.html_escape(F.col("html")).cast("binary")).alias("escaped_md5"))


def og_image(spark, sf_dir):
    return signalled(spark, sf_dir).select("page_id", P.og_image(F.col("html")).alias("poster_url"))


def body_images(spark, sf_dir):
    return signalled(spark, sf_dir).select("page_id", F.array_join(P.image_urls(F.col("html")), "|").alias("image_urls"))


def handles(spark, sf_dir):
    return signalled(spark, sf_dir).select("page_id", F.array_join(P.handles(F.col("html")), "|").alias("handles"))


def published_date_priority(spark, sf_dir):
    return signalled(spark, sf_dir).select("page_id", P.published(F.col("html")).alias("published_at"))


def html_parse_udf(spark, sf_dir):
    got = P.parse_pages(signalled(spark, sf_dir)).select("page_id", "page.*")
    return got.select("page_id", F.length("body").alias("n_chars"), "poster_image_url", F.array_join("image_urls", "|").alias("image_urls"), F.array_join("instagram_candidates", "|").alias("handles"), "published_at")


def maps(spark, sf_dir):
    """Four sitemaps from the pages' urls, percent-escaped in part; each comes in parts of at most 1,000 places, so that no row grows with the pages."""
    loc = F.concat(F.lit("<loc> "), F.replace("url", F.lit("example"), F.lit("/entry/%65xample+")), F.lit("\n</loc>"))
    return pages(spark, sf_dir).groupBy((F.col("page_id") % 4).cast("int").alias("source_pos"), F.floor(F.col("page_id") / 4000).alias("part")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", loc.alias("x")))), lambda s: s["x"]), "").alias("xml"))


def sitemap_locs(spark, sf_dir):
    return sitemap.sitemap_entries(maps(spark, sf_dir)).select("source_pos", F.col("loc_pos").cast("long").alias("loc_pos"), "url")


ASKED = [(0, "/en/", 7), (1, "/fr/", 1), (2, "/de/", 25), (3, "/es/", 3), (4, "/xx/", 1)]


def sitemap_match(spark, sf_dir):
    seed = spark.createDataFrame(ASKED, "seed_pos int, university string, year int")
    entries = pages(spark, sf_dir).select(F.col("url"), F.lit(0).alias("source_pos"), F.col("page_id").alias("loc_pos")).where(~urls.is_blocked(F.col("url"), ("example.org",)))
    return sitemap.sitemap_candidates(seed, entries).select("seed_pos", "url", F.col("rank").cast("long").alias("rank"))


def sitemap_match_many(spark, sf_dir):
    """All customers as asked names, each with a year; entries are made from orders, whose addresses hold the name and the year of the order."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    seed = c.select(F.col("c_custkey").cast("int").alias("seed_pos"), F.concat("c_name", F.lit("/")).alias("university"), (F.lit(1992) + F.col("c_custkey") % 7).cast("int").alias("year"))
    url = F.concat(F.lit("https://maps.example/entry/"), "c_name", F.lit("/"), F.year("o_orderdate"), F.lit("-"), F.lower("o_orderpriority"))
    entries = o.join(c.hint("merge"), F.col("o_custkey") == F.col("c_custkey")).select(url.alias("url"), F.lit(0).alias("source_pos"), F.col("o_orderkey").alias("loc_pos"))
    return sitemap.sitemap_candidates(seed, entries, candidates.MOST).select("seed_pos", "url", F.col("rank").cast("long").alias("rank"))


def by_host(spark, sf_dir):
    """Candidates per host with a flag made from page_id."""
    p = pages(spark, sf_dir).select(urls.host(F.col("url")).alias("host"), "page_id", "url")
    return p.withColumn("flag", F.when(F.col("page_id") % 3 == 0, "ok").when(F.col("page_id") % 3 == 1, "mismatch").otherwise("fetch_failed"))


RANKED = """ranked AS (SELECT regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1) AS host, page_id, url, CASE page_id % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'mismatch' ELSE 'fetch_failed' END AS flag,
    row_number() OVER (PARTITION BY regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1) ORDER BY page_id) AS rank FROM pages)"""


def first_of_host(spark, sf_dir):
    """The first candidates of each host with their ranks: cut before they are numbered, so that the limit stands below the shuffle."""
    return sitemap.ranked(candidates.top_candidates(by_host(spark, sf_dir), "host", order="page_id"), "host", "page_id")


def candidates_top3(spark, sf_dir):
    return first_of_host(spark, sf_dir).select("host", "page_id", F.col("rank").cast("long").alias("rank"))


def first_ok_candidate(spark, sf_dir):
    got = candidates.first_ok(first_of_host(spark, sf_dir), "host")
    return got.select("host", "page_id", F.col("rank").cast("long").alias("rank"))


def waterfall(spark, sf_dir):
    """Seed: every page. Manual, sitemap and search attempts with flags made from page_id; a page in seven has no url, one in eleven no search answer."""
    p = pages(spark, sf_dir).select(F.col("page_id").cast("int").alias("seed_pos"), F.when(F.col("page_id") % 7 != 0, F.col("url")).alias("url"))
    n = F.col("seed_pos")
    manual = p.where("url IS NOT NULL").select("seed_pos", F.lit(0).alias("source"), F.lit(1).alias("rank"), "url", F.element_at(F.array(*map(F.lit, ("ok", "fetch_failed", "mismatch", "empty_body", "extract_failed"))), (n % 5 + 1).cast("int")).alias("flag"))
    more = lambda source, mod, most: p.select("seed_pos", F.lit(source).alias("source"), F.explode(F.sequence(F.lit(1), F.lit(most))).alias("rank")).select("*", F.concat(F.lit(f"s{source}-"), F.col("rank").cast("string")).alias("url"), F.when((n + F.col("rank")) % mod == 0, "ok").otherwise("mismatch").alias("flag"))
    search = p.select("seed_pos", (n % 11 != 0).alias("answered"))
    attempts = manual.unionByName(more(1, 9, 5)).unionByName(more(2, 13, 4).join(search.where("answered"), "seed_pos", "left_semi"))
    return candidates.waterfall(p, attempts, search)


QUERIES = {f.__name__: f for f in (page_body, page_main_text, page_flag_counts, page_host, blocked_pages, page_links_top5, host_rewrite, safe_urls, html_escapes, og_image, body_images, handles, published_date_priority, html_parse_udf, sitemap_locs, sitemap_match, sitemap_match_many, candidates_top3, first_ok_candidate, waterfall)}

ORACLES = {
    "page_body": BODY + "SELECT page_id, CASE WHEN length(t) >= 100 THEN md5(left(t, 8000)) END AS body_md5, CASE WHEN length(t) >= 100 THEN length(left(t, 8000)) END AS n_chars FROM body",
    "page_main_text": f"""
WITH p AS (SELECT page_id, unnest(l) AS part, generate_subscripts(l, 1) AS i FROM (
    SELECT page_id, regexp_split_to_array(regexp_replace(replace(replace(html, '<article>', '<div>'), '</article>', '</div>'), '{readability.HIDDEN_PATTERN}', ' ', 'g'), '{readability.BLOCK_PATTERN}') AS l FROM pages)),
t AS (SELECT page_id, i, trim(regexp_replace(regexp_replace(part, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text,
    trim(regexp_replace(regexp_replace(array_to_string(regexp_extract_all(part, '(?is)<a\b[^>]*>(.*?)</a\s*>', 1), ' '), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS links FROM p),
w AS (SELECT page_id, i, text, len(string_split(text, ' ')) AS words, CASE WHEN links = '' THEN 0 ELSE len(string_split(links, ' ')) END / len(string_split(text, ' ')) AS linked FROM t WHERE text <> ''),
n AS (SELECT *, coalesce(lag(words) OVER s, 0) AS words_before, coalesce(lag(linked) OVER s, 0) AS linked_before, coalesce(lead(words) OVER s, 0) AS words_after FROM w WINDOW s AS (PARTITION BY page_id ORDER BY i)),
k AS (SELECT *, linked <= 0.333333 AND CASE WHEN linked_before <= 0.555556 THEN words > 16 OR words_after > 15 OR words_before > 4 ELSE words > 40 OR words_after > 17 END AS keep FROM n),
b AS (SELECT page_id, count(*) AS n_blocks, string_agg(text, chr(10) ORDER BY i) FILTER (keep) AS t FROM k GROUP BY 1)
SELECT page_id, coalesce(n_blocks, 0) AS n_blocks, CASE WHEN length(t) >= 100 THEN length(left(t, 8000)) END AS n_chars, CASE WHEN length(t) >= 100 THEN md5(left(t, 8000)) END AS text_md5 FROM pages LEFT JOIN b USING (page_id)""",
    "page_flag_counts": BODY + "SELECT CASE WHEN length(t) >= 100 THEN 'ok' ELSE 'empty_body' END AS flag, count(*) AS n FROM body GROUP BY 1",
    "page_host": "SELECT page_id, regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1) AS host FROM pages",
    "blocked_pages": "SELECT page_id, url FROM pages WHERE regexp_matches(regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1), '(^|\\.)(example\\.org|www\\.cheap-pills\\.example\\.com)$')",
    "page_links_top5": """
WITH l AS (SELECT page_id, regexp_extract_all(html, 'href="(/[^"]*)"', 1) AS a FROM pages),
u AS (SELECT page_id, unnest(a) AS link, generate_subscripts(a, 1) AS i FROM l),
d AS (SELECT page_id, link, min(i) AS i FROM u GROUP BY ALL)
SELECT page_id, pos, link FROM (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos, link FROM d) WHERE pos < 5""",
    "host_rewrite": r"""
SELECT page_id, CASE WHEN regexp_extract(replace(url, '://blog.', '://'), '^[a-z]+://([^/?#]*)', 1) = 'ththan.example.net'
    THEN replace(replace(url, '://blog.', '://'), '://ththan.example.net', '://m.ththan.example.net') ELSE replace(url, '://blog.', '://') END AS read_url,
    regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host FROM pages""",
    "safe_urls": "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '' ELSE url END AS url FROM pages",
    "html_escapes": "SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')) AS escaped_md5 FROM pages",
    "og_image": "SELECT page_id, 'https://img.example/' || page_id || '.jpg' AS poster_url FROM pages",
    "body_images": "SELECT page_id, 'https://img.example/a' || (page_id % 3) || '.png|https://img.example/b.png|https://img.example/c' || page_id || '.png' AS image_urls FROM pages",
    "handles": f"""
WITH s AS ({SIGNALLED}), m AS (SELECT page_id, regexp_extract_all(html, '(?:^|[/.\"''\\s])(?:www\\.)?instagram\\.com/([A-Za-z0-9_.]{{2,30}})', 1) AS a FROM s),
u AS (SELECT page_id, rtrim(lower(unnest(a)), '.') AS h, generate_subscripts(a, 1) AS i FROM m),
d AS (SELECT page_id, h, min(i) AS i FROM u WHERE regexp_extract(h, '([^.]*)$', 1) NOT IN ('js','css','json','png','jpg','jpeg','gif','svg','ico','html') AND h NOT IN ('p','reel','reels','explore','accounts','stories','share') GROUP BY ALL)
SELECT page_id, string_agg(h, '|' ORDER BY i) AS handles FROM d GROUP BY page_id""",
    "published_date_priority": """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN d WHEN 1 THEN d || 'T00:00' WHEN 2 THEN d || ' 게시' END AS published_at
FROM (SELECT page_id, '2026-05-' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') AS d FROM pages)""",
    "sitemap_locs": """
SELECT (page_id % 4)::INTEGER AS source_pos, row_number() OVER (PARTITION BY page_id % 4 ORDER BY page_id) - 1 AS loc_pos, replace(url, 'example', '/entry/example+') AS url
FROM pages""",
    "sitemap_match": """
WITH a(seed_pos, u, y) AS (VALUES (0, '/en/', '7'), (1, '/fr/', '1'), (2, '/de/', '25'), (3, '/es/', '3'), (4, '/xx/', '1'))
SELECT seed_pos, url, row_number() OVER (PARTITION BY seed_pos ORDER BY page_id) AS rank
FROM pages JOIN a ON contains(url, u) AND contains(url, y) WHERE NOT regexp_matches(regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1), '(^|\\.)example\\.org$')""",
    "sitemap_match_many": """
WITH e AS (SELECT 'https://maps.example/entry/' || c_name || '/' || year(o_orderdate) || '-' || lower(o_orderpriority) AS url, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey),
m AS (SELECT c_custkey::INTEGER AS seed_pos, url, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) AS rank FROM e JOIN customer ON contains(url, c_name || '/') AND contains(url, (1992 + c_custkey % 7)::VARCHAR))
SELECT seed_pos, url, rank FROM m WHERE rank <= 3""",
    "candidates_top3": f"WITH {RANKED} SELECT host, page_id, rank FROM ranked WHERE rank <= 3",
    "first_ok_candidate": f"WITH {RANKED} SELECT host, min(page_id) AS page_id, min(rank) AS rank FROM ranked WHERE rank <= 3 AND flag = 'ok' GROUP BY host",
    "waterfall": """
WITH p AS (SELECT page_id::INTEGER AS n, CASE WHEN page_id % 7 <> 0 THEN url END AS url, page_id % 11 <> 0 AS answered FROM pages),
s AS (SELECT *, CASE WHEN url IS NOT NULL THEN ['ok','fetch_failed','mismatch','empty_body','extract_failed'][n % 5 + 1] END AS m,
    list_min(list_filter([1,2,3], lambda r: (n + r) % 9 = 0)) AS r1, CASE WHEN answered THEN list_min(list_filter([1,2,3], lambda r: (n + r) % 13 = 0)) END AS r2 FROM p)
SELECT n AS seed_pos,
    CASE WHEN m = 'ok' OR r1 IS NOT NULL OR r2 IS NOT NULL THEN 'ok' WHEN m IS NOT NULL THEN m WHEN answered THEN 'no_candidate' ELSE 'no_source' END AS flag,
    CASE WHEN m = 'ok' THEN 'manual' WHEN r1 IS NOT NULL THEN 'sitemap' WHEN r2 IS NOT NULL THEN 'search' ELSE '' END AS discovery,
    CASE WHEN m = 'ok' THEN url WHEN r1 IS NOT NULL THEN 's1-' || r1 WHEN r2 IS NOT NULL THEN 's2-' || r2 ELSE url END AS url,
    coalesce(m = 'ok', false) OR r1 IS NOT NULL OR r2 IS NOT NULL OR (answered AND coalesce(m, '') NOT IN ('fetch_failed', 'extract_failed')) AS cached FROM s""",
}
