"""Queries over records: answers, verification, keys, cache, festivals."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import judge, keys, text
from millrace.functions.strict_json import strict_json
from millrace.operators import attempts, cache, festivals, lineup
from millrace.plans.pages import table
from millrace.schemas import EXTRACTION
from millrace.sources import seed


def json_slice(spark, sf_dir):
    """Event properties within fences and words, cut out and read."""
    fenced = F.concat(F.lit("answer {:\n```json\n"), F.regexp_replace("props", r"^\{", '{"v": 1, '), F.lit("\n```"))
    raw = F.when(F.col("event_id") % 10 == 0, F.lit("no object")).otherwise(F.replace(fenced, F.lit("answer {:"), F.lit("answer:")))
    part = text.json_slice(raw)
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(part, "$.k").cast("long").alias("k"), part.isNotNull().alias("has_object"))


def answers(spark, sf_dir):
    """Answers to extraction prompts made from orders; some lack a field, some have a bad value."""
    o = table(spark, sf_dir, "orders")
    year = F.when(F.col("o_orderkey") % 5 == 0, '"soon"').otherwise(F.concat(F.lit('"'), F.year("o_orderdate").cast("string"), F.lit('"')))
    name = F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.concat(F.lit(', "university_name": "U'), (F.col("o_custkey") % 9).cast("string"), F.lit('"')))
    raw = F.concat(F.lit('```{"found": true, "year": '), year, name, F.lit(', "lineup": [{"artist_raw": "A & B", "day": 1}]}```'))
    return o.select("o_orderkey", raw.alias("raw"))


def json_strict(spark, sf_dir):
    got = answers(spark, sf_dir).select("o_orderkey", strict_json(F.col("raw")).alias("a"))
    return got.select("o_orderkey", F.col("a.value.university_name").alias("name"), F.col("a.value.year").cast("long").alias("year"), F.coalesce(F.array_size("a.value.lineup"), F.lit(0)).cast("long").alias("n"), F.col("a.error").isNull().alias("valid"))


def retry_first_valid(spark, sf_dir):
    """Turns of conversations as answers: the first of the first two turns that is long enough."""
    c = table(spark, sf_dir, "conversations").withColumn("n", F.row_number().over(_by_turn()))
    got = attempts.first_valid(c, "conv_id", F.length("text") >= 200, order="n")
    return got.select("conv_id", F.col("n").cast("long").alias("attempt"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


def _by_turn():
    from pyspark.sql import Window

    return Window.partitionBy("conv_id").orderBy("turn", "role", "text")


def asked(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    i = F.col("o_orderkey")
    return o.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.when(i % 3 == 0, "spring").when(i % 3 == 1, "fall").alias("season"),
        F.when(i % 6 != 0, F.year("o_orderdate")).alias("year"), (F.lit(1992) + (i % 7).cast("int")).alias("asked_year"), (i % 10 != 0).alias("found"),
        F.when(i % 8 == 0, "").when(i % 8 == 1, "Univ 3 North").otherwise(F.concat(F.lit("Univ "), (i % 4).cast("string"))).alias("name"), F.lit("Univ 3").alias("university"),
    )


ASKED = """a AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE o_orderkey % 3 WHEN 0 THEN 'spring' WHEN 1 THEN 'fall' END AS season,
    CASE WHEN o_orderkey % 6 <> 0 THEN year(o_orderdate) END AS year, 1992 + o_orderkey % 7 AS asked_year, o_orderkey % 10 <> 0 AS found,
    CASE o_orderkey % 8 WHEN 0 THEN '' WHEN 1 THEN 'Univ 3 North' ELSE 'Univ ' || (o_orderkey % 4) END AS name, 'Univ 3' AS university FROM orders),
b AS (SELECT *, CASE season WHEN 'spring' THEN month(day::DATE) BETWEEN 3 AND 6 WHEN 'fall' THEN month(day::DATE) BETWEEN 9 AND 11 ELSE true END AS season_ok FROM a)"""


def verify_rows(spark, sf_dir):
    a = asked(spark, sf_dir)
    c = F.col
    return a.select("o_orderkey", judge.verify(c("found"), c("name"), c("year"), c("day"), c("university"), c("asked_year"), c("season")).alias("verified"))


def season_match(spark, sf_dir):
    odd = F.when(F.col("o_orderkey") % 4 == 0, "2026-봄").otherwise(F.col("day"))
    return asked(spark, sf_dir).select("o_orderkey", judge.season_match(odd, F.col("season")).alias("matches"))


def date_warning(spark, sf_dir):
    said = F.concat(F.lit("posted 20"), F.substring("day", 3, 2), F.lit(" or 2031"))
    return asked(spark, sf_dir).select("o_orderkey", judge.date_warning(said, F.col("asked_year") + 8).alias("warning"))


def placed(spark, sf_dir):
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])


def import_keys(spark, sf_dir):
    day = F.when(F.col("o_orderkey") % 9 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    key = keys.import_key(F.col("n_name"), F.col("c_mktsegment"), F.year("o_orderdate"), keys.festival_month(day))
    return placed(spark, sf_dir).select("o_orderkey", key.alias("import_key"), keys.key_prefix(key).alias("prefix"), keys.cache_slug(F.col("n_name"), F.when(F.col("o_orderkey") % 2 == 0, "spring")).alias("slug"))


def festival_month(spark, sf_dir):
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    odd = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit(" "), d, F.lit("\n"))).when(F.col("o_orderkey") % 5 == 1, F.concat(d, F.lit("T"))).when(F.col("o_orderkey") % 5 == 2, F.lit(None)).otherwise(d)
    return table(spark, sf_dir, "orders").select("o_orderkey", keys.festival_month(odd).alias("month"), keys.month_label(odd).alias("label"))


def cache_hit_stale(spark, sf_dir):
    """Latest event of a user as cached record, customers as seed: hits, stale successes, refreshed columns, kept successes."""
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type"), "event_id").alias("e"))
    i = F.col("e.event_id")
    records = e.select(
        F.col("user_id").cast("string").alias("slug"), F.lit(2026).alias("year"), F.when(i % 2 == 0, 4).when(i % 3 == 0, 3).alias("schema_version"), F.when(i % 5 != 0, F.lit("u")).alias("seed_url"),
        F.when(i % 7 == 0, "fetch_failed").otherwise("ok").alias("flag"), F.lit("old").alias("campus"), F.lit("r").alias("region"), F.lit("1").alias("latitude"), F.lit("2").alias("longitude"), F.col("e.event_type").alias("name"),
    )
    s = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("slug"), F.lit(2026).alias("year"), F.when(F.col("c_custkey") % 4 != 0, "u").alias("url"), F.col("c_mktsegment").alias("campus"), F.col("c_custkey"))
    p = cache.probe(s, records)
    old = cache.refreshed(F.col("cached"), {c: F.col("campus") if c == "campus" else F.lit("x") for c in cache.SEED_COLUMNS})
    kept = cache.keep_stale(F.struct(F.lit("new").alias("name")), F.when(F.col("stale"), F.struct(old["name"].alias("name"))), F.when(F.col("c_custkey") % 2 == 0, "ok").otherwise("mismatch"))
    return p.select(F.col("c_custkey"), "hit", "stale", F.when(F.col("cached").isNotNull(), old["campus"]).alias("campus"), kept["name"].alias("kept"))


def sanitize_cells(spark, sf_dir):
    mark = F.element_at(F.array(*map(F.lit, ("=", "+", "-", "@", ""))), (F.col("p_partkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", text.sanitize_cell(F.when(F.col("p_partkey") % 11 != 0, F.concat(mark, "p_name"))).alias("cell"))


def made_records(spark, sf_dir):
    """Records with extractions made from orders and their lines."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    item = F.struct(F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit(" & S"), F.col("l_suppkey").cast("string"), F.lit(" & "))).otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("artist_raw"), F.when(F.col("l_linenumber") % 4 != 0, (F.col("l_linenumber") % 2 + 1).cast("int")).alias("day"), (F.col("l_partkey") % 10 == 0).alias("is_secret"))
    items = l.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", item.alias("i"), F.col("l_partkey"), F.col("l_suppkey")))), lambda x: x["i"]).alias("lineup"))
    o = table(spark, sf_dir, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"))
    have = {"found": F.lit(True), "university_name": F.lit("U"), "year": F.year("o_orderdate"), "festival_name": F.col("o_orderpriority"), "start_date": F.when(F.col("o_orderkey") % 9 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")), "admission_raw": F.repeat("o_orderpriority", 40), "hashtags": F.array("o_orderstatus", "o_orderpriority"), "instagram_handle": F.when(F.col("o_orderkey") % 2 == 0, F.lit("h")), "lineup": F.col("lineup")}
    from millrace.schemas import struct

    fields = struct(f"e {EXTRACTION}")["e"].dataType.fields
    extraction = F.when(F.col("o_orderkey") % 13 != 0, F.struct(*(have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields)))
    return o.select(F.col("o_orderkey").alias("rec_id"), F.lit("U").alias("university"), F.col("o_orderstatus").alias("campus"), F.year("o_orderdate").alias("year"), F.lit("37.5").alias("latitude"), F.lit("-127").alias("longitude"), F.lit(None).cast("string").alias("poster_image_url"), F.array(F.lit("a"), F.lit("b")).alias("image_urls"), extraction.alias("extraction"), F.lit("u").alias("url"), F.lit("manual").alias("discovery"), F.when(F.col("o_orderkey") % 5 == 0, "mismatch").otherwise("ok").alias("flag"))


def festivals_table(spark, sf_dir):
    return festivals.build_festivals(made_records(spark, sf_dir))


def names_mapping(spark, sf_dir):
    return table(spark, sf_dir, "part").where("p_partkey % 3 = 0").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("artist_raw"), F.col("p_name").alias("artist_canonical"))


def lineup_table(spark, sf_dir):
    got = lineup.build_lineup(made_records(spark, sf_dir), names_mapping(spark, sf_dir))
    return got.select("rec_id", "import_key", F.col("day").cast("long").alias("day"), F.col("order").cast("long").alias("order"), "artist_raw", "artist_canonical", "revealed")


MADE = """items AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 3 = 0 THEN 'P' || l_partkey || ' & S' || l_suppkey || ' & ' ELSE 'P' || l_partkey END AS raw,
    CASE WHEN l_linenumber % 4 <> 0 THEN l_linenumber % 2 + 1 END AS day, l_partkey % 10 = 0 AS secret,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, raw, day, secret, l_partkey, l_suppkey) - 1 AS pos FROM lineitem),
recs AS (SELECT o_orderkey AS rec_id, 'U-' || o_orderstatus || '-' || year(o_orderdate) || '-' || CASE WHEN o_orderkey % 9 <> 0 AND o_orderkey % 13 <> 0 THEN strftime(o_orderdate, '%m') ELSE '00' END AS import_key,
    o_orderkey % 13 <> 0 AS has, o_orderkey % 5 <> 0 AS ok, * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))"""


def seed_duplicates(spark, sf_dir):
    return _as_seed(spark, sf_dir).transform(seed.duplicate_keys).select("university", "campus", "season", "n")


def _as_seed(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(F.col("n_name").alias("university"), F.col("c_mktsegment").alias("campus"), F.when(F.col("c_custkey") % 3 == 0, "spring").when((F.col("c_custkey") % 3 == 1) | (F.col("c_nationkey") % 2 == 0), "fall").alias("season"), (F.lit(2020) + F.col("c_custkey") % 4).cast("int").alias("year"))


def season_all_or_none(spark, sf_dir):
    return _as_seed(spark, sf_dir).transform(seed.mixed_seasons)


def year_homogeneity(spark, sf_dir):
    return seed.wrong_years(_as_seed(spark, sf_dir), 2020)


QUERIES = {f.__name__: f for f in (json_slice, json_strict, retry_first_valid, verify_rows, season_match, date_warning, import_keys, festival_month, cache_hit_stale, sanitize_cells, festivals_table, lineup_table, seed_duplicates, season_all_or_none, year_homogeneity)}

AS_SEED = """s AS (SELECT n_name AS university, c_mktsegment AS campus, CASE WHEN c_custkey % 3 = 0 THEN 'spring' WHEN c_custkey % 3 = 1 OR c_nationkey % 2 = 0 THEN 'fall' END AS season, (2020 + c_custkey % 4)::INTEGER AS year
    FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

ORACLES = {
    "json_slice": "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN (props::JSON->>'$.k')::BIGINT END AS k, event_id % 10 <> 0 AS has_object FROM events",
    "json_strict": """
SELECT o_orderkey, CASE WHEN v THEN 'U' || (o_custkey % 9) END AS name, CASE WHEN v THEN year(o_orderdate) END AS year, CASE WHEN v THEN 1 ELSE 0 END::BIGINT AS n, v AS valid
FROM (SELECT *, o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AS v FROM orders)""",
    "retry_first_valid": """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM conversations)
SELECT conv_id, min(n) AS attempt, md5(min_by(text, n)) AS text_md5 FROM n WHERE n <= 2 AND length(text) >= 200 GROUP BY conv_id""",
    "verify_rows": f"WITH {ASKED} SELECT o_orderkey, found AND name <> '' AND (contains(university, name) OR contains(name, university)) AND (year IS NULL OR year = asked_year) AND season_ok AS verified FROM b",
    "season_match": f"WITH {ASKED} SELECT o_orderkey, o_orderkey % 4 = 0 OR season_ok AS matches FROM b",
    "date_warning": f"WITH {ASKED} SELECT o_orderkey, CASE WHEN '20' || substr(day, 3, 2) <> (asked_year + 8)::VARCHAR THEN '출처 게시 연도 20' || substr(day, 3, 2) || ' != 요청 연도 ' || (asked_year + 8) END AS warning FROM b",
    "import_keys": """
SELECT o_orderkey, p || '-' || CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%m') ELSE '00' END AS import_key, p AS prefix, CASE WHEN o_orderkey % 2 = 0 THEN n_name || '-spring' ELSE n_name END AS slug
FROM (SELECT *, n_name || '-' || c_mktsegment || '-' || year(o_orderdate) AS p FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""",
    "festival_month": """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (1, 2) THEN '00' ELSE strftime(o_orderdate, '%m') END AS month,
    CASE WHEN o_orderkey % 5 IN (0, 2) THEN '월 미상' ELSE month(o_orderdate) || '월' END AS label FROM orders""",
    "cache_hit_stale": """
WITH e AS (SELECT user_id, max(event_id) AS i, max_by(event_type, event_id) AS name FROM events GROUP BY 1),
j AS (SELECT c.*, e.*, CASE WHEN c_custkey % 4 <> 0 THEN 'u' END AS url, CASE WHEN i % 5 <> 0 THEN 'u' END AS old_url, CASE WHEN i % 2 = 0 THEN 4 WHEN i % 3 = 0 THEN 3 END AS v FROM customer c LEFT JOIN e ON c_custkey = user_id),
h AS (SELECT *, coalesce(i IS NOT NULL AND v = 4 AND url IS NOT DISTINCT FROM old_url, false) AS hit FROM j),
s AS (SELECT *, coalesce(i IS NOT NULL AND NOT hit AND i % 7 <> 0 AND url IS NOT DISTINCT FROM old_url, false) AS stale FROM h)
SELECT c_custkey, hit, stale, CASE WHEN i IS NOT NULL THEN c_mktsegment END AS campus, CASE WHEN c_custkey % 2 <> 0 AND stale THEN name ELSE 'new' END AS kept FROM s""",
    "sanitize_cells": """
SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 5 < 4 THEN '''' || ['=', '+', '-', '@'][p_partkey % 5 + 1] || p_name WHEN left(p_name, 1) IN ('=', '+', '-', '@') THEN '''' || p_name ELSE p_name END AS cell FROM part""",
    "festivals_table": f"""
WITH {MADE}
SELECT import_key, 'U' AS host_name, CASE WHEN has THEN o_orderpriority ELSE '' END AS name, CASE WHEN has AND o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS start_date, '' AS end_date, '' AS venue_name,
    '37.5' AS latitude, '-127' AS longitude, '' AS poster_url, 'a|b' AS image_urls, '' AS description, CASE WHEN has THEN o_orderstatus || '|' || o_orderpriority ELSE '' END AS hashtags, '' AS external_visitor_policy, '' AS verification_method,
    '' AS ticket_type, '' AS ticket_open_at, CASE WHEN has THEN left(repeat(o_orderpriority, 40), 200) ELSE '' END AS admission_raw, 'u' AS source_url, 'MANUAL' AS discovery, CASE WHEN ok THEN 'OK' ELSE 'MISMATCH' END AS flag,
    CASE WHEN has AND o_orderkey % 2 = 0 THEN 'https://www.instagram.com/h/' ELSE '' END AS instagram_url FROM recs""",
    "lineup_table": f"""
WITH {MADE},
parts AS (SELECT i.*, import_key, CASE WHEN secret THEN [''] ELSE list_filter(list_transform(string_split(raw, ' & '), lambda x: trim(x)), lambda x: x <> '') END AS names FROM items i JOIN recs ON l_orderkey = rec_id WHERE has AND ok),
each AS (SELECT *, unnest(names) AS name, generate_subscripts(names, 1) AS sp FROM parts)
SELECT l_orderkey AS rec_id, import_key, day::BIGINT AS day, row_number() OVER (PARTITION BY l_orderkey, day ORDER BY pos, sp) AS "order", name AS artist_raw,
    CASE WHEN secret THEN '' ELSE coalesce((SELECT p_name FROM part WHERE p_partkey % 3 = 0 AND 'P' || p_partkey = name), name) END AS artist_canonical, NOT secret AS revealed FROM each""",
    "seed_duplicates": f"WITH {AS_SEED} SELECT university, campus, season, count(*) AS n FROM s GROUP BY ALL HAVING count(*) > 1",
    "season_all_or_none": f"WITH {AS_SEED} SELECT university, count(*) FILTER (season IS NULL) AS \"without\", count(season) AS \"with\" FROM s GROUP BY 1 HAVING count(season) > 0 AND count(*) > count(season)",
    "year_homogeneity": f"WITH {AS_SEED} SELECT DISTINCT year FROM s WHERE year <> 2020",
}
