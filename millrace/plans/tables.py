"""Queries over the reviewed tables and names."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from millrace import streaming
from millrace.operators import candidates, lineup, names, review
from millrace.plans.naming import shared_folder
from millrace.plans.pages import table
from millrace.sources import seed, tables


def joint_split(spark, sf_dir):
    raw = F.when(F.col("p_partkey") % 4 == 0, F.concat("p_name", F.lit(" & "), "p_brand", F.lit(" & & & "), "p_type")).when(F.col("p_partkey") % 4 == 1, F.lit(" & ")).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(lineup.split_joint(raw), "|").alias("names"))


def lineup_order(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linenumber") % 2).cast("int").alias("day"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice").alias("item_pos"), F.lit(0).alias("split_pos"), "l_partkey")  # noqa: E741
    return lineup.numbered(l, "l_orderkey").select("l_orderkey", F.col("day").cast("long").alias("day"), F.col("order").cast("long").alias("order"), "l_partkey")


def _mapping(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("artist_raw")).agg(F.min("p_brand").alias("artist_canonical")).where("length(artist_raw) % 2 = 0")


def canonical_map(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("name"), (F.col("p_partkey") % 10 == 0).alias("is_secret"))
    return lineup.canonical(p, _mapping(spark, sf_dir)).select("p_partkey", "artist_canonical")


def merged_mapping(spark, sf_dir):
    answer = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("artist_raw")).agg(F.max("p_brand").alias("artist_canonical"))
    asked = table(spark, sf_dir, "part").where("p_size < 10").select(F.col("p_type").alias("artist_raw")).distinct()
    return names.merged_mapping(_mapping(spark, sf_dir), answer, asked)


def new_names(spark, sf_dir):
    return names.new_names(table(spark, sf_dir, "part").select(F.col("p_type").alias("artist_raw")).distinct(), _mapping(spark, sf_dir))


def merge_artists(spark, sf_dir):
    old = table(spark, sf_dir, "supplier").select(F.concat(F.lit("N"), (F.col("s_suppkey") * 3).cast("string")).alias("name"), F.lit("img").alias("image_url"), F.col("s_suppkey").cast("int").alias("pos"))
    found = table(spark, sf_dir, "part").select(F.concat(F.lit("N"), (F.col("p_partkey") % 150).cast("string")).alias("name"), F.col("p_partkey").cast("int").alias("pos"))
    return names.merge_artists(old, found)


def alias_merge(spark, sf_dir):
    english = F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand"))
    got = names.other_names(F.col("p_name"), english, F.col("p_type"), F.concat_ws(";", "p_name", "p_brand", F.lit(" "), F.lit(" x ")))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(got, "|").alias("other_names"))


def review_filter(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "OK").otherwise("MISMATCH").alias("flag"), F.when(F.col("o_orderkey") % 3 == 0, "SITEMAP").when(F.col("o_orderkey") % 3 == 1, "SEARCH").otherwise("MANUAL").alias("discovery"))
    part = lambda view: review.visible(o, view).groupBy(F.lit(view).alias("view")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))
    return part("problem").unionByName(part("search")).unionByName(part("all"))


def _keyed(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("import_key", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderkey").cast("string")).otherwise(""))
    l = table(spark, sf_dir, "lineitem").withColumn("import_key", F.when(F.col("l_orderkey") % 10 != 0, F.col("l_orderkey").cast("string")).otherwise(""))  # noqa: E741
    return o, l


def review_join(spark, sf_dir):
    return review.details(*_keyed(spark, sf_dir)).select("o_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey")


def lineup_counts(spark, sf_dir):
    o, l = _keyed(spark, sf_dir)  # noqa: E741
    return review.lineup_counts(o, l.where("l_linenumber > 2 AND import_key <> ''")).select("o_orderkey", "n")


def slug_join(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("U"), (F.col("s_nationkey") % 7).cast("string")).alias("university"), F.lit("c").alias("campus"), F.lit(2026).alias("year"), F.when(F.col("s_suppkey") % 2 == 0, "spring").otherwise("fall").alias("season"), F.col("s_suppkey").alias("seed_pos"))
    f = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("U"), (F.col("n_nationkey") % 9).cast("string")).alias("host_name")).withColumn("import_key", F.concat("host_name", F.lit("-c-2026-05")))
    return review.with_slugs(f, review.slug_map(s)).select("n_nationkey", "cache_slug")


def artist_sort(spark, sf_dir):
    a = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_acctbal") < 0).alias("needs_review"), F.col("s_suppkey").alias("pos"))
    return review.sorted_artists(a).select("s_suppkey", "needs_review")


def month_distribution(spark, sf_dir):
    return review.month_counts(table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.date_format("o_orderdate", "MM").alias("month")))


def review_counts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.agg(F.count_if(F.col("p_size") < 10).alias("to_review"), F.count_if(F.col("p_brand") == "Brand#11").alias("genre_11"), F.count("*").alias("n"))


def first_rows(spark, sf_dir):
    return seed.first_rows(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("seed_pos")), 100).select("o_orderkey")


def offset_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "events").select(F.col("event_id").alias("pos"), F.col("event_type").alias("line"))
    return streaming.from_offset(lines, 500)


def unresolved(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seed_pos"))
    return candidates.remaining(o, table(spark, sf_dir, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("seed_pos")))


def csv_roundtrip(spark, sf_dir):
    """Nations through the CSV exporter and back. The exporter writes a file for people to the shared folder."""
    path = os.path.join(shared_folder(spark), "nation.csv")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("key"), F.concat(F.lit("="), "n_name", F.lit('",\n')).alias("name"), F.lit(None).cast("string").alias("none"))
    tables.export_csv(n, path, ["key", "name", "none"], ["key"])
    return tables.read_table(spark, path, ["key", "name", "none"]).select("key", "name", "none")


QUERIES = {f.__name__: f for f in (joint_split, lineup_order, canonical_map, merged_mapping, new_names, merge_artists, alias_merge, review_filter, review_join, lineup_counts, slug_join, artist_sort, month_distribution, review_counts, first_rows, offset_lines, unresolved, csv_roundtrip)}

MAPPING = "m AS (SELECT p_type AS artist_raw, min(p_brand) AS artist_canonical FROM part GROUP BY 1 HAVING length(p_type) % 2 = 0)"

ORACLES = {
    "joint_split": "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN concat_ws('|', p_name, p_brand, '&', p_type) WHEN 1 THEN ' & ' ELSE p_name END AS names FROM part",
    "lineup_order": """
SELECT l_orderkey, CASE WHEN l_linenumber % 3 <> 0 THEN l_linenumber % 2 END::BIGINT AS day, row_number() OVER (PARTITION BY l_orderkey, CASE WHEN l_linenumber % 3 <> 0 THEN l_linenumber % 2 END
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS "order", l_partkey FROM lineitem""",
    "canonical_map": f"WITH {MAPPING} SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN '' ELSE coalesce(artist_canonical, p_type) END AS artist_canonical FROM part LEFT JOIN m ON artist_raw = p_type",
    "merged_mapping": f"""
WITH {MAPPING}, a AS (SELECT p_type AS artist_raw, max(p_brand) AS artist_canonical FROM part GROUP BY 1), k AS (SELECT * FROM a WHERE artist_raw IN (SELECT p_type FROM part WHERE p_size < 10))
SELECT * FROM m WHERE artist_raw NOT IN (SELECT artist_raw FROM k) UNION ALL SELECT * FROM k""",
    "new_names": f"WITH {MAPPING} SELECT DISTINCT p_type AS artist_raw FROM part WHERE p_type NOT IN (SELECT artist_raw FROM m)",
    "merge_artists": """
WITH old AS (SELECT 'N' || (s_suppkey * 3) AS name, 'img' AS image_url, s_suppkey::INTEGER AS pos FROM supplier),
found AS (SELECT 'N' || (p_partkey % 150) AS name, min(p_partkey)::INTEGER AS pos FROM part GROUP BY 1)
SELECT name, image_url, pos FROM old UNION ALL SELECT name, '', (pos + (SELECT coalesce(max(pos) + 1, 0) FROM old))::INTEGER FROM found WHERE name NOT IN (SELECT name FROM old)""",
    "alias_merge": """
SELECT p_partkey, concat_ws('|', CASE WHEN p_partkey % 3 <> 0 AND p_brand <> p_name THEN p_brand END, CASE WHEN p_type <> p_name THEN p_type END, CASE WHEN p_partkey % 3 = 0 AND p_brand <> p_name THEN p_brand END, 'x') AS other_names FROM part""",
    "review_filter": """
WITH o AS (SELECT o_orderkey, o_orderstatus = 'O' AS ok, o_orderkey % 3 IN (0, 1) AS searched FROM orders)
SELECT 'problem' AS view, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM o WHERE NOT ok UNION ALL SELECT 'search', count(*), sum(o_orderkey)::BIGINT FROM o WHERE searched UNION ALL SELECT 'all', count(*), sum(o_orderkey)::BIGINT FROM o""",
    "review_join": "SELECT o_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderkey % 10 <> 0",
    "lineup_counts": "SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_linenumber > 2 AND l_orderkey % 10 <> 0 GROUP BY 1",
    "slug_join": """
WITH s AS (SELECT 'U' || (s_nationkey % 7) AS u, min_by('U' || (s_nationkey % 7) || CASE WHEN s_suppkey % 2 = 0 THEN '-spring' ELSE '-fall' END, s_suppkey) AS slug FROM supplier GROUP BY 1)
SELECT n_nationkey, coalesce(slug, 'U' || (n_nationkey % 9)) AS cache_slug FROM nation LEFT JOIN s ON u = 'U' || (n_nationkey % 9)""",
    "artist_sort": "SELECT s_suppkey, s_acctbal < 0 AS needs_review FROM supplier ORDER BY 2 DESC, 1",
    "month_distribution": "SELECT year(o_orderdate)::INTEGER AS year, " + ", ".join(f"count(*) FILTER (month(o_orderdate) = {m}) AS m{m:02d}" for m in range(13)) + " FROM orders GROUP BY 1",
    "review_counts": "SELECT count(*) FILTER (p_size < 10) AS to_review, count(*) FILTER (p_brand = 'Brand#11') AS genre_11, count(*) AS n FROM part",
    "first_rows": "SELECT o_orderkey FROM orders ORDER BY 1 LIMIT 100",
    "offset_lines": "SELECT event_id AS pos, event_type AS line FROM events WHERE event_id >= 500",
    "csv_roundtrip": "SELECT n_nationkey::VARCHAR AS key, '''=' || n_name || '\",' || chr(10) AS name, '' AS none FROM nation",
    "unresolved": "SELECT o_orderkey AS seed_pos FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40)",
}
