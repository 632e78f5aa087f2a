"""Queries over the parts of a whole run: requests, searches, stores and the state of every seed row, also where rows share a slug."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import crawl, ledger
from millrace.plans.naming import shared_path
from millrace.plans.pages import table

# Customers as seed rows, many of a slug and year; suppliers as known searches and cached records, each slug and year once.

def seed_rows(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    k = F.col("c_custkey")
    rows = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(
        F.col("n_name").alias("university"), F.col("c_mktsegment").alias("campus"), F.lit("r").alias("region"), (F.lit(2020) + k % 3).cast("int").alias("year"), F.when(k % 4 != 0, F.concat(F.lit("u"), (k % 2).cast("string"))).alias("url"),
        k.cast("string").alias("latitude"), F.lit("2").alias("longitude"), F.when(F.col("c_nationkey") % 2 == 0, "spring").alias("season"), k.cast("int").alias("seed_pos"),
    )
    return crawl.slugged(rows)


SEED = """s AS (SELECT n_name AS university, c_mktsegment AS campus, (2020 + c_custkey % 3)::INTEGER AS year, CASE WHEN c_custkey % 4 <> 0 THEN 'u' || (c_custkey % 2) END AS url, c_custkey::INTEGER AS seed_pos,
    CASE WHEN c_nationkey % 2 = 0 THEN 'spring' END AS season, CASE WHEN c_nationkey % 2 = 0 THEN n_name || '-spring' ELSE n_name END AS slug FROM customer JOIN nation ON c_nationkey = n_nationkey),
l AS (SELECT *, min(seed_pos) OVER (PARTITION BY slug, year, url) AS leader FROM s)"""


def known_searches(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    slug = F.when(F.col("n_nationkey") % 2 == 0, F.concat("n_name", F.lit("-spring"))).otherwise(F.col("n_name"))
    return n.where("n_nationkey % 3 = 0").select(slug.alias("slug"), F.lit(2021).alias("year"), F.lit(None).cast("string").alias("season"), F.when(F.col("n_nationkey") % 6 == 0, F.array(F.lit("a"), F.col("n_name"))).otherwise(F.array().cast("array<string>")).alias("candidates"))


KNOWN = """k AS (SELECT CASE WHEN n_nationkey % 2 = 0 THEN n_name || '-spring' ELSE n_name END AS slug, 2021 AS year, CASE WHEN n_nationkey % 6 = 0 THEN ['a', n_name] ELSE []::VARCHAR[] END AS candidates FROM nation WHERE n_nationkey % 3 = 0)"""


def request_leaders(spark, sf_dir):
    return seed_rows(spark, sf_dir).select("seed_pos", "slug", "leader")


def search_requests(spark, sf_dir):
    return crawl.to_search(seed_rows(spark, sf_dir), known_searches(spark, sf_dir)).select("slug", "year", "seed_pos")


def search_candidate_rows(spark, sf_dir):
    got = crawl.search_candidates(seed_rows(spark, sf_dir).where("seed_pos = leader"), known_searches(spark, sf_dir))
    return got.select("seed_pos", F.col("rank").cast("long").alias("rank"), "url")


def search_store(spark, sf_dir):
    """New answers for all slugs of 2020 and 2021, a failed one for some: known ones stay, failed ones aren't kept."""
    asked = seed_rows(spark, sf_dir).where("year < 2022").select("slug", "year", "season").distinct()
    found = asked.withColumn("candidates", F.when(F.length("slug") % 4 != 0, F.array(F.lit("new"))))
    return crawl.stored_searches(known_searches(spark, sf_dir), found).select("slug", "year", F.array_join("candidates", "|").alias("candidates"))


class Scripted:
    """Recorded answers that stand in the prompt itself: after FIRST for the first call, after SECOND once an error is under it."""

    def __call__(self, prompt: str) -> str:
        asked, _, errors = prompt.partition("\n\n")
        first, _, second = asked.partition("FIRST")[2].partition("SECOND")
        return second if errors else first


def paid_answers(spark, sf_dir):
    """Orders as prompts whose first or both answers are broken in part, a third of them equal to others; asked for in two runs over one ledger."""
    k = F.col("o_orderkey") - F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(0)
    good = F.concat(F.lit('{"found": true, "university_name": "U'), (k % 9).cast("string"), F.lit('"}'))
    bad = F.lit('{"found": "perhaps"}')
    prompt = F.concat(F.lit("page "), k.cast("string"), F.lit(" FIRST"), F.when(k % 4 == 0, bad).otherwise(good), F.lit(" SECOND"), F.when(k % 8 == 0, bad).otherwise(good))
    asked = table(spark, sf_dir, "orders").select("o_orderkey", prompt.alias("prompt"))
    path = f"{shared_path(spark)}/ledger"
    for part in (asked.where("o_orderkey % 2 = 0"), asked):
        ledger.ask_all(part, Scripted(), path, per_task=5000)
    got = ledger.answers(asked, path)
    return got.select("o_orderkey", F.col("tries").cast("long").alias("tries"), F.get_json_object(text.json_slice(F.col("answer")), "$.university_name").alias("name"), F.col("error").isNotNull().alias("failed"))


def made_state(spark, sf_dir):
    """The state of leaders, with flags made from their place in the seed."""
    k = F.col("seed_pos")
    flag = F.when(k % 5 == 0, "fetch_failed").when(k % 5 == 1, "mismatch").when(k % 5 == 2, "extract_failed").otherwise("ok")
    return seed_rows(spark, sf_dir).where("seed_pos = leader").select("seed_pos", (k % 7 != 0).alias("answered"), (k % 11 == 0).alias("hit"), (k % 13 == 0).alias("restored"), "slug", "year", "campus", "region", "latitude", "longitude", flag.alias("flag"))


def record_store(spark, sf_dir):
    state = made_state(spark, sf_dir)
    cached = known_searches(spark, sf_dir).select("slug", "year", F.lit("c").alias("campus"), F.lit("r").alias("region"), F.lit("1").alias("latitude"), F.lit("2").alias("longitude"), F.lit("old").alias("flag"))
    return crawl.stored_records(state, cached).select("slug", "year", "campus", "latitude", "flag")


def shared_states(spark, sf_dir):
    got = crawl.shared(seed_rows(spark, sf_dir), made_state(spark, sf_dir))
    return got.select("seed_pos", "slug", "campus", "latitude", "flag")


STATE = """t AS (SELECT *, CASE seed_pos % 5 WHEN 0 THEN 'fetch_failed' WHEN 1 THEN 'mismatch' WHEN 2 THEN 'extract_failed' ELSE 'ok' END AS flag FROM l WHERE seed_pos = leader)"""

QUERIES = {f.__name__: f for f in (request_leaders, search_requests, search_candidate_rows, search_store, paid_answers, record_store, shared_states)}

ORACLES = {
    "request_leaders": f"WITH {SEED} SELECT seed_pos, slug, leader FROM l",
    "search_requests": f"WITH {SEED}, {KNOWN} SELECT slug, year, min(seed_pos) AS seed_pos FROM s WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.slug = s.slug AND k.year = s.year) GROUP BY 1, 2",
    "search_candidate_rows": f"WITH {SEED}, {KNOWN} SELECT seed_pos, generate_subscripts(candidates, 1) AS rank, unnest(candidates) AS url FROM l JOIN k USING (slug, year) WHERE seed_pos = leader",
    "search_store": f"""
WITH {SEED}, {KNOWN}, n AS (SELECT DISTINCT slug, year FROM s WHERE year < 2022 AND length(slug) % 4 <> 0)
SELECT slug, year, array_to_string(candidates, '|') AS candidates FROM k UNION ALL SELECT slug, year, 'new' FROM n WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.slug = n.slug AND k.year = n.year)""",
    "paid_answers": """
WITH k AS (SELECT o_orderkey, o_orderkey - CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS k FROM orders)
SELECT o_orderkey, CASE WHEN k % 4 = 0 THEN 2 ELSE 1 END::BIGINT AS tries, CASE WHEN k % 8 <> 0 THEN 'U' || (k % 9) END AS name, k % 8 = 0 AS failed FROM k""",
    "record_store": f"""
WITH {SEED}, {KNOWN}, {STATE}, f AS (SELECT slug, year, max(seed_pos) AS p FROM t WHERE flag NOT IN ('fetch_failed', 'extract_failed') AND seed_pos % 7 <> 0 AND seed_pos % 11 <> 0 AND seed_pos % 13 <> 0 GROUP BY 1, 2)
SELECT slug, year, campus, seed_pos::VARCHAR AS latitude, flag FROM t JOIN f USING (slug, year) WHERE p = seed_pos
UNION ALL SELECT slug, year, 'c', '1', 'old' FROM k WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.slug = k.slug AND f.year = k.year)""",
    "shared_states": f"WITH {SEED}, {STATE} SELECT l.seed_pos, l.slug, l.campus, l.seed_pos::VARCHAR AS latitude, t.flag FROM l JOIN t ON t.seed_pos = l.leader",
}
