"""Queries over prompts, attempts, names and the files of a run."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import attempts, lineup, names
from millrace.plans.pages import table
from millrace.plans.records import ASKED, MADE, asked, made_records, names_mapping
from millrace.schemas import EXTRACTION, GENRES, struct
from millrace.sources import mapping, seed, tables


def shared_path(spark) -> str:
    """A new path under spark.checkpoint.dir, for Spark's writers; only a local session may do without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="millrace-")
    return f"{root.rstrip('/')}/millrace/{uuid.uuid4().hex}"


def shared_folder(spark) -> str:
    """A new folder that the driver and all executors see: under spark.checkpoint.dir, which only a local session may lack."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="millrace-")
    if not root or "://" in (root := root.removeprefix("file://")):
        raise ValueError("files for people need a spark.checkpoint.dir that is mounted on all machines")
    path = os.path.join(root, "millrace", f"files-{uuid.uuid4().hex}")
    os.makedirs(path)
    return path


def stripped_text(spark, sf_dir):
    """Names between blanks of several kinds, one in seven nothing but blanks."""
    name = F.when(F.col("p_partkey") % 7 != 0, F.col("p_name")).otherwise("")
    cell = F.concat(F.lit("\u3000\t "), name, F.lit("\u00a0\n"))
    return table(spark, sf_dir, "part").select("p_partkey", text.strip(cell).alias("stripped"), text.blank_to_null(cell).alias("or_null"))


def discovery_prompts(spark, sf_dir):
    a = asked(spark, sf_dir)
    return a.select("o_orderkey", attempts.discovery_prompt(F.col("university"), F.col("asked_year"), F.col("season")).alias("prompt"))


def extraction_prompts(spark, sf_dir):
    """Prompts over texts that hold the template's own marks, and over missing ones."""
    body = F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("{year} {body} "), "name"))
    prompt = attempts.extraction_prompt(F.col("university"), F.col("asked_year"), F.array(F.lit("a"), F.col("day")), body)
    return asked(spark, sf_dir).select("o_orderkey", F.md5(prompt.cast("binary")).alias("prompt_md5"))


def prompt_marks(spark, sf_dir):
    """Prompts whose values are themselves marks of the template."""
    p = F.col("p_partkey")
    university = F.when(p % 3 == 0, "{body}{year}").when(p % 3 == 1, F.concat(F.lit("{handles}"), "p_name")).otherwise(F.col("p_name"))
    prompt = attempts.extraction_prompt(university, F.lit(2026), F.array(F.lit("{university}"), F.lit("{body}")), F.concat("p_name", F.lit("{fields}{year}")))
    return table(spark, sf_dir, "part").select("p_partkey", F.length(prompt).cast("long").alias("n_chars"), F.md5(prompt.cast("binary")).alias("prompt_md5"))


def attempt_flags(spark, sf_dir):
    k = F.col("o_orderkey")
    status = F.when(k % 11 == 0, "fetch_failed").when(k % 11 == 1, "empty_body").otherwise("ok")
    error = F.when((k % 11 > 1) & (k % 13 == 0), "no JSON object in the answer")
    have = {"found": F.col("found"), "university_name": F.col("name"), "year": F.col("year"), "start_date": F.col("day")}
    fields = struct(f"e {EXTRACTION}")["e"].dataType.fields
    extraction = F.struct(*(have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))
    rows = asked(spark, sf_dir).select(
        "o_orderkey", "university", "season", F.col("asked_year").alias("year"), status.alias("status"), error.alias("error"),
        F.when((status == "ok") & error.isNull(), extraction).alias("extraction"), F.when(k % 2 == 0, F.concat(F.col("asked_year") + 8, F.lit("-01"))).alias("published_at"),
    )
    return attempts.judged(rows).select("o_orderkey", "flag", "date_warning")


def collected_names(spark, sf_dir):
    return names.raw_names(made_records(spark, sf_dir))


def collected_split_names(spark, sf_dir):
    return names.raw_names(made_records(spark, sf_dir), split_names=True)


def canonical_names(spark, sf_dir):
    return names.canonical_names(names_mapping(spark, sf_dir))


def refreshed_lineup(spark, sf_dir):
    """The lineup as stored, under a newer mapping."""
    stored = lineup.build_lineup(made_records(spark, sf_dir), names_mapping(spark, sf_dir)).withColumn("revealed", F.col("revealed").cast("string"))
    newer = table(spark, sf_dir, "part").where("p_partkey % 2 = 0").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("artist_raw"), F.col("p_brand").alias("artist_canonical"))
    got = lineup.refreshed(stored, newer)
    return got.select("rec_id", F.col("day").cast("long").alias("day"), F.col("order").cast("long").alias("order"), "artist_raw", "artist_canonical", "revealed")


def legacy_artists(spark, sf_dir):
    k = F.col("p_partkey")
    name = F.concat("p_name", F.lit("#"), k.cast("string"))
    old = table(spark, sf_dir, "part").select(
        name.alias("name_canonical"), F.when(k % 4 != 0, F.col("p_brand")).alias("name_en"), F.when(k % 3 != 0, name).otherwise(F.lit(" ")).alias("real_name"),
        F.concat(F.lit(" x ;;"), F.coalesce("p_type", F.lit("")), F.lit(";x")).alias("aliases"), F.lit("singer").alias("category"), (k % 2 == 0).alias("needs_review"), k.cast("int").alias("pos"),
    )
    genre = F.when(k % 6 != 0, F.element_at(F.array(*map(F.lit, GENRES)), (k % 4 + 1).cast("int")))
    genres = table(spark, sf_dir, "part").where(k % 5 != 0).select(name.alias("name"), genre.alias("genre"))
    return names.migrate_artists(old, genres)


def seed_scan(spark, sf_dir):
    """Nations as a seed file with quotes, line breaks and blanks, read as a run reads it."""
    k, n = F.col("n_nationkey"), table(spark, sf_dir, "nation")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    cells = [F.concat(F.lit(" "), "n_name", F.lit('"\n')), F.lit("c,d"), F.lit("r"), F.lit(" 2026 "), F.when(k % 2 == 0, "http://u/").otherwise(" "), k.cast("string"), F.lit("1.50"), F.when(k % 3 == 0, "spring").otherwise("")]
    rows = n.select(F.concat_ws(",", *map(quoted, cells)).alias("line")).orderBy("n_nationkey")
    path = seed.seed_path(shared_folder(spark), 2026)
    tables.write_lines(rows, path, ",".join((*seed.REQUIRED, "season\r\n")).encode())
    return seed.read_seed(spark, path)


def mapping_scan(spark, sf_dir):
    """Regions and nations as a mapping file, written twice and read."""
    path = os.path.join(shared_folder(spark), "mapping.json")
    old = {r.r_name: "old" for r in table(spark, sf_dir, "region").toLocalIterator()}
    mapping.save_mapping(path, old)
    mapping.save_mapping(path, mapping.load_mapping(path) | {r.n_name: f'"{r.n_regionkey}"\n' for r in table(spark, sf_dir, "nation").toLocalIterator()})
    return mapping.mapping_frame(spark, mapping.load_mapping(path))


QUERIES = {f.__name__: f for f in (stripped_text, discovery_prompts, extraction_prompts, prompt_marks, attempt_flags, collected_names, collected_split_names, canonical_names, refreshed_lineup, legacy_artists, seed_scan, mapping_scan)}


def _text(s: str) -> str:
    """A string as a literal of SQL."""
    return "'" + s.replace("'", "''") + "'"


_HEAD = attempts.EXTRACTION_TASK.replace("{fields}", attempts.fields_block()).removesuffix("{body}")

_PARTS = re.split(r"\{\w+\}", _HEAD)

ORACLES = {
    "stripped_text": "SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_name ELSE '' END AS stripped, CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS or_null FROM part",
    "discovery_prompts": f"""
WITH {ASKED} SELECT o_orderkey, '''' || university || '''의 ' || asked_year || '년' || CASE season WHEN 'spring' THEN ' 봄' WHEN 'fall' THEN ' 가을' ELSE '' END ||
    ' 축제 라인업을 다룬 글의 주소를 관련도 순서로 최대 8개, JSON {{"candidates": [{{"url": ..., "title": ...}}]}} 로만 답하세요.' AS prompt FROM a""",
    "extraction_prompts": f"""
WITH {ASKED} SELECT o_orderkey, md5(replace(replace(replace({_text(_HEAD)}, '{{university}}', university), '{{year}}', asked_year::VARCHAR), '{{handles}}', 'a, ' || day)
    || CASE WHEN o_orderkey % 5 <> 0 THEN '{{year}} {{body}} ' || name ELSE '' END) AS prompt_md5 FROM a""",
    "prompt_marks": f"""
WITH p AS (SELECT p_partkey, {_text(_PARTS[0])} || CASE p_partkey % 3 WHEN 0 THEN '{{body}}{{year}}' WHEN 1 THEN '{{handles}}' || p_name ELSE p_name END || {_text(_PARTS[1])} || '2026' || {_text(_PARTS[2])}
    || '{{university}}, {{body}}' || {_text(_PARTS[3])} || p_name || '{{fields}}{{year}}' AS prompt FROM part)
SELECT p_partkey, length(prompt) AS n_chars, md5(prompt) AS prompt_md5 FROM p""",
    "attempt_flags": f"""
WITH {ASKED} SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'fetch_failed' WHEN o_orderkey % 11 = 1 THEN 'empty_body' WHEN o_orderkey % 13 = 0 THEN 'extract_failed'
    WHEN found AND name <> '' AND (contains(university, name) OR contains(name, university)) AND (year IS NULL OR year = asked_year) AND season_ok THEN 'ok' ELSE 'mismatch' END AS flag,
    CASE WHEN o_orderkey % 2 = 0 AND asked_year + 8 >= 2000 THEN '출처 게시 연도 ' || (asked_year + 8) || ' != 요청 연도 ' || asked_year END AS date_warning FROM b""",
    "collected_names": f"WITH {MADE} SELECT DISTINCT raw AS artist_raw FROM items JOIN recs ON l_orderkey = rec_id WHERE has AND ok AND NOT secret",
    "collected_split_names": f"""
WITH {MADE} SELECT DISTINCT unnest(list_filter(list_transform(string_split(raw, ' & '), lambda x: trim(x)), lambda x: x <> '')) AS artist_raw
FROM items JOIN recs ON l_orderkey = rec_id WHERE has AND ok AND NOT secret""",
    "canonical_names": "SELECT DISTINCT p_name AS artist_canonical FROM part WHERE p_partkey % 3 = 0",
    "refreshed_lineup": f"""
WITH {MADE},
parts AS (SELECT i.*, CASE WHEN secret THEN [''] ELSE list_filter(list_transform(string_split(raw, ' & '), lambda x: trim(x)), lambda x: x <> '') END AS names FROM items i JOIN recs ON l_orderkey = rec_id WHERE has AND ok),
each AS (SELECT *, unnest(names) AS name, generate_subscripts(names, 1) AS sp FROM parts)
SELECT l_orderkey AS rec_id, day::BIGINT AS day, row_number() OVER (PARTITION BY l_orderkey, day ORDER BY pos, sp) AS "order", name AS artist_raw,
    CASE WHEN secret THEN '' ELSE coalesce((SELECT p_brand FROM part WHERE p_partkey % 2 = 0 AND 'P' || p_partkey = name), name) END AS artist_canonical, CASE WHEN secret THEN 'false' ELSE 'true' END AS revealed FROM each""",
    "legacy_artists": f"""
SELECT p_name || '#' || p_partkey AS name, CASE WHEN p_partkey % 4 <> 0 THEN p_brand || '|' ELSE '' END || 'x|' || p_type AS other_names,
    CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 6 <> 0 THEN {list(GENRES)}[p_partkey % 4 + 1] ELSE '' END AS genre, '' AS image_url, p_partkey % 2 = 0 AS needs_review, p_partkey::INTEGER AS pos FROM part""",
    "seed_scan": """
SELECT n_name || '"' AS university, 'c,d' AS campus, 'r' AS region, 2026 AS year, CASE WHEN n_nationkey % 2 = 0 THEN 'http://u/' END AS url, n_nationkey::VARCHAR AS latitude, '1.50' AS longitude,
    CASE WHEN n_nationkey % 3 = 0 THEN 'spring' END AS season, (row_number() OVER (ORDER BY n_nationkey) - 1)::INTEGER AS seed_pos FROM nation""",
    "mapping_scan": "SELECT n_name AS artist_raw, '\"' || n_regionkey || '\"' || chr(10) AS artist_canonical FROM nation UNION ALL SELECT r_name, 'old' FROM region WHERE r_name NOT IN (SELECT n_name FROM nation)",
}
