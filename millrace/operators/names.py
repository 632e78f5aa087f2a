"""Canonical names and the artists table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.lineup import split_joint


def raw_names(records: DataFrame, split_names: bool = False) -> DataFrame:
    """artist_raw: the distinct names of usable records, secret items aside. Joint names stay whole unless split_names."""
    usable = records.where((F.col("flag") == "ok") & F.col("extraction").isNotNull())
    items = usable.select(F.explode("extraction.lineup").alias("i")).where(~F.coalesce("i.is_secret", F.lit(False)))
    name = F.col("i.artist_raw")
    names = items.select(F.explode(split_joint(name)).alias("artist_raw")) if split_names else items.select(name.alias("artist_raw"))
    return names.distinct()


def canonical_names(mapping: DataFrame) -> DataFrame:
    """The distinct canonical names of a mapping."""
    return mapping.select("artist_canonical").distinct()


def new_names(names: DataFrame, mapping: DataFrame) -> DataFrame:
    return names.join(mapping.select("artist_raw"), "artist_raw", "left_anti")


def merged_mapping(mapping: DataFrame, answer: DataFrame, asked: DataFrame) -> DataFrame:
    """The mapping updated by an answer, of which only names that were asked count; the answer wins."""
    kept = answer.join(asked.select("artist_raw"), "artist_raw", "left_semi")
    return mapping.join(kept.select("artist_raw"), "artist_raw", "left_anti").unionByName(kept.select(*mapping.columns))


def merge_artists(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Existing rows in file order (pos), then rows of unseen names in order of their first occurrence. image_url of new ones is ''."""
    first = found.withColumn("__n", F.row_number().over(Window.partitionBy("name").orderBy("pos"))).where("__n = 1").drop("__n")
    fresh = first.join(existing.select("name"), "name", "left_anti")
    offset = existing.agg(F.coalesce(F.max("pos") + 1, F.lit(0)).alias("offset"))  # one row
    fresh = fresh.crossJoin(F.broadcast(offset)).withColumn("pos", F.col("pos") + F.col("offset")).withColumn("image_url", F.lit(""))
    return existing.unionByName(fresh.select(*existing.columns))


def other_names(name: Column, english: Column, real: Column, aliases: Column) -> Column:
    """English name, real name and the ;-parted aliases, stripped, without empty ones and the name itself, distinct in order."""
    every = F.concat(F.array(F.coalesce(english, F.lit("")), F.coalesce(real, F.lit(""))), F.split(F.coalesce(aliases, F.lit("")), ";"))
    return F.array_distinct(F.filter(F.transform(every, lambda x: F.btrim(x)), lambda x: (x != "") & (x != name)))


def migrate_artists(legacy: DataFrame, genres: DataFrame) -> DataFrame:
    """The artists table from the legacy one: names merged into other_names, genre by name ('' if unknown), category dropped."""
    g = genres.select(F.col("name").alias("__name"), "genre")
    rows = legacy.join(g, F.col("name_canonical") == F.col("__name"), "left")
    names = other_names(F.col("name_canonical"), F.col("name_en"), F.col("real_name"), F.col("aliases"))
    return rows.select(F.col("name_canonical").alias("name"), F.array_join(names, "|").alias("other_names"), F.coalesce("genre", F.lit("")).alias("genre"), F.lit("").alias("image_url"), "needs_review", "pos")
