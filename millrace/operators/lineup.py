"""Line-ups: one row per performer, in order within the day, under canonical names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.keys import festival_month, import_key
from millrace.functions.text import strip


def split_joint(raw: Column) -> Column:
    """Names of a joint stage, parted at ' & ', stripped, without empty ones; the raw name where nothing is left."""
    parts = F.filter(F.transform(F.split(raw, " & "), strip), lambda x: x != "")
    return F.when(F.size(parts) == 0, F.array(raw)).otherwise(parts)


def split(items: DataFrame) -> DataFrame:
    """A row per name of items (artist_raw, day, is_secret, item_pos and others): split_pos, name. Secret items aren't split and have no name."""
    secret = F.coalesce("is_secret", F.lit(False))
    names = F.when(secret, F.array(F.lit(""))).otherwise(split_joint(F.col("artist_raw")))
    return items.withColumn("is_secret", secret).select(*(c for c in items.columns if c != "artist_raw"), F.posexplode(names).alias("split_pos", "name"))


def exploded(records: DataFrame, key: str = "rec_id") -> DataFrame:
    """A row per performer of the records that are ok and have an extraction: key, item_pos, day, is_secret, split_pos, name."""
    usable = records.where((F.col("flag") == "ok") & F.col("extraction").isNotNull())
    items = usable.select(*(c for c in records.columns if c != "extraction"), F.posexplode("extraction.lineup").alias("item_pos", "item"))
    return split(items.select(*(c for c in items.columns if c != "item"), "item.artist_raw", "item.day", "item.is_secret"))


def numbered(rows: DataFrame, key: str = "rec_id") -> DataFrame:
    """With order: the running number within a record's day after splitting; a null day is a day of its own."""
    return rows.withColumn("order", F.row_number().over(Window.partitionBy(key, "day").orderBy("item_pos", "split_pos")))


def canonical(rows: DataFrame, mapping: DataFrame, name: str = "name", secret: str = "is_secret") -> DataFrame:
    """With artist_canonical: the mapped name, else the raw one, '' for secret rows. Spark broadcasts the mapping by its size."""
    m = mapping.select(F.col("artist_raw").alias("__raw"), F.col("artist_canonical").alias("__canonical"))
    got = rows.join(m, F.col(name) == F.col("__raw"), "left")
    return got.withColumn("artist_canonical", F.when(F.col(secret), "").otherwise(F.coalesce("__canonical", name))).drop("__raw", "__canonical")


def build_lineup(records: DataFrame, mapping: DataFrame, key: str = "rec_id", *keep: str) -> DataFrame:
    """The lineup table (import_key, day, order, artist_raw, artist_canonical, revealed) with the positions that order it for export, and the record's columns to keep."""
    return lineup_table(exploded(keyed(records), key), mapping, key, *keep)


def keyed(records: DataFrame) -> DataFrame:
    return records.withColumn("import_key", import_key(F.col("university"), F.col("campus"), F.col("year"), festival_month(F.col("extraction.start_date"))))


def lineup_table(names: DataFrame, mapping: DataFrame, key: str = "rec_id", *keep: str) -> DataFrame:
    """The line-up table of names that are split already; see build_lineup."""
    rows = canonical(numbered(names, key), mapping)
    return rows.select("import_key", "day", "order", F.col("name").alias("artist_raw"), "artist_canonical", (~F.col("is_secret")).alias("revealed"), key, "item_pos", "split_pos", *keep)


def refreshed(lineup: DataFrame, mapping: DataFrame) -> DataFrame:
    """A stored lineup under a newer mapping; rows not revealed stay as they are."""
    hidden = lineup.withColumn("__hidden", F.lower(F.col("revealed").cast("string")) == "false").withColumnRenamed("artist_canonical", "__old")
    m = mapping.select(F.col("artist_raw").alias("__raw"), F.col("artist_canonical").alias("__new"))
    got = hidden.join(m, F.col("artist_raw") == F.col("__raw"), "left")
    return got.withColumn("artist_canonical", F.when(F.col("__hidden"), F.col("__old")).otherwise(F.coalesce("__new", "artist_raw"))).select(*lineup.columns)
