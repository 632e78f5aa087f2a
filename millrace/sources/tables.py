"""Reading and writing the reviewed CSV tables."""

from __future__ import annotations

import csv
import io
import os
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import sanitize_cell
from millrace.schemas import struct
from millrace.sources.files import Files


class CsvUnreadable(ValueError):
    """The file exists but can't be read as UTF-8 CSV with its header."""


def read_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as text, in file order (pos); empty if there is no file. Empty cells are ''."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    if not os.path.exists(path):
        return spark.createDataFrame([], schema + ", pos int")
    try:
        with open(path, encoding="utf-8-sig", newline="") as f:
            header = next(csv.reader(f, strict=True), [])
            f.read()
    except (UnicodeDecodeError, csv.Error) as e:
        raise CsvUnreadable(f"{path}: {e}") from e
    if header != columns:
        raise CsvUnreadable(f"{path}: columns are {header}")
    rows = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rows.select(*(F.coalesce(f"`{c}`", F.lit("")).alias(c) for c in columns), F.monotonically_increasing_id().cast("int").alias("pos"))


def csv_cell(c: Column) -> Column:
    """A guarded cell as CSV: quoted where it holds a comma, a quote or a line's end."""
    cell = sanitize_cell(c)
    return F.when(cell.rlike('[,"\r\n]'), F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(cell)


def write_lines(lines: DataFrame, path: str, head: bytes) -> None:
    """One file of head and the rows of lines (one text column) in their order, each ended by CRLF. Ranges are written where the rows are and put together; no row passes the driver."""
    files, parts = Files(lines.sparkSession), f"{path}.{uuid.uuid4().hex}.lines"
    try:
        lines.write.option("lineSep", "\r\n").text(parts)
        files.put_together(path, head, files.parts(parts))
    finally:
        files.remove(parts)


def export_csv(df: DataFrame, path: str, columns: list[str], order: list[str]) -> None:
    """One CSV file for people: UTF-8 with byte order mark, header, CRLF, guarded cells, rows in `order`, replaced as a whole. The canonical output is Parquet."""
    head = io.StringIO()
    csv.writer(head, lineterminator="\r\n").writerow(columns)
    cells = [csv_cell(F.col(f"`{c}`")) for c in columns]
    write_lines(df.orderBy(*order).select(F.concat_ws(",", *cells).alias("value")), path, b"\xef\xbb\xbf" + head.getvalue().encode())


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of Parquet files, empty where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


#: Parts of a store by the hash of its keys. An update writes those anew that it touches. Part of the layout: it stays as it is for as long as a store lives.
STORE_BUCKETS = 16


def _stored(schema: str) -> str:
    return f"{schema}, gone boolean, bucket int"


def _bucketed(rows: DataFrame, keys: tuple[str, ...], gone: bool) -> DataFrame:
    return rows.withColumn("gone", F.lit(gone)).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(STORE_BUCKETS)).cast("int"))


def read_store(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, empty if there is none. What an interrupted update has left is put right first."""
    _finish_update(spark, path, schema)
    return read_if_there(spark, path, _stored(schema)).where("NOT gone").drop("gone", "bucket")


def update_store(spark: SparkSession, path: str, schema: str, keys: tuple[str, ...], rows: DataFrame | None = None, gone: DataFrame | None = None) -> None:
    """Puts rows into a stored table, in place of those of the same keys, and takes out the rows of the keys in `gone`; both may be made from the table itself.

    Only the buckets that are touched are written. They are written whole beside the table first; then Spark's dynamic overwrite takes them in. An update
    that ends before the first is complete changes nothing, one that ends later is finished by the next reader or update. A key taken out leaves a
    row that says so, as an overwrite replaces just the buckets it has rows of.
    """
    _finish_update(spark, path, schema)
    changes = [] if rows is None else [_bucketed(rows, keys, False)]
    if gone is not None:
        empty = [F.col(f.name) if f.name in keys else F.lit(None).cast(f.dataType).alias(f.name) for f in struct(schema).fields]
        changes.append(_bucketed(gone.select(*empty), keys, True))
    names = [f.name for f in struct(_stored(schema)).fields]
    new = reduce(DataFrame.unionByName, changes).select(*names)
    touched = [r[0] for r in new.select("bucket").distinct().collect()]  # STORE_BUCKETS at most
    if not touched:
        return
    old = read_if_there(spark, path, _stored(schema)).where(F.col("bucket").isin(*touched)).alias("old")
    same = reduce(Column.__and__, (F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys))
    kept = old.join(new.select(*keys).alias("new"), same, "left_anti")
    kept.unionByName(new).write.mode("overwrite").parquet(f"{path}.update")
    _finish_update(spark, path, schema)


def _finish_update(spark: SparkSession, path: str, schema: str) -> None:
    """Takes a complete update in, which may be done again; an incomplete one is removed."""
    files, update = Files(spark), f"{path}.update"
    if files.exists(f"{update}/_SUCCESS"):
        ready = spark.read.schema(_stored(schema)).parquet(update)
        ready.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    if files.exists(update):
        files.remove(update)


def year_dirs(base: str) -> list[int]:
    """Years with an output folder, ascending."""
    return sorted(int(d) for d in (os.listdir(base) if os.path.isdir(base) else []) if d.isdigit() and os.path.isdir(os.path.join(base, d)))
