"""The festivals table: one row of text per record, whatever its flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.keys import festival_month, import_key
from millrace.functions.text import truncate
from millrace.schemas import FESTIVAL_COLUMNS

ADMISSION_MOST = 200


def build_festivals(records: DataFrame, *keep: str) -> DataFrame:
    """FESTIVAL_COLUMNS of every record, and the columns to keep: nulls as '', lists joined by |, flag and discovery in upper case, admission text cut."""
    x = lambda name: F.col(f"extraction.{name}")
    handle = F.coalesce(x("instagram_handle"), F.lit(""))
    out = {
        "import_key": import_key(F.col("university"), F.col("campus"), F.col("year"), festival_month(x("start_date"))),
        "host_name": F.col("university"), "name": x("festival_name"), "start_date": x("start_date"), "end_date": x("end_date"), "venue_name": x("venue_name"),
        "latitude": F.col("latitude"), "longitude": F.col("longitude"), "poster_url": F.col("poster_image_url"), "image_urls": F.array_join("image_urls", "|"),
        "description": x("description"), "hashtags": F.array_join(x("hashtags"), "|"), "external_visitor_policy": x("external_visitor_policy"),
        "verification_method": x("verification_method"), "ticket_type": x("ticket_type"), "ticket_open_at": x("ticket_open_at"),
        "admission_raw": truncate(x("admission_raw"), ADMISSION_MOST), "source_url": F.col("url"), "discovery": F.upper("discovery"), "flag": F.upper("flag"),
        "instagram_url": F.when(handle != "", F.concat(F.lit("https://www.instagram.com/"), handle, F.lit("/"))),
    }
    return records.select(*(F.coalesce(out[c], F.lit("")).alias(c) for c in FESTIVAL_COLUMNS), *keep)
