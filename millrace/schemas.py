"""Record schemas and closed domains of the pipeline's tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Flags, ways of discovery, seasons and enumerations of the records.
SCHEMA_VERSION = 4
FLAGS = ("ok", "fetch_failed", "empty_body", "extract_failed", "mismatch", "no_candidate", "no_source")
DISCOVERIES = ("", "manual", "sitemap", "search")
#: Months, first and last, in which a season's events begin.
SEASON_MONTHS = {"spring": (3, 6), "fall": (9, 11)}
SEASON_WORDS = {"spring": " 봄", "fall": " 가을"}
POLICIES = ("ALLOWED", "CONDITIONAL", "DENIED")
VERIFICATIONS = ("NONE", "STUDENT_ID", "PRE_BOOKING", "INVITATION", "OTHER")
TICKETS = ("FREE", "PAID")
DOMAINS = {"external_visitor_policy": POLICIES, "verification_method": VERIFICATIONS, "ticket_type": TICKETS}
GENRES = ("HIPHOP", "BALLAD_RNB", "DANCE", "BAND")

# The columns of the output tables, in order.
FESTIVAL_COLUMNS = [
    "import_key", "host_name", "name", "start_date", "end_date", "venue_name", "latitude", "longitude", "poster_url", "image_urls", "description",
    "hashtags", "external_visitor_policy", "verification_method", "ticket_type", "ticket_open_at", "admission_raw", "source_url", "discovery", "flag", "instagram_url",
]
LINEUP_COLUMNS = ["import_key", "day", "order", "artist_raw", "artist_canonical", "revealed"]
ARTIST_COLUMNS = ["name", "other_names", "genre", "image_url", "needs_review"]
LEGACY_ARTIST_COLUMNS = ["name_canonical", "name_en", "real_name", "category", "aliases", "needs_review"]

# The fields of the seed, of extractions and of records.
SEED = "university string, campus string, region string, year int, url string, latitude string, longitude string, season string, seed_pos int"
LINEUP_FIELDS = (("artist_raw", "string"), ("day", "int"), ("is_secret", "boolean"))
#: Name and type; a list of text is "array<string>", one of objects has their fields.
EXTRACTION_FIELDS = (
    ("found", "boolean"), ("university_name", "string"), ("year", "int"), ("festival_name", "string"), ("start_date", "string"), ("end_date", "string"), ("venue_name", "string"), ("description", "string"),
    ("hashtags", "array<string>"), ("external_visitor_policy", "string"), ("verification_method", "string"), ("ticket_type", "string"), ("ticket_open_at", "string"), ("admission_raw", "string"),
    ("instagram_handle", "string"), ("lineup", LINEUP_FIELDS),
)
REQUIRED_FIELDS = ("found", "university_name", "artist_raw")


def struct_type(fields: tuple) -> str:
    """The struct of fields; one whose type is itself fields is a list of such structs."""
    return f"struct<{','.join(f'{name}:{kind if isinstance(kind, str) else f"array<{struct_type(kind)}>"}' for name, kind in fields)}>"


EXTRACTION = struct_type(EXTRACTION_FIELDS)
RECORD = (
    "slug string, schema_version int, university string, campus string, region string, year int, latitude string, longitude string, seed_url string, url string, "
    f"discovery string, flag string, poster_image_url string, image_urls array<string>, extraction {EXTRACTION}, published_at string, date_warning string"
)
SEARCHES = "slug string, year int, season string, candidates array<string>"
ATTEMPT = f"flag string, poster_image_url string, image_urls array<string>, extraction {EXTRACTION}, published_at string, date_warning string"


def struct(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)
