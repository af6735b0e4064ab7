"""Fixed schemas of the three feeds, their raw tables and the JSON paths read.

Nothing is ever inferred: every read passes one of these schemas, and every
JSON column is parsed with an explicit, pruned DDL.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the upstream pipeline's for identical rows.
# ---------------------------------------------------------------------------
CATALOG = "steam_catalog"
APPDETAILS = "steam_appdetails"
REVIEWS = "steam_reviews"
FEEDS = (CATALOG, APPDETAILS, REVIEWS)

SOURCE_CATALOG = "steam_istoreservice_getapplist_v1"
SOURCE_APPDETAILS = "steam_store_appdetails"
SOURCE_REVIEWS = "steam_store_appreviews"

# Keys kept from an app-details object, in the upstream order.
TRIMMED_DETAIL_KEYS = (
    "steam_appid", "type", "name", "is_free", "required_age", "developers",
    "publishers", "price_overview", "platforms", "categories", "genres",
    "recommendations", "release_date", "metacritic", "content_descriptors",
)

# Renames from the reviews API query_summary to the feed columns.
REVIEW_SUMMARY_FIELDS = (
    ("total_reviews", "total_reviews"),
    ("total_positive", "good_reviews"),
    ("total_negative", "bad_reviews"),
    ("review_score", "review_score"),
    ("review_score_desc", "review_score_desc"),
    ("num_reviews", "num_reviews_returned"),
)

# Release dates look like "Mar 5, 2020"; a month-name pattern that parses
# abbreviated names also takes full ones ("March 5, 2020"), hence the second
# pattern.  Anything else is not a date.
RELEASE_DATE_FORMAT = "MMM d, yyyy"
RELEASE_DATE_FORMAT_FULL_MONTH = "MMMM d, yyyy"

# Day partition column of each feed.
DATE_COLUMN = {CATALOG: "partition_date", APPDETAILS: "ingestion_date",
               REVIEWS: "ingestion_date"}

# ---------------------------------------------------------------------------
# Feed file schemas (one JSON object per line).  ``raw`` / ``error_payload``
# hold nested JSON objects; the JSON reader keeps their text verbatim in a
# string column.
# ---------------------------------------------------------------------------
CATALOG_FILE_DDL = (
    "ingested_at_utc string, partition_date date, source string, appid bigint, "
    "name string, last_modified bigint, price_change_number bigint, raw string"
)
APPDETAILS_FILE_DDL = (
    "ingested_at string, ingestion_date date, source string, appid bigint, "
    "success boolean, type string, name string, raw string, error_payload string"
)
REVIEWS_FILE_DDL = (
    "ingested_at string, ingestion_date date, source string, appid bigint, "
    "success boolean, total_reviews bigint, good_reviews bigint, bad_reviews bigint, "
    "review_score bigint, review_score_desc string, num_reviews_returned bigint, "
    "raw string, error_payload string"
)

# Raw table schemas: the file schemas without the ingest stamp; reviews also
# declares ``name`` (never written, always NULL).
CATALOG_RAW_DDL = (
    "partition_date date, source string, appid bigint, name string, "
    "last_modified bigint, price_change_number bigint, raw string"
)
APPDETAILS_RAW_DDL = (
    "ingestion_date date, source string, appid bigint, success boolean, type string, "
    "name string, raw string, error_payload string"
)
REVIEWS_RAW_DDL = (
    "ingestion_date date, source string, appid bigint, success boolean, "
    "total_reviews bigint, good_reviews bigint, bad_reviews bigint, review_score bigint, "
    "review_score_desc string, num_reviews_returned bigint, name string, raw string, "
    "error_payload string"
)

FILE_DDL = {CATALOG: CATALOG_FILE_DDL, APPDETAILS: APPDETAILS_FILE_DDL,
            REVIEWS: REVIEWS_FILE_DDL}
RAW_DDL = {CATALOG: CATALOG_RAW_DDL, APPDETAILS: APPDETAILS_RAW_DDL,
           REVIEWS: REVIEWS_RAW_DDL}

# History reader for processed keys: keys and flags may have any JSON type in
# old files, and a quoted key read as bigint would drop the whole record.  Plain
# readers get text; key sets read the typed form, as the text "false" is not the
# value false.
HISTORY_DDL = "appid string, success string"
HISTORY_TYPED_DDL = "appid variant, success variant"

# The only paths of ``appdetails.raw`` ever read downstream.  Leaves are text
# (like a JSON-path scalar) and are cast where used; ids stay text because
# genre ids arrive quoted.
DETAILS_RAW_JSON_DDL = (
    "is_free string, "
    "release_date struct<coming_soon: string, date: string>, "
    "developers array<string>, publishers array<string>, "
    "price_overview struct<currency: string, initial: string, final: string>, "
    "categories array<struct<id: string, description: string>>, "
    "genres array<struct<id: string, description: string>>"
)

def struct_of(ddl: str) -> T.StructType:
    """StructType of a DDL string."""
    return T.StructType.fromDDL(ddl)


def columns_of(ddl: str) -> list[str]:
    return [f.name for f in struct_of(ddl).fields]
