"""Staging models: latest rows per app, typed columns, full-row distinct."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json_fields import (as_structs, cents_to_price, json_scalar,
                                     parse_details_raw, to_bool)
from ..operators.filters import only_success
from ..operators.late import distinct_ties, fetch, latest_counted, latest_located
from ..operators.latest import latest_per_key
from ..session import scratch_dir

REVIEW_COLUMNS = ("appid", "total_reviews", "good_reviews", "bad_reviews",
                  "review_score", "review_score_desc")


def stg_catalog(raw: DataFrame, method: str = "join") -> DataFrame:
    """appid, name of each app's latest catalog day (distinct).

    ``ties`` puts only apps with several latest rows through the distinct.
    """
    if method == "ties":
        rows = latest_counted(raw.select("appid", "name", "partition_date"), "appid", "partition_date")
        return distinct_ties(materialize(rows.drop("partition_date")))
    latest = latest_per_key(raw.select("appid", "name", "partition_date"),
                            "appid", "partition_date", method)
    return latest.select("appid", "name").distinct()


def stg_appdetails(raw: DataFrame, method: str = "join") -> DataFrame:
    """Typed app details of each app's latest successful day (distinct).

    Only successful rows take part, also in the max.  ``raw`` is parsed once,
    after the latest-day join, with a schema holding just the paths read.

    ``ties`` (for parquet tables) finds the latest rows by their narrow columns alone,
    reads ``raw`` of these rows only, and puts only apps with several through the
    distinct.  The rows' places are written once to the shared scratch folder.
    """
    if method == "ties":
        rows = latest_located(only_success(raw), "appid", "ingestion_date", ("name",))
        return distinct_ties(materialize(rows.drop("ingestion_date")),
                             lambda df: _typed_details(fetch(df, "raw string")))
    ok = only_success(raw.select("appid", "ingestion_date", "success", "name", "raw"))
    return _typed_details(latest_per_key(ok, "appid", "ingestion_date", method)).distinct()


def _typed_details(latest: DataFrame) -> DataFrame:
    """Typed columns of (appid, name, raw) rows."""
    parsed = latest.select("appid", "name", parse_details_raw("raw").alias("j"))
    j = F.col("j")
    return parsed.select(
        "appid",
        "name",
        to_bool(j["is_free"]).alias("is_free"),
        to_bool(j["release_date"]["coming_soon"]).alias("is_coming_soon"),
        json_scalar(j["release_date"]["date"]).alias("release_date"),
        j["developers"].alias("developers"),
        j["publishers"].alias("publishers"),
        json_scalar(j["price_overview"]["currency"]).alias("currency"),
        cents_to_price(j["price_overview"]["initial"]).alias("original_price"),
        cents_to_price(j["price_overview"]["final"]).alias("discount_price"),
        as_structs(j["categories"], "category_name").alias("categories"),
        as_structs(j["genres"], "genre_name").alias("genres"),
    )


def materialize(df: DataFrame) -> DataFrame:
    """Write a model once as parquet in the shared scratch folder and read it back.

    ``stg_appdetails`` holds all JSON parsing; a mart filter on a parsed
    column (release date) would otherwise be pushed below the latest-day join
    and parse ``raw`` for every historic row, several times.  The written
    copy is a plan boundary, so parsing happens once per latest row, and columnar:
    each mart reads its own columns and pushes its filters into the scan.
    """
    path = scratch_dir(df.sparkSession, "model")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stg_reviews(raw: DataFrame, method: str = "join") -> DataFrame:
    """Review metrics of each app's latest day, failed rows included (distinct).

    No success filter: a later failed fetch hides an earlier good one and
    leaves NULL metrics, and a failed and a good row of one day both stay.
    ``ties`` puts only apps with several latest rows through the distinct.
    """
    cols = list(REVIEW_COLUMNS) + ["ingestion_date"]
    if method == "ties":
        return distinct_ties(materialize(latest_counted(raw.select(*cols)).drop("ingestion_date")))
    latest = latest_per_key(raw.select(*cols), "appid", "ingestion_date", method)
    return latest.select(*REVIEW_COLUMNS).distinct()
