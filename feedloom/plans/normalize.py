"""Landed API payloads → feed rows (catalog pages, app details, reviews).

Input tables hold one payload text per fetched page / key, plus the fetch
error when the request itself failed.  Everything is JVM-side: payloads are
parsed into VARIANT once, sub-objects pass through untouched into the
written lines, and each payload form is classified by a cheap object test
instead of by catching exceptions.

A row becomes a *failure row* (and its key goes to the failed list) exactly
where a per-row parser would raise: fetch error, payload not an object, app
block not an object, ``data`` / ``query_summary`` present but not an object.
An API refusal (``success`` false, or the key absent) is a normal row.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import truthy
from ..sources.feeds import iso_day
from ..schemas import (REVIEW_SUMMARY_FIELDS, SOURCE_APPDETAILS, SOURCE_CATALOG,
                       SOURCE_REVIEWS, TRIMMED_DETAIL_KEYS, columns_of, FILE_DDL,
                       APPDETAILS, REVIEWS)

FAILED = "failed"

# Fixed failure texts (the error_payload of failure rows).
ERR_NOT_OBJECT = "payload is not a JSON object"
ERR_BLOCK = "app block is not a JSON object"
ERR_DATA = "data is not a JSON object"
ERR_SUMMARY = "query_summary is not a JSON object"


def is_object(v: Column) -> Column:
    """True when the variant is a JSON object (cheap: no walk of the value);
    false for arrays, scalars, JSON null and absent values."""
    return F.try_variant_get(v, "$", "struct<`__probe`: int>").isNotNull()


def _day(day: date | str) -> Column:
    return F.lit(iso_day(day)).cast("date")


def _stamp(ingested_at: str | None) -> Column:
    if ingested_at is not None:
        return F.lit(ingested_at)
    # the run instant in UTC, ISO text (e.g. 2026-01-02T02:30:00.123456+00:00)
    return F.concat(F.expr(
        "date_format(convert_timezone('UTC', current_timestamp()), "
        "\"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"), F.lit("+00:00"))


def _error_json(text: Column) -> Column:
    return F.to_variant_object(F.struct(text.alias("error")))


def _empty_object() -> Column:
    return F.parse_json(F.lit("{}"))


# --------------------------------------------------------------------------
# Catalog pages (S7 + P1)
# --------------------------------------------------------------------------
def catalog_from_pages(pages: DataFrame, day: date | str) -> DataFrame:
    """One catalog feed row per app over all pages (duplicates kept).

    A page without ``response`` or ``apps`` yields no rows; a page that is
    not JSON fails the job.  Rows are sorted by (page_no, index) so the file
    keeps the API order.
    """
    parsed = pages.select(
        "page_no",
        F.from_json("payload", "response struct<apps: array<variant>>",
                    {"mode": "FAILFAST"})
        .alias("p"))
    apps = parsed.select("page_no", F.posexplode(F.col("p.response.apps"))
                         .alias("idx", "app"))
    return shape_catalog(apps, day).orderBy("page_no", "idx").drop("page_no", "idx")


def shape_catalog(apps: DataFrame, day: date | str, app: str = "app") -> DataFrame:
    """Envelope of one app object: run day, source, 4 scalars, whole object."""
    a = F.col(app)
    keep = [c for c in ("page_no", "idx") if c in apps.columns]
    return apps.select(
        F.lit(iso_day(day)).alias("ingested_at_utc"),
        _day(day).alias("partition_date"),
        F.lit(SOURCE_CATALOG).alias("source"),
        F.try_variant_get(a, "$.appid", "bigint").alias("appid"),
        F.try_variant_get(a, "$.name", "string").alias("name"),
        F.try_variant_get(a, "$.last_modified", "bigint").alias("last_modified"),
        F.try_variant_get(a, "$.price_change_number", "bigint")
        .alias("price_change_number"),
        a.alias("raw"),
        *keep,
    )


# --------------------------------------------------------------------------
# App details (P2 + P3 + P5)
# --------------------------------------------------------------------------
def trim_details(data: Column) -> Column:
    """The 15 kept keys of a details object, in order; absent keys → null,
    nested values unchanged (a struct of variants, written as one object)."""
    return F.struct(*[
        F.variant_get(data, f"$.{k}", "variant").alias(k) for k in TRIMMED_DETAIL_KEYS])


def shape_details(payloads: DataFrame, day: date | str,
                  ingested_at: str | None = None) -> DataFrame:
    """(appid, payload, error) → details feed rows plus a ``failed`` flag."""
    key = F.col("appid").cast("string")
    m = F.from_json(F.col("payload"), "map<string, variant>")
    # a one-row explode keeps the optimiser from copying the parse into each use of it
    staged = payloads.select("appid", "error", F.inline(F.array(F.struct(m.alias("m")))))
    staged = staged.select("appid", "error", "m", F.map_contains_key("m", key).alias("has_key"),
                           F.col("m")[key].alias("block"))
    block = F.col("block")
    success = truthy(F.variant_get(block, "$.success", "variant"))
    data = F.variant_get(block, "$.data", "variant")
    staged = staged.select(
        "appid", "error", "m", "has_key", "block",
        is_object(block).alias("block_obj"),
        data.alias("data"), is_object(data).alias("data_obj"))
    staged = staged.withColumn(
        "ok", F.col("block_obj") & F.when(F.col("block_obj"), success).otherwise(False))
    err = (F.when(F.col("error").isNotNull(), F.col("error"))
           .when(F.col("m").isNull(), F.lit(ERR_NOT_OBJECT))
           .when(F.col("has_key") & ~F.col("block_obj"), F.lit(ERR_BLOCK))
           .when(F.col("ok") & F.col("data").isNotNull() & ~F.col("data_obj"),
                 F.lit(ERR_DATA)))
    staged = staged.withColumn("err", err)
    failed = F.col("err").isNotNull()
    ok = ~failed & F.col("ok")
    d = F.col("data")
    return staged.select(
        _stamp(ingested_at).alias("ingested_at"),
        _day(day).alias("ingestion_date"),
        F.lit(SOURCE_APPDETAILS).alias("source"),
        "appid",
        ok.alias("success"),
        F.when(ok, F.try_variant_get(d, "$.type", "string")).alias("type"),
        F.when(ok, F.try_variant_get(d, "$.name", "string")).alias("name"),
        F.when(ok, trim_details(d)).alias("raw"),
        F.when(failed, _error_json(F.col("err")))
        .when(~ok, F.coalesce(F.col("block"), _empty_object()))
        .alias("error_payload"),
        failed.alias(FAILED),
    )


# --------------------------------------------------------------------------
# Reviews (P4 + P5)
# --------------------------------------------------------------------------
def review_success(v: Column) -> Column:
    """``payload.success == 1``: true for 1, 1.0 and JSON true; not for "1"."""
    s = F.variant_get(v, "$.success", "variant")
    t = F.schema_of_variant(s)
    numeric = ~(t.isin("STRING", "VOID") | t.startswith("OBJECT") | t.startswith("ARRAY"))
    return F.coalesce(numeric & (F.try_variant_get(s, "$", "double") == 1.0), F.lit(False))


def shape_reviews(payloads: DataFrame, day: date | str,
                  ingested_at: str | None = None) -> DataFrame:
    """(appid, payload, error) → reviews feed rows plus a ``failed`` flag."""
    v = F.try_parse_json(F.col("payload"))
    staged = payloads.select("appid", "error", v.alias("v"))
    v = F.col("v")
    ok0 = F.when(is_object(v), review_success(v)).otherwise(F.lit(False))
    qs = F.variant_get(v, "$.query_summary", "variant")
    staged = staged.select("appid", "error", "v", is_object(v).alias("v_obj"),
                           ok0.alias("ok0"), qs.alias("qs"), is_object(qs).alias("qs_obj"))
    err = (F.when(F.col("error").isNotNull(), F.col("error"))
           .when(~F.col("v_obj"), F.lit(ERR_NOT_OBJECT))
           .when(F.col("ok0") & F.col("qs").isNotNull() & ~F.col("qs_obj"),
                 F.lit(ERR_SUMMARY)))
    staged = staged.withColumn("err", err)
    failed = F.col("err").isNotNull()
    ok = ~failed & F.col("ok0")
    q = F.col("qs")
    metrics = []
    for src, dst in REVIEW_SUMMARY_FIELDS:
        # numbers pass as they are: one that is not whole fails the load
        value = (F.try_variant_get(q, f"$.{src}", "string") if dst == "review_score_desc"
                 else F.variant_get(q, f"$.{src}", "variant"))
        metrics.append(F.when(ok, value).alias(dst))
    return staged.select(
        _stamp(ingested_at).alias("ingested_at"),
        _day(day).alias("ingestion_date"),
        F.lit(SOURCE_REVIEWS).alias("source"),
        "appid",
        ok.alias("success"),
        *metrics,
        F.when(ok, F.coalesce(q, _empty_object())).alias("raw"),
        F.when(failed, _error_json(F.col("err")))
        .when(~ok, F.col("v")).alias("error_payload"),
        failed.alias(FAILED),
    )


def feed_columns(feed: str) -> list[str]:
    """Column order of a feed file line."""
    return columns_of(FILE_DDL[feed])


SHAPERS = {APPDETAILS: shape_details, REVIEWS: shape_reviews}
