"""Checked queries: each takes (spark, sf_dir) and returns a DataFrame.

Each builds its feeds from the shared tables (written as JSONL and read
back), runs one model or operator, and flattens array columns to text so an
independent SQL engine can compare values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import on_day, only_success
from ..operators.keys import first_by_counts, processed_keys, union_processed
from ..operators.latest import latest_per_key
from ..schemas import APPDETAILS, CATALOG, FILE_DDL, HISTORY_TYPED_DDL, REVIEWS
from ..session import scratch_dir
from ..sources.derived import AS_OF, PENDING_RUN_DAY
from . import incremental, marts, staging
from ..sources.feeds import (feed_path, latest_feed_day, load_feed, read_catalog,
                             read_catalog_or_latest, read_failed, read_feed_day,
                             read_feed_history)
from ..sources.tables import raw
from ..sources.warehouse import raw_table
from .fixtures import (REPLACED_DAY, built_db, ingest_root, loaded_root,
                       pending_raw_root, pending_root, published_root, published_run, raw_feed,
                       replaced_root, resumed_root, views_db)
from .jobs import build_all

Query = Callable[[SparkSession, str], DataFrame]


def texts(items: Column | str) -> Column:
    """array<string> → 'a, b' (NULL array stays NULL)."""
    return F.array_join(items, ", ")


def pairs(items: Column | str, field: str) -> Column:
    """array<struct<id, name>> → 'id:name|id:name' in element order."""
    items = F.col(items) if isinstance(items, str) else items
    return F.array_join(F.transform(
        items, lambda x: F.concat(x["id"].cast("string"), F.lit(":"), x[field])), "|")


# -- staging ---------------------------------------------------------------
def q_latest_per_key(spark: SparkSession, sf_dir: str, method: str = "join") -> DataFrame:
    raw = only_success(raw_feed(spark, sf_dir, APPDETAILS))
    return latest_per_key(raw, "appid", "ingestion_date", method).select(
        "appid", "ingestion_date", "name")


def q_latest_per_key_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_latest_per_key(spark, sf_dir, "rank")


def stg_appdetails_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_appdetails(raw_feed(spark, sf_dir, APPDETAILS))


def stg_reviews_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_reviews(raw_feed(spark, sf_dir, REVIEWS))


def q_stg_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_catalog(raw_feed(spark, sf_dir, CATALOG))


def flat_appdetails(s: DataFrame) -> DataFrame:
    """All staged columns, arrays as text."""
    return s.select(
        "appid", "name", "is_free", "is_coming_soon", "release_date",
        texts("developers").alias("developers"), texts("publishers").alias("publishers"),
        "currency", "original_price", "discount_price",
        pairs("categories", "category_name").alias("categories"),
        pairs("genres", "genre_name").alias("genres"))


def q_stg_appdetails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_appdetails(stg_appdetails_of(spark, sf_dir))


def q_stg_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_reviews_of(spark, sf_dir)


# -- marts -----------------------------------------------------------------
def staged_appdetails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging written once: the marts filter on parsed columns."""
    return staging.materialize(stg_appdetails_of(spark, sf_dir))


def mart_appdetails_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_appdetails(staged_appdetails(spark, sf_dir), AS_OF)


def q_mart_appdetails(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mart_appdetails_of(spark, sf_dir)
    return m.select(
        "appid", "name", "is_free", "is_coming_soon", "cleaned_release_date",
        texts("developers").alias("developers"), texts("publishers").alias("publishers"),
        "is_multiplayer", "is_coop", "is_indie", "is_self_published", "is_very_indie")


def q_mart_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_categories(staged_appdetails(spark, sf_dir), AS_OF)


def q_mart_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_genres(staged_appdetails(spark, sf_dir), AS_OF)


def q_mart_genres_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The genres mart as of the day of the run (UTC)."""
    return marts.mart_genres(staged_appdetails(spark, sf_dir))


def q_mart_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_reviews(stg_reviews_of(spark, sf_dir))


def q_mart_details_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = marts.mart_details_reviews(mart_appdetails_of(spark, sf_dir),
                                   marts.mart_reviews(stg_reviews_of(spark, sf_dir)))
    return m.withColumn("developers", texts("developers")) \
            .withColumn("publishers", texts("publishers"))


# -- incremental -----------------------------------------------------------
def q_pending_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = pending_root(spark, sf_dir, CATALOG, APPDETAILS)
    return incremental.pending(spark, root, APPDETAILS, PENDING_RUN_DAY).select("appid")


def q_pending_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = pending_root(spark, sf_dir, CATALOG, REVIEWS)
    return incremental.pending(spark, root, REVIEWS, PENDING_RUN_DAY).select("appid")


def q_pending_details_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same keys by the loaded raw table and the run day's own file."""
    return incremental.pending(spark, pending_root(spark, sf_dir, CATALOG, APPDETAILS), APPDETAILS, PENDING_RUN_DAY,
                               raw_root=pending_raw_root(spark, sf_dir)).select("appid")


def q_pending_details_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same keys by the kept table of done keys, which a second run leaves as it is."""
    root, state = pending_root(spark, sf_dir, CATALOG, APPDETAILS), scratch_dir(spark, "done-keys")
    incremental.keep_done_keys(spark, root, APPDETAILS, PENDING_RUN_DAY, state)
    return incremental.pending(spark, root, APPDETAILS, PENDING_RUN_DAY, state_root=state).select("appid")


PENDING_LIMIT = 100


def q_limit_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 100 pending keys in catalog order (a top-k report)."""
    root = pending_root(spark, sf_dir, CATALOG, APPDETAILS)
    return incremental.pending(spark, root, APPDETAILS, PENDING_RUN_DAY,
                               limit=PENDING_LIMIT).select("appid")


def q_limit_pending_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same keys by counts and prefix sums: only the chunk of the last key is sorted."""
    root = pending_root(spark, sf_dir, CATALOG, APPDETAILS)
    todo = incremental.pending(spark, root, APPDETAILS, PENDING_RUN_DAY)
    return first_by_counts(todo, PENDING_LIMIT).select("appid")


def q_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = pending_root(spark, sf_dir, CATALOG, APPDETAILS)
    return incremental.run_counts(spark, root, APPDETAILS, PENDING_RUN_DAY)


def q_run_counts_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a run that fetches at most 100 keys."""
    root = pending_root(spark, sf_dir, CATALOG, APPDETAILS)
    return incremental.run_counts(spark, root, APPDETAILS, PENDING_RUN_DAY, limit=PENDING_LIMIT)


def q_union_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historic keys (all files but today's) and today's, as a set union."""
    root = pending_root(spark, sf_dir, APPDETAILS)
    hist = read_feed_history(spark, root, APPDETAILS, exclude_day=PENDING_RUN_DAY,
                             ddl=HISTORY_TYPED_DDL)
    today = read_feed_day(spark, root, APPDETAILS, PENDING_RUN_DAY, ddl=HISTORY_TYPED_DDL)
    return union_processed(processed_keys(hist), processed_keys(today))


def q_processed_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys done in the run day's own file."""
    root = pending_root(spark, sf_dir, REVIEWS)
    return processed_keys(read_feed_day(spark, root, REVIEWS, PENDING_RUN_DAY,
                                        ddl=HISTORY_TYPED_DDL))


def q_catalog_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog of a day without a file: the greatest catalog file is read."""
    root = pending_root(spark, sf_dir, CATALOG)
    return read_catalog_or_latest(spark, root, "1996-1-1").select(
        "appid", "name", "partition_date", F.lit(latest_feed_day(spark, root, CATALOG))
        .cast("date").alias("file_day"))


# -- normalisers and sinks --------------------------------------------------
def _json_text(col: str, path: str) -> Column:
    return F.get_json_object(F.col(col), path)


def q_ingest_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details payloads → feed file → read back (every payload form)."""
    root = ingest_root(spark, sf_dir, APPDETAILS)
    feed = load_feed(spark, feed_path(root, APPDETAILS, AS_OF), APPDETAILS)
    return feed.select(
        "appid", "ingestion_date", "success", "type", "name",
        _json_text("raw", "$.is_free").alias("is_free"),
        _json_text("raw", "$.price_overview.final").alias("price_final"),
        _json_text("raw", "$.genres[2].description").alias("genre3"),
        _json_text("error_payload", "$.error").alias("error"),
        _json_text("error_payload", "$.success").alias("refused"))


def q_failed_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the details rows that failed with an exception."""
    return read_failed(spark, ingest_root(spark, sf_dir, APPDETAILS), APPDETAILS, AS_OF)


def q_ingest_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews payloads → feed file → read back (every payload form)."""
    root = ingest_root(spark, sf_dir, REVIEWS)
    feed = load_feed(spark, feed_path(root, REVIEWS, AS_OF), REVIEWS)
    return feed.select(
        "appid", "success", "total_reviews", "good_reviews", "bad_reviews",
        "review_score", "review_score_desc", "num_reviews_returned",
        _json_text("error_payload", "$.error").alias("error"))


def q_catalog_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App-list pages → catalog file → read back."""
    cat = read_catalog(spark, ingest_root(spark, sf_dir, CATALOG), AS_OF)
    return cat.select("appid", "name", "last_modified", "price_change_number",
                      "partition_date", "source")


# Day load: each whole derived feed is landed as one day file, so the load
# replaces that day and appends every other row to its own day folder (a
# multi-year backfill, ~2,400 day folders).
def q_load_day_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole reviews feed loaded into its day-partitioned raw table."""
    root = loaded_root(spark, sf_dir, REVIEWS)
    return raw(spark, root, REVIEWS).select(
        "appid", "ingestion_date", "success", "total_reviews", "good_reviews",
        "review_score_desc", "name")


def q_load_day_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole catalog feed loaded into its day-partitioned raw table."""
    root = loaded_root(spark, sf_dir, CATALOG)
    return raw(spark, root, CATALOG).select("appid", "name", "partition_date")


def q_publish_day_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day's feeds copied to the lake; the reviews copy read back."""
    root = published_root(spark, sf_dir)
    return load_feed(spark, feed_path(root, REVIEWS, AS_OF), REVIEWS).select(
        "appid", "ingestion_date", "success", "total_reviews", "good_reviews",
        "review_score_desc", "name")


def q_failed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the reviews rows that failed with an exception."""
    return read_failed(spark, ingest_root(spark, sf_dir, REVIEWS), REVIEWS, AS_OF)


def q_publish_day_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The details copy of a published day."""
    root = published_root(spark, sf_dir)
    return load_feed(spark, feed_path(root, APPDETAILS, AS_OF), APPDETAILS).select(
        "appid", "ingestion_date", "success", "name")


def q_publish_day_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog copy of a published day."""
    root = published_root(spark, sf_dir)
    return load_feed(spark, feed_path(root, CATALOG, AS_OF), CATALOG).select(
        "appid", "name", "partition_date")


def q_replace_day_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole reviews table after one of its days was loaded again, twice."""
    return raw(spark, replaced_root(spark, sf_dir, False), REVIEWS).select(
        "appid", "ingestion_date", "success", "total_reviews", "review_score_desc")


def q_replace_day_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole reviews table after one of its days was loaded without rows."""
    return raw(spark, replaced_root(spark, sf_dir, True), REVIEWS).select(
        "appid", "ingestion_date", "success", "total_reviews", "review_score_desc")


def q_raw_on_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of the raw reviews table, by its partition."""
    return on_day(raw(spark, replaced_root(spark, sf_dir, False), REVIEWS),
                  "ingestion_date", REPLACED_DAY).select("appid", "total_reviews", "success")


# Staging models as another session of the catalog sees them after a further load.
def q_view_stg_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.newSession().table(f"{views_db(spark, sf_dir)}.stg_steam_catalog")


def q_view_stg_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.newSession().table(f"{views_db(spark, sf_dir)}.stg_steam_reviews")


def q_view_stg_appdetails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_appdetails(spark.newSession().table(f"{views_db(spark, sf_dir)}.stg_steam_appdetails"))


def q_bucketed_stg_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog staging over the bucketed raw table, read in place by key."""
    return staging.stg_catalog(raw_table(spark, views_db(spark, sf_dir), CATALOG), "bucketed")


# Staging over the loaded raw tables: the latest rows by their places, and a distinct of
# tied keys only.
def q_stg_appdetails_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_appdetails(staging.stg_appdetails(
        raw_table(spark, views_db(spark, sf_dir), APPDETAILS), "ties"))


def q_stg_reviews_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_reviews(raw_table(spark, views_db(spark, sf_dir), REVIEWS), "ties")


def q_stg_catalog_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_catalog(raw_table(spark, views_db(spark, sf_dir), CATALOG), "ties")


def q_build_all_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One selected mart, built with what it reads from the catalog's raw tables."""
    db = "feedloom_genres_" + views_db(spark, sf_dir).rsplit("_", 1)[-1]
    built = build_all(spark, None, db, ["mart_steam_genres"], AS_OF, scratch_dir(spark, "marts"),
                      raw_db=views_db(spark, sf_dir))
    return built["mart_steam_genres"]


# -- published copies and resumed ingests ------------------------------------
def q_limit_pending_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 100 catalog keys of a published day not done in its own files, in catalog order."""
    return incremental.pending(spark, published_run(spark, sf_dir), APPDETAILS, PENDING_RUN_DAY,
                               limit=PENDING_LIMIT).select("appid")


def q_ingest_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole feed lines of an ingest that died and was run again: envelopes, stamp and all."""
    root = resumed_root(spark, sf_dir)
    feed = spark.read.schema(FILE_DDL[APPDETAILS]).option("recursiveFileLookup", "true") \
        .json(feed_path(root, APPDETAILS, AS_OF))
    return feed.select("ingested_at", "appid", "success", "raw", "error_payload")


def q_failed_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed keys of that ingest."""
    return read_failed(spark, resumed_root(spark, sf_dir), APPDETAILS, AS_OF)


def q_table_raw_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.newSession().table(f"{views_db(spark, sf_dir)}.{APPDETAILS}").select(
        "appid", "ingestion_date", "success", "name")


def q_build_all_details_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """build_all over the loaded day-partitioned raw tables; the written
    details ⟕ reviews mart read back."""
    m = spark.table(f"{built_db(spark, sf_dir)}.mart_steam_details_reviews")
    return m.withColumn("developers", texts("developers")) \
            .withColumn("publishers", texts("publishers"))


QUERIES: dict[str, Query] = {
    "latest_per_key": q_latest_per_key,
    "latest_per_key_rank": q_latest_per_key_rank,
    "stg_catalog": q_stg_catalog,
    "stg_appdetails": q_stg_appdetails,
    "stg_reviews": q_stg_reviews,
    "mart_appdetails": q_mart_appdetails,
    "mart_categories": q_mart_categories,
    "mart_genres": q_mart_genres,
    "mart_genres_today": q_mart_genres_today,
    "mart_reviews": q_mart_reviews,
    "mart_details_reviews": q_mart_details_reviews,
    "pending_details": q_pending_details,
    "pending_details_loaded": q_pending_details_loaded,
    "pending_details_kept": q_pending_details_kept,
    "pending_reviews": q_pending_reviews,
    "limit_pending": q_limit_pending,
    "run_counts": q_run_counts,
    "run_counts_limited": q_run_counts_limited,
    "union_processed": q_union_processed,
    "processed_today": q_processed_today,
    "catalog_fallback": q_catalog_fallback,
    "ingest_details": q_ingest_details,
    "failed_details": q_failed_details,
    "ingest_reviews": q_ingest_reviews,
    "catalog_from_pages": q_catalog_from_pages,
    "load_day_reviews": q_load_day_reviews,
    "load_day_catalog": q_load_day_catalog,
    "publish_day_reviews": q_publish_day_reviews,
    "publish_day_details": q_publish_day_details,
    "publish_day_catalog": q_publish_day_catalog,
    "failed_reviews": q_failed_reviews,
    "replace_day_twice": q_replace_day_twice,
    "replace_day_emptied": q_replace_day_emptied,
    "raw_on_day": q_raw_on_day,
    "view_stg_catalog": q_view_stg_catalog,
    "view_stg_reviews": q_view_stg_reviews,
    "view_stg_appdetails": q_view_stg_appdetails,
    "table_raw_details": q_table_raw_details,
    "build_all_details_reviews": q_build_all_details_reviews,
    "bucketed_stg_catalog": q_bucketed_stg_catalog,
    "build_all_genres": q_build_all_genres,
    "limit_pending_published": q_limit_pending_published,
    "ingest_resumed": q_ingest_resumed,
    "failed_resumed": q_failed_resumed,
    "limit_pending_counts": q_limit_pending_counts,
    "stg_catalog_ties": q_stg_catalog_ties,
    "stg_appdetails_ties": q_stg_appdetails_ties,
    "stg_reviews_ties": q_stg_reviews_ties,
}
