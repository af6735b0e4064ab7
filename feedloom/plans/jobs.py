"""Composed batch jobs: ingest landed payloads, publish and load a day, build
all models.  Each is a plain function of a session and arguments."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import APPDETAILS, CATALOG, FEEDS, REVIEWS
from ..session import file_system
from ..sources import warehouse
from ..sources.copies import copy_tree
from ..sources.feeds import (batch_done, batch_path, failed_path, feed_dir, feed_path, iso_day, load_feed,
                             payload_batch, write_failed, write_feed_batch, write_feed_day)
from ..sources.tables import (as_table, as_view, create_latest_view, ensure_tables, raw,
                              register_tables, replace_day)
from . import graph, staging
from .normalize import FAILED, SHAPERS, catalog_from_pages, feed_columns


# --------------------------------------------------------------------------
# Landed payloads → day feed (+ failed keys)
# --------------------------------------------------------------------------
def ingest(spark: SparkSession, payloads: DataFrame, feed: str, root: str,
           day: date | str, ingested_at: str | None = None, batch: str | None = None) -> dict[str, str]:
    """Shape payloads into feed rows, add them to the day's file as one batch, and the
    exception rows' keys to the day's failed list.

    A batch appears in the day's file by one rename, so readers see all of it or
    nothing.  A batch that is there already is not added again: an ingest that died
    is run again as it was.  ``batch`` names it; by default it is known by the paths, sizes
    and times of the payload files (payloads that are no files are a new batch each
    time).  Payloads are parsed once and written once; where a count taken on the way
    shows failures, their keys are read from the written lines.  Payloads are parsed a
    second time only if a refusal could be taken for a failure by its line, or if an
    ingest died before its failed keys were written.
    """
    # the payload parser keeps the last value of a repeated JSON key
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    batch = batch or payload_batch(payloads)
    shaped = SHAPERS[feed](payloads, day, ingested_at)
    paths, counts = {"feed": feed_path(root, feed, day)}, None
    if not batch_done(spark, paths["feed"], batch):
        seen = Observation()
        has_error = F.try_variant_get("error_payload", "$.error", "variant").isNotNull()
        rows = shaped.observe(seen, F.count_if(F.col(FAILED)).alias("failures"),
                              F.count_if(~F.col(FAILED) & has_error).alias("alike"))
        write_feed_batch(rows.select(*feed_columns(feed)), root, feed, day, batch)
        counts = seen.get
    if counts is None and batch_done(spark, failed_path(root, feed, day), batch):
        paths["failed"] = failed_path(root, feed, day)
    elif counts is None or counts["failures"]:
        failed = (written_failures(spark, batch_path(paths["feed"], batch)) if counts and not counts["alike"]
                  else shaped.filter(F.col(FAILED)).select("appid"))
        if counts or failed.take(1):
            paths["failed"] = write_failed(failed, root, feed, day, batch=batch)
    return paths


def written_failures(spark: SparkSession, path: str) -> DataFrame:
    """Keys of the failure rows among written lines: rows with an ``error`` in their payload."""
    lines = (spark.read.schema("appid string, error_payload string").option("mode", "FAILFAST")
             .option("recursiveFileLookup", "true").json(path))
    return lines.filter(F.get_json_object("error_payload", "$.error").isNotNull()).select("appid")


def ingest_catalog(spark: SparkSession, pages: DataFrame, root: str,
                   day: date | str) -> str:
    """All catalog pages → the day's catalog file (overwritten), API order kept."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    rows = catalog_from_pages(pages, day)
    return write_feed_day(rows.select(*feed_columns(CATALOG)), root, CATALOG, day,
                          mode="overwrite")


# --------------------------------------------------------------------------
# K6: publish a day's feeds under the lake root
# --------------------------------------------------------------------------
def publish_day(spark: SparkSession, src_root: str, dst_root: str,
                day: date | str) -> list[str]:
    """Copy the day's three feed files byte for byte, under the same names.

    The catalog and details files must exist before anything is copied;
    the reviews file is only needed when its turn comes.  Each copy is whole before
    it takes its place; sizes and SHA-256 of its files are in
    ``<feed>/_published_<day>.json`` beside it.
    """
    for feed in (CATALOG, APPDETAILS):
        fs, p = file_system(spark, feed_path(src_root, feed, day))
        if not fs.exists(p):
            raise FileNotFoundError(f"no {feed} file of {iso_day(day)} under {src_root}")
    out = []
    for feed in (CATALOG, APPDETAILS, REVIEWS):
        dst = feed_path(dst_root, feed, day)
        manifest = copy_tree(spark, feed_path(src_root, feed, day), dst)
        rows = spark.createDataFrame([tuple(r.values()) for r in manifest],
                                     "source string, name string, size bigint, sha256 string")
        rows.coalesce(1).write.mode("overwrite").json(manifest_path(dst_root, feed, day))
        out.append(dst)
    return out


def manifest_path(root: str, feed: str, day: date | str) -> str:
    return f"{feed_dir(root, feed)}/_published_{iso_day(day)}.json"


# --------------------------------------------------------------------------
# Load a day's three feeds into the raw tables
# --------------------------------------------------------------------------
def load_tables(spark: SparkSession, lake_root: str, day: date | str, raw_root: str, db: str,
                feeds: tuple[str, ...] = FEEDS, buckets: int | None = None) -> None:
    """Load a day into the raw tables of the catalog, created if absent, with the
    staging views over them.

    Each feed's file is read and written once and its day committed by its
    location (``sources.warehouse``), so the views show the day in every session
    as soon as its feed is loaded.
    """
    warehouse.create_tables(spark, raw_root, db, buckets)
    warehouse.create_views(spark, db)
    for feed in feeds:
        warehouse.commit_day(load_feed(spark, feed_path(lake_root, feed, day), feed), db, feed, day)


def load_day(spark: SparkSession, lake_root: str, day: date | str, raw_root: str,
             feeds: tuple[str, ...] = FEEDS) -> None:
    """Ensure the raw tables, then replace each feed's day with the day's
    file (catalog, details, reviews in turn).  A missing file or a bad record
    fails that feed's load and leaves its table as it was.  Loading a day again
    gives the same day; rows of other days in its file are appended again."""
    ensure_tables(spark, raw_root)
    for feed in feeds:
        replace_day(load_feed(spark, feed_path(lake_root, feed, day), feed),
                    raw_root, feed, day)


def publish_views(spark: SparkSession, raw_root: str, db: str) -> list[str]:
    """Raw tables and staging models for SQL users, in the catalog.

    Tables over the raw folders, and permanent views of the catalog and reviews
    staging over them.  The details staging is parsed once into parquet beside
    the raw tables, and its view reads that copy; run this after a load.
    """
    tables = register_tables(spark, raw_root, db)
    path = f"{raw_root.rstrip('/')}/stg_steam_appdetails"
    staging.stg_appdetails(raw(spark, raw_root, APPDETAILS)).write.mode("overwrite").parquet(path)
    name = f"{db}.stg_steam_appdetails"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    return tables + [
        create_latest_view(spark, f"{db}.stg_steam_catalog", f"{db}.{CATALOG}", CATALOG,
                           ("appid", "name")),
        name,
        create_latest_view(spark, f"{db}.stg_steam_reviews", f"{db}.{REVIEWS}", REVIEWS,
                           staging.REVIEW_COLUMNS)]


# --------------------------------------------------------------------------
# Build every model
# --------------------------------------------------------------------------
def build_all(spark: SparkSession, raw_root: str | None, out_db: str = "steam",
              select: list[str] | None = None, as_of: date | str | None = None,
              location: str | None = None, buckets: int | None = None,
              raw_db: str | None = None, method: str | None = None) -> dict[str, DataFrame]:
    """Staging models as views, marts as tables: the selected ones and all they read.

    Order and selection come from the models' inputs (``plans.graph``); marts that do not
    need each other are built at the same time, and only the raw tables that the
    selection reads are opened.  These are the folders under ``raw_root``, or with
    ``raw_db`` tables of the catalog, read in place by key where they are bucketed.  ``method``
    names another form of the staging models (``ties`` reads wide columns of latest rows only).

    ``stg_steam_appdetails`` carries all JSON parsing and feeds three marts,
    so it is written once (to the shared scratch folder) whenever one of them is
    built, instead of being re-parsed per mart.  ``mart_steam_details_reviews`` reads the two
    mart tables just written; with ``buckets`` those two are bucketed by appid
    alike, so that join runs without a shuffle.
    """
    names = graph.closure(select)
    found: dict[str, DataFrame] = {}
    form = method or "join"
    for feed in sorted(graph.sources(names)):
        found[feed] = warehouse.raw_table(spark, raw_db, feed) if raw_db else raw(spark, raw_root, feed)
        if not method and raw_db and warehouse.table_buckets(spark, f"{raw_db}.{feed}"):
            form = "bucketed"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {out_db}")
    options = {"as_of": as_of, "method": form}
    co_located = {"mart_steam_appdetails", "mart_steam_reviews"}
    read_by_marts = {i for n in names if graph.MODELS[n].table for i in graph.MODELS[n].inputs}

    def build(name: str) -> None:
        model = graph.MODELS[name]
        df = model.build({i: found[i] for i in model.inputs}, options)
        if model.table:
            path = f"{location.rstrip('/')}/{name}" if location else None
            as_table(df, f"{out_db}.{name}", path, buckets if name in co_located else None)
            found[name] = spark.table(f"{out_db}.{name}")
        else:
            parsed = name == "stg_steam_appdetails" and name in read_by_marts
            found[name] = as_view(staging.materialize(df) if parsed else df, name)

    graph.build_in_order(names, build)
    return {n: found[n] for n in graph.MODELS if n in names}
