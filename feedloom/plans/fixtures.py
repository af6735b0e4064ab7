"""Write the testdata-derived feeds as real JSONL once per session.

Every checked query reads these files back through the same readers a
production job uses, so JSON writing, reading and parsing are all exercised.
Files go to a fresh folder under the session's shared checkpoint folder.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import APPDETAILS, CATALOG, FEEDS, REVIEWS
from ..session import scratch_dir, shuffles_dropped
from ..sources.derived import (AS_OF, PENDING_RUN_DAY, catalog_feed, details_feed,
                               reviews_feed)
from ..sources.feeds import feed_path, load_feed, write_feed_day

REPLACED_DAY = "1995-01-01"

DERIVED = {APPDETAILS: details_feed, REVIEWS: reviews_feed, CATALOG: catalog_feed}

_LOCK = threading.RLock()
_WRITTEN: dict[tuple[str, str, str], str] = {}


def _key(spark: SparkSession, sf_dir: str, kind: str) -> tuple[str, str, str]:
    return (spark.sparkContext.applicationId, os.path.abspath(sf_dir), kind)


def _written(spark: SparkSession, sf_dir: str, kind: str, parts: Iterable[str],
             write: Callable[[str, str], object]) -> str:
    """The folder of ``kind`` with each of ``parts`` in it; ``write(root, part)`` is called
    for a part that is not there yet."""
    with _LOCK:
        k = _key(spark, sf_dir, kind)
        root = _WRITTEN.setdefault(k, scratch_dir(spark, kind))
        for part in parts:
            k = _key(spark, sf_dir, f"{kind}: {part}")
            if k not in _WRITTEN:
                write(root, part)
                _WRITTEN[k] = root
        return root


#: Slices in which a feed that is joined from several tables is written.
SLICES = 4


def write_sliced(df: DataFrame, root: str, feed: str, day: str) -> None:
    """``write_feed_day`` of the rows of one slice of keys after another: the shuffles of a
    slice go when it is written, so those of all rows are never on disk at once."""
    part = F.pmod(F.xxhash64("appid"), F.lit(SLICES))
    for k in range(SLICES):
        write_feed_day(df.filter(part == k), root, feed, day, "append" if k else "overwrite")


def lake_root(spark: SparkSession, sf_dir: str, *feeds: str) -> str:
    """Folder with the whole derived ``feeds`` (all three without names), one day file each."""
    def write(root: str, feed: str) -> None:
        # reviews come from one table and are not shuffled
        (write_feed_day if feed == REVIEWS else write_sliced)(DERIVED[feed](spark, sf_dir), root, feed, AS_OF)

    return _written(spark, sf_dir, "lake", feeds or FEEDS, write)


def raw_feed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """A whole derived feed read back in its raw table schema."""
    return load_feed(spark, feed_path(lake_root(spark, sf_dir, feed), feed, AS_OF), feed)


def _day_before(day: str) -> str:
    return (date.fromisoformat(day) - timedelta(days=1)).isoformat()


#: Days of the two earlier output files of the pending run.
PENDING_DAYS = ("1995-02-28", _day_before(PENDING_RUN_DAY))


def pending_root(spark: SparkSession, sf_dir: str, *feeds: str) -> str:
    """Folder for one incremental run on ``PENDING_RUN_DAY`` with ``feeds`` (all three without names).

    The catalog file of the run day holds every catalog row in (day, appid)
    order.  Details and reviews rows are in the output file of their time: those dated
    before the run day in two earlier day files, those of the run day in its own
    (the run is being resumed); later days have no file yet.
    """
    def write(root: str, feed: str) -> None:
        if feed == CATALOG:
            write_feed_day(catalog_feed(spark, sf_dir, ordered=True), root, CATALOG, PENDING_RUN_DAY)
            return
        run, split = (F.lit(d).cast("date") for d in (PENDING_RUN_DAY, "1995-03-01"))
        df, day = DERIVED[feed](spark, sf_dir), F.col("ingestion_date")
        write_day = write_feed_day if feed == REVIEWS else write_sliced
        write_day(df.filter((day < run) & (day < split)), root, feed, PENDING_DAYS[0])
        write_day(df.filter((day < run) & (day >= split)), root, feed, PENDING_DAYS[1])
        write_feed_day(df.filter(day == run), root, feed, PENDING_RUN_DAY)

    return _written(spark, sf_dir, "pending", feeds or FEEDS, write)


def pending_raw_root(spark: SparkSession, sf_dir: str) -> str:
    """Raw tables root that holds the history of the pending run: the details
    rows before the run day, which are those of its earlier files."""
    from ..sources.tables import replace_day

    k = _key(spark, sf_dir, "pending-raw")
    with _LOCK:
        if k not in _WRITTEN:
            root = scratch_dir(spark, "raw")
            pending = pending_root(spark, sf_dir, APPDETAILS)
            older, old = (load_feed(spark, feed_path(pending, APPDETAILS, d), APPDETAILS) for d in PENDING_DAYS)
            replace_day(older.unionByName(old), root, APPDETAILS, AS_OF)
            _WRITTEN[k] = root
        return _WRITTEN[k]


def ingest_root(spark: SparkSession, sf_dir: str, *feeds: str) -> str:
    """Folder where the derived payload tables of ``feeds`` (all three without names) were
    ingested on ``AS_OF``: details and reviews feeds with failed lists, and the catalog pages."""
    from ..sources.derived import (INGESTED_AT, catalog_pages, details_payloads,
                                   reviews_payloads)
    from .jobs import ingest, ingest_catalog

    def write(root: str, feed: str) -> None:
        if feed == CATALOG:
            ingest_catalog(spark, catalog_pages(spark, sf_dir), root, AS_OF)
            return
        payloads = {APPDETAILS: details_payloads, REVIEWS: reviews_payloads}[feed]
        ingest(spark, payloads(spark, sf_dir), feed, root, AS_OF, INGESTED_AT)

    return _written(spark, sf_dir, "ingest", feeds or FEEDS, write)


def loaded_root(spark: SparkSession, sf_dir: str, feed: str) -> str:
    """One raw-tables root per session and scale; each whole derived feed is
    loaded into it once, as day ``AS_OF`` (its rows of other days are
    appended to their own days)."""
    from .jobs import load_day

    with _LOCK:
        k_root = _key(spark, sf_dir, "raw-root")
        if k_root not in _WRITTEN:
            _WRITTEN[k_root] = scratch_dir(spark, "raw")
        root = _WRITTEN[k_root]
        k = _key(spark, sf_dir, "loaded-" + feed)
        if k not in _WRITTEN:
            load_day(spark, lake_root(spark, sf_dir, feed), AS_OF, root, feeds=(feed,))
            _WRITTEN[k] = root
        return root


def built_db(spark: SparkSession, sf_dir: str) -> str:
    """Database with the details, reviews and details ⟕ reviews marts built by
    ``build_all`` over the loaded raw tables."""
    from .jobs import build_all

    with _LOCK:
        k = _key(spark, sf_dir, "built")
        if k not in _WRITTEN:
            for feed in FEEDS:
                root = loaded_root(spark, sf_dir, feed)
            loc = scratch_dir(spark, "marts")
            db = "feedloom_" + loc.rsplit("-", 1)[-1]
            build_all(spark, root, out_db=db, as_of=AS_OF, location=loc,
                      select=["mart_steam_appdetails", "mart_steam_reviews",
                              "mart_steam_details_reviews"])
            _WRITTEN[k] = db
        return _WRITTEN[k]


def replaced_root(spark: SparkSession, sf_dir: str, emptied: bool) -> str:
    """Raw tables root with the whole reviews feed; then one of its days is loaded twice
    with another total, or emptied."""
    from ..sources.tables import replace_day

    with _LOCK:
        k = _key(spark, sf_dir, f"replaced-{emptied}")
        if k not in _WRITTEN:
            root = scratch_dir(spark, "raw")
            feed = raw_feed(spark, sf_dir, REVIEWS)
            replace_day(feed, root, REVIEWS, AS_OF)  # every row is of another day
            day = feed.filter(F.col("ingestion_date") == F.lit(REPLACED_DAY).cast("date"))
            if emptied:
                replace_day(day.limit(0), root, REVIEWS, REPLACED_DAY)
            else:
                more = day.withColumn("total_reviews", F.col("total_reviews") + 1)
                for spelling in (REPLACED_DAY, REPLACED_DAY.replace("-0", "-")):
                    replace_day(more, root, REVIEWS, spelling)
            _WRITTEN[k] = root
        return _WRITTEN[k]


#: Days before and from here on are loaded by two loads into the catalog's tables.
SECOND_LOAD = "1996-01-01"


def views_db(spark: SparkSession, sf_dir: str) -> str:
    """Database of raw tables, with buckets in proportion to their feeds, and staging views.
    The derived feeds are loaded in two loads; between them another session reads all views."""
    from ..schemas import DATE_COLUMN
    from ..sources import warehouse

    with _LOCK:
        k = _key(spark, sf_dir, "views")
        if k not in _WRITTEN:
            root = scratch_dir(spark, "warehouse")
            db = "feedloom_raw_" + root.rsplit("-", 1)[-1]
            lake = lake_root(spark, sf_dir)
            warehouse.create_tables(spark, root, db, {
                feed: warehouse.buckets_of(spark, feed_path(lake, feed, AS_OF)) for feed in FEEDS})
            views = warehouse.create_views(spark, db)
            later = F.lit(SECOND_LOAD).cast("date")
            other = spark.newSession()
            for old in (True, False):
                for feed in FEEDS:
                    df, day = raw_feed(spark, sf_dir, feed), F.col(DATE_COLUMN[feed])
                    warehouse.commit_day(df.filter(day < later if old else day >= later), db, feed,
                                         _day_before(SECOND_LOAD) if old else AS_OF)
                if old:
                    # reading by key is a task a bucket: the tasks of all views share the cores
                    with shuffles_dropped(other), ThreadPoolExecutor(len(views)) as pool:
                        list(pool.map(lambda name: other.table(name).count(), views))
            _WRITTEN[k] = db
        return _WRITTEN[k]


def published_root(spark: SparkSession, sf_dir: str) -> str:
    """Lake folder the derived feeds of day ``AS_OF`` were published to."""
    from .jobs import publish_day

    k = _key(spark, sf_dir, "published")
    with _LOCK:
        if k not in _WRITTEN:
            root = scratch_dir(spark, "published")
            publish_day(spark, lake_root(spark, sf_dir), root, AS_OF)
            _WRITTEN[k] = root
        return _WRITTEN[k]


def published_run(spark: SparkSession, sf_dir: str) -> str:
    """Lake folder to which the three files of the pending run's day were published."""
    from .jobs import publish_day

    k = _key(spark, sf_dir, "published-run")
    with _LOCK:
        if k not in _WRITTEN:
            root = scratch_dir(spark, "published")
            publish_day(spark, pending_root(spark, sf_dir), root, PENDING_RUN_DAY)
            _WRITTEN[k] = root
        return _WRITTEN[k]


def resumed_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder where landed details payloads were ingested by a run that died after the feed
    write, and then by the same run again, twice."""
    from ..sources.derived import INGESTED_AT, details_payloads
    from . import jobs

    k = _key(spark, sf_dir, "resumed")
    with _LOCK:
        if k not in _WRITTEN:
            root, landed = scratch_dir(spark, "resumed"), scratch_dir(spark, "payloads")
            details_payloads(spark, sf_dir).write.option("maxRecordsPerFile", 500_000).parquet(landed)
            payloads = spark.read.parquet(landed)
            kept = jobs.write_failed

            def die(*_, **__):
                raise InterruptedError("died after the feed write")

            jobs.write_failed = die
            try:
                jobs.ingest(spark, payloads, APPDETAILS, root, AS_OF, INGESTED_AT)
            except InterruptedError:
                pass
            finally:
                jobs.write_failed = kept
            for _ in range(2):
                jobs.ingest(spark, payloads, APPDETAILS, root, AS_OF, INGESTED_AT)
            _WRITTEN[k] = root
        return _WRITTEN[k]
