"""Keys still to fetch: catalog keys minus keys already fetched successfully.

All key sets stay distributed: first-seen order is a column, the difference
is an anti join, and only a limited report is sorted.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import only_success
from ..operators.keys import (POSITION, dedup_ordered, file_position, limit_pending,
                              nonnull_keys, pending_keys, processed_keys, to_key, truthy,
                              union_processed)
from ..schemas import HISTORY_TYPED_DDL
from ..session import file_system
from ..sources.feeds import (FEED_DAY, add_batch, batch_done, day_in_path, feed_files, files_digest, iso_day,
                             read_catalog_or_latest, read_feed_day, read_feed_history)
from ..sources.tables import raw

CATALOG_KEY_DDL = "appid variant"


def catalog_keys(spark: SparkSession, root: str, day: date | str) -> DataFrame:
    """(appid, pos): the day's (or latest) catalog keys in first-seen order.

    Keys are read as VARIANT and coerced like ``int(appid)``; rows without a
    key are ignored; a malformed catalog line fails the read.
    """
    cat = read_catalog_or_latest(spark, root, day, CATALOG_KEY_DDL)
    return dedup_ordered(nonnull_keys(file_position(cat).select("appid", POSITION)))


def processed(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """Keys with a successful row in any output file of ``feed``.

    History (every file but today's) ∪ today's file is every file, so the
    union is one scan of the feed's files.
    """
    return processed_keys(read_feed_history(spark, root, feed, ddl=HISTORY_TYPED_DDL))


def processed_loaded(spark: SparkSession, root: str, feed: str, day: date | str,
                     raw_root: str) -> DataFrame:
    """The same keys from the raw table of ``feed`` and today's output file.

    Two narrow parquet columns with the success filter pushed down, in place of
    all JSON lines ever written.  It equals :func:`processed` where every earlier
    day was loaded; keys of a day that was not are pending again.
    """
    loaded = only_success(raw(spark, raw_root, feed)).select("appid").where("appid IS NOT NULL")
    today = read_feed_day(spark, root, feed, day, ddl=HISTORY_TYPED_DDL)
    return union_processed(loaded, processed_keys(today))


def keep_done_keys(spark: SparkSession, root: str, feed: str, day: date | str, state_root: str) -> list[str]:
    """Bring the kept table of done keys up to date; the days that were read.

    The table holds the distinct keys done in each closed day file (every one but that of
    ``day``), as a batch named by a digest of the day's files.  A day that is there
    with the same files is not read again; one whose files changed is replaced.
    A batch appears by a rename, so a run that dies leaves whole days only.
    """
    files: dict[str, list[str]] = {}
    for path in feed_files(spark, root, feed):
        files.setdefault(day_in_path(feed, path), []).append(path)
    files.pop(iso_day(day), None)
    read = []
    for d in sorted(files):
        at, batch = f"{state_root.rstrip('/')}/{feed}/{d}", files_digest(spark, files[d])
        if batch_done(spark, at, batch):
            continue
        keys = processed_keys(read_feed_day(spark, root, feed, d, ddl=HISTORY_TYPED_DDL)).select("appid")
        add_batch(spark, at, batch, keys.write.parquet)
        fs, p = file_system(spark, at)
        for s in fs.listStatus(p):  # what the day's files were before
            if s.getPath().getName() != f"batch-{batch}":
                fs.delete(s.getPath(), True)
        read.append(d)
    return read


def processed_kept(spark: SparkSession, root: str, feed: str, day: date | str, state_root: str) -> DataFrame:
    """The keys of :func:`processed` from the kept table, brought up to date, and today's
    file: no earlier day's lines are read again."""
    keep_done_keys(spark, root, feed, day, state_root)
    today = processed_keys(read_feed_day(spark, root, feed, day, ddl=HISTORY_TYPED_DDL))
    fs, p = file_system(spark, f"{state_root.rstrip('/')}/{feed}")
    if not fs.exists(p):  # no closed day yet
        return today
    kept = (spark.read.schema("appid bigint").option("recursiveFileLookup", "true")
            .parquet(f"{state_root.rstrip('/')}/{feed}"))
    return union_processed(kept, today)


def pending(spark: SparkSession, root: str, feed: str, day: date | str,
            limit: int | None = None, raw_root: str | None = None,
            state_root: str | None = None) -> DataFrame:
    """(appid, pos) still to fetch; with ``limit`` the first keys in order, with
    ``raw_root`` by the loaded raw table and today's file, with ``state_root`` by the kept
    table of done keys and today's file."""
    if raw_root is not None and state_root is not None:
        raise ValueError("the history comes from raw_root or from state_root")
    done = (processed_kept(spark, root, feed, day, state_root) if state_root is not None
            else processed(spark, root, feed) if raw_root is None
            else processed_loaded(spark, root, feed, day, raw_root))
    return limit_pending(pending_keys(catalog_keys(spark, root, day), done), limit)


def run_counts(spark: SparkSession, root: str, feed: str, day: date | str,
               limit: int | None = None) -> DataFrame:
    """One row: catalog keys, historic / today's processed keys, pending keys.

    Historic counts every file except the day's own; today counts the day's
    file; pending keys are those that a run with ``limit`` would fetch.  One full
    outer join of the two key sets and one aggregate.
    """
    if limit is not None and limit < 0:
        raise ValueError("limit must be >= 0")
    hist = read_feed_history(spark, root, feed, ddl=HISTORY_TYPED_DDL).filter(truthy("success"))
    is_today = F.col(FEED_DAY) == F.lit(iso_day(day))
    flags = (hist.select(to_key("appid").alias("appid"), is_today.alias("t"))
             .filter(F.col("appid").isNotNull()).groupBy("appid")
             .agg(F.max(~F.col("t")).alias("in_history"), F.max("t").alias("in_today")))
    keys = catalog_keys(spark, root, day).select("appid", F.lit(True).alias("in_catalog"))
    both = keys.join(flags, "appid", "full_outer")
    in_cat = F.coalesce(F.col("in_catalog"), F.lit(False))
    done = F.col("in_history").isNotNull()
    left = F.count_if(in_cat & ~done)
    return both.agg(
        F.count_if(in_cat).alias("catalog_keys"),
        F.count_if(F.coalesce(F.col("in_history"), F.lit(False))).alias("historic_processed"),
        F.count_if(F.coalesce(F.col("in_today"), F.lit(False))).alias("today_processed"),
        (left if limit is None else F.least(left, F.lit(limit))).cast("long")
        .alias("pending_keys"),
    )
