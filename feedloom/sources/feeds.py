"""Dated JSONL feeds: ``<root>/<feed>/<feed>_YYYY-MM-DD.jsonl``.

A day "file" may be a single JSONL file (as landed by any writer) or a
directory of part files (as Spark writes it, gzipped here), with batches as folders in it; every
reader takes all of them.  A batch is written as a hidden folder and shown by a rename.
Readers always pass an explicit schema; nothing is inferred.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CATALOG, FILE_DDL, HISTORY_DDL, RAW_DDL, struct_of
from ..session import file_system, shuffles_dropped

FEED_DAY = "feed_day"
_DAY_RE = r"(\d{4}-\d{2}-\d{2})"


def feed_dir(root: str, feed: str) -> str:
    return f"{root.rstrip('/')}/{feed}"


def iso_day(day: date | str) -> str:
    """``YYYY-MM-DD`` of a date or of its text; ``2024-1-2`` is 2024-01-02.

    Anything else raises: a day names files and folders, so it has one spelling.
    """
    if isinstance(day, datetime):
        return day.date().isoformat()
    if isinstance(day, date):
        return day.isoformat()
    m = re.fullmatch(r"(\d{4})-(\d{1,2})-(\d{1,2})", day.strip())
    if not m:
        raise ValueError(f"not a day: {day!r}")
    return date(*map(int, m.groups())).isoformat()


def path_missing(e: AnalysisException) -> bool:
    """Whether a read failed because nothing is at its path (and for no other reason)."""
    return e.getCondition() == "PATH_NOT_FOUND"


def feed_path(root: str, feed: str, day: date | str) -> str:
    return f"{feed_dir(root, feed)}/{feed}_{iso_day(day)}.jsonl"


def feed_glob(root: str, feed: str) -> str:
    return f"{feed_dir(root, feed)}/{feed}_*.jsonl"


def failed_path(root: str, feed: str, day: date | str) -> str:
    return f"{root.rstrip('/')}/{feed}_failed/{feed}_failed_{iso_day(day)}.txt"


def day_of_file(feed: str, path: Column | str) -> Column:
    """The ``YYYY-MM-DD`` of a feed file path (empty text if none)."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(path, rf"/{re.escape(feed)}_{_DAY_RE}\.jsonl(/|$)", 1)


def _lines(spark: SparkSession, ddl: str, mode: str):
    """Reader of JSON lines: part files and batches of a day alike."""
    return spark.read.schema(ddl).option("mode", mode).option("recursiveFileLookup", "true")


def _empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], struct_of(ddl))


# --------------------------------------------------------------------------
# Catalog day file
# --------------------------------------------------------------------------
def read_catalog(spark: SparkSession, root: str, day: date | str,
                 ddl: str = FILE_DDL[CATALOG]) -> DataFrame:
    """The catalog file of ``day``; a missing file raises, a bad line fails."""
    return _lines(spark, ddl, "FAILFAST").json(feed_path(root, CATALOG, day))


def feed_files(spark: SparkSession, root: str, feed: str) -> list[str]:
    """Every data file of a feed's days (file listing only, no data read)."""
    try:
        return sorted(spark.read.option("recursiveFileLookup", "true").text(feed_glob(root, feed)).inputFiles())
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return []


def day_in_path(feed: str, path: str) -> str:
    """The day that a feed file's path names (empty text if none)."""
    m = re.search(rf"/{re.escape(feed)}_{_DAY_RE}\.jsonl(/|$)", path)
    return m.group(1) if m else ""


def latest_feed_day(spark: SparkSession, root: str, feed: str) -> str:
    """Greatest day among the feed's files (file listing only, no data read)."""
    days = [d for f in feed_files(spark, root, feed) if (d := day_in_path(feed, f))]
    if not days:
        raise FileNotFoundError(f"no {feed} files under {feed_dir(root, feed)}")
    return max(days)


def read_catalog_or_latest(spark: SparkSession, root: str, day: date | str,
                           ddl: str = FILE_DDL[CATALOG]) -> DataFrame:
    """The day's catalog, else the greatest catalog file (may be newer)."""
    try:
        return read_catalog(spark, root, day, ddl)
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return read_catalog(spark, root, latest_feed_day(spark, root, CATALOG), ddl)


# --------------------------------------------------------------------------
# Output history of a feed
# --------------------------------------------------------------------------
def read_feed_history(spark: SparkSession, root: str, feed: str,
                      exclude_day: date | str | None = None,
                      ddl: str = HISTORY_DDL) -> DataFrame:
    """Every dated output file of ``feed`` (optionally without one day).

    Malformed lines are skipped.  Keys and flags are read as text (old files may
    quote them), or with their JSON type under ``HISTORY_TYPED_DDL``; a
    ``feed_day`` column names the file's day.  Only a feed without any file is an empty history; any other
    failure to read it raises.
    """
    try:
        df = _lines(spark, ddl, "DROPMALFORMED").json(feed_glob(root, feed))
    except AnalysisException as e:
        if not path_missing(e):  # only "never written" means nothing done yet
            raise
        return _empty(spark, ddl).withColumn(FEED_DAY, F.lit(None).cast("string"))
    df = df.withColumn(FEED_DAY, day_of_file(feed, F.col("_metadata.file_path")))
    if exclude_day is not None:
        df = df.filter(F.col(FEED_DAY) != F.lit(iso_day(exclude_day)))
    return df


def read_feed_day(spark: SparkSession, root: str, feed: str, day: date | str,
                  ddl: str = HISTORY_DDL) -> DataFrame:
    """Today's output for resuming; a missing file is an empty set."""
    try:
        return _lines(spark, ddl, "DROPMALFORMED").json(feed_path(root, feed, day))
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return _empty(spark, ddl)


def load_feed(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """A feed file in its raw table schema: unknown fields ignored, a bad
    record (malformed line or wrong type) fails the load."""
    return _lines(spark, RAW_DDL[feed], "FAILFAST").json(path)


# --------------------------------------------------------------------------
# Writers (K1, K2, K3)
# --------------------------------------------------------------------------
JSON_COLUMNS = ("raw", "error_payload")


def _embed_json(df: DataFrame) -> DataFrame:
    """JSON-text columns become VARIANT so lines hold nested objects."""
    out = []
    for f in df.schema.fields:
        if f.name in JSON_COLUMNS and isinstance(f.dataType, T.StringType):
            out.append(F.parse_json(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def write_feed_day(df: DataFrame, root: str, feed: str, day: date | str,
                   mode: str = "overwrite") -> str:
    """Write a day's feed lines: UTF-8 unescaped, NULL fields kept.

    ``overwrite`` replaces the day (catalog); ``append`` adds to it so an
    interrupted run resumes (details, reviews).
    """
    path = feed_path(root, feed, day)
    with shuffles_dropped(df.sparkSession):
        _feed_writer(df).mode(mode).json(path)
    return path


#: Lines of a part file; gzip is read from its start, so a part is what one task reads.
PART_LINES = 500_000


def _feed_writer(df: DataFrame):
    """Feed lines repeat their field names and envelope: gzip takes a twentieth of their
    disk, at level 6 a third less than at its fastest.  Readers take plain lines too."""
    return (_embed_json(df).write.option("ignoreNullFields", "false")
            .option("dateFormat", "yyyy-MM-dd").option("maxRecordsPerFile", PART_LINES)
            .option("compression", "gzip").option("zlib.compress.level", "SIX"))


def write_failed(keys: DataFrame, root: str, feed: str, day: date | str,
                 key: str = "appid", batch: str | None = None) -> str:
    """Append failed keys, one per line; those of a ``batch`` only once."""
    path = failed_path(root, feed, day)
    lines = keys.select(F.col(key).cast("string").alias("value"))
    if batch is None:
        lines.write.mode("append").text(path)
    else:
        add_batch(keys.sparkSession, path, batch, lines.write.text)
    return path


# --------------------------------------------------------------------------
# Batches of a day
# --------------------------------------------------------------------------
def payload_batch(payloads: DataFrame) -> str:
    """Name of the batch that some landed files are: a digest of their paths, sizes
    and times; a new name where ``payloads`` does not come from files."""
    files = payloads.inputFiles()
    return files_digest(payloads.sparkSession, files) if files else uuid.uuid4().hex


def files_digest(spark: SparkSession, files) -> str:
    """A digest of the paths, sizes and times of some files."""
    digest = hashlib.sha256()
    for f in sorted(files):
        fs, p = file_system(spark, f)
        s = fs.getFileStatus(p)
        digest.update(f"{f} {s.getLen()} {s.getModificationTime()}\n".encode())
    return digest.hexdigest()[:32]


def batch_path(path: str, batch: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.-]*", batch):
        raise ValueError(f"not a batch name: {batch!r}")
    return f"{path}/batch-{batch}"


def batch_done(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether a day's file or list at ``path`` holds the batch."""
    fs, p = file_system(spark, batch_path(path, batch))
    return fs.exists(p)


def add_batch(spark: SparkSession, path: str, batch: str, write) -> bool:
    """Add what ``write(folder)`` writes as a batch, unless it is there; whether it was added.

    Readers skip ``_`` names: an attempt is not seen until its folder is renamed.
    """
    fs, done = file_system(spark, batch_path(path, batch))
    if fs.exists(done):
        return False
    attempt = f"{path}/_attempt-{uuid.uuid4().hex}"
    write(attempt)
    # of two writers of a batch the second finds its folder there and gives way
    if fs.exists(done) or not fs.rename(file_system(spark, attempt)[1], done):
        fs.delete(file_system(spark, attempt)[1], True)
        if not fs.exists(done):
            raise OSError(f"can't add batch {batch} to {path}")
        return False
    return True


def write_feed_batch(df: DataFrame, root: str, feed: str, day: date | str, batch: str) -> str:
    """Add a batch of feed lines to a day, once."""
    path = feed_path(root, feed, day)
    add_batch(df.sparkSession, path, batch, lambda at: _feed_writer(df).json(at))
    return path


def read_failed(spark: SparkSession, root: str, feed: str, day: date | str) -> DataFrame:
    try:
        return spark.read.option("recursiveFileLookup", "true").text(failed_path(root, feed, day)).select(
            F.col("value").cast("bigint").alias("appid"))
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return _empty(spark, "appid bigint")
