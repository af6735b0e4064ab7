"""Day-partitioned raw tables, idempotent day loads and model materialisation.

Raw tables are parquet folders partitioned by their day column
(``<root>/<feed>/<day_col>=YYYY-MM-DD/``).  They are addressed by path, so a
load touches only the folders of the days it writes; ``register_tables`` puts
them into the catalog for SQL and other sessions.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DATE_COLUMN, FEEDS, RAW_DDL, columns_of, struct_of
from ..session import file_system, scratch_dir, shuffles_dropped, size_listing, slices_at_once
from .feeds import iso_day


def table_path(root: str, feed: str) -> str:
    return f"{root.rstrip('/')}/{feed}"


def day_path(root: str, feed: str, day: date | str) -> str:
    return f"{table_path(root, feed)}/{DATE_COLUMN[feed]}={iso_day(day)}"


def raw(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """A raw table: explicit schema, day column from the folder names.

    Filters on the day column prune folders (``PartitionFilters``).  A table that
    was never created raises, so a mistyped root can't empty a mart.
    """
    size_listing(spark)
    path = table_path(root, feed)
    return (spark.read.schema(struct_of(RAW_DDL[feed])).option("basePath", path)
            .parquet(path))


def ensure_tables(spark: SparkSession, root: str) -> list[str]:
    """Create each raw table's folder when absent; existing ones are not listed."""
    paths = [table_path(root, feed) for feed in FEEDS]
    for path in paths:
        fs, p = file_system(spark, path)
        if not fs.exists(p) and not fs.mkdirs(p):
            raise OSError(f"can't create {path}")
    return paths


def register_tables(spark: SparkSession, root: str, db: str) -> list[str]:
    """Catalog tables ``<db>.<feed>`` over the raw folders, day-partitioned.

    They are external: every session of the catalog reads them, and dropping one
    keeps the data.  Days that the catalog does not know yet are added.
    """
    ensure_tables(spark, root)
    size_listing(spark)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    names = []
    for feed in FEEDS:
        name = f"{db}.{feed}"
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                         for f in struct_of(RAW_DDL[feed]).fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
                  f"PARTITIONED BY ({DATE_COLUMN[feed]}) LOCATION '{table_path(root, feed)}'")
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        names.append(name)
    return names


def create_latest_view(spark: SparkSession, name: str, table: str, feed: str,
                       columns: tuple[str, ...]) -> str:
    """A permanent view: distinct ``columns`` of each key's latest day in ``table``."""
    day, cols = DATE_COLUMN[feed], ", ".join(f"t.{c}" for c in columns)
    spark.sql(f"""
        CREATE OR REPLACE VIEW {name} AS
        SELECT DISTINCT {cols} FROM {table} t
        JOIN (SELECT appid, max({day}) AS day FROM {table} GROUP BY appid) m
          ON t.appid = m.appid AND t.{day} = m.day""")
    return name


def conform(df: DataFrame, feed: str) -> DataFrame:
    """The raw table's columns in order; absent columns become typed NULLs."""
    have = set(df.columns)
    return df.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in struct_of(RAW_DDL[feed]).fields])


#: Slices of days in which the rows of other days than the loaded one are sorted.
SLICES = 8
_SLICE = "slice"


def replace_day(df: DataFrame, root: str, feed: str, day: date | str) -> None:
    """Day load: the day's folder is replaced by the day's rows.

    ``df`` is scanned once, into a scratch table, so a bad record anywhere in it
    fails the load while the old day is still whole.  The day's rows are
    range-partitioned and sorted by appid (tight min/max statistics per file)
    into a folder beside the day, which then takes the day's place by a rename.
    The day is replaced also when the feed has no row of it (it is then emptied).

    Rows dated another day are appended to their days without clearing them; a
    load that is run again appends them again.  They are range-partitioned on
    (day, appid), so each task writes few folders and no day lands in one task.
    This is done for one slice of days after another, each with its own files in the
    scratch table: a slice's files and shuffle go when it is written.  Its folders are
    beside the days too and join them when all slices are written.
    """
    spark, col = df.sparkSession, DATE_COLUMN[feed]
    staged, day = scratch_dir(spark, "load"), iso_day(day)
    of_day = F.col(col).eqNullSafe(F.lit(day).cast("date"))
    rows = conform(df, feed).withColumn(_SLICE, F.when(of_day, 0).otherwise(
        F.pmod(F.xxhash64(col), F.lit(SLICES)) + 1).cast("int"))
    with slices_at_once(spark, SLICES + 1):
        rows.write.partitionBy(_SLICE).option("compression", "zstd").parquet(staged)

    data_cols = [c for c in columns_of(RAW_DDL[feed]) if c != col]
    beside = f"{table_path(root, feed)}/_load-{uuid.uuid4().hex}"  # readers skip "_" names
    new, others = f"{beside}/day", f"{beside}/others"
    # a fixed range count: AQE would merge small ranges into a few tasks that
    # then write every day folder one after another
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for k in range(SLICES + 1):
        at = f"{staged}/{_SLICE}={k}"
        fs, p = file_system(spark, at)
        if not fs.exists(p) and (k or not fs.mkdirs(p)):
            continue
        part = spark.read.schema(struct_of(RAW_DDL[feed])).parquet(at)
        with shuffles_dropped(spark):
            if k:
                (part.select(*columns_of(RAW_DDL[feed])).repartitionByRange(n, col, "appid")
                 .sortWithinPartitions(col, "appid").write.mode("append").option("compression", "zstd")
                 .partitionBy(col).parquet(others))
            else:
                (part.select(*data_cols).repartitionByRange("appid").sortWithinPartitions("appid")
                 .write.option("compression", "zstd").parquet(new))
        fs.delete(p, True)

    target = day_path(root, feed, day)
    fs, p = file_system(spark, target)
    fs.delete(p, True)
    if not fs.rename(file_system(spark, new)[1], p):
        raise OSError(f"can't move {new} to {target}")
    if fs.exists(file_system(spark, others)[1]):
        for s in fs.listStatus(file_system(spark, others)[1]):
            if s.isDirectory():
                add_folder(spark, s.getPath().toString(), f"{table_path(root, feed)}/{s.getPath().getName()}")
    for left in (beside, staged):
        fs, p = file_system(spark, left)
        fs.delete(p, True)


def add_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the files of a folder into another; their names are unique to a load."""
    fs, p = file_system(spark, source)
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if not name.startswith(("_", ".")) and not fs.rename(s.getPath(), file_system(spark, f"{target}/{name}")[1]):
            raise OSError(f"can't move {s.getPath()} to {target}")


def add_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to ``target``, or its files into it where that is there."""
    fs, p = file_system(spark, target)
    if fs.exists(p):
        add_files(spark, source, target)
    elif not fs.rename(file_system(spark, source)[1], p):
        raise OSError(f"can't move {source} to {target}")


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Staging models are views."""
    df.createOrReplaceTempView(name)
    return df


def as_table(df: DataFrame, name: str, path: str | None = None,
             buckets: int | None = None, key: str = "appid") -> None:
    """Marts are rebuilt in full on each run (catalog table, optional path).

    With ``buckets`` the table is bucketed and sorted by ``key``: two tables
    bucketed alike join on ``key`` without a shuffle on either side.
    """
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    if buckets:
        # one task a bucket, so one file a bucket
        w = (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
             .bucketBy(buckets, key).sortBy(key))
        if path:
            w = w.option("path", path)
    w.saveAsTable(name)
