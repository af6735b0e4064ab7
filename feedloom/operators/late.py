"""Latest rows by locator, and a distinct that only tied keys pay for.

``latest_located`` picks the latest rows on narrow columns and says where each lies
(its parquet file and row); ``fetch`` reads wide columns of such rows, and of no
others, from the files.  What is shuffled are locators, never the wide columns.

Each row also says how many rows its key has on its latest day.  A key with one row
can have no duplicate, so ``distinct_ties`` puts only the rows of other keys through
the full-row distinct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

ROWS_AT_LATEST = "__rows_at_latest"
FILE, ROW = "__file", "__row"
#: Rows of a file that one task fetches: a large file is read by many tasks.
BLOCK = 1 << 18


def latest_days(df: DataFrame, key: str = "appid", date: str = "ingestion_date") -> DataFrame:
    """(key, date, rows): each key's greatest date and how many rows it has on it.

    Counts by (key, date) are partial first, and so is the maximum over a key's
    dates: a hot key is combined map-side in both.
    """
    days = (df.filter(F.col(key).isNotNull() & F.col(date).isNotNull())
            .groupBy(key, date).agg(F.count(F.lit(1)).alias(ROWS_AT_LATEST)))
    latest = days.groupBy(key).agg(F.max(date).alias("__latest"),
                                   F.max_by(ROWS_AT_LATEST, date).alias(ROWS_AT_LATEST))
    return latest.withColumnRenamed("__latest", date)


def latest_counted(df: DataFrame, key: str = "appid", date: str = "ingestion_date") -> DataFrame:
    """The rows of ``latest_per_key`` with ``__rows_at_latest``, the rows of the key among them."""
    return (df.join(latest_days(df.select(key, date), key, date), [key, date])
            .select(*df.columns, ROWS_AT_LATEST))


def latest_located(table: DataFrame, key: str = "appid", date: str = "ingestion_date",
                   columns: tuple[str, ...] = ()) -> DataFrame:
    """key, date, ``columns``, ``__file``, ``__row``, ``__rows_at_latest`` of the latest rows.

    ``table`` reads parquet files (filters on it are fine); only these columns are scanned.
    """
    narrow = table.select(key, date, *columns, F.col("_metadata.file_path").alias(FILE),
                          F.col("_metadata.row_index").alias(ROW))
    return latest_counted(narrow, key, date)


def fetch(located: DataFrame, wide: T.StructType | str, block: int = BLOCK) -> DataFrame:
    """``located`` with the columns ``wide`` of the rows it locates, without its locators.

    Rows go to tasks by (file, block of rows), in file order.  A task reads only row
    groups that hold wanted rows, and of these one batch at a time.  A file that pyarrow
    has no file system for raises.
    """
    schema = T.StructType.fromDDL(wide) if isinstance(wide, str) else wide
    kept = [f for f in located.schema.fields if f.name not in (FILE, ROW)]
    out = T.StructType(kept + schema.fields)
    names, types = schema.names, [to_arrow_type(f.dataType) for f in schema.fields]
    own = [f.name for f in kept]

    def run(batches):  # by value: workers need not have this package
        import numpy as np
        import pyarrow as pa
        from pyarrow.fs import FileSystem
        from pyarrow.parquet import ParquetFile

        at, reader, ends, group, held, lo, parts = None, None, None, -1, None, 0, None
        for b in batches:
            files = b.column(FILE)
            place = b.column(ROW).to_numpy()
            k = 0
            while k < b.num_rows:
                file = files[k].as_py()
                if file != at:
                    if reader is not None:
                        reader.close()
                    fs, path = FileSystem.from_uri(file)
                    reader, at, group = ParquetFile(fs.open_input_file(path)), file, -1
                    m = reader.metadata
                    ends = np.cumsum([m.row_group(g).num_rows for g in range(m.num_row_groups)])
                g = int(np.searchsorted(ends, place[k], side="right"))
                if g != group or place[k] < lo:
                    parts = reader.iter_batches(batch_size=4096, row_groups=[g], columns=names)
                    group, lo, held = g, int(ends[g - 1]) if g else 0, next(parts)
                while place[k] >= lo + held.num_rows:
                    lo, held = lo + held.num_rows, next(parts)
                # rows from here on in the same file and batch, in file order
                n = k + 1
                while n < b.num_rows and place[n - 1] < place[n] < lo + held.num_rows and files[n].as_py() == file:
                    n += 1
                rows = held.take(pa.array(place[k:n] - lo))
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).slice(k, n - k) for c in own]
                    + [rows.column(c).cast(t) for c, t in zip(names, types)], names=own + names)
                k = n

    return (located.repartition(F.col(FILE), F.floor(F.col(ROW) / F.lit(block)))
            .sortWithinPartitions(FILE, ROW).mapInArrow(run, out))


def distinct_ties(rows: DataFrame, shape=lambda df: df) -> DataFrame:
    """Distinct rows of ``shape(rows)``, where ``__rows_at_latest`` tells which can repeat.

    Rows that are alone on their key's latest day pass by; the others go through a
    full-row distinct.  ``shape`` maps rows one by one, keeps the key, and drops the count.
    ``rows`` is read twice, each row in one of the two: hand over a written table.
    """
    alone = rows.where(F.col(ROWS_AT_LATEST) == 1).drop(ROWS_AT_LATEST)
    tied = rows.where(F.col(ROWS_AT_LATEST) > 1).drop(ROWS_AT_LATEST)
    return shape(alone).unionByName(shape(tied).distinct())
