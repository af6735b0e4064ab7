"""Shared helpers: scratch tables, words, row keepers, folds."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: A word is a maximal run of anything but the six ASCII white-space characters.
#: ``bytes.split()`` splits on exactly this set, so Python code uses that.
WORD = r"[^\x20\x09-\x0D]+"


_SHIPPED: set = set()


def ship(spark: SparkSession) -> None:
    """Give the workers of a session this package, once (as --py-files would)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="feedloom-py-"), "feedloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    A session in a single process (master ``local[...]``, as in tests) gets a
    temporary folder where the setting is missing; any other session must name
    a folder that its driver and executors share.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and "
                         "all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="feedloom-llm-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_root(spark)}/llm-{label}-{uuid.uuid4().hex[:12]}"


def spill(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts lineage and survives lost executors; the explicit schema saves the
    footer scan.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_text(text: str = "text") -> Column:
    """The text column with null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def n_words(text: str = "text") -> Column:
    return F.regexp_count(clean_text(text), F.lit(WORD)).cast("long")


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus`` (null id: 0)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus, F.lit(0))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores after it as keep it apart from the
    columns of ``df`` (whose case does not count)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def column(df: DataFrame, name: str) -> Column:
    """A column by its name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def keep_rows(docs: DataFrame, keepers: DataFrame, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``keepers`` (doc_id, text_hash, ties) names.

    ``text_hash`` is ``xxhash64`` of the text (null as empty).  A keeper whose
    (id, text) pair is repeated in ``docs`` (``ties`` > 1) keeps one row of the
    repeats; only such rows are shuffled again, combined map-side.
    """
    cols = docs.columns
    i, h, n, row = free_names(docs, "__id", "__th", "__ties", "__row")
    k = keepers.select(F.col("doc_id").alias(i), F.col("text_hash").alias(h),
                       F.col("ties").alias(n)).distinct()
    on = docs[doc_id].eqNullSafe(F.col(i)) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == F.col(h))
    once = docs.join(k.where(F.col(n) == 1), on, "left_semi")
    tied = docs.join(k.where(F.col(n) > 1), on, "left_semi")
    first = (tied.withColumn(h, F.xxhash64(clean_text(text)))
             .groupBy(F.col(doc_id).alias(i), h)
             .agg(F.first(F.struct(*[column(docs, c) for c in cols])).alias(row))
             .select(*[F.col(row)[c].alias(c) for c in cols]))
    return once.unionByName(first)


def numbered(df: DataFrame, keys: list[str], order: list[str], number: str = "number") -> DataFrame:
    """``df`` with ``number``: its rows from 0 in ``order`` within equal ``keys`` (one
    numbering of all rows without keys).

    The rows are sorted by ranges of (keys, order), numbered in a stream, and get as a base
    the rows of their key in the ranges before; no key has to fit a task.  ``number``
    and the order's columns are the caller's to keep free.
    """
    names = df.columns
    place = {c: f"c{k}" for k, c in enumerate(names)}  # Python stages take plain names only
    flat = df.toDF(*place.values())
    keys, order = [place[k] for k in keys], [place[c] for c in order]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in flat.schema] + ["part long", "at long"])
    where = [flat.columns.index(k) for k in keys]

    def run(batches):
        me, last, n = TaskContext.get().partitionId(), None, 0
        for b in batches:
            places = []
            for key in zip(*(b.column(k).to_pylist() for k in where)) if where else ((),) * b.num_rows:
                n = n + 1 if key == last else 0
                last = key
                places.append(n)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([me] * b.num_rows, pa.int64()), pa.array(places, pa.int64())],
                names=[*b.schema.names, "part", "at"])

    by = keys + order
    laid = spill(flat.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, schema), "numbered")
    # a row a partition and key that meet
    parts = laid.groupBy(*keys, "part").agg(F.count("*").alias("m"))
    window = (W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))).orderBy("part")
    base = spill(parts.withColumn("base", F.coalesce(F.sum("m").over(
        window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).where("base > 0"), "bases")
    b, d = base.alias("b"), laid.alias("d")
    on = F.col("d.part") == F.col("b.part")
    for k in keys:
        on = on & F.col(f"d.{k}").eqNullSafe(F.col(f"b.{k}"))
    return d.join(b, on, "left").select(*[F.col(f"d.{place[c]}").alias(c) for c in names],
                                        (F.col("d.at") + F.coalesce("b.base", F.lit(0))).alias(number))
