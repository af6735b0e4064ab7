"""Session helper and the shared scratch folder.

Jobs cut lineage and stage intermediate files only under the folder the
cluster names in ``spark.checkpoint.dir``.  A folder of our own is set only
when a session in one process (master ``local[...]``, as in tests) has none; any
other session must name one.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # checkpointed models (staging) are removed once no DataFrame uses them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # a JSON object that repeats a key keeps its last value
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "feedloom", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, ANSI SQL and AQE on."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(k, conf[k])
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and "
                             "all executors share")
        configured = tempfile.mkdtemp(prefix="feedloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


#: Tasks that list folders, and Spark's own setting of it.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_DEFAULT = 10_000


def size_listing(spark: SparkSession) -> None:
    """List folders by four tasks a core of the session, in place of a task a folder.

    A table of thousands of days otherwise spends a task on each whenever it is read or
    its days are registered.  A session that has set the number keeps it.
    """
    if int(spark.conf.get(LISTING)) == LISTING_DEFAULT:
        spark.conf.set(LISTING, str(min(LISTING_DEFAULT - 1, 4 * spark.sparkContext.defaultParallelism)))


#: Whether a statement's shuffle files are removed when it ends (else whenever the driver collects garbage).
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Files that a task of a partitioned write has open at most (more: it sorts its rows first).
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str, default: str) -> Iterator[None]:
    before = spark.conf.get(key, default)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shuffles_dropped(spark: SparkSession):
    """Remove the shuffle files of each write in the block as soon as it ends."""
    return _setting(spark, DROP_SHUFFLES, "true", "false")


def slices_at_once(spark: SparkSession, n: int):
    """Writes in the block, partitioned by a column of ``n`` values, do not sort rows by it."""
    return _setting(spark, OPEN_FILES, str(n), "0")


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch_dir(spark: SparkSession, label: str = "scratch") -> str:
    """A fresh folder under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/feedloom-{label}-{uuid.uuid4().hex[:12]}"
