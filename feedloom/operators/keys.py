"""Key sets of the incremental fetch: catalog order, processed and pending keys.

Key sets stay DataFrames end to end (no key list on the driver): the
difference is a ``left_anti`` join and the order is a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir

POSITION = "pos"


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _typed(df: DataFrame, name: str) -> Column:
    """A VARIANT column as it is; text as the JSON value it spells, or as text."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.VariantType):
        return c
    text = c.cast("string")
    return F.coalesce(F.try_parse_json(text), text.cast("variant"))


def _is_number(v: Column) -> Column:
    k = _kind(v)
    return (k == "BIGINT") | (k == "DOUBLE") | (k == "FLOAT") | k.startswith("DECIMAL")


def to_key(c: Column | str) -> Column:
    """``int(appid)`` of a VARIANT: numbers lose their fraction, quoted whole
    numbers count, NULL and JSON null are no key; other text fails (ANSI)."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.when(_is_number(c), F.variant_get(c, "$", "decimal(38, 9)").cast("bigint"))
            .when(_kind(c) == "BOOLEAN", F.variant_get(c, "$", "boolean").cast("bigint"))
            .when(_kind(c) != "VOID", F.trim(F.variant_get(c, "$", "string")).cast("bigint")))


def file_position(df: DataFrame) -> DataFrame:
    """Add ``pos``: the row's place in file order of a file-based DataFrame.

    Ordered by (file path, split start, row id in the task): a split is read
    by one task in line order, and the row id grows within a task, so the
    triple orders lines across files and splits without a global sort.
    """
    return df.withColumn(POSITION, F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ))


def nonnull_keys(df: DataFrame, key: str = "appid") -> DataFrame:
    """Coerce the VARIANT key like ``int(appid)`` and drop rows without one."""
    return df.withColumn(key, to_key(_typed(df, key))).filter(F.col(key).isNotNull())


def dedup_ordered(df: DataFrame, key: str = "appid", order: str = POSITION) -> DataFrame:
    """Unique keys, each at its first position (``dict.fromkeys`` order).

    A partial + final ``min`` per key: duplicates of a hot key are combined
    before the shuffle.
    """
    return df.groupBy(key).agg(F.min(order).alias(order))


def truthy(c: Column | str) -> Column:
    """Truth of a JSON value by its type: true, numbers but 0, and texts, lists
    and objects that are not empty (so the texts ``"false"`` and ``"0"`` too);
    JSON null and a missing value are false."""
    c = F.col(c) if isinstance(c, str) else c
    kind = _kind(c)
    return F.coalesce(
        F.when(kind == "BOOLEAN", F.try_variant_get(c, "$", "boolean"))
        .when(_is_number(c), F.try_variant_get(c, "$", "double") != 0)
        .when(kind == "STRING", F.try_variant_get(c, "$", "string") != "")
        .when(kind != "VOID", ~F.to_json(c).isin("[]", "{}")), F.lit(False))


def processed_keys(history: DataFrame, key: str = "appid",
                   success: str = "success") -> DataFrame:
    """Distinct keys with a truthy ``success`` (only successes count as done)."""
    return nonnull_keys(history.filter(truthy(_typed(history, success))).select(key), key).distinct()


def union_processed(*key_sets: DataFrame, key: str = "appid") -> DataFrame:
    """Historic ∪ today's processed keys (distinct).

    ``incremental.processed`` gets the same set from one scan of every output
    file; this is the explicit set operation for callers holding both sets.
    """
    out = key_sets[0].select(key)
    for other in key_sets[1:]:
        out = out.unionByName(other.select(key))
    return out.distinct()


def pending_keys(catalog_keys: DataFrame, processed: DataFrame,
                 key: str = "appid") -> DataFrame:
    """Catalog keys not yet processed; extra catalog columns (``pos``) kept.

    AQE broadcasts the processed side when it is measured small and falls
    back to a shuffled anti join otherwise.
    """
    return catalog_keys.join(processed.select(key), on=key, how="left_anti")


#: Keys up to which a limit is a sort that keeps its first rows in every task.
SORT_AT_MOST = 100_000
#: Row ids that share a chunk differ in these lowest bits only.
CHUNK_BITS = 16


def limit_pending(df: DataFrame, n: int | None, order: str = POSITION,
                  sort_at_most: int = SORT_AT_MOST) -> DataFrame:
    """First ``n`` keys in catalog order; ``None`` keeps all (unordered).

    More than ``sort_at_most`` keys are taken by counts (:func:`first_by_counts`, in no
    order), fewer by a sort.
    """
    if n is None:
        return df
    if n < 0:
        raise ValueError("limit must be >= 0")
    return df.orderBy(order).limit(n) if n <= sort_at_most else first_by_counts(df, n, order)


def first_by_counts(df: DataFrame, n: int, order: str = POSITION, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """The first ``n`` rows by a file position, without sorting them.

    Keys are counted by chunk of a split; prefix sums over files, and over the chunks of
    each file, tell in which chunk the nth key lies.  Only that chunk, at most
    2 ** ``chunk_bits`` rows, is sorted for the nth position; the result is a filter on it.
    ``df`` is written once to the shared scratch folder, so that all steps see the same
    positions.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "keys")
    if n == 0:
        return df.limit(0)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    at = {c: F.col(f"{order}.{c}") for c in ("file", "block", "row")}
    chunk = F.shiftright(at["row"], chunk_bits)
    sizes = kept.groupBy(at["file"].alias("file"), at["block"].alias("block"), chunk.alias("chunk")) \
        .agg(F.count(F.lit(1)).alias("n"))
    files = sizes.groupBy("file").agg(F.sum("n").alias("total"))  # a row a file
    before = files.select("file", (F.sum("total").over(Window.orderBy("file")) - F.col("total")).alias("before"))
    w = Window.partitionBy("file").orderBy("block", "chunk")
    last = (sizes.withColumn("upto", F.sum("n").over(w)).join(before, "file")
            .withColumn("upto", F.col("upto") + F.col("before"))
            .where((F.col("upto") >= n) & (F.col("upto") - F.col("n") < n)).first())
    if last is None:  # there are fewer
        return kept
    rows = kept.where((at["file"] == last.file) & (at["block"] == last.block) & (chunk == last.chunk)) \
        .select(at["row"].alias("row")).orderBy("row").limit(n - (last.upto - last.n))
    row = rows.agg(F.max("row")).first()[0]
    nth = F.struct(F.lit(last.file).alias("file"), F.lit(last.block).cast("long").alias("block"),
                   F.lit(row).cast("long").alias("row"))
    return kept.where(F.struct(*(c.alias(k) for k, c in at.items())) <= nth)
