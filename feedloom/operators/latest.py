"""Latest rows per key: every row at the key's greatest date (ties kept)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LATEST = "__latest_date"
_WORD, _BITS = "__latest_word", "__latest_bits"
#: Words of 64 bits that the hash filter has at most, whatever the number of keys.
WORDS = 1 << 19


def _word_and_bit(key: str, date: str) -> tuple[Column, Column]:
    """Word number and bit, as a word, of a (key, date) in the hash filter."""
    h = F.xxhash64(key, date)
    bit = F.pmod(F.shiftright(h, 32), F.lit(64)).cast("int")
    return F.pmod(h, F.lit(WORDS)), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def near_latest(rows: DataFrame, latest: DataFrame, key: str, date: str) -> DataFrame:
    """``rows`` without most of those whose (key, date) is not in ``latest``; no row that is in it is lost.

    A hash of each (key, date) sets one of 64 x ``WORDS`` bits, which are broadcast: up
    to some millions of keys few other rows pass, with more keys more do.  Rows that pass
    by chance are left to the join that follows.
    """
    word, bit = _word_and_bit(key, date)
    bits = latest.select(word.alias(_WORD), bit.alias(_BITS)).groupBy(_WORD).agg(F.bit_or(_BITS).alias(_BITS))
    return (rows.withColumn(_WORD, word).join(F.broadcast(bits), _WORD)
            .where(F.col(_BITS).bitwiseAND(bit) != 0).select(*rows.columns))


def latest_per_key(df: DataFrame, key: str = "appid", date: str = "ingestion_date",
                   method: str = "join") -> DataFrame:
    """Keep all rows whose ``date`` equals the maximum ``date`` of their ``key``.

    Rows with a NULL key or NULL date never match (left join + not-null test
    in the model SQL).  Three equal plans:

    * ``join`` (default): ``max(date) group by key`` and an inner join back on
      (key, date).  The max is a partial + final hash aggregate, so a hot key
      is combined map-side; the join's skewed (key, date) partitions are split.
      Wide columns (JSON text) are only carried on the probe side, and there
      ``near_latest`` drops rows of other days before they are shuffled.
    * ``rank``: ``rank() over (partition by key order by date desc) = 1``;
      one shuffle by key with a partial ``WindowGroupLimit`` before it.  All
      rows of one key meet in one task, so it is the choice only when keys
      are known not to be hot.
    * ``bucketed``: the join on the key alone, keeping rows whose date is not
      before the key's greatest.  Over a table bucketed by key neither the max
      nor the join moves a row; a hot key is then as large as its bucket.
    """
    valid = df.filter(F.col(key).isNotNull() & F.col(date).isNotNull())
    if method == "rank":
        w = Window.partitionBy(key).orderBy(F.col(date).desc())
        return (valid.withColumn("__rank", F.rank().over(w))
                .filter(F.col("__rank") == 1).drop("__rank"))
    if method == "bucketed":
        latest = valid.groupBy(key).agg(F.max(date).alias(_LATEST))
        return (valid.join(latest, key).where(F.col(date) >= F.col(_LATEST))
                .select(*df.columns))
    if method != "join":
        raise ValueError(f"unknown method {method!r}")
    latest = (valid.groupBy(key).agg(F.max(date).alias(_LATEST))
              .withColumnRenamed(_LATEST, date))
    return (near_latest(valid, latest, key, date).join(latest, on=[key, date], how="inner")
            .select(*df.columns))
