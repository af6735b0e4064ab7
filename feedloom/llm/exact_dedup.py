"""Exact dedup with a heavy-hitter split.

1. Every text gets its SHA-256; (id, digest, row) goes to a narrow table.
2. Misra-Gries summaries of ``counters`` counters, one per partition, are added
   up by digest.  A summed count is below the true count by at most
   n / (counters + 1), so every digest held by ``share`` of the rows or more
   sums to at least n * (share - 1 / (counters + 1)); the digests that do are
   the candidates, fewer than 1 / (share - 1 / (counters + 1)) of them.
3. One exact pass over the narrow table, combined map-side, verifies the
   candidates.  The verified winners, at most 1 / share rows, are broadcast and
   their copies are settled without a shuffle.
4. All other digests go through an ordinary shuffle: a group's size and best row
   are combined map-side, and the digests held more than once are joined back.
   No group is gathered in one task.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean_text, keep_rows, spill

#: Misra-Gries counters of a partition, and the share of all rows that makes a
#: digest a heavy hitter.
COUNTERS = 1000
SHARE = 0.01


def misra_gries(summary: dict, counts: dict, k: int) -> dict:
    """Merge ``counts`` into ``summary`` and cut back to ``k`` counters.

    Cutting takes the (k+1)-th largest count off all: the merge rule that keeps
    the error of the whole stream at n / (k + 1).
    """
    for d, c in counts.items():
        summary[d] = summary.get(d, 0) + c
    if len(summary) <= k:
        return summary
    cut = sorted(summary.values(), reverse=True)[k]
    return {d: c - cut for d, c in summary.items() if c > cut}


def heavy_candidates(digests: DataFrame, n: int, counters: int = COUNTERS,
                     share: float = SHARE) -> DataFrame:
    """Digests whose summed Misra-Gries count allows ``share`` of ``n`` rows."""

    def summarise(batches):
        held: dict = {}
        for b in batches:
            vc = b.column(0).value_counts()
            held = misra_gries(held, dict(zip(vc.field(0).to_pylist(), vc.field(1).to_pylist())),
                               counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
            names=["digest", "c"])

    least = max(1.0, n * (share - 1.0 / (counters + 1)))
    return (digests.select("digest").mapInArrow(summarise, "digest string, c long")
            .groupBy("digest").agg(F.sum("c").alias("c"))
            .where(F.col("c") >= least).select("digest"))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     counters: int = COUNTERS, share: float = SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty.  Of equal texts the
    row with the largest id stays (null ids last; of rows that repeat an id
    with its text one stays).  ``keep_id`` is the id of that row.  Other columns
    are ignored.  An empty table gives an empty table.
    Extra columns ``text_hash`` and ``row`` serve :func:`drop_duplicates`.
    """
    if share <= 2.0 / (counters + 1):
        raise ValueError("share must exceed 2 / (counters + 1)")
    narrow = spill(docs.select(
        F.col(doc_id).alias("doc_id"), F.sha2(clean_text(text), 256).alias("digest"),
        F.xxhash64(clean_text(text)).alias("text_hash"),
        F.monotonically_increasing_id().alias("row")), "digests")
    n = narrow.count()
    best = F.max(F.struct(F.col("doc_id"), F.col("row"))).alias("best")
    # at most 1 / (share - 1 / (counters + 1)) candidates, 1 / share winners
    candidates = spill(heavy_candidates(narrow, n, counters, share), "candidates")
    winners = spill(narrow.join(F.broadcast(candidates), "digest")
                    .groupBy("digest").agg(F.count("*").alias("group_size"), best)
                    .where(F.col("group_size") >= n * share), "winners")
    heavy = narrow.join(F.broadcast(winners), "digest")
    light = narrow.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    # written, so that both sides of the join come from exchanges and adaptive
    # execution can split a partition or broadcast a small side
    groups = spill(light.groupBy("digest").agg(F.count("*").alias("group_size"), best)
                   .where("group_size > 1"), "groups")
    rest = (light.join(groups, "digest", "left")
            .withColumn("group_size", F.coalesce("group_size", F.lit(1)).cast("long"))
            .withColumn("best", F.coalesce("best", F.struct("doc_id", "row"))))
    cols = ["doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
            (F.col("row") == F.col("best.row")).alias("kept"),
            F.col("digest").alias("text_sha256"), "text_hash", "row"]
    return heavy.select(*cols).unionByName(rest.select(*cols))


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``docs`` with one row of each set of equal texts, all columns kept."""
    found = exact_duplicates(docs, doc_id, text, **kw)
    # kept rows have distinct digests; repeats of (id, text) are the ties
    ties = (found.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .groupBy("text_sha256").agg(F.first("doc_id").alias("doc_id"),
                                        F.first("text_hash").alias("text_hash"),
                                        F.count("*").alias("ties")))
    return keep_rows(docs, ties, doc_id, text)
