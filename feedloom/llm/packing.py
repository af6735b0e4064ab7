"""Best-fit packing of documents into sequences of a fixed number of tokens.

Only the lengths decide the packing, and there are at most ``capacity`` of
them.  So Spark encodes the documents and counts the lengths; the bins are
planned from that histogram with counts in place of single items; and every
piece finds its place from its rank among the pieces of its length.  Ranks are
a running number within a partition plus a prefix sum over the partitions
before it; no step depends on the number of documents in one place.

The plan: pieces above a third of the capacity go at most two to a bin, the
largest with the largest that still fits (greedy matching); the smaller ones,
largest first, go to the fullest bin that still takes them (best fit).
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import clean_text, spill
from .tokens import encoder


def plan_bins(counts: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Segments (length, rank, n, bin, offset) and the number of bins.

    Pieces ``rank .. rank + n - 1`` of ``length`` go, one each, to the bins from
    ``bin`` on, at ``offset``.
    """
    left = {n: c for n, c in counts.items() if c}
    if left and not 0 < min(left) <= max(left) <= capacity:
        raise ValueError("lengths must lie between 1 and the capacity")
    used = dict.fromkeys(left, 0)
    segments: list[tuple] = []
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> (first bin, bins)
    free: list[int] = []  # the keys of room, ascending
    bins = 0

    def put(length: int, n: int, first: int, offset: int) -> None:
        segments.append((length, used[length], n, first, offset))
        used[length] += n
        left[length] -= n

    def keep(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in room:
                room[space] = []
                insort(free, space)
            room[space].append((first, n))

    # greedy matching of the large pieces
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        big = large[-1]
        at = bisect_left(large, capacity - big + 1) - 1
        mate = large[at] if at >= 0 else None
        if mate == big and left[big] < 2:
            mate = large[at - 1] if at >= 1 else None
        n = left[big] if mate is None else left[big] // 2 if mate == big else min(left[big], left[mate])
        put(big, n, bins, 0)
        if mate is not None:
            put(mate, n, bins, big)
        keep(capacity - big - (mate or 0), bins, n)
        bins += n
        large = [x for x in large if left[x]]

    # best fit of the small ones, largest first
    for size in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[size]:
            at = bisect_left(free, size)
            if at < len(free):
                space = free[at]
                first, n = room[space].pop()
                if not room[space]:
                    del room[space]
                    free.pop(at)
            else:
                space, first, n = capacity, bins, -(-left[size] // (capacity // size))
                bins += n
            each = min(space // size, left[size])
            full = min(n, left[size] // each)
            keep(space, first + full, n - full)
            for k in range(each):
                put(size, full, first, capacity - space + k * size)
            keep(space - each * size, first, full)
    return segments, bins


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; the first may be shorter."""
    first = n % capacity if n > capacity else n
    starts = [0] * bool(first) + list(range(first, n, capacity))
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2,
                   doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Place every token of every document: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset and, on request, ids (uint32 bytes).

    Null texts count as empty; each document gets ``end_id`` appended, so none is
    without tokens.  Documents longer than ``capacity`` are cut into pieces of
    ``capacity`` tokens, the first of which may be shorter.  Rows that repeat an
    id are packed one by one; other columns are ignored.  An empty table gives
    an empty table.  Sequence ids run from 0 without gaps.
    """
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
              "part long, nth long" + ", ids binary" * with_ids)
    names = [x.split()[0] for x in schema.split(", ")]

    def pieces(batches):
        part, seen = TaskContext.get().partitionId(), {}
        end = np.array([end_id], "<u4").tobytes()
        enc = encoder(tokenizer)
        for b in batches:
            rows = []
            for i, packed in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist())):
                packed = memoryview(packed + end)
                for k, (start, n) in enumerate(cut(len(packed) // 4, capacity)):
                    ids = packed[4 * start:4 * (start + n)]
                    nth = seen.get(n, 0)
                    seen[n] = nth + 1
                    row = (i, k, start, n, zlib.crc32(ids), part, nth)
                    rows.append((*row, bytes(ids)) if with_ids else row)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if x == "piece" else pa.binary() if x == "ids" else pa.int64())
                     for x, c in zip(names, zip(*rows))], names=names)

    cut_up = spill(docs.select(F.col(doc_id).cast("long"), clean_text(text))
                   .mapInArrow(pieces, schema), "pieces")
    by_part = cut_up.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = by_part.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in
              by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    segments, _ = plan_bins(counts, capacity)
    seg = np.array(sorted(segments), np.int64).reshape(-1, 5)
    starts = (seg[:, 0] << 44) + seg[:, 1]  # lengths and ranks as one sorted key
    shared = docs.sparkSession.sparkContext.broadcast((starts, seg))
    out = [x for x in names if x not in ("part", "nth")]

    def place(batches):
        starts, seg = shared.value
        for b in batches:
            rank = b.column("rank").to_numpy()
            s = seg[np.searchsorted(starts, (b.column("length").to_numpy() << 44) + rank, "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(x) for x in out), pa.array(s[:, 3] + rank - s[:, 1]), pa.array(s[:, 4])],
                names=[*out, "sequence_id", "offset"])

    ranked = (cut_up.join(base.select("part", "length", "base"), ["part", "length"])
              .select(*out, (F.col("base") + F.col("nth")).alias("rank")))
    types = dict(x.split() for x in schema.split(", "))
    return ranked.mapInArrow(place, ", ".join([f"{x} {types[x]}" for x in out]
                                              + ["sequence_id long", "offset long"]))
