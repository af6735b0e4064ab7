"""Mixing sources to target weights along a time-varying curriculum.

Training time runs from 0 to 1.  Each source has a weight schedule, a piecewise
linear density over that time with integral 1; its cumulative token demand at t
is its target times the integral of the density up to t.  A source's documents,
in an order fixed by the MD5 of the id, lie end to end and are repeated as often
as the target asks; a copy whose midpoint comes before the target gets the
training position at which the cumulative demand reaches that midpoint (the
inverse of the demand), any later copy is not taken.  Range-sorting the copies
by position gives the training order.

Running sums never put a source into one task: documents are range-sorted by
(source, order), each partition sums up in a stream, and its base is the prefix
sum of the partitions before it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import clean_text, column, free_names, n_words, numbered, spill

#: Weights by the sources' order, repeating; what all sources share of the total
#: size; the most a source may be repeated.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
#: Density knots (time, density) of the sources, by order, repeating: the first
#: kind stays level, the second fades out, the third comes in late.
SCHEDULES = (
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.6), (0.5, 1.0), (1.0, 0.4)),
    ((0.0, 0.4), (0.5, 1.0), (1.0, 1.6)),
)


def invert_schedule(knots, share: np.ndarray) -> np.ndarray:
    """Times at which the integral of the density reaches ``share`` (0 to 1)."""
    t = np.array([k[0] for k in knots], float)
    d = np.array([k[1] for k in knots], float)
    area = np.concatenate([[0.0], np.cumsum((d[1:] + d[:-1]) / 2 * np.diff(t))])
    d, area = d / area[-1], area / area[-1]
    k = np.clip(np.searchsorted(area, share, "right") - 1, 0, len(t) - 2)
    a, slope, rest = d[k], (d[k + 1] - d[k]) / (t[k + 1] - t[k]), share - area[k]
    # rest = a x + slope x^2 / 2, in the form that holds for slope 0
    root = np.sqrt(np.maximum(a * a + 2 * slope * rest, 0))
    return np.clip(t[k] + 2 * rest / np.maximum(a + root, 1e-300), 0, 1)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_repeats: float = MAX_REPEATS) -> DataFrame:
    """(source, source_size, rank, weight, target) from (source, source_size).

    Sources take ``weights`` by code point order, null last.  The level at which
    targets weight * level, cut at ``max_repeats`` times the source's size, add
    up to ``share`` of all sizes is reached by cutting what is above and sharing
    the excess anew; each pass is one sum over the sources.
    """
    order = W.orderBy(F.col("source").isNull(), "source")  # one row a source
    ranked = spill(sizes.withColumn("rank", F.row_number().over(order) - 1)
                   .withColumn("weight", F.element_at(
                       F.array(*[F.lit(float(w)) for w in weights]),
                       (F.col("rank") % len(weights) + 1).cast("int")))
                   .withColumn("most", F.col("source_size") * F.lit(float(max_repeats))), "sources")
    budget = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, cut = 0.0, -1
    while True:
        over = F.col("most") <= F.col("weight") * F.lit(level)
        r = ranked.agg(F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0.0)).alias("held"),
                       F.count(F.when(over, 1)).alias("cut"),
                       F.sum(F.when(~over, F.col("weight"))).alias("open")).first()
        if r["cut"] == cut or not r["open"]:
            break
        level, cut = (budget - r["held"]) / r["open"], r["cut"]
    return ranked.select("source", "source_size", "rank", "weight",
                         F.least(F.col("weight") * F.lit(level), "most").alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, share: float = SHARE, max_repeats: float = MAX_REPEATS,
        schedules=SCHEDULES) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, repeat, source_size, target,
    positions.

    ``positions`` holds the training positions (0 to 1) of the copies that the
    mix takes of the row.  ``size`` is the number of words (null text: 0);
    ``repeat`` numbers rows of equal (doc_id, source, size) from 0; they lie next to each
    other, each at a place of its own.  A null source is a source of its own, the last one.
    A document without words takes up no room; it is taken where it lies.  Where
    all sizes are 0, every document is taken once, at the start.  Other columns
    are ignored; an empty table gives an empty table.
    """
    sizes = spill(docs.groupBy(F.col(doc_id).cast("long").alias("doc_id"),
                               F.col(source).cast("string").alias("source"),
                               n_words(text).alias("size"))
                  .agg(F.count("*").alias("rows"))
                  .withColumn("ord", F.md5(F.col("doc_id").cast("string"))), "sizes")
    targets = spill(source_targets(sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size")), weights, share, max_repeats), "targets")

    def run(batches):
        part, last, total = TaskContext.get().partitionId(), None, 0
        for b in batches:
            before = []
            for s, n, m in zip(b.column("source").to_pylist(), b.column("size").to_pylist(),
                               b.column("rows").to_pylist()):
                if last is None or s != last[0]:
                    last, total = (s,), 0
                before.append(total)
                total += n * m
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([part] * len(before), pa.int64()), pa.array(before, pa.int64())],
                names=[*b.schema.names, "part", "before"])

    by = [F.col("source").isNull(), "source", "ord", "doc_id", "size"]
    laid = spill(sizes.repartitionByRange(*by).sortWithinPartitions(*by)
                 .mapInArrow(run, "doc_id long, source string, size long, rows long, ord string, "
                                  "part long, before long"), "laid")
    # a row a partition and source that meet
    parts = laid.groupBy("source", "part").agg(F.sum(F.col("size") * F.col("rows")).alias("n"))
    base = parts.withColumn("base", F.coalesce(F.sum("n").over(
        W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    base = base.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))) \
        .select("b.source", "b.part", "b.base", "t.source_size", "t.target", "t.rank")
    at = (laid.alias("d").join(base.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source"))
                               & (F.col("d.part") == F.col("b.part")))
          .select("d.doc_id", "d.source", "d.size", "b.source_size", "b.target", "b.rank",
                  (F.col("base") + F.col("before")).alias("start"),
                  F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("repeat"))
          .withColumn("mid", F.col("start") + F.col("size") * F.col("repeat") + F.col("size") / 2))
    copies = int(np.ceil(max_repeats))
    schema = ("doc_id long, source string, size long, repeat long, source_size long, target double, "
              "positions array<double>")
    names = [x.split()[0] for x in schema.split(", ")]

    def place(batches):
        for b in batches:
            mid, size, target = (b.column(x).to_numpy().astype(float)
                                 for x in ("mid", "source_size", "target"))
            rank = b.column("rank").to_numpy()
            laps = np.arange(copies)[None, :] * size[:, None] + mid[:, None]
            taken = laps < target[:, None]
            taken[size == 0, 0] = True
            share_at = np.clip(laps / np.maximum(target, 1e-300)[:, None], 0, 1) * (size > 0)[:, None]
            pos = np.zeros_like(laps)
            for k, knots in enumerate(schedules):
                own = rank % len(schedules) == k
                pos[own] = invert_schedule(knots, share_at[own])
            yield pa.RecordBatch.from_arrays(
                [b.column(x) for x in names[:-1]]
                + [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], taken.sum(1).cumsum()]), pa.int32()),
                                            pa.array(pos[taken]))], names=names)

    return at.mapInArrow(place, schema)


def training_order(plan: DataFrame) -> DataFrame:
    """(doc_id, source, size, repeat, copy, position, rank): the copies of a mix, ranked
    from 0 in training order (by position; then id, null first, source, size, repeat, copy)."""
    copies = plan.select("doc_id", "source", "size", "repeat",
                         F.posexplode("positions").alias("copy", "position"))
    return numbered(copies, [], ["position", "doc_id", "source", "size", "repeat", "copy"], "rank")


def ranked_mix(docs: DataFrame, **kw) -> DataFrame:
    """:func:`mix` with ``ranks``, the places of the positions in the training order."""
    plan = spill(mix(docs, **kw), "mix")
    key = ["doc_id", "source", "size", "repeat"]
    # a row's copies, at most the greatest repeat of them
    ranks = spill(training_order(plan).groupBy(*key).agg(
        F.sort_array(F.collect_list("rank")).alias("ranks")), "ranks").alias("r")
    on = F.lit(True)
    for k in key:
        on = on & F.col(f"p.{k}").eqNullSafe(F.col(f"r.{k}"))
    return (plan.alias("p").join(ranks, on, "left")
            .select("p.*", F.coalesce("r.ranks", F.array().cast("array<long>")).alias("ranks")))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    source: str = "source", **kw) -> DataFrame:
    """``docs`` as the mix takes it, in training order: every row once for each
    copy, range-sorted by position; rows without a copy are dropped.  All
    columns stay."""
    cols = [column(docs, c) for c in docs.columns]
    i, s, z, r, at, h, n = free_names(docs, "__id", "__source", "__size", "__repeat", "__at", "__th", "__n")
    plan = spill(mix(docs, doc_id, text, source, **kw), "mix")
    keyed = (docs.withColumn(i, F.col(doc_id).cast("long")).withColumn(s, F.col(source).cast("string"))
             .withColumn(z, n_words(text)))
    same = [i, s, z]
    names = plan.select(F.col("doc_id").alias(i), F.col("source").alias(s), F.col("size").alias(z),
                        F.col("repeat").alias(r), "positions")

    def match(a, b, on):
        cond = F.lit(True)
        for c in on:
            cond = cond & a[c].eqNullSafe(b[c])
        return cond

    # rows that repeat (id, source, size) are numbered as their places are
    often = spill(names.where(F.col(r) > 0).select(*same).distinct(), "repeats")
    once = keyed.join(often, match(keyed, often, same), "left_anti").withColumn(r, F.lit(0).cast("long"))
    again = keyed.join(often, match(keyed, often, same), "left_semi").withColumn(h, F.xxhash64(clean_text(text)))
    again = numbered(again, same, [h], r).drop(h)
    rows = once.unionByName(again)
    copies = names.select(*[F.col(c).alias(f"{c}{n}") for c in (*same, r)], F.explode("positions").alias(at))
    both = rows
    cond = F.lit(True)
    for c in (*same, r):
        cond = cond & F.col(c).eqNullSafe(F.col(f"{c}{n}"))
    both = rows.join(copies, cond)
    return (both.repartitionByRange(at, i, s, z, r).sortWithinPartitions(at, i, s, z, r).select(*cols))


def _inverse_sql(x: str, kind: str, schedules=SCHEDULES) -> str:
    """SQL of :func:`invert_schedule`, its operations in the same order."""
    out = "CASE"
    for k, knots in enumerate(schedules):
        t = np.array([p[0] for p in knots], float)
        d = np.array([p[1] for p in knots], float)
        area = np.concatenate([[0.0], np.cumsum((d[1:] + d[:-1]) / 2 * np.diff(t))])
        d, area = d / area[-1], area / area[-1]
        for j in range(len(t) - 2, -1, -1):
            a, slope, low, start = (f"'{float(v)!r}'::DOUBLE" for v in (
                d[j], 2 * ((d[j + 1] - d[j]) / (t[j + 1] - t[j])), area[j], t[j]))
            rest = f"({x} - {low})"
            out += (f" WHEN {kind} = {k}" + (f" AND {x} >= {low}" if j else "")
                    + f" THEN greatest(least({start} + 2 * {rest} / greatest({a} + sqrt(greatest("
                      f"{a} * {a} + {slope} * {rest}, 0)), 1e-300), 1), 0)")
    return out + " END"


#: DuckDB SQL of the query: closed form of the shared level over the sources,
#: running sums in MD5 order.
MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3 + 1)::INT] AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, 2.0::DOUBLE * source_size AS most,
         row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source_size) AS k FROM s
), c AS (
  SELECT *, coalesce(sum(most) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
         1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE AS budget FROM r
), l AS (
  SELECT arg_min((budget - held) / open, k) FILTER (WHERE most > weight * ((budget - held) / open)) AS level FROM c
), t AS (
  SELECT source, source_size, least(weight * coalesce(level, 0), most) AS target, (row_number() OVER (
         ORDER BY source IS NULL, source COLLATE "C") - 1) % 3 AS kind FROM r, l
), p AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, t.kind,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(d.doc_id::VARCHAR), d.doc_id, d.size
                           ROWS UNBOUNDED PRECEDING) - d.size + d.size / 2.0 AS mid,
         row_number() OVER () AS row
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least((mid + copy * source_size)::DOUBLE / greatest(target, 1e-300), 1) END::DOUBLE AS x
  FROM p, (SELECT unnest([0, 1]) AS copy)
  WHERE mid + copy * source_size < target OR source_size = 0 AND copy = 0
), o AS (
  SELECT *, {_inverse_sql("x", "kind")}::DOUBLE AS position FROM q
), k AS (
  SELECT row, copy, position, row_number() OVER (
         ORDER BY position, doc_id NULLS FIRST, source COLLATE "C" NULLS FIRST, size, row, copy) - 1 AS rank FROM o
)
SELECT p.doc_id, p.size, p.source_size, p.target,
       (p.size * ((a.row IS NOT NULL)::INT + (b.row IS NOT NULL)::INT))::BIGINT AS taken,
       a.position AS first_position, b.position AS second_position, a.rank AS first_rank, b.rank AS second_rank
FROM p LEFT JOIN k a ON a.row = p.row AND a.copy = 0 LEFT JOIN k b ON b.row = p.row AND b.copy = 1
"""
