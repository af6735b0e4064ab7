"""Embedding near-dedup as an exact metric range join.

Cosine at least c between unit vectors is an angle of at most t = acos(c), and
angles obey the triangle inequality.  Pivots (spread over a bounded sample,
farthest first; their number grows with the rows) partition the vectors into
cells of the nearest pivot.  A vector x of cell i has partners in cell j only where

* angle(x, p_j) <= R_j + t, R_j the largest angle of cell j's vectors to p_j, and
* x (p_i - p_j) <= sin(t) |p_i - p_j|, the angle of x to the half-space that is
  cell j's.

Cells are joined in groups, those nearest to one of the first pivots.  Of two groups
one is the host of their pairs; a vector is copied into a host that has a cell
within its reach.  Within a group, rows are dealt into blocks that are rings of the angle
to the group's pivot, at most ``BLOCK`` rows a side; rings more than t apart do
not meet.  Two blocks are compared by matrix products, cell by cell of one side
with those rows of the other that reach the cell.  Every pair that a single-precision
product leaves near or above c is decided again in double precision.  Equal
vectors are one class with a weight before all this.  A pair is met once; a block
returns counts and a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spill
from .components import connected_components, local_roots

MIN_COSINE = 0.95
#: Rows that pivots are chosen from, vectors to a pivot, pivots at most.
SAMPLE = 4000
PER_PIVOT = 128
MAX_PIVOTS = 1024
#: Rows and bytes of a block's side, rings that a group's angles are counted in.
BLOCK = 16384
BLOCK_BYTES = 32 << 20
RINGS = 64
#: More than single precision can be off for unit vectors of a few thousand
#: dimensions.
SLACK = 1e-3


def farthest_first(x: np.ndarray, k: int) -> np.ndarray:
    """``k`` rows of ``x``, each the farthest from those before it."""
    chosen = [0]
    d = 2 - 2 * x @ x[0]
    while len(chosen) < min(k, len(x)):
        nxt = int(np.argmax(d))
        if d[nxt] <= 1e-8:  # nearer pivots would not tell their bisector in double precision
            break
        chosen.append(nxt)
        d = np.minimum(d, 2 - 2 * x @ x[nxt])
    return x[chosen]


def unit(column) -> np.ndarray:
    """Rows of a binary column of float64 as unit vectors."""
    x = np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)
    if not x.size:
        return x
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of the squares
    return x / np.sqrt((x * x).sum(1))[:, None]


class Cells:
    """Pivots by group, the reach of cells and the rings of groups."""

    def __init__(self, pivots: np.ndarray, groups: int, min_cosine: float):
        group = (pivots @ pivots[:groups].T).argmax(1)
        order = np.argsort(group, kind="stable")
        self.pivots, self.group = pivots[order], group[order]
        self.starts = np.searchsorted(self.group, np.arange(groups))
        self.centers = pivots[:groups]
        self.angle = float(np.arccos(min_cosine)) + 1e-6
        self.sine = float(np.sin(min(self.angle, np.pi / 2)))
        self.floor = np.full(len(pivots), np.inf)  # least cosine to a pivot within its cell's reach
        a, b = np.meshgrid(np.arange(groups), np.arange(groups), indexing="ij")
        #: Whether vectors of group a visit group b: one way only, and a group itself
        self.visits = (a == b) | ((a < b) == ((a + b) % 2 == 0))

    def set_radius(self, radius: np.ndarray) -> None:
        """Largest angle in each cell, -inf for a cell without vectors."""
        far = radius + self.angle
        self.floor = np.where(np.isneginf(radius), np.inf,
                              np.where(far < np.pi, np.cos(np.minimum(far, np.pi)), -2))

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dots = v @ self.pivots.T
        cell = dots.argmax(1)
        return cell, np.arccos(np.clip(dots[np.arange(len(v)), cell], -1, 1))

    def apart(self, cell: np.ndarray, other) -> np.ndarray:
        """Distance of pivots."""
        p = self.pivots
        return np.sqrt(np.maximum(2 - 2 * (p[cell] @ p[other].T), 0))

    def reach(self, v: np.ndarray, cell: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Which of the cells ``other`` may hold partners of each vector."""
        dots = v @ self.pivots[other].T
        own = (v * self.pivots[cell]).sum(1)[:, None]
        homes, at = np.unique(cell, return_inverse=True)
        go = own - dots <= self.sine * self.apart(homes, other)[at] + 1e-12
        return go & (dots >= self.floor[other]) | (cell[:, None] == other)

    def groups_of(self, v: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Which groups each vector goes to."""
        go = self.reach(v, cell, np.arange(len(self.pivots)))
        return np.logical_or.reduceat(go, self.starts, axis=1) & self.visits[self.group[cell]]

    def rings(self, v: np.ndarray, group: int) -> np.ndarray:
        angle = np.arccos(np.clip(v @ self.centers[group], -1, 1))
        return np.minimum((angle * (RINGS / np.pi)).astype(np.int64), RINGS - 1)


class Blocks:
    """Blocks of a group's rows on one side: runs of rings of at most ``most`` rows; a
    fuller ring is several blocks by hash."""

    def __init__(self, counts: np.ndarray, most: int):
        self.first = np.zeros(RINGS, np.int64)
        self.parts = np.ones(RINGS, np.int64)
        low, high = [], []
        held = most + 1
        full = np.nonzero(counts)[0]
        for ring in full.tolist():
            n = int(counts[ring])
            if held + n > most:
                parts = -(-n // most)
                self.first[ring], self.parts[ring] = len(low), parts
                low += [ring] * parts
                high += [ring] * parts
                held = n if parts == 1 else most + 1
            else:
                self.first[ring] = len(low) - 1
                high[-1] = ring
                held += n
        # a ring counted as empty belongs to the nearest that is not
        if len(full):
            near = full[np.abs(np.arange(RINGS)[:, None] - full).argmin(1)]
            self.first, self.parts = self.first[near], self.parts[near]
        self.low, self.high = np.array(low, np.int64), np.array(high, np.int64)

    def __len__(self):
        return len(self.low)

    def near(self, other: "Blocks", block: int, angle: float) -> np.ndarray:
        """Blocks of this side that rows of ``other``'s block may have partners in; a
        ring of room on either side."""
        gap = np.maximum(self.low - other.high[block], other.low[block] - self.high) - 2
        return np.nonzero(gap * (np.pi / RINGS) <= angle)[0]


def classes(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, DataFrame]:
    """Members (vec_id, key) of all rows, key null for a vector that links with
    nothing, and the distinct vectors (node, key, dim, v, least, weight)."""

    def run(batches):
        for b in batches:
            out = []
            for v in b.column(1).to_pylist():
                x = np.array([np.nan if y is None else y for y in v or ()], np.float64) + 0.0  # no -0
                out.append(x.tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["vec_id", "v"])

    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                           F.col(embedding).cast("array<double>").alias("e"))
            .mapInArrow(run, "vec_id long, v binary")
            .withColumn("key", F.when(F.col("vec_id").isNotNull(), F.sha2("v", 256))))
    rows = spill(rows, "vectors")
    distinct = (rows.where("key is not null").groupBy("key")
                .agg(F.first("v").alias("v"), F.min("vec_id").alias("least"), F.count("*").alias("weight"))
                .withColumn("dim", F.length("v")).withColumn("node", F.monotonically_increasing_id()))
    return rows.select("vec_id", "key"), spill(distinct, "classes")


def embedding_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                         min_cosine: float = MIN_COSINE, sample: int = SAMPLE,
                         per_pivot: int = PER_PIVOT, max_pivots: int = MAX_PIVOTS,
                         block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows at a cosine of ``min_cosine`` or more,
    ``component_id`` is the smallest id that links reach, the own one included,
    ``kept`` whether that is the row's own.  Vectors that are null, empty, zero
    or hold null or non-finite components link with nothing, as do vectors of
    different lengths; a row without an id links with nothing and has a null
    component.  Rows that repeat an id are rows of their own.  Other columns are
    ignored; an empty table gives an empty table.
    """
    if not 0 < min_cosine <= 1:
        raise ValueError("min_cosine must lie in (0, 1]")
    spark = vectors.sparkSession
    members, distinct = classes(vectors, vec_id, embedding)
    counts = []
    forests = []
    # one length of vector as a rule; lengths are the table's schema, not its rows
    for d in sorted(r["dim"] for r in distinct.select("dim").distinct().collect()):
        own = distinct.where(F.col("dim") == d).select("node", "v", "weight", "key")
        n = own.count()
        k = int(min(max_pivots, sample, max(2, -(-n // per_pivot))))
        # ``sample`` rows at most
        seen = own.orderBy("key").limit(sample).select("v").toArrow()
        pivots = farthest_first(unit(seen.column("v")), k)
        most = max(1, min(block, BLOCK_BYTES // d))
        cells = Cells(pivots, int(min(len(pivots), max(1, -(-n // most)))), min_cosine)
        found = _join(spark, own, cells, min_cosine, most)
        counts.append(found.where("links is not null").select("node", "links"))
        forests.append(found.where("other is not null").select("node", "other"))
    empty = spark.createDataFrame([], "node long, links long")
    links, forest = empty, empty.select("node", F.col("links").alias("other"))
    for c, f in zip(counts, forests):
        links, forest = links.unionByName(c), forest.unionByName(f)
    links = links.groupBy("node").agg(F.sum("links").alias("links"))
    label = connected_components(forest)
    known = (distinct.select("node", "key", "least", "weight").join(links, "node", "left")
             .join(label, "node", "left").withColumn("label", F.coalesce("label", "node")))
    component = known.groupBy("label").agg(F.min("least").alias("component"))
    known = spill(known.join(component, "label").select(
        "key", "component", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links")), "known")
    return (members.join(known, "key", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def _slices(batch, rows: int = 1024):
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def _join(spark, own: DataFrame, cells: Cells, min_cosine: float, most: int) -> DataFrame:
    """(node, links, null) and (node, null, other) rows over all groups of cells."""
    start = spark.sparkContext.broadcast(cells)

    def nearest(batches):
        c = start.value
        for whole in batches:
            for b in _slices(whole):
                v = unit(b.column(1))
                cell, angle = c.nearest(v)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(angle)],
                                                 names=["node", "v", "weight", "cell", "angle"])

    at = spill(own.select("node", "v", "weight")
               .mapInArrow(nearest, "node long, v binary, weight long, cell long, angle double"), "cells")
    radius = np.full(len(cells.pivots), -np.inf)
    for r in at.groupBy("cell").agg(F.max("angle").alias("radius")).collect():  # a row a pivot
        radius[r["cell"]] = r["radius"]
    cells.set_radius(radius)
    reaching = spark.sparkContext.broadcast(cells)

    def sides(b):
        """(group, side, rows, rings) of a batch; side 0 are the group's own."""
        c = reaching.value
        v, cell = unit(b.column(1)), b.column(3).to_numpy()
        home = c.group[cell]
        go = c.groups_of(v, cell)
        for g in np.nonzero(go.any(0))[0].tolist():
            for side, rows in ((0, np.nonzero(home == g)[0]), (1, np.nonzero(go[:, g] & (home != g))[0])):
                if len(rows):
                    yield g, side, rows, c.rings(v[rows], g)

    def count(batches):
        n = np.zeros((len(reaching.value.centers), 2, RINGS), np.int64)
        for whole in batches:
            for b in _slices(whole):
                for g, side, _, ring in sides(b):
                    n[g, side] += np.bincount(ring, minlength=RINGS)
        g, side, ring = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(side), pa.array(ring), pa.array(n[g, side, ring])],
                                         names=["g", "side", "ring", "n"])

    # two numbers a ring of a group
    rows = np.zeros((len(cells.centers), 2, RINGS), np.int64)
    for r in (at.mapInArrow(count, "g long, side long, ring long, n long")
              .groupBy("g", "side", "ring").agg(F.sum("n").alias("n")).collect()):
        rows[r["g"], r["side"], r["ring"]] = r["n"]
    laid = spark.sparkContext.broadcast([[Blocks(n, most) for n in g] for g in rows])

    def deal(batches):
        """Each row to every pair of blocks that its block is in: blocks of a group's own
        rows with each other (i <= o) and with its guests' (numbered after them)."""
        angle = reaching.value.angle
        for whole in batches:
            for b in _slices(whole):
                node = b.column(0).to_numpy()
                mix = ((node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
                for g, side, some, ring in sides(b):
                    mine, guest = laid.value[g]
                    my = (mine, guest)[side]
                    if not len(mine):
                        continue
                    block = my.first[ring] + mix[some] % my.parts[ring]
                    for k in np.unique(block).tolist():
                        near = mine.near(my, k, angle)
                        if side:
                            tasks = [(i, len(mine) + k, 1) for i in near.tolist()]
                        else:
                            tasks = [(min(i, k), max(i, k), int(i < k)) for i in near.tolist()]
                            tasks += [(k, len(mine) + o, 0) for o in guest.near(my, k, angle).tolist()]
                        rows = pa.array(some[block == k])
                        part = [b.column(j).take(rows) for j in range(4)]
                        for i, o, s in tasks:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(rows), x)) for x in (g, i, o, s)] + part,
                                names=["g", "i", "o", "side", "node", "v", "weight", "cell"])

    def compare(table):
        c = reaching.value
        table = table.combine_chunks()
        side = table.column("side").to_numpy()
        l = table.filter(pa.array(side == 0))
        same = bool(table.num_rows) and table.column("i")[0] == table.column("o")[0]
        r = l if same else table.filter(pa.array(side == 1))
        ln, rn = l.column("node").to_numpy(), r.column("node").to_numpy()
        x, y = unit(l.column("v")), unit(r.column("v"))
        lw, rw = l.column("weight").to_numpy(), r.column("weight").to_numpy()
        lc, rc = l.column("cell").to_numpy(), r.column("cell").to_numpy()
        nodes, place = np.unique(np.concatenate([ln, rn]), return_inverse=True)
        lp, rp = place[:len(ln)], place[len(ln):]
        links, label = np.zeros(len(nodes)), np.arange(len(nodes))
        x4, y4 = x.astype(np.float32), y.astype(np.float32)
        order = np.argsort(lc, kind="stable")
        held, kept = [], 0

        def tie(label):
            i, j = (np.concatenate(z) for z in zip(*held))
            return local_roots(len(nodes), label[i], label[j])[label]

        homes = np.unique(lc) if len(rn) else lc[:0]
        for h in range(0, len(homes), 64):
            some = homes[h:h + 64]
            go = np.concatenate([c.reach(y[k:k + 1024], rc[k:k + 1024], some) for k in range(0, len(y), 1024)])
            for n, home in enumerate(some.tolist()):
                right = np.nonzero(go[:, n])[0]
                left = order[np.searchsorted(lc, home, sorter=order):
                             np.searchsorted(lc, home, "right", sorter=order)]
                z = y4[right].T
                for k in range(0, len(left), 512):
                    i, j = np.nonzero(x4[left[k:k + 512]] @ z >= min_cosine - SLACK)
                    for m in range(0, len(i), 1 << 16):
                        a, b = left[k + i[m:m + (1 << 16)]], right[j[m:m + (1 << 16)]]
                        ok = ((x[a] * y[b]).sum(1) >= min_cosine) & (ln[a] != rn[b])
                        a, b = a[ok], b[ok]
                        if not len(a):
                            continue
                        links += np.bincount(lp[a], rw[b], len(nodes))
                        if not same:
                            links += np.bincount(rp[b], lw[a], len(nodes))
                        held.append((lp[a], rp[b]))
                        kept += len(a)
                        if kept >= 1 << 16:
                            label, held, kept = tie(label), [], 0
        if held:
            label = tie(label)
        # roots are joined through label, so each node points at its root's node
        tied, some = np.nonzero(label != np.arange(len(nodes)))[0], np.nonzero(links)[0]
        void = np.arange(len(some) + len(tied)) >= len(some)
        return pa.table({
            "node": pa.array(np.concatenate([nodes[some], nodes[tied]])),
            "links": pa.array(np.concatenate([links[some].astype(np.int64), np.zeros(len(tied), np.int64)]), mask=void),
            "other": pa.array(np.concatenate([np.zeros(len(some), np.int64), nodes[label[tied]]]), mask=~void)})

    dealt = at.mapInArrow(
        deal, "g long, i long, o long, side long, node long, v binary, weight long, cell long")
    return spill(dealt.groupBy("g", "i", "o").applyInArrow(compare, "node long, links long, other long"), "links")
