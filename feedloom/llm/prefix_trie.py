"""Prefix trie of conversations by range minima over sorted LCPs.

A turn is a unit of 20 bytes (16 of a SHA-256 of role and text, 4 of its length), a
conversation the string of its units; bytewise order puts a prefix before its
extensions.  Equal conversations are one row with a count and a smallest id.  These
rows are sorted by range and cut into blocks of at most ``BLOCK`` units, each with
the sequence before it and the one after it.

In a block, LCPs of neighbours get a sparse table.  Every candidate (a row and a
depth that its predecessor in the block does not share) binary-searches the first
and the last row of its prefix, each for itself, by range minima: that is the
member interval.  Counts, leaves and code points of an interval are differences of
prefix sums, its smallest id is a range minimum of a second sparse table.  All of
them are sums or minima over rows, so a node whose interval reaches a block's edge
(a prefix of the block's first or last row) is put together from its parts by one
grouped sum; every other node is ready in its block.

No group is gathered: neither the root nor a first turn that a third of the
conversations share is more than a row a block.  A task holds a block, or one conversation
that is longer (24 bytes a turn).  The members that end in a node are hashed in a stream
of packed runs of ids, as a SHA-256 has to read them one after another.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import spill

UNIT = 20
#: Units of a block, unless one conversation has more; ids of a packed run.
BLOCK = 200_000
RUN = 65_536
#: Conversations that share a start, and the exclusive bound of the shared turns.
FAMILY = 100
MOST_SHARED = 6
NO_MEMBERS = hashlib.sha256(b"").hexdigest()

NODES = ("key binary, depth long, conv_id long, parent_key binary, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved long, end binary")


# --- sequences ------------------------------------------------------------

def numbered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, unit): turns in order, numbered from 1.

    Order is by turn (null first), then role, then digest of role and text.  Null
    roles and texts count as empty; rows without a conversation id are none.  Numbers
    come from prefix sums over sorted ranges, so no conversation has to fit a task.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    by = ["conv_id", "turn", "role", "unit"]

    def run(batches):
        part, last, n = TaskContext.get().partitionId(), None, 0
        for b in batches:
            at = []
            for c in b.column(0).to_pylist():
                n = n + 1 if c == last else 1
                last = c
                at.append(n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.full(len(at), part), pa.int64()), pa.array(at, pa.int64())],
                names=["conv_id", "unit", "part", "n"])

    rows = (conversations.where(F.col(conv_id).isNotNull())
            .select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), role.alias("role"),
                    F.unhex(F.concat(F.substring(digest, 1, 32),
                                     F.lpad(F.hex(F.length(text)), 8, "0"))).alias("unit")))
    laid = spill(rows.repartitionByRange(*by).sortWithinPartitions(*by).select("conv_id", "unit")
                 .mapInArrow(run, "conv_id long, unit binary, part long, n long"), "turns")
    # a row a partition and conversation that meet; only a conversation cut by a range has two
    parts = (laid.groupBy("conv_id", "part").agg(F.max("n").alias("m"))
             .groupBy("conv_id").agg(F.count("*").alias("k"), F.collect_list(F.struct("part", "m")).alias("parts"))
             .where("k > 1"))  # at most a row a partition
    base = (parts.select("conv_id", F.explode("parts").alias("p"), "parts")
            .select("conv_id", "p.part", F.expr(
                "aggregate(filter(parts, x -> x.part < p.part), 0L, (a, x) -> a + x.m)").alias("base")))
    return (laid.join(base, ["conv_id", "part"], "left")
            .select("conv_id", (F.col("n") + F.coalesce("base", F.lit(0))).alias("pos"), "unit"))


def shared_starts(turns: DataFrame, family: int = FAMILY, most: int = MOST_SHARED) -> DataFrame:
    """``turns`` with the start of each conversation taken from its family's first.

    Conversation c takes the first h turns of c - c % ``family`` (fewer if there are
    fewer), then its own after its first h, h being crc32(c) % ``most``.
    """
    c = F.col("conv_id")
    h = F.crc32(c.cast("string").cast("binary")) % most
    first = turns.where((c % family == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "first")
    size = first.groupBy("first").agg(F.max("pos").alias("size"))
    ids = turns.select("conv_id").distinct().withColumn("h", h).withColumn("first", c - c % family)
    # family - 1 conversations and most - 1 turns a family at most
    taken = (ids.join(first, "first").where("pos <= h").select("conv_id", "pos", "unit"))
    lent = ids.join(size, "first").select("conv_id", F.least("size", "h").alias("lent"))
    own = (turns.withColumn("h", h).where("pos > h").join(lent, "conv_id", "left")
           .select("conv_id", (F.col("pos") - F.col("h") + F.coalesce("lent", F.lit(0))).alias("pos"), "unit"))
    return taken.unionByName(own)


def sequences(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, seq): the units of each of ``ids`` end to end, empty without any."""
    whole = (turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "unit"))).alias("u"))
             .select("conv_id", F.unhex(F.array_join(F.transform("u", lambda x: F.hex(x["unit"])), "")).alias("seq")))
    return (ids.select("conv_id").distinct().join(whole, "conv_id", "left")
            .select("conv_id", F.coalesce("seq", F.unhex(F.lit(""))).alias("seq")))


def member_hashes(members: DataFrame, run_length: int = RUN) -> DataFrame:
    """(end, ends_sha256) over (end, conv_id): SHA-256 of the ids of each end, ascending
    and comma-joined."""

    def pack(batches):
        end, ids = None, []

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([end], pa.binary()), pa.array([ids[0]], pa.int64()),
                 pa.array([",".join(map(str, ids))], pa.string())], names=["end", "first", "ids"])

        for b in batches:
            for e, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if ids and (e != end or len(ids) == run_length):
                    yield out()
                    ids = []
                end = e
                ids.append(c)
        if ids:
            yield out()

    def digest(batches):
        end, h, done = None, None, []

        def out():
            rows = list(done)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                               pa.array([r[1] for r in rows], pa.string())],
                                              names=["end", "ends_sha256"])

        for b in batches:
            for e, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if e != end:
                    if h is not None:
                        done.append((end, h.hexdigest()))
                    end, h = e, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield out()
        if h is not None:
            done.append((end, h.hexdigest()))
        yield out()

    runs = (members.select("end", "conv_id").repartitionByRange("end", "conv_id")
            .sortWithinPartitions("end", "conv_id").mapInArrow(pack, "end binary, first long, ids string"))
    return (runs.repartition("end").sortWithinPartitions("end", "first")
            .mapInArrow(digest, "end binary, ends_sha256 string"))


# --- a block --------------------------------------------------------------

def _units(seq: bytes) -> np.ndarray:
    return np.frombuffer(seq, np.uint8).reshape(-1, UNIT)


def common_units(a: bytes, b: bytes) -> int:
    """Number of leading units that two sequences share."""
    n = min(len(a), len(b)) // UNIT
    differ = np.nonzero((_units(a[:n * UNIT]) != _units(b[:n * UNIT])).any(1))[0]
    return int(differ[0]) if len(differ) else n


def sparse_table(v: np.ndarray) -> list[np.ndarray]:
    """Level k holds the minima of the 2^k values that start at each place."""
    levels, step = [v], 1
    while 2 * step <= len(v):
        low = levels[-1]
        levels.append(np.minimum(low[:-step], low[step:]))
        step *= 2
    return levels


def extents(levels: list[np.ndarray], row: np.ndarray, depth: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last of ``m`` rows that share ``depth`` units with ``row``; the
    table is over the LCPs, that of rows i and i + 1 at place i."""
    left, right = row.copy(), row.copy()
    for k in range(len(levels) - 1, -1, -1):
        step, low = 1 << k, levels[k]
        at = np.nonzero(right + step < m)[0]
        at = at[low[right[at]] >= depth[at]]
        right[at] += step
        at = np.nonzero(left >= step)[0]
        at = at[low[left[at] - step] >= depth[at]]
        left[at] -= step
    return left, right


def block_nodes(seqs: list[bytes], least: np.ndarray, count: np.ndarray, before: bytes | None,
                after: bytes | None) -> dict:
    """The parts of all nodes over a block of sorted, distinct sequences.

    A dict of columns: key, depth, least, parent_key, parent, convs, children,
    leaves, saved, end, and whether the node, and its parent, reach an edge.
    """
    m = len(seqs)
    n = np.fromiter((len(s) // UNIT for s in seqs), np.int64, m)
    ends = np.cumsum(n)
    first = ends - n
    units = np.frombuffer(b"".join(seqs), np.uint8).reshape(-1, UNIT)
    chars = units[:, 16:].copy().view(">u4").ravel().astype(np.int64)
    total = np.concatenate([[0], np.cumsum(chars)])

    def upto(row, depth):
        """Code points of a row's first ``depth`` turns."""
        return total[first[row] + np.maximum(depth, 0)] - total[first[row]]

    # LCPs of neighbours: the first place where they differ
    pair = np.minimum(n[:-1], n[1:])
    lcp = pair.copy()
    place = np.arange(pair.sum()) - np.repeat(np.cumsum(pair) - pair, pair)
    who = np.repeat(np.arange(m - 1), pair)
    differ = (units[first[who] + place] != units[first[who + 1] + place]).any(1)
    np.minimum.at(lcp, who[differ], place[differ])
    edge_low = -1 if before is None else common_units(before, seqs[0])
    edge_high = -1 if after is None else common_units(after, seqs[-1])
    shared = np.concatenate([[edge_low], lcp])  # with the row before, in all blocks
    leaf = np.concatenate([lcp, [edge_high]]) < n  # not a prefix of the row after

    # candidates: the depths of a row that the row before it in the block lacks
    own = np.concatenate([[-1], lcp])
    fresh = n - own
    row = np.repeat(np.arange(m), fresh)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(fresh) - fresh, fresh) + np.repeat(own, fresh) + 1
    left, right = extents(sparse_table(lcp), row, depth, m)

    def between(values):
        s = np.concatenate([[0], np.cumsum(values)])
        return s[right + 1] - s[left]

    ids = sparse_table(least)
    level = np.log2(right - left + 1).astype(np.int64)
    small = np.empty(len(row), np.int64)
    for k in np.unique(level):
        at = np.nonzero(level == k)[0]
        small[at] = np.minimum(ids[k][left[at]], ids[k][right[at] - (1 << k) + 1])

    everyone = np.arange(m)
    new = upto(everyone, n) - upto(everyone, shared)  # code points of turns no earlier row has
    # of the first row of an interval only what lies at the depth or below
    inside = between(new) - new[left] + upto(left, n[left]) - upto(left, np.maximum(shared[left], depth - 1))
    convs = between(count)
    saved = between(count * upto(everyone, n)) - convs * upto(left, depth - 1) - inside
    order = np.sort(lcp * (m + 1) + np.arange(m - 1))  # (LCP, place): forks by depth
    forks = np.searchsorted(order, depth * (m + 1) + right) - np.searchsorted(order, depth * (m + 1) + left)
    children = forks + ((shared[left] <= depth) & (n[left] > depth))

    open_low = (left == 0) & (depth <= edge_low)
    open_high = (right == m - 1) & (depth <= edge_high)
    # a node's parent is the candidate one less deep that covers it: the row's own, or
    # that of an earlier row, found as the latest candidate of that depth
    parent = np.full(len(row), -1, np.int64)
    at_depth = np.full(int(n.max(initial=0)) + 1, -1, np.int64)
    keys: list[bytes] = []
    states: list = [hashlib.sha256()]  # of the prefixes of the row at hand
    d_list, at, data = depth.tolist(), 0, [bytes(s) for s in seqs]
    for r, k in enumerate(fresh.tolist()):
        for c in range(at, at + k):
            d = d_list[c]
            if d:
                h = states[d - 1].copy()
                h.update(data[r][(d - 1) * UNIT:d * UNIT])
                del states[d:]
                states.append(h)
                parent[c] = at_depth[d - 1]
            at_depth[d] = c
            keys.append(states[d].digest())
        at += k
    opened = open_low | open_high
    none = parent < 0
    return {"key": keys, "depth": depth, "least": small,
            "parent_key": [None if p < 0 else keys[p] for p in parent.tolist()],
            "parent": np.where(none, 0, small[parent]), "convs": convs, "children": children,
            "leaves": between(leaf.astype(np.int64)), "saved": saved, "no_parent": none,
            "end": [k if e else None for k, e in zip(keys, (depth == n[left]).tolist())],
            "open": opened, "parent_open": ~none & opened[parent]}


# --- the trie -------------------------------------------------------------

def trie(convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node over (conv_id, seq): node_key, depth, conv_id, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs = spill(convs.select("conv_id", "seq", F.unhex(F.sha2("seq", 256)).alias("end")), "sequences")
    hashes = spill(member_hashes(convs), "ends")
    # copies meet map-side
    kinds = convs.groupBy("seq").agg(F.min("conv_id").alias("least"), F.count("*").alias("n"))

    def cut(batches):
        part, number, size = TaskContext.get().partitionId() << 32, 0, 0
        for b in batches:
            at = []
            for s in b.column(0).to_pylist():
                units = len(s) // UNIT + 1
                if size and size + units > block:
                    number, size = number + 1, 0
                size += units
                at.append(part + number)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *b.columns], names=["block", "seq", "least", "n"])

    rows = spill(kinds.repartitionByRange("seq").sortWithinPartitions("seq")
                 .mapInArrow(cut, "block long, seq binary, least long, n long"), "blocks")
    # a row a block: its neighbours' nearest sequences
    by = W.orderBy("block")
    edges = (rows.groupBy("block").agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
             .select("block", F.lag("high").over(by).alias("before"), F.lead("low").over(by).alias("after")))
    none = F.lit(None).cast("long")
    framed = rows.withColumn("side", F.lit(0)).unionByName(
        edges.where("before is not null").select("block", F.col("before").alias("seq"), none.alias("least"),
                                                 none.alias("n"), F.lit(-1).alias("side"))).unionByName(
        edges.where("after is not null").select("block", F.col("after").alias("seq"), none.alias("least"),
                                                none.alias("n"), F.lit(1).alias("side")))
    schema = "block long, " + NODES + ", open boolean, parent_open boolean"

    def nodes(key, table):  # a block
        table = table.sort_by("seq").combine_chunks()
        side = table.column("side").to_numpy()
        seqs = table.column("seq").to_pylist()
        mine = np.nonzero(side == 0)[0]
        edge = {s: seqs[k] for k, s in enumerate(side.tolist()) if s}
        got = block_nodes([seqs[k] for k in mine.tolist()],
                          *(table.column(c).to_numpy(zero_copy_only=False)[mine].astype(np.int64) for c in ("least", "n")),
                          edge.get(-1), edge.get(1))
        k = len(got["key"])
        return pa.table({
            "block": pa.array(np.full(k, key[0].as_py())), "key": pa.array(got["key"], pa.binary()),
            "depth": got["depth"], "conv_id": got["least"], "parent_key": pa.array(got["parent_key"], pa.binary()),
            "parent_conv_id": pa.array(got["parent"], mask=got["no_parent"]), "n_convs": got["convs"],
            "n_children": got["children"], "n_leaves": got["leaves"], "saved": got["saved"],
            "end": pa.array(got["end"], pa.binary()), "open": got["open"], "parent_open": got["parent_open"]})

    parts = spill(framed.groupBy("block").applyInArrow(nodes, schema), "nodes")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    # at most two paths a block
    joined = spill(parts.where("open").groupBy("key").agg(
        F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.first("parent_key").alias("parent_key"),
        *sums, F.max("end").alias("end")), "open-nodes")
    names = joined.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("p"))
    whole = (joined.join(names, "parent_key", "left")
             .select("key", "depth", "conv_id", F.col("p").alias("parent_conv_id"),
                     "n_convs", "n_children", "n_leaves", "saved", "end"))
    # the nodes under an open parent take its smallest member by block, where no key is hot
    here = (parts.where("open").select("block", F.col("key").alias("parent_key"))
            .join(names, "parent_key").select("block", "parent_key", "p"))
    ready = parts.where("not open")
    cols = ["key", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "end"]
    under = (ready.where("parent_open").join(here, ["block", "parent_key"])
             .withColumn("parent_conv_id", F.col("p")))
    every = (whole.unionByName(ready.where("not parent_open").select(*cols)).unionByName(under.select(*cols)))
    # nodes without members that end there would all meet at the null key
    ended = every.where("end is not null").join(hashes, "end").drop("end")
    other = every.where("end is null").drop("end").withColumn("ends_sha256", F.lit(NO_MEMBERS))
    return ended.unionByName(other).select(
        F.col("key").alias("node_key"), "depth", "conv_id", "parent_conv_id", "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")


def conversation_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                      role: str = "role", text: str = "text", rebuild: bool = True, block: int = BLOCK) -> DataFrame:
    """The trie of all conversations, with ``rebuild`` after :func:`shared_starts`.

    Ids of conversations without a turn left are members of the root.  Rows without a
    conversation id are ignored, as are other columns; rows that repeat a turn are
    turns of their own.  An empty table gives an empty table.
    """
    turns = spill(numbered_turns(conversations, conv_id, turn, role, text), "numbered")
    return trie(sequences(shared_starts(turns) if rebuild else turns, turns), block)


#: DuckDB SQL of the query: crc32 bit by bit, nodes as lists of turns.
TRIE_SQL = """
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT c, c::VARCHAR AS s, 0 AS k, 4294967295::BIGINT AS x FROM ids
  UNION ALL
  SELECT c, s, k + 1, CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END
  FROM (SELECT *, CASE WHEN k % 8 = 0 THEN xor(x, ascii(s[k // 8 + 1])::BIGINT) ELSE x END AS y
        FROM crc WHERE k < 8 * length(s))
), h AS (
  SELECT c, (xor(x, 4294967295) % 6)::INT AS h FROM crc WHERE k = 8 * length(s)
), o AS (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
         ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), s AS (
  SELECT o.c, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS seq
  FROM o JOIN h USING (c) LEFT JOIN o b ON b.c = o.c - o.c % 100
), p AS (
  SELECT c, seq, unnest(range(0, len(seq) + 1)) AS depth FROM s
), n AS (
  SELECT seq[1:depth] AS node, depth, min(c) AS conv_id, count(*) AS n_convs, max(len(seq)) = depth AS leaf,
         string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(seq) = depth) AS ends,
         CASE WHEN depth = 0 THEN 0 ELSE length(any_value(seq[depth].t)) END AS chars
  FROM p GROUP BY node, depth
), up AS (
  SELECT node[1:unnest(range(0, depth + 1))] AS top, leaf, (n_convs - 1) * chars AS saved FROM n
), below AS (
  SELECT top, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM up GROUP BY top
), kids AS (
  SELECT node[1:depth - 1] AS top, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY top
)
SELECT n.conv_id, n.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs,
       coalesce(kids.n_children, 0) AS n_children, below.n_leaves, below.saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n JOIN below ON below.top = n.node LEFT JOIN kids ON kids.top = n.node
LEFT JOIN n q ON n.depth > 0 AND q.depth = n.depth - 1 AND q.node = n.node[1:n.depth - 1]
"""
