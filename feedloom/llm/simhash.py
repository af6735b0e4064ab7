"""SimHash near-dedup with Golay-code fuzzy hashing.

Fingerprint: bit b is 1 if it is set in over half the XXH64 values (seed 42) of
the document's word shingles.

Candidate keys: the 64 bits are three segments of 22, 21 and 21 bits.  Two
errors at most leave one segment without any (pigeonhole), and put at most two
into the next one.  A segment is decoded with the perfect binary Golay code
[23, 12, 7] (every 23-bit word lies within 3 bits of exactly one codeword), and
so are all words one bit away: the distinct codeword indices, six or so, are its
fuzzy keys.  Two segments at most two bits apart have a word within one bit of
both, hence a common index.  The key (segment number, exact segment, index of
the next segment) thus brings every pair within two bits together, on 33 bits.

Buckets of up to ``BUCKET`` fingerprints are compared in place.  A larger bucket
is split by its members' neighbour words instead: each member goes to its own
word and to all words one bit away, members that meet at a word are within two
bits, and all pairs within two bits meet at one.  Either way a bucket of b
members gives O(b) links, a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean_text, keep_rows, spill
from .components import connected_components, local_roots

SHINGLE = 3
MAX_DISTANCE = 2
SEED = 42
#: Bits of the three segments, and their places from the low end.
SEGMENTS = (22, 21, 21)
SHIFTS = (42, 21, 0)
#: Members of a bucket that are compared with each other in one task.
BUCKET = 64
#: Generator polynomial of the binary Golay code.
GOLAY = 0b101011100011

_DECODE: list = []


def golay_decode() -> np.ndarray:
    """Index (the 12 data bits) of the codeword within 3 bits of each 23-bit word."""
    if not _DECODE:
        data = np.arange(1 << 12, dtype=np.int64)
        code = np.zeros(1 << 12, np.int64)
        for k in range(12):
            code ^= np.where(data >> k & 1, GOLAY << k, 0)
        flips = [0] + [1 << a for a in range(23)]
        flips += [1 << a | 1 << b for a in range(23) for b in range(a)]
        flips += [1 << a | 1 << b | 1 << c for a in range(23) for b in range(a) for c in range(b)]
        table = np.empty(1 << 23, np.int16)
        for f in flips:
            table[code ^ f] = data
        _DECODE.append(table)
    return _DECODE[0]


def fuzzy_indices(words: np.ndarray, bits: int) -> np.ndarray:
    """Codeword indices of each word and of the words one bit away, sorted."""
    table = golay_decode()
    near = np.stack([words] + [words ^ (1 << b) for b in range(bits)], axis=1)
    return np.sort(table[near], axis=1)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned 64-bit fingerprint of one text (none without words)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(flat, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-shingle].tolist()]
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(flat[a:b], seed) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())],
                      dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[k:k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle, seed) for t in b.column(2).to_pylist()],
                          np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)],
                                             names=["doc_id", "text_hash", "fp"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                        F.xxhash64(clean_text(text)).alias("text_hash"), clean_text(text).alias("t"))
            .mapInArrow(run, "doc_id long, text_hash long, fp long"))


def bucket_keys(fps: DataFrame) -> DataFrame:
    """(key, fp) for each fuzzy key of each distinct fingerprint."""

    def run(batches):
        for b in batches:
            all_fp = b.column(0).to_numpy()
            for lo in range(0, len(all_fp), 8192):
                fp = all_fp[lo:lo + 8192]
                u = fp.view(np.uint64)
                seg = [((u >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64)
                       for s, n in zip(SHIFTS, SEGMENTS)]
                for i in range(3):
                    j = (i + 1) % 3
                    idx = fuzzy_indices(seg[j], SEGMENTS[j])
                    new = np.ones(idx.shape, bool)
                    new[:, 1:] = idx[:, 1:] != idx[:, :-1]
                    row, col = np.nonzero(new)
                    key = (i << 40) | (seg[i][row] << 12) | idx[row, col].astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])],
                                                     names=["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def links(fps: DataFrame, distance: int = MAX_DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between distinct fingerprints that span every component.

    ``distance`` is 0 to 2, what the keys cover.
    """
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError(f"distance must be 0 to {MAX_DISTANCE}")
    keys = bucket_keys(fps)
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = spill(keys.join(sizes, "key"), "buckets")  # most keys have one member

    def compare(batches):
        for b in batches:
            out_a, out_b = [], []
            for members in b.column(0).to_pylist():
                m = np.sort(np.array(members, np.int64))
                u = m.view(np.uint64)
                i, j = np.nonzero(np.triu(np.bitwise_count(u[:, None] ^ u[None, :]) <= distance, 1))
                if len(i):
                    root = local_roots(len(m), i, j)
                    own = np.nonzero(root != np.arange(len(m)))[0]
                    out_a.append(m[own])
                    out_b.append(m[root[own]])
            if out_a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    small = (shared.where(F.col("n") <= bucket).groupBy("key")
             .agg(F.collect_list("fp").alias("members")).select("members")
             .mapInArrow(compare, "a long, b long"))
    # words within distance - 1 of the member on one side, within 1 on the other:
    # at distance 2 all one-bit neighbours meet, at 1 the lower word of each pair
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.expr(f"shiftleft(1L, {b})")) for b in range(64)]
    large = (shared.where(F.col("n") > bucket).select("fp").distinct()
             .select("fp", F.explode(F.array(*(flips if distance else flips[:1]))).alias("word")))
    if distance == 1:
        large = large.join(shared.where(F.col("n") > bucket).select(F.col("fp").alias("word")).distinct(),
                           "word", "left_semi")
        met = large.where("fp <> word").select(F.col("fp").alias("a"), F.col("word").alias("b"))
    else:
        met = (large.groupBy("word").agg(F.collect_list("fp").alias("all"), F.min("fp").alias("b"))
               .select(F.explode("all").alias("a"), "b").where("a <> b"))  # 65 members at most
    return small.unionByName(met).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id, text_hash, class_fp.

    Fingerprints of at most ``distance`` differing bits are linked;
    ``component_id`` is the smallest doc_id reachable, ``class_fp`` the
    component's own key.  Null texts count as empty; a text without words has
    fingerprint zero and is linked like any other.  A row with a null id takes
    part but never names a component that has another id.  Repeated rows stay
    rows; other columns are ignored; an empty table gives an empty table.
    """
    fp = spill(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    # copies of one fingerprint are one node from here on
    nodes = spill(fp.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    label = connected_components(links(nodes, distance))
    known = (nodes.join(label.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("class_fp", F.coalesce("label", "fp")))
    least = known.groupBy("class_fp").agg(F.min("least").alias("component_id"))
    classes = spill(known.join(least, "class_fp").select("fp", "class_fp", "component_id"), "classes")
    return (fp.join(classes, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id", "text_hash", "class_fp"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id
    (null ids last), all columns kept."""
    found = spill(near_duplicates(docs, doc_id, text, **kw), "near-duplicates")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = found.groupBy("class_fp").agg(F.min(order).alias("o"))
    ties = (found.groupBy("class_fp", "doc_id", "text_hash").agg(F.count("*").alias("ties")))
    keep = (first.select("class_fp", "o.doc_id", "o.text_hash").alias("k")
            .join(ties.alias("t"), (F.col("k.class_fp") == F.col("t.class_fp"))
                  & F.col("k.doc_id").eqNullSafe(F.col("t.doc_id"))
                  & (F.col("k.text_hash") == F.col("t.text_hash")))
            .select("k.doc_id", "k.text_hash", "t.ties"))
    return keep_rows(docs, keep, doc_id, text)
