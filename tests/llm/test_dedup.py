"""Exact dedup, SimHash and embeddings against brute force."""

import random

import duckdb
import numpy as np
import pytest
import xxhash

import __spark_entry__ as E
from feedloom.llm import embedding_dedup, exact_dedup, simhash
from feedloom.llm.components import connected_components, local_roots

SF = "/root/testdata/sf0.001"


def test_components_of_a_long_path_and_odd_edges(spark):
    rows = [(i, i + 1) for i in range(1, 40)] + [(7, 7), (3, 2), (3, 2), (100, 90), (None, 1)]
    got = {r["node"]: r["label"] for r in connected_components(
        spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 90: 90, 100: 90}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_misra_gries_keeps_every_frequent_digest():
    random.seed(3)
    stream = ["hot"] * 300 + [f"d{i}" for i in range(2000)]
    random.shuffle(stream)
    held: dict = {}
    for k in range(0, len(stream), 50):
        part: dict = {}
        for d in stream[k:k + 50]:
            part[d] = part.get(d, 0) + 1
        held = exact_dedup.misra_gries(held, part, 20)
        assert len(held) <= 20
    assert 300 - len(stream) / 21 <= held["hot"] <= 300


@pytest.mark.parametrize("kw", [{}, {"counters": 30, "share": 0.1}])
def test_exact_nasty(spark, nasty, no_docs, kw):
    rows = exact_dedup.exact_duplicates(nasty, **kw).collect()
    assert len(rows) == 14 and sum(r["kept"] for r in rows) == 9
    same = [r for r in rows if r["group_size"] == 4]
    assert len(same) == 4 and {r["keep_id"] for r in same} == {2} and sum(r["kept"] for r in same) == 1
    empty = [r for r in rows if r["group_size"] == 3]  # null counts as empty
    assert {r["keep_id"] for r in empty} == {4}
    kept = exact_dedup.drop_duplicates(nasty, **kw)
    assert kept.columns == nasty.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 5, 6, 7, 8, 9, 10, 11]
    assert exact_dedup.exact_duplicates(no_docs, **kw).count() == 0
    assert exact_dedup.drop_duplicates(no_docs, **kw).count() == 0


def test_exact_hot_digest_is_settled_by_broadcast(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}", "en", "s", 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = exact_dedup.exact_duplicates(docs)
    hot = got.where("group_size > 1").collect()
    assert len(hot) == 1000 and {r["keep_id"] for r in hot} == {2997}
    digests = docs.selectExpr("sha2(text, 256) AS digest")
    assert exact_dedup.heavy_candidates(digests, 3000).count() == 1


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, distance=2):
    u = np.array(fps, np.uint64)
    i, j = np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= distance)
    root = local_roots(len(u), i, j)
    least = {}
    for k, r in enumerate(root):
        if ids[k] is not None:
            least[r] = min(ids[k], least.get(r, ids[k]))
    return [least.get(r) for r in root]


def test_golay_code_is_perfect_and_meets_at_two_bits():
    table = simhash.golay_decode()
    assert (np.bincount(table) == 2048).all() and len(table) == 1 << 23
    rng = np.random.default_rng(0)
    for bits in simhash.SEGMENTS:
        w = rng.integers(0, 1 << bits, 3000)
        v = w ^ (1 << rng.integers(0, bits, 3000)) ^ (1 << rng.integers(0, bits, 3000))
        a, b = simhash.fuzzy_indices(w, bits), simhash.fuzzy_indices(v, bits)
        assert (a[:, :, None] == b[:, None, :]).any((1, 2)).all()


@pytest.mark.parametrize("bucket", [64, 2])  # 2: the way of large buckets
@pytest.mark.parametrize("distance", [0, 1, 2])
def test_links_span_all_components(spark, bucket, distance):
    rng = random.Random(bucket + distance)
    fps = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):
            fps.add(x)
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    label = {r["node"]: r["label"] for r in connected_components(
        simhash.links(nodes, distance, bucket)).collect()}
    want = brute_components(signed, fps, distance)
    assert [label.get(x, x) for x in signed] == want


def test_simhash_nasty(spark, nasty, no_docs):
    rows = simhash.near_duplicates(nasty).collect()
    docs = nasty.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r["text"]) for r in docs]
    want = sorted(zip([r["doc_id"] for r in docs], [f"{x:016x}" for x in fps],
                      brute_components([r["doc_id"] for r in docs], fps)), key=str)
    assert sorted([(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows], key=str) == want
    kept = simhash.drop_near_duplicates(nasty)
    assert kept.columns == nasty.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({w[2] for w in want})
    assert simhash.near_duplicates(no_docs).count() == simhash.drop_near_duplicates(no_docs).count() == 0


def test_simhash_query_against_brute_force(spark):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"])
           for r in E.queries()["op2_simhash_near_dedup"](spark, SF).collect()}
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    fps = [brute_fingerprint(t) for _, t in docs]
    comp = brute_components([i for i, _ in docs], fps)
    assert got == {i: (f"{x:016x}", c) for (i, _), x, c in zip(docs, fps, comp)}


def brute_vectors(rows):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        v = v / np.abs(v).max()
        return v / np.linalg.norm(v)
    u = [unit(v) if i is not None else None for i, v in rows]
    link = [(a, b) for a in range(len(u)) for b in range(len(u)) if a != b and u[a] is not None
            and u[b] is not None and len(u[a]) == len(u[b]) and u[a] @ u[b] >= 0.95]
    n = [sum(a == k for a, _ in link) for k in range(len(u))]
    i, j = (np.array([x[k] for x in link], int) for k in (0, 1))
    root = local_roots(len(u), i, j)
    comp = [None if rows[k][0] is None else min(rows[m][0] for m in np.nonzero(root == root[k])[0]
                                                if rows[m][0] is not None) for k in range(len(u))]
    return sorted([(rows[k][0], n[k], comp[k], rows[k][0] is not None and rows[k][0] == comp[k])
                   for k in range(len(u))], key=str)


@pytest.mark.parametrize("kw", [{}, {"per_pivot": 20, "block": 7, "sample": 40},
                                {"per_pivot": 2, "block": 30}, {"per_pivot": 3, "block": 16, "max_pivots": 9}])
def test_embeddings_against_brute_force(spark, kw):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(6):
        center = rng.normal(size=8)
        for k in range(20):
            rows.append((len(rows), (center * rng.uniform(0.1, 9) + rng.normal(size=8) * 0.35).tolist()))
    rows += [(500, None), (501, []), (502, [0.0] * 8), (503, [1.0, None] + [0.0] * 6), (504, [float("nan")] * 8),
             (505, [float("inf")] + [0.0] * 7), (506, rows[0][1]), (506, rows[0][1]), (None, rows[0][1]),
             (507, [1.0, 0.0]), (508, [2.0, 0.0]), (509, [-0.0, 1.0]), (510, [0.0, 1.0]), (511, [1e-300] * 8),
             (512, [1e300] * 8)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "'x' AS node", "'x' AS cell", "'x' AS key", "'x' AS v", "1 AS weight")
    got = embedding_dedup.embedding_duplicates(v, **kw).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_vectors(rows)


@pytest.mark.parametrize("cosine", [0.95, 0.6, 1.0])
def test_cells_reach_every_partner(cosine):
    """Each pair at the cosine or above meets: both directions of reach hold, one of two groups
    is the host, and the rings of their blocks are near."""
    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(60, 5)), 12, axis=0) + rng.normal(size=(720, 5)) * rng.choice([0, 0.05, 0.5], (720, 1))
    x /= np.linalg.norm(x, axis=1)[:, None]
    cells = embedding_dedup.Cells(embedding_dedup.farthest_first(x[:300], 90), 11, cosine)
    cell, angle = cells.nearest(x)
    radius = np.full(len(cells.pivots), -np.inf)
    np.maximum.at(radius, cell, angle)
    cells.set_radius(radius)
    everywhere = np.arange(len(radius))
    go, visits, group = cells.reach(x, cell, everywhere), cells.groups_of(x, cell), cells.group[cell]
    assert not go.all() and go.any(1).all()
    pairs = [(a, b) for a, b in np.argwhere(x @ x.T >= cosine) if a != b]
    assert len(pairs) > 50
    blocks = [[embedding_dedup.Blocks(np.bincount(cells.rings(x[rows], g), minlength=embedding_dedup.RINGS), 8)
               for rows in (group == g, visits[:, g] & (group != g))] for g in range(11)]
    for a, b in pairs:
        assert go[a, cell[b]]
        hosts = [g for g in {group[a], group[b]} if visits[a, g] and visits[b, g]]
        assert len(hosts) == 1
        g = hosts[0]
        at = []
        for k in (a, b):
            side = blocks[g][int(group[k] != g)]
            ring = cells.rings(x[k:k + 1], g)[0]
            at.append((side, side.first[ring] + (side.parts[ring] - 1)))
        assert at[1][1] in at[1][0].near(at[0][0], at[0][1], cells.angle)


def test_blocks_hold_all_rings():
    counts = np.zeros(embedding_dedup.RINGS, int)
    counts[[3, 4, 5, 20, 40, 41]] = [4, 3, 2, 25, 1, 1]
    b = embedding_dedup.Blocks(counts, 8)
    assert list(zip(b.low.tolist(), b.high.tolist())) == [(3, 4), (5, 5)] + [(20, 20)] * 4 + [(40, 41)]
    assert b.first[3] == b.first[4] == b.first[0] == 0 and b.first[19] == 2 and b.parts[20] == 4
    assert b.near(b, 6, 0.3).tolist() == [6]  # rings far apart do not meet
    assert not len(embedding_dedup.Blocks(counts * 0, 8))


def test_embeddings_empty(spark):
    v = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.embedding_duplicates(v).count() == 0
