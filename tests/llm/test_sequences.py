"""Language identification, fill-in-middle, conversation trie."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from feedloom.llm import fill_in_middle as fim
from feedloom.llm import language_id as lid
from feedloom.llm import prefix_trie as pt

SF = "/root/testdata/sf0.001"


# --- language identification ----------------------------------------------

def brute_languages(train, texts, share):
    """The method in plain Python: words, then n-grams, over (lang, text)."""
    words = defaultdict(Counter)
    for a, t in train:
        words[a].update(lid.words_of(t))
    words = {a: c for a, c in words.items() if c}
    langs = sorted(words)
    cuts = lambda w, o: [w[k:k + o] for k in range(len(w) - o + 1) if w[k:k + o] != ' ']
    grams = {(a, o): Counter(g for w in words[a] for g in cuts(f" {w} ", o))
             for a in langs for o in range(1, lid.ORDER + 1)}

    def logs(tables):
        total = {a: sum(c.values()) for a, c in tables.items()}
        known = {g for a, c in tables.items() for g, n in c.items() if n >= share * total[a]}
        return {g: np.array([np.log((tables[a][g] + lid.SMOOTHING) / (total[a] + lid.SMOOTHING * len(known)))
                             for a in langs]) for g in known}

    by_word = logs(words)
    by_gram = {o: logs({a: grams[a, o] for a in langs}) for o in range(1, lid.ORDER + 1)}
    out = []
    for t in texts:
        total, found = np.zeros(len(langs)), lid.words_of(t)
        for w in found:
            if w in by_word:
                total += by_word[w]
                continue
            p = f" {w} "
            for k in range(len(p)):
                for o in range(min(lid.ORDER, len(p) - k), 0, -1):
                    if p[k:k + o] in by_gram[o]:
                        total += by_gram[o][p[k:k + o]] / o
                        break
        out.append((langs[int(total.argmax())] if found else "und", total))
    return out


@pytest.mark.parametrize("share", [lid.SHARE, 0.002])
def test_language_against_brute_force(spark, sf, share):
    docs = sf("documents")
    rows = docs.collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows}
    texts = [r["text"][:400] for r in rows]
    want = brute_languages([(r["lang"], r["text"]) for r in rows if not held[r["doc_id"]] and r["lang"]],
                           texts, share)
    learn = docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    model = lid.train(learn, share=share)
    sums, _ = lid.Scorer(model).sums(texts)
    assert np.allclose(sums, [w[1] for w in want], rtol=1e-4, atol=1e-2)
    got = {r["doc_id"]: r for r in lid.predict(docs.withColumn("text", F.substring("text", 1, 400)), model).collect()}
    assert all(got[r["doc_id"]]["lang_pred"] == w[0] and got[r["doc_id"]]["held_out"] == held[r["doc_id"]]
               for r, w in zip(rows, want))


def test_language_on_held_out_rows(spark, sf):
    docs = sf("documents", "sf0.01")
    rows = lid.identify(docs).join(docs.select("doc_id", "lang", F.length("text").alias("size")), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 200 and np.mean([r["lang_pred"] == r["lang"] for r in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_unseen_words_comes_from_their_ngrams(spark):
    rows = [(k, t, a) for k, (t, a) in enumerate(
        [("schlossung keitheit schungen", "de"), ("ciones amiento ación", "es")] * 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lid.train(docs)
    assert model.languages == ["de", "es"]
    found = lid.predict(spark.createDataFrame(
        [(1, "Verheitung"), (2, "miento"), (3, "123 ."), (4, None), (5, ""), (6, "ΩΨ")], "doc_id long, text string"), model)
    assert {r["doc_id"]: r["lang_pred"] for r in found.collect()} == {
        1: "de", 2: "es", 3: "und", 4: "und", 5: "und", 6: "de"}


def test_language_nasty(spark, nasty, no_docs):
    rows = lid.identify(nasty).collect()
    assert len(rows) == 14 and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r for r in rows}
    assert by[3]["lang_pred"] == by[4]["lang_pred"] == by[5]["lang_pred"] == "und"
    assert by[6]["lang_pred"] == "en" and by[8]["lang_pred"] in ("en", "fr", "de")
    assert lid.identify(no_docs).count() == 0
    blank = nasty.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in lid.identify(blank).collect()} == {"und"}


# --- fill in middle -------------------------------------------------------

def brute_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_against_brute_force(spark, sf, nasty, no_docs):
    odd = ["<", "<P", "a<S>b", "P><S", "<M><M", "😀é́x\n\r\n\0y", "S>P>M><<", "<<P>>"]
    more = spark.createDataFrame([(100 * k + j, t) for j, t in enumerate(odd) for k in range(1, 30)],
                                 "doc_id long, text string")
    seen = set()
    for docs in (sf("documents").select("doc_id", "text"), nasty, more):
        found = fim.fill_in_middle(docs)
        rows = found.withColumn("back", fim.restored()).collect()
        want = Counter(brute_fim(r["doc_id"], r["text"]) for r in docs.collect())
        assert Counter(tuple(r)[:6] for r in rows) == want
        text = Counter(r["text"] or "" for r in docs.collect())
        assert Counter(r["back"] for r in rows) == text
        seen |= {r["form"] for r in rows}
    assert seen == {"plain", "psm", "spm"} and fim.fill_in_middle(no_docs).count() == 0


def test_fill_in_middle_rates(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "'one two three' AS text")
    n = Counter(r["form"] for r in fim.fill_in_middle(docs, plain_percent=50, spm_percent=50).collect())
    assert 900 < n["plain"] < 1100 and 400 < n["spm"] < 600


# --- prefix trie ----------------------------------------------------------

def brute_trie(convs):
    """Nodes by prefix over {conv_id: [(role, text), ...]}."""
    members = defaultdict(list)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, who in members.items():
        worth = (len(who) - 1) * (len(p[-1][1]) if p else 0)
        for d in range(len(p) + 1):
            saved[p[:d]] += worth
            leaves[p[:d]] += p not in kids
    return Counter((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(who) if len(convs[c]) == len(p)).encode()).hexdigest())
                   for p, who in members.items())


def rebuilt(rows):
    turns = defaultdict(list)
    for c, n, r, t in rows:
        if c is not None:
            turns[c].append(((n is not None, n or 0), r or "", t or ""))
    turns = {c: [x[1:] for x in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - c % 100, [])[:h] + own[h:]
    return out


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("seed, block", [(0, 1), (1, 7), (2, 40), (3, pt.BLOCK)])
def test_trie_against_brute_force(spark, seed, block):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(1500), 160):
        n = rng.choice([1, 2, 3, 4, 5, 6, 7, 30 if c % 5 == 0 else 2])
        texts = ["hello"] * n if rng.random() < 0.2 else [rng.choice(["a", "bb", "é😀", ""]) for _ in range(n)]
        rows += [(c, k if k else rng.choice([None, -3]), rng.choice(["user", "user", None]), t) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert nodes(pt.conversation_trie(df, block=block)) == brute_trie(rebuilt(rows))


def test_trie_nasty(spark):
    rows = [(7, None, None, None), (7, 1, "user", "x" * 50_000), (None, 1, "user", "a"), (8, 0, "user", ""),
            (8, 0, "user", ""), (100, 1, "a:b", "c"), (101, 1, "a", "b:c"), (203, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .selectExpr("*", *[f"'x' AS {c}" for c in ("pos", "unit", "seq", "block", "end", "h", "first", "depth", "key")])
    assert nodes(pt.conversation_trie(df)) == brute_trie(rebuilt(rows))
    assert pt.conversation_trie(df.limit(0)).count() == 0
    plain = {7: [("", ""), ("user", "x" * 50_000)], 8: [("user", ""), ("user", "")], 100: [("a:b", "c")],
             101: [("a", "b:c")], 203: [("", "")]}
    assert nodes(pt.conversation_trie(df, rebuild=False)) == brute_trie(plain)


def test_numbers_run_over_partition_borders(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(5000).selectExpr("if(id < 4000, 1, id) AS conv_id", "id AS turn", "'u' AS role", "'t' AS text")
        got = pt.numbered_turns(df)
        assert got.where("conv_id = 1").selectExpr("min(pos)", "max(pos)", "count(distinct pos)").first() == (1, 4000, 4000)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_member_hashes_join_packed_runs(spark):
    rows = [(bytes([k % 3]), 37 * k - 500) for k in range(300)]
    got = {bytes(r["end"]): r["ends_sha256"] for r in pt.member_hashes(
        spark.createDataFrame([(bytearray(e), c) for e, c in rows], "end binary, conv_id long"), run_length=7).collect()}
    for e in {e for e, _ in rows}:
        ids = ",".join(map(str, sorted(c for x, c in rows if x == e)))
        assert got[e] == hashlib.sha256(ids.encode()).hexdigest()


def test_extents_find_every_interval():
    rng = np.random.default_rng(0)
    lcp = rng.integers(0, 4, 50)
    levels = pt.sparse_table(lcp)
    row, depth = np.repeat(np.arange(51), 5), np.tile(np.arange(5), 51)
    left, right = pt.extents(levels, row, depth, 51)
    for r, d, a, b in zip(row, depth, left, right):
        lo = hi = r
        while lo and lcp[lo - 1] >= d:
            lo -= 1
        while hi < 50 and lcp[hi] >= d:
            hi += 1
        assert (a, b) == (lo, hi)


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_prefix_trie"])
def test_queries_match_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = E.queries()[name](spark, SF)
    cols = sorted(got.columns)
    want = con.sql(E.oracle_sql()[name]).select(", ".join(cols)).fetchall()
    assert Counter(tuple(r[c] for c in cols) for r in got.collect()) == Counter(want)
