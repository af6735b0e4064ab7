"""Classifiers, language model, mixing, extraction, pipeline."""

import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from feedloom.llm import html_extract, lm_scoring, mixing, quality, toxicity
from feedloom.llm.html_extract import Page

SF = "/root/testdata/sf0.001"


# --- extraction -----------------------------------------------------------

@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b &amp; c&nbsp;d<br>e", "a\n\nb & c d e"),
    ("<nav>m</nav><article><h1>T</h1><p>x &lt; y</p><aside>s</aside><form>f</form></article><footer>z</footer>",
     "T\n\nx < y"),
    ("<div class='sidebar'>s</div><div>main <b>bold</b></div><div id=comments><p>hey</div>", "main bold"),
    ("<article><header><h1>T</h1></header><p>x</article><header>site</header>", "T\n\nx"),
    ("<script>var t='<p>';</script><style>p{}</style>x<!-- c --><textarea>zz", "x"),
    ("<article class='comment-open'><p>a</p><section class=comments><article>no</article></section></article>", "a"),
    ("<ul><li><a href=1>a</a><li><a href=2>b</a><li><a href=3>c</a></ul><p>t", "t"),
    ("<div class=ad>buy</div><div class='cookie-notice'>ok?</div><p>t</p>", "t"),
    ("<p>a <unknown x='<p>'>b", "a b"), ("a < b", "a < b"), ("<p", ""),
])
def test_page_text(html, want):
    assert Page(html).text(set()) == want


@pytest.mark.parametrize("html, want", [
    ("<form><div>menu</div><article><p>a</p></article></form>", "a"),
    ("<div class='content with-sidebar'><article><p>a</p></article><div class=sidebar>s</div></div>", "a"),
    ("<div class='layout sidebar-right'><div>x</div><main><p>a</p></main></div><article><p>b</p></article>", "a\n\nb"),
    ("<div class=has-banner><article>a</article></div>", "a"), ("<dialog><article>a</article></dialog>", "a"),
    ("<div class='layout sidebar'><article>a</article><p>x</div>", "a"),
    ("<main><div class='no-sidebar'><article class='post has-banner'>a</article></div></main>", "a"),
    ("<main><h1>T</h1><form><p>x</p><article>a</article></form></main>", "T\n\na"),
    ("<article>a</article><div class=sidebar><article>teaser</article></div>", "a"),
    ("<article>a</article><section class=comments-area><article>c</article></section>", "a"),
    ("<p>a</p><nav><article>n</article></nav><footer><article>f</article></footer>"
     "<div class=comments><article>c</article></div>", "a"),
    ("<body><form><nav>n</nav><p>a</p><div class=footer>f</div></form></body>", "a"),
])
def test_wrappers_do_not_remove_an_article(html, want):
    assert Page(html).text(set()) == want


@pytest.mark.parametrize("html, want", [
    ("<div id=content><p>Main text of the page.</p></div><section><article class='comment'>Reader comment</article>"
     "</section>", "Main text of the page."),
    ("<div id=content><p>A plain container with the long main text.</p></div><section><article>teaser one</article>"
     "<article>teaser two</article></section>", "A plain container with the long main text."),
    ("<article><p>a</p><div class='market-share'>b</div><section class='related-work'>c</section>"
     "<div class=ad-hoc>d</div><div class='open-share'>e</div></article>", "a\n\nb\n\nc\n\nd\n\ne"),
    ("<article><p>a</p><div class='share-buttons'>b</div><section class=related-posts>c</section>"
     "<div class=comments__list>d</div><div class='ad'>e</div></article>", "a"),
    ("<div class=market-share>a</div><div class=acme-sidebar>b</div><div class=blog_footer>c</div>", "a"),
    ("<article><p>first</p></article><article><p>second one</p></article><p>x</p>", "first\n\nsecond one"),
    ("<article class='post widget'><p>a</p></article><footer>f</footer>", "a"),
    ("<article class=teaser>t</article><div><p>main</p></div>", "main"),
])
def test_comments_teasers_and_words_in_names(html, want):
    assert Page(html).text(set()) == want


def test_a_deep_page_takes_memory_in_proportion():
    import time
    import tracemalloc
    peaks = []
    for n in (10_000, 40_000):
        html = "<div class=a>" * n + "deep" + "</p></section>" * n
        tracemalloc.start()
        start = time.time()
        page = Page(html)
        assert page.text(set()) == "deep" and len(page.statistics()) == n
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert time.time() - start < 30
    assert peaks[1] < 6 * peaks[0] and peaks[1] < 100e6


TEMPLATE = ("<body><div class=qa><a href=/start>Start</a> <a href=/all>All</a> updated {0}</div>"
            "<div class=qb><div class=qc>All rights of this house are kept, write to the desk, build {0}</div></div>"
            "<div class=qd><h1>About {1}</h1><p>{2}</p></div><div class=qe>Written by {1} for you {3}</div></body>")


def template_pages():
    import random
    rng = random.Random(5)
    rows = []
    for i in range(60):
        words = [f"w{int(rng.paretovariate(0.6)) % 4000}" for _ in range(80)]
        name = f"name{i} of{rng.randrange(40)}"
        rows.append((i, f"http://h{i % 2}.org/{i}", TEMPLATE.format(i, name, " ".join(words), " ".join(words[:5])),
                     f"About {name}\n\n{' '.join(words)}"))
    return rows


def test_the_tree_removes_boilerplate_that_no_name_tells(spark):
    rows = template_pages()
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    on = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    off = {r["page_id"]: r["text"] for r in html_extract.extract(pages, threshold=0.0).collect()}
    for i, _, _, main in rows:
        assert "All rights" in off[i] and "Start All" in off[i] and main in off[i]
        assert "All rights" not in on[i] and "Start" not in on[i]
        assert on[i].startswith(main)  # and the byline, which differs


def test_style_tree_against_brute_force(spark):
    rows = template_pages() + [(100 + k, "http://h0.org/c", template_pages()[0][2], "") for k in range(3)] \
        + [(200, "http://h0.org/x", "<body><article><p>x</p><ul><li>Start</ul></article></body>", "")]
    got = {(r["host"], r["path"]): r for r in html_extract.style_tree(html_extract.page_nodes(
        spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string"))).collect()}
    nodes = {}
    for _, url, html, _ in rows:
        for path, unit, children, share, features in Page(html).statistics():
            nodes.setdefault((url.split("/")[2], path), {})[unit] = (children, share, features)
    assert nodes.keys() == got.keys()

    def base(x, m):
        return math.log(x) / math.log(m)

    for key, units in nodes.items():
        m, looks = len(units), Counter(v[0] for v in units.values())
        pres = -sum(c / m * base(c / m, m) for c in looks.values()) if m > 1 else 1.0
        counts, own = Counter(f for v in units.values() for f in v[2]), sum(bool(v[2]) for v in units.values())
        cont = 1 - sum(base(counts[f], own) for v in units.values() for f in v[2]) / counts.total() if own > 1 else 1.0
        r = got[key]
        assert (r["pages"], r["styles"]) == (m, len(looks))
        assert np.allclose([r["presentation"], r["content"], r["importance"]],
                           [pres, cont, (1 - 0.9 ** len(looks)) * pres + 0.9 ** len(looks) * cont])


def test_style_tree_removes_what_a_host_repeats(spark):
    page = "<body><div class=x1>Same words everywhere</div><div class=story><p>{}</p></div></body>"
    rows = [(i, f"http://h{i % 2}.com/{i}", page.format(f"Story {i} " * 20)) for i in range(40)]
    rows += [(100 + i, "http://copies.com/a", "<article><p>One story</p></article>") for i in range(20)]
    rows += [(200, None, None), (None, "x", page.format("q")), (201, "http://h0.com/z", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string") \
        .selectExpr("*", "'x' AS host", "'x' AS path", "'x' AS low", "'x' AS text")
    got = {r["page_id"]: r for r in html_extract.extract(pages).collect()}
    assert got[7]["text"] == ("Story 7 " * 20).strip() and got[7]["n_chars"] == len(got[7]["text"])
    assert got[100]["text"] == "One story" and got[200]["text"] == "" and got[201]["n_chars"] == 0
    assert got[None]["text"] == "Same words everywhere\n\nq"
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_copies_of_an_article_are_no_evidence_against_its_parts(spark):
    story = ("<body><div class=top>{}</div><article><p>{}</p><ul><li>first</ul><blockquote>said {}</blockquote>"
             "<section class=tail>Read more of us</section></article></body>")
    other = [(i, "http://many.com/", story.replace("first", f"item {i}").format(i, f"Other {i} " * 20, i))
             for i in range(50)]
    rows = [(100 + i, "http://three.com/", story.format(0, "One story " * 20, "she")) for i in range(3)]
    # the copies stand in pages that differ elsewhere
    rows += [(1000 + i, "http://many.com/", story.format(i, "One story " * 20, "she")) for i in range(1000)]
    pages = spark.createDataFrame(other + rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    one = "\n\n".join([("One story " * 20).strip(), "first", "said she"])
    assert all(got[100 + i] == one + "\n\nRead more of us" for i in range(3))
    assert all(got[1000 + i] == one for i in range(1000))  # what all 51 articles repeat is not theirs
    assert all(got[i] == "\n\n".join([(f"Other {i} " * 20).strip(), f"item {i}", f"said {i}"]) for i in range(50))


def test_extraction_of_the_test_pages(spark):
    got = {r["page_id"]: r["text"] for r in E.queries()["op1_html_extraction"](spark, SF).collect()}
    import re
    from html import unescape
    for i, h in duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall():
        body = re.search(r"(?s)<article>(.*?)</article>", h)[1]
        blocks = (re.sub(r"<[^>]*>", " ", b) if "<br>" in b else re.sub(r"<[^>]*>", "", b)
                  for b in re.split(r"</?(?:p|h1)>", body))
        assert got[i] == "\n\n".join(x for x in (" ".join(unescape(b).split()) for b in blocks) if x)


# --- classifiers ----------------------------------------------------------

def test_toxicity_on_held_out_rows(spark, sf):
    docs, labels = sf("documents", "sf0.01"), sf("labels", "sf0.01")
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) >= 0.95
    toxic, clean = ([r["score"] for r in held if r["toxic"] == k] for k in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) >= 0.9


def test_kneser_ney_is_a_distribution():
    words = [b"abc", b"abd", b"xyz", b"ab"]
    m = toxicity.KneserNey(words, np.array([[3, 0], [1, 2], [0, 5], [2, 2]], float))
    flat = np.frombuffer(b" ab", np.uint8)
    for c in (0, 1):
        total = 0.0
        for s in range(256):
            text = np.append(flat, s).astype(np.uint8)
            at = np.array([3])
            p = m.base[text[at]]
            for n in range(2, 5):
                t = m.shared[n] if n <= toxicity.SHARED else m.long[c][n]
                p = toxicity._apply(t, toxicity.grams(text, at, n), toxicity.grams(text, at - 1, n - 1),
                                    np.array([0]), p)
            total += p[0]
        assert abs(total - 1) < 1e-9


def test_quality_on_held_out_rows(spark, sf):
    docs, labels = sf("documents", "sf0.01"), sf("labels", "sf0.01")
    rows = quality.quality(docs, labels).join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows if r["held_out"]]) >= 0.97


def test_co_training_exchanges_labels_and_learns():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 900)
    views = [rng.normal(size=(900, 4)) + 1.8 * y[:, None] * (np.arange(4) == k) for k in (0, 1)]
    fit, cal, pool = slice(0, 40), slice(40, 200), slice(200, 900)
    v, given = quality.co_train([x[fit] for x in views], y[fit], [x[cal] for x in views], y[cal],
                                [x[pool] for x in views], certain=0.9)
    p = quality.combine(0.5, [f.predict(x[pool]) for f, x in zip(v, views)])
    assert given > 0 and np.mean((p >= 0.5) == y[pool]) > 0.83


def test_co_training_hands_over_open_rows_in_every_round():
    rng = np.random.default_rng(1)
    y = np.arange(1400) % 2
    views = [rng.normal(size=(1400, 4)) + 6.0 * y[:, None] * (np.arange(4) == k) for k in (0, 1)]
    fit, cal, pool = slice(0, 100), slice(100, 400), slice(400, 1400)
    _, given = quality.co_train([x[fit] for x in views], y[fit], [x[cal] for x in views], y[cal],
                                [x[pool] for x in views], rounds=4, per_round=20)
    assert given == 2 * 2 * 4 * 20  # views, classes, rounds: far more rows are certain


def test_the_pool_is_every_unlabelled_row(spark, sf):
    """The picks on Spark are those of a pool in memory, a row an id."""
    rng = np.random.default_rng(2)
    y = np.arange(900) % 2
    x = [(rng.normal(size=(900, d)) + 2.5 * y[:, None] * (np.arange(d) == k)).astype(np.float32)
         for k, d in enumerate((quality.TEXT_DIM, quality.META_DIM))]
    rows = [(f"{i:04d}", bytearray(x[0][i].tobytes()), bytearray(x[1][i].tobytes())) for i in range(200, 900)]
    pool = spark.createDataFrame(rows + rows[:300] * 3, "i string, a binary, b binary").repartition(7)
    split = [v.astype(float) for v in x]
    args = [v[:100] for v in split], y[:100], [v[100:200] for v in split], y[100:200]
    views, given = quality.exchange(*args, quality.PoolPicker(pool, 0.8, 15), 3)
    want, given_there = quality.co_train(*args, [v[200:] for v in split], 3, 0.8, 15)
    assert given == given_there > 60
    for a, b, v in zip(views, want, split):
        assert np.allclose(a.predict(v), b.predict(v), atol=1e-6)


def test_quality_against_a_plain_version(spark, sf):
    docs, labels = sf("documents"), sf("labels")
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    rows = docs.collect()
    x = (np.array([quality.text_features(r["text"]) for r in rows], float),
         np.array([quality.meta_features(r["lang"], r["source"], r["n_chars"]) for r in rows], float))
    ids = [r["doc_id"] for r in rows]
    part = lambda test: sorted((k for k, i in enumerate(ids) if test(i)), key=lambda k: str(ids[k]))
    fit = part(lambda i: i in known and fold(i) in (1, 2, 3))
    cal = part(lambda i: i in known and fold(i) == 4)
    pool = part(lambda i: i not in known and fold(i))
    label = lambda at: np.array([known[ids[k]] for k in at])
    views, _ = quality.co_train([v[fit] for v in x], label(fit), [v[cal] for v in x], label(cal), [v[pool] for v in x])
    want = quality.combine(label(fit + cal).mean(), [f.predict(v) for f, v in zip(views, x)])
    got = {r["doc_id"]: r["score"] for r in quality.quality(docs, labels).collect()}
    assert np.allclose([got[i] for i in ids], want, atol=1e-4)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_a_repeated_id_brings_one_row_to_the_driver(spark, module, monkeypatch):
    rows = [(i, f"text {i} {'bad' if i % 2 else 'good'} word{i % 7}", "en", "s", 9) for i in range(60)]
    docs = spark.createDataFrame(rows + [(7, f"text {k % 3} bad", "en", "s", 9) for k in range(20_000)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    real, most = Classic.toArrow, []
    monkeypatch.setattr(Classic, "toArrow", lambda df: (most.append(real(df)), most[-1])[1])
    module.train(docs, labels)
    assert most and max(t.num_rows for t in most) < 200


@pytest.mark.parametrize("model", [quality.quality, toxicity.toxicity])
def test_classifiers_nasty(spark, nasty, no_docs, model):
    labels = spark.createDataFrame(
        [(1, 1, 0), (4, 0, 1), (6, 1, 0), (6, 0, 1), (9, None, None), (None, 1, 1), (999, 1, 1), (11, 0, 1), (10, 1, 0)],
        "doc_id long, quality int, toxic int")
    rows = model(nasty, labels).collect()
    assert len(rows) == 14 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert model(no_docs, labels).count() == 0
    assert model(nasty, labels.limit(0)).count() == 14
    assert quality.keep_good(nasty, labels).columns == nasty.columns


# --- language model -------------------------------------------------------

def brute_base(docs):
    count = Counter()
    for i, t in docs:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            count.update((t or "").encode().lower().split() + [b""])
    n, v = sum(count.values()), len(count)
    out = []
    for i, t in docs:
        w = (t or "").encode().lower().split() + [b""]
        out.append((i, len(w), sum(count[x] > 0 for x in w), n,
                    sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)))
    return out


@pytest.mark.parametrize("kw", [{}, {"vocabulary": 20, "head_size": 40}])
def test_lm_against_brute_force(spark, sf, nasty, kw):
    for docs in (nasty, sf("documents")):
        docs = docs.select("doc_id", "text")
        got = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])
               for r in lm_scoring.lm_scores(docs, **kw).collect()]
        want = brute_base([tuple(r) for r in docs.collect()])
        assert sorted([g[:4] for g in got], key=str) == sorted([w[:4] for w in want], key=str)
        assert np.allclose(sorted(g[4] for g in got), sorted(w[4] for w in want), rtol=1e-9)


def test_lm_empty_and_better_than_base(spark, sf, no_docs):
    assert lm_scoring.lm_scores(no_docs).count() == 0
    r = lm_scoring.lm_scores(sf("documents", "sf0.01")).where("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_lm_partitions_train_from_a_common_start(spark, sf):
    docs = sf("documents", "sf0.01").repartition(16, "doc_id")
    r = lm_scoring.lm_scores(docs).where("held_out").agg(
        F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (r[0] - r[1]) / r[2] > 0.048  # 0.037 if each starts at random


def test_lm_normalisers_and_gradient():
    rng = np.random.default_rng(0)
    m = lm_scoring.Model(9, np.full(9, 1 / 9), dim=5)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(10), np.arange(10)))
    want = np.log(np.exp((m.predicted(a, b) @ m.symbol.T + m.bias).astype(float)).sum(1))
    for bits in (1, 3, 12):  # pairs may take each other's place
        z = lm_scoring.Normalisers(m, bits)
        for _ in range(2):
            assert np.allclose(z.find(a, b), want, atol=1e-5)
            assert np.allclose(z.find(a[::-3], b[::-3]), want[::-3], atol=1e-5)
    # a chain in which symbol x + 1 follows x is learnt
    w = np.arange(40_000) % 9
    p, q = lm_scoring.triples(w, np.array([40_000]), 9)
    assert (p[:3].tolist(), q[:3].tolist()) == ([9, 0, 1], [9, 9, 0])
    fit = lm_scoring.Trainer(m, rng)
    for k in range(0, len(w), 256):
        fit.batch(p[k:k + 256], q[k:k + 256], w[k:k + 256])
    lp = (m.predicted(p, q) * m.symbol[w]).sum(1) + m.bias[w] - lm_scoring.Normalisers(m).find(p, q)
    assert lp.mean() > np.log(1 / 9) + 1


def test_lm_vocabulary_grows_with_the_training_tokens():
    sizes = [lm_scoring.vocabulary_of(n) for n in (0, 10**6, 10**9, 10**12, 10**13)]
    assert sizes[:2] == [1000, 1000] and sizes[2] == 2500 and sizes[3] == 25_000 and sizes[4] > 50_000


@pytest.mark.parametrize("kw", [{}, {"vocabulary": 20, "head_size": 40}])
def test_lm_scores_against_a_full_softmax(spark, kw):
    """Each token's probability by a loop over all symbols, and its share in a class by counts."""
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["a", "b", "of", "zebra,", "zoo", "The", "été"] + [f"w{k}" for k in range(60)],
                                 rng.integers(0, 30))) for _ in range(80)] + [None, "", "never seen, at all"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, t string").selectExpr(
        "doc_id", "crc32(cast(doc_id as string)) % 7 = 2 AS held_out", "coalesce(t, '') AS t")
    fitted = lm_scoring.fit(docs, **kw)
    head, m, n_own = fitted.head.value, fitted.model, fitted.n_own
    count = {bytes(r["word"]): r["n_train"] for r in fitted.counts.collect()}
    for r in lm_scoring.score(docs, fitted).collect():
        want, a, b = 0.0, len(m.bias), len(m.bias)
        for w in lm_scoring.words_of(texts[r["doc_id"]]) + [lm_scoring.END]:
            k = head.place.get(w)
            own = int(head.symbol[k]) if k is not None else n_own + lm_scoring.spelling_class(w)
            x = (m.context[a] * m.place[0] + m.context[b] * m.place[1]).astype(float) @ m.symbol.T + m.bias
            want += (x[own] - np.log(np.exp(x).sum())) / np.log(10)
            if own >= n_own:
                n, v = fitted.classes[own - n_own]
                want += np.log10((count.get(w, 0) + 1) / (n + v + 1))
            a, b = own, a
        assert abs(r["score"] - want) < 1e-3 * max(1, abs(want)), (r, want)


# --- mixing ---------------------------------------------------------------

def test_schedules_integrate_and_invert():
    for knots in mixing.SCHEDULES:
        share = np.linspace(0, 1, 101)
        t = mixing.invert_schedule(knots, share)
        assert (np.diff(t) >= 0).all() and t[0] == 0 and abs(t[-1] - 1) < 1e-9
        x = np.linspace(0, 1, 20_001)
        d = np.interp(x, *zip(*knots))
        area = np.concatenate([[0], np.cumsum((d[1:] + d[:-1]) / 2 * np.diff(x))])
        assert np.abs(np.interp(t, x, area / area[-1]) - share).max() < 1e-6


def test_mixing_query_matches_sql_and_targets(spark):
    got = E.queries()["op5_source_mixing"](spark, SF).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rel = con.sql(E.oracle_sql()["op5_source_mixing"])
    cols = "doc_id, size, source_size, target, taken, first_position, second_position, first_rank, second_rank"
    want = {r[0]: r for r in rel.select(cols).fetchall()}
    assert len(got) == len(want)
    for r in got:
        w = want[r["doc_id"]]
        assert tuple(r[c] for c in cols.split(", ")) == w  # to the last bit
    source = dict(duckdb.sql(f"SELECT doc_id, source FROM '{SF}/documents.parquet'").fetchall())
    total, most, target = Counter(), Counter(), {}
    for r in got:
        s = source[r["doc_id"]]
        total[s] += r["taken"]
        most[s] = max(most[s], r["size"])
        target[s] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert all(abs(total[s] - target[s]) <= most[s] for s in target)
    assert math.isclose(sum(target.values()), 1.5 * sum(r["size"] for r in got))


def test_mixing_nasty(spark, nasty, no_docs):
    rows = mixing.mix(nasty).collect()
    assert len(rows) == 14
    kept = mixing.mixed_documents(nasty)
    assert kept.columns == nasty.columns
    want = Counter()
    for r in rows:
        want[r["doc_id"]] += len(r["positions"])
        assert len(r["positions"]) <= 2 and all(0 <= p <= 1 for p in r["positions"])
    assert Counter(r["doc_id"] for r in kept.collect()) == +want
    again = mixing.mix(nasty.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert mixing.mix(no_docs).count() == mixing.mixed_documents(no_docs).count() == 0
    blank = nasty.where("doc_id IN (4, 5)")
    assert mixing.mixed_documents(blank).count() == 2


def test_repeated_rows_are_placed_one_by_one(spark):
    rows = [(1, "one two three four", "en", "a", 9)] * 1000 + [(None, f"w{k} x", "en", "a", 9) for k in range(500)]
    rows += [(k, "x " * 40, "en", "b", 9) for k in range(2, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plan = mixing.ranked_mix(docs, share=0.9).collect()
    assert len(plan) == len(rows)
    taken, target = Counter(), {}
    for r in plan:
        taken[r["source"]] += r["size"] * len(r["positions"])
        target[r["source"]] = r["target"]
    assert abs(taken["a"] - target["a"]) <= 4 and abs(taken["b"] - target["b"]) <= 40
    ranks = sorted((k, p) for r in plan for k, p in zip(r["ranks"], r["positions"]))
    assert [k for k, _ in ranks] == list(range(len(ranks)))
    assert all(a[1] <= b[1] for a, b in zip(ranks, ranks[1:]))
    kept = mixing.mixed_documents(docs, share=0.9).collect()
    assert len(kept) == len(ranks)
    most = Counter(r["text"] for r in kept if r["doc_id"] is None)
    assert all(n <= 2 for n in most.values())  # rows of equal id and size are told apart


def test_numbers_of_rows_run_over_ranges(spark):
    from feedloom.llm.common import numbered
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, NULL, id % 2) AS k", "id AS o")
    got = numbered(df, ["k"], ["o"]).collect()
    for key in (None, 0, 1):
        own = sorted((r["o"], r["number"]) for r in got if r["k"] == key)
        assert [n for _, n in own] == list(range(len(own))) and len(own) == 1000
    assert [r["number"] for r in sorted(numbered(df, [], ["o"]).collect(), key=lambda r: r["o"])] == list(range(3000))


def test_mixed_documents_come_in_order_of_position(spark, sf):
    docs = sf("documents")
    at = {}
    for r in mixing.mix(docs).collect():
        at[r["doc_id"]] = list(r["positions"])
    order = [r["doc_id"] for r in mixing.mixed_documents(docs).select("doc_id").collect()]
    assert Counter(order) == Counter({i: len(p) for i, p in at.items() if p})
    last, used = -1.0, Counter()
    for i in order:
        p = sorted(at[i])[used[i]]
        used[i] += 1
        assert p >= last
        last = p


# --- pipeline -------------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark, sf):
    from .test_dedup import brute_components, brute_fingerprint
    from .test_tokens import plain

    docs = sf("documents")
    labels = {r["doc_id"]: r["quality"] for r in sf("labels").collect()}
    stage = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES] == list(stage) and len(stage) == 5
    good, exact, near, mixed, packed = ((k, stage[k]) for k in stage)

    def run(f, docs):
        out = f[1](spark, docs, SF).cache()
        return out, out.collect()

    d1, r1 = run(good, docs)
    assert d1.columns == docs.columns
    kept = {r["doc_id"] for r in r1}
    clean = [i for i, q in labels.items() if q == 1]
    assert np.mean([i in kept for i in clean]) >= 0.98
    assert np.mean([i in kept for i, q in labels.items() if q == 0]) <= 0.2
    d2, r2 = run(exact, d1)
    best = {}
    for r in r1:
        best[r["text"]] = max(r["doc_id"], best.get(r["text"], -1))
    assert d2.columns == docs.columns and sorted(r["doc_id"] for r in r2) == sorted(best.values())
    d3, r3 = run(near, d2)
    comp = brute_components([r["doc_id"] for r in r2], [brute_fingerprint(r["text"]) for r in r2])
    assert d3.columns == docs.columns and sorted(r["doc_id"] for r in r3) == sorted(set(comp))
    d4, r4 = run(mixed, d3)
    assert d4.columns == docs.columns
    copies = Counter(r["doc_id"] for r in r4)
    assert set(copies) <= set(comp) and max(copies.values()) <= 2
    _, r5 = run(packed, d4)
    text = {r["doc_id"]: r["text"] for r in r4}
    total = Counter()
    for r in r5:
        total[r["doc_id"]] += r["length"]
    assert total == Counter({i: (len(plain(text[i])) + 1) * c for i, c in copies.items()})
    assert corpus_pipeline.run(spark, SF).count() == len(r5)


def test_every_operator_is_registered():
    names = list(E.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names
