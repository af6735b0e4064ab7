"""Toxicity by class-conditional Kneser-Ney models.

Each class has an interpolated Kneser-Ney model of the bytes of a word.  The
long contexts (orders 6 to 4) are counted in the class alone; below them both
classes share one backoff model (orders 3 to 1) whose counts are continuation
counts, the number of distinct words of either class in which a sequence
occurs.  So a rare or new expression differs between the classes only by what a
class has really seen of its parts.

A text is scored by length-normalised log-likelihood differences: that of the
whole text, and the largest and second largest of its words, since one
expression makes a long text toxic.  A logistic regression, fitted on labelled
rows that the language models have not seen, turns them into a probability.
"""

from __future__ import annotations

from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean_text, fold
from .numeric import GramTable, fit_logistic, predict_logistic

ORDER = 6
SHARED = 3
DISCOUNT = 0.75
#: Labelled rows of each class that the models are fitted on, at most.
MAX_DOCS = 4000
#: Words that a Python worker remembers.
MAX_WORDS = 500_000

_SCORERS: dict = {}


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def symbols(words: list[bytes]):
    """The words with their boundaries as one sequence of bytes; for each, how
    many symbols of the word there are before it, and its word; and the places
    of the symbols to be predicted."""
    flat = np.frombuffer(b" " + b"  ".join(words) + b" ", np.uint8)
    n = np.fromiter(map(len, words), np.int32, len(words)) + 2
    first = np.repeat(np.cumsum(n, dtype=np.int32) - n, n)
    depth = np.arange(len(flat), dtype=np.int32) - first
    word = np.repeat(np.arange(len(words), dtype=np.int32), n)
    return flat, depth, word, np.nonzero(depth > 0)[0]


def grams(flat: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Codes of the ``n`` symbols that end at each place."""
    out = flat[at].astype(np.uint64)
    for k in range(1, n):
        out |= flat[at - k].astype(np.uint64) << np.uint64(8 * k)
    return out


class KneserNey:
    """Two models, ``long[c][n]`` for class c and orders above SHARED, and the
    shared ones, each as (grams, their share, contexts, their backoff)."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        """``counts``: a row per word, a column per class."""
        flat, depth, word, at = symbols(words)
        self.shared = {}
        self.long: list[dict] = [{}, {}]
        self.base = np.bincount(flat[at], minlength=256) + 0.5
        self.base /= self.base.sum()
        for n in range(2, ORDER + 1):
            pos = at[depth[at] >= n - 1]
            if n <= SHARED:  # distinct words: each counts once
                self.shared[n] = _order(n, grams(flat, pos, n), None, word[pos])
            else:
                for c in (0, 1):
                    own = pos[counts[word[pos], c] > 0]
                    self.long[c][n] = _order(n, grams(flat, own, n), counts[word[own], c])

    def log_ratio(self, words: list[bytes]) -> np.ndarray:
        """log P(word | class 1) - log P(word | class 0)."""
        if not words:
            return np.zeros(0)
        flat, depth, word, at = symbols(words)
        p = self.base[flat[at]]
        both = [p, p]
        for n in range(2, ORDER + 1):
            deep = np.nonzero(depth[at] >= n - 1)[0]
            seen, context = grams(flat, at[deep], n), grams(flat, at[deep] - 1, n - 1)
            if n <= SHARED:
                both = [_apply(self.shared[n], seen, context, deep, both[0])] * 2
            else:
                both = [_apply(self.long[c][n], seen, context, deep, both[c]) for c in (0, 1)]
        return np.bincount(word[at], np.log(both[1] / both[0]), len(words))


def _order(n, codes, count, word=None):
    """(grams, share, contexts, backoff) of one order; without counts, a gram
    counts once for each word that it occurs in."""
    place = np.argsort(codes, kind="stable")
    codes = codes[place]
    new = np.ones(len(codes), bool)
    new[1:] = codes[1:] != codes[:-1]
    if count is None:
        once = new.copy()
        once[1:] |= word[place][1:] != word[place][:-1]  # words stay in order
        count = once.astype(float)
    else:
        count = count[place]
    first = np.nonzero(new)[0]
    keys = codes[first]
    c = np.add.reduceat(count, first) if len(first) else np.zeros(0)
    # the context is the gram without its last symbol, the low byte
    hkeys, hplace = np.unique(keys >> np.uint64(8), return_inverse=True)
    total = np.bincount(hplace, c, len(hkeys))
    kinds = np.bincount(hplace, minlength=len(hkeys))
    share = np.maximum(c - DISCOUNT, 0) / total[hplace]
    return GramTable(keys), share, GramTable(hkeys), DISCOUNT * kinds / total


def _apply(order, seen, context, deep, p):
    table, share, contexts, backoff = order
    g, h = table.find(seen), contexts.find(context)
    q, low = p.copy(), p[deep]
    a = np.where(g >= 0, np.append(share, 0.0)[g], 0.0)
    q[deep] = np.where(h >= 0, a + np.append(backoff, 1.0)[h] * low, low)
    return q


class Scorer:
    """Features of texts under a model, remembering words."""

    def __init__(self, model: KneserNey):
        self.model, self.known = model, {}

    def features(self, texts: list) -> np.ndarray:
        """Per text: mean log ratio per symbol of the whole text, and the largest
        and second largest log ratio of a word, per symbol and in all."""
        if len(self.known) > MAX_WORDS:
            self.known = dict(islice(self.known.items(), MAX_WORDS // 2))
        rows = [words_of(t) for t in texts]
        new = list({w for r in rows for w in r if w not in self.known})
        for k in range(0, len(new), 20_000):
            some = new[k:k + 20_000]
            self.known.update(zip(some, self.model.log_ratio(some).tolist()))
        out = np.zeros((len(texts), 5))
        for k, r in enumerate(rows):
            if r:
                v = np.fromiter(map(self.known.__getitem__, r), float, len(r))
                n = np.fromiter(map(len, r), float, len(r)) + 1
                top = np.sort(v[np.argsort(v)[-2:]])[::-1]
                per = np.sort(v / n)[-2:][::-1]
                out[k] = [v.sum() / n.sum(), per[0], per[-1] if len(r) > 1 else 0,
                          top[0] / 10, top[-1] / 10 if len(r) > 1 else 0]
        return np.clip(out, -5, 5)


def _scorer(shared) -> Scorer:
    if shared.id not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[shared.id] = Scorer(shared.value["model"])
    return _SCORERS[shared.id]


class _Shared:
    """A broadcast value with a key of its own, for the worker's cache."""

    def __init__(self, spark, value):
        import uuid

        self.id, self.held = uuid.uuid4().hex, spark.sparkContext.broadcast(value)

    @property
    def value(self):
        return self.held.value


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, doc_id: str = "doc_id",
          text: str = "text", label: str = "toxic") -> dict:
    """Model and calibration from labelled rows outside the held-out fold.

    At most ``max_docs`` labelled ids of each class are used (those with the
    smallest hashes), and of an id that is repeated one row (the smallest text hash).  Folds 1 to 3 of crc32(id) mod 5 count for the language
    models, fold 4 for the calibration; fold 0 is never read.  Rows without a
    label or an id, and ids with both labels, count as unlabelled.
    """
    ids = (labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
           .where(fold(doc_id, 5) != 0)
           .groupBy(F.col(doc_id).alias("__id")).agg(F.min(label).alias("y"), F.max(label).alias("hi"))
           .where("y = hi").select("__id", "y", fold("__id", 5).alias("f")))
    prior = {r["y"]: r["n"] for r in ids.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pick = [ids.where(F.col("y") == y).orderBy(F.xxhash64("__id"), "__id").limit(max_docs) for y in (0, 1)]
    chosen = F.broadcast(pick[0].unionByName(pick[1]))  # 2 * max_docs rows at most
    rows = (docs.select(F.col(doc_id).alias("__id"), clean_text(text).alias("t")).join(chosen, "__id")
            .groupBy("__id").agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t", "y", "f")).alias("x"))
            .select("x.y", "x.f", "x.t"))  # a row an id

    def count(batches):
        for b in batches:
            held = (Counter(), Counter())
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held[y].update(words_of(t))
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for c in held for w in c], pa.binary()),
                 *(pa.array([c[w] if k == j else 0 for k, c in enumerate(held) for w in c], pa.int64())
                   for j in (0, 1))], names=["word", "n0", "n1"])

    table = (rows.where("f <> 4").select("y", "t")
             .mapInArrow(count, "word binary, n0 long, n1 long")
             .groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))).toArrow()
    order = np.argsort(np.array(table.column("word").to_pylist(), dtype=object), kind="stable") \
        if table.num_rows else np.zeros(0, int)
    words = [table.column("word")[int(i)].as_py() for i in order] or [b"-"]
    counts = np.stack([table.column(c).to_numpy()[order] for c in ("n0", "n1")], axis=1).astype(float) \
        if table.num_rows else np.ones((1, 2))
    model = KneserNey(words, counts)
    shared = _Shared(docs.sparkSession, {"model": model})

    def measure(batches):
        for b in batches:
            x = _scorer(shared).features(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), *map(pa.array, x.T)], names=["y", *"abcde"])

    cal = (rows.where("f = 4").select("y", "t")
           .mapInArrow(measure, "y long, a double, b double, c double, d double, e double")
           .orderBy(*"yabcde").toArrow())
    x = np.stack([cal.column(c).to_numpy() for c in "abcde"], axis=1)
    y = cal.column("y").to_numpy()
    if len(set(y.tolist())) < 2:  # nothing to learn from: the prior, or 0
        p = prior.get(1, 0) / max(1, sum(prior.values()))
        return {"model": model, "weights": np.array([0] * 5 + [np.log((p + 1e-3) / (1 - p + 1e-3))]),
                "shared": shared}
    own = np.array([(y == k).sum() for k in (0, 1)])
    rate = np.array([prior[k] / sum(prior.values()) for k in (0, 1)])
    weights = fit_logistic(x, y, (rate / own * len(y))[y], ridge=0.1)
    return {"model": model, "weights": weights, "shared": shared}


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row's whole text.

    Null texts count as empty; a null id is not held out.  Repeated rows stay
    rows; other columns are ignored; an empty table gives an empty table.
    """
    shared, weights = model["shared"], model["weights"]

    def run(batches):
        for b in batches:
            t = b.column(2).to_pylist()
            p = predict_logistic(weights, _scorer(shared).features(t)) if t else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    held = (F.col(doc_id).isNotNull() & (fold(doc_id, 5) == 0)).alias("held_out")
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), held, clean_text(text))
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))


def toxicity(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """Train on ``labels`` and score all ``docs``."""
    return score(docs, train(docs, labels, **kw))
