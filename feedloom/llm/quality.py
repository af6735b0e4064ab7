"""Quality classifier by co-training.

Two views of a document get a classifier each: the text (rates of byte kinds,
punctuation and byte pairs, word and line statistics of the whole text) and the
page metadata (language, source, recorded length).  In each round both are
fitted on the rows they have labels for, calibrated on labelled rows kept aside,
and hand the documents of which their calibrated probability is certain
enough to the other view as pseudo-labels.  A document's score combines the
calibrated views: the prior's log-odds plus what each view adds to them.

The pool is every unlabelled document outside the held-out fold.  Its features are
written once; in each round Spark scores all of it with both views and brings the most
certain rows to the driver, a fixed number for each view and class.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean_text, column, fold, free_names, spill
from .numeric import fit_logistic, logit, predict_logistic, sigmoid

#: Labelled rows that the classifiers are fitted on, at most.
MAX_LABELLED = 6000
ROUNDS = 4
#: Pseudo-labels need this calibrated probability; a view hands over at most
#: so many of each class in a round.
CERTAIN = 0.97
PER_ROUND = 400

PAIR_BINS = 128
LANG_BINS = 16
SOURCE_BINS = 32
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
TEXT_DIM = PAIR_BINS + len(PUNCTUATION) + 13
META_DIM = LANG_BINS + SOURCE_BINS + 5


def text_features(text: str | None) -> np.ndarray:
    out = np.zeros(TEXT_DIM, np.float32)
    raw = (text or "").encode()
    if not raw:
        return out
    b = np.frombuffer(raw, np.uint8)
    hist = np.bincount(b, minlength=256) / len(b)
    pairs = (b[:-1].astype(np.uint32) * 257 + b[1:]) * np.uint32(2654435761) >> np.uint32(25)
    out[:PAIR_BINS] = np.sqrt(np.bincount(pairs, minlength=PAIR_BINS)[:PAIR_BINS] / len(b))
    k = PAIR_BINS + len(PUNCTUATION)
    out[PAIR_BINS:k] = np.sqrt(hist[list(PUNCTUATION)])
    words = raw.lower().split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    seen = Counter(words)
    n, m = max(1, len(words)), max(1, len(lines))
    long = sum(map(len, words)) / n
    same = sum(a == c for a, c in zip(words, words[1:])) / n
    out[k:] = [np.sqrt(hist[65:91].sum()), np.sqrt(hist[97:123].sum()), np.sqrt(hist[48:58].sum()),
               np.sqrt(hist[128:].sum()), np.sqrt(hist[9:14].sum()), hist[32],
               len(seen) / n, max(seen.values(), default=0) / n, same, long / 10,
               np.log1p(n) / 10, len(set(lines)) / m, np.log1p(n / m) / 10]
    return out


def meta_features(lang, source, n_chars) -> np.ndarray:
    out = np.zeros(META_DIM, np.float32)
    if lang is not None:
        out[zlib.crc32(str(lang).encode()) % LANG_BINS] = 1
    if source is not None:
        out[LANG_BINS + zlib.crc32(str(source).encode()) % SOURCE_BINS] = 1
    k = LANG_BINS + SOURCE_BINS
    n_chars = None if n_chars is None else int(n_chars)
    size = np.log1p(max(0, n_chars or 0)) / 10
    out[k:] = [size, size * size, (n_chars or 0) < 100, n_chars is None, (n_chars or 0) > 20000]
    return out


def _platt(p: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Calibration of a view's probabilities on rows it was not fitted on."""
    return fit_logistic(logit(p)[:, None] / 10, y, ridge=0.01)


class View:
    def __init__(self, x, y, cal_x, cal_y):
        self.mean, self.scale = x.mean(0), x.std(0) + 0.05
        self.w = fit_logistic((x - self.mean) / self.scale, y, ridge=2.0)
        self.cal = _platt(self.raw(cal_x), cal_y) if len(set(cal_y.tolist())) > 1 else np.array([10.0, 0.0])

    def raw(self, x):
        return predict_logistic(self.w, (x - self.mean) / self.scale)

    def predict(self, x):
        return predict_logistic(self.cal, logit(self.raw(x))[:, None] / 10)


def exchange(views: list[np.ndarray], y: np.ndarray, cal: list[np.ndarray], cal_y: np.ndarray,
             pick, rounds: int = ROUNDS) -> tuple[list[View], int]:
    """The two fitted views and the number of pseudo-labels exchanged.

    ``pick(fitted)`` gives for each view the rows that the other one is most certain
    of, and their labels; rows that a view was given before are not given again.
    """
    own = [(v, y) for v in views]
    fitted, given = [View(*o, c, cal_y) for o, c in zip(own, cal)], 0
    for _ in range(rounds):
        new = pick(fitted)
        if not any(len(label) for _, label in new):
            break
        for k, (x, label) in enumerate(new):
            given += len(label)
            own[k] = (np.vstack([own[k][0], x]), np.concatenate([own[k][1], label]))
        fitted = [View(*o, c, cal_y) for o, c in zip(own, cal)]
    return fitted, given


def most_certain(p: list[np.ndarray], open_: list[np.ndarray], certain: float, per_round: int):
    """For each view k: (rows, labels, certainty), the ``per_round`` open rows of each
    class that view 1 - k is most certain of."""
    out = []
    for k in (0, 1):
        sides = (p[1 - k], 1 - p[1 - k])
        left = [np.nonzero(open_[k] & (s >= certain))[0] for s in sides]
        best = [i[np.argsort(-s[i], kind="stable")[:per_round]] for i, s in zip(left, sides)]
        out.append((np.concatenate(best), np.repeat([1, 0], list(map(len, best))),
                    np.concatenate([s[i] for i, s in zip(best, sides)])))
    return out


def co_train(views: list[np.ndarray], y: np.ndarray, cal: list[np.ndarray], cal_y: np.ndarray,
             pool: list[np.ndarray], rounds: int = ROUNDS, certain: float = CERTAIN,
             per_round: int = PER_ROUND) -> tuple[list[View], int]:
    """:func:`exchange` over a pool in memory."""
    open_ = [np.ones(len(pool[0]), bool) for _ in views]  # pool rows that view k has no label for

    def pick(fitted):
        new = most_certain([f.predict(u) for f, u in zip(fitted, pool)], open_, certain, per_round)
        for k, (i, _, _) in enumerate(new):
            open_[k][i] = False
        return [(pool[k][i], label) for k, (i, label, _) in enumerate(new)]

    return exchange(views, y, cal, cal_y, pick, rounds)


class PoolPicker:
    """The most certain rows of a pool (i, a, b) of any size, a row an id."""

    def __init__(self, pool: DataFrame, certain: float = CERTAIN, per_round: int = PER_ROUND):
        self.pool, self.certain, self.per_round = pool, certain, per_round
        self.taken: list[set] = [set(), set()]  # ids by view: per_round a class and round

    def __call__(self, fitted):
        certain, per_round = self.certain, self.per_round
        shared = self.pool.sparkSession.sparkContext.broadcast((fitted, self.taken))

        def run(batches):
            views, taken = shared.value
            held: dict[tuple[int, int], dict] = {(k, c): {} for k in (0, 1) for c in (0, 1)}
            for batch in batches:
                for lo in range(0, batch.num_rows, 4096):
                    t = batch.slice(lo, 4096)
                    ids = t.column(0).to_pylist()
                    x = [_matrix(t.column(1), TEXT_DIM), _matrix(t.column(2), META_DIM)]
                    open_ = [np.array([i not in own for i in ids], bool) for own in taken]
                    found = most_certain([f.predict(v) for f, v in zip(views, x)], open_, certain, len(ids))
                    for k, picks in enumerate(found):
                        for r, c, s in zip(*(v.tolist() for v in picks)):
                            best = held[k, c]
                            if s > best.get(ids[r], (-1.0,))[0]:
                                best[ids[r]] = (s, t.column(1)[r].as_py(), t.column(2)[r].as_py())
                    for key, best in held.items():
                        if len(best) > per_round:
                            top = sorted(best, key=lambda i: (-best[i][0], i))[:per_round]
                            held[key] = {i: best[i] for i in top}
            rows = [(k, c, s, i, a, b) for (k, c), best in held.items() for i, (s, a, b) in best.items()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.string(),
                                                                 pa.binary(), pa.binary()))],
                    names=["k", "c", "s", "i", "a", "b"])

        # at most 4 * per_round rows a partition
        certain_rows = spill(self.pool.select("i", "a", "b").mapInArrow(
            run, "k long, c long, s double, i string, a binary, b binary"), "certain")
        best = certain_rows.groupBy("k", "c", "i").agg(F.max(F.struct("s", "a", "b")).alias("x"))
        parts = [best.where((F.col("k") == k) & (F.col("c") == c)).orderBy(F.col("x.s").desc(), "i").limit(per_round)
                 for k in (0, 1) for c in (1, 0)]
        got = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]) \
            .select("k", "c", "x.s", "i", "x.a", "x.b").toArrow()
        got = got.sort_by([("k", "ascending"), ("c", "descending"), ("s", "descending"), ("i", "ascending")])
        k, c = (got.column(n).to_numpy() for n in ("k", "c"))
        out = []
        for view, (name, dim) in enumerate((("a", TEXT_DIM), ("b", META_DIM))):
            mine = got.filter(pa.array(k == view))
            self.taken[view] |= set(mine.column("i").to_pylist())
            out.append((_matrix(mine.column(name), dim), c[k == view]))
        return out


def combine(prior: float, p: list[np.ndarray]) -> np.ndarray:
    base = logit(np.array(prior))
    return sigmoid(base + sum(logit(v) - base for v in p))


def _features(docs: DataFrame, extra: list, cols: tuple) -> DataFrame:
    """``extra`` columns and both views' features as binary float32."""
    doc_id, text, lang, source, n_chars = cols
    picked = docs.select(*extra, clean_text(text).alias("__t"), F.col(lang).cast("string").alias("__l"),
                         F.col(source).cast("string").alias("__s"), F.col(n_chars).cast("long").alias("__n"))
    names = [f.name for f in picked.schema[:len(extra)]]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema[:len(extra)]]
                       + ["a binary", "b binary"])

    def run(batches):
        for b in batches:
            t, la, so, n = (b.column(len(names) + k).to_pylist() for k in range(4))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(names)], pa.array([text_features(x).tobytes() for x in t], pa.binary()),
                 pa.array([meta_features(*x).tobytes() for x in zip(la, so, n)], pa.binary())],
                names=[*names, "a", "b"])

    return picked.mapInArrow(run, schema)


def _matrix(column, dim: int) -> np.ndarray:
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, np.float32).reshape(-1, dim).astype(float)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
          doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          source: str = "source", n_chars: str = "n_chars", label: str = "quality",
          certain: float = CERTAIN, per_round: int = PER_ROUND, rounds: int = ROUNDS) -> dict:
    """Fit the views on labelled rows outside the held-out fold.

    At most ``max_labelled`` labelled ids are used, those with the smallest hashes, and
    of an id that is repeated one row (that with the smallest hash).  Fold 4 of crc32(id)
    mod 5 calibrates and folds 1 to 3 train; fold 0 is never read.  All other rows with an id
    are the pool; ids with both labels are among them.  The driver gets the labelled rows and
    at most 4 * ``rounds`` * ``per_round`` rows of the pool.  With one class only, that
    class is the score.
    """
    cols = (doc_id, text, lang, source, n_chars)
    ids = (labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
           .groupBy(F.col(doc_id).cast("string").alias("i")).agg(F.min(label).alias("y"), F.max(label).alias("hi"))
           .where("y = hi").select("i", F.col("y").cast("int")))
    picked = docs.select(F.col(doc_id).alias("__id"), *(F.col(c).alias(f"__{k}") for k, c in enumerate(cols[1:])))
    inside = picked.where(F.col("__id").isNotNull() & (fold("__id", 5) != 0))
    rows = spill(_features(inside, [F.col("__id").cast("string").alias("i"), fold("__id", 5).cast("int").alias("f"),
                                    F.xxhash64("__0", "__1", "__2", "__3").alias("h")],
                           ("__id", "__0", "__1", "__2", "__3")).join(ids, "i", "left"), "features")
    order = (F.xxhash64("i"), F.col("i"))
    chosen = ids.where(fold("i", 5) != 0).orderBy(*order).limit(max_labelled).select("i")
    known = (rows.where("y is not null").join(F.broadcast(chosen), "i")  # max_labelled rows at most
             .groupBy("i").agg(F.min(F.struct("h", "f", "y", "a", "b")).alias("x"))
             .select("i", "x.f", "x.y", "x.a", "x.b").toArrow().sort_by("i"))
    y, f = known.column("y").to_numpy(), known.column("f").to_numpy()
    x = [_matrix(known.column("a"), TEXT_DIM), _matrix(known.column("b"), META_DIM)]
    fit, cal = f != 4, f == 4
    prior = float(y.mean()) if len(y) else 1.0
    if len(set(y[fit].tolist())) < 2:
        return {"prior": prior, "views": None, "given": 0}
    views, given = exchange([v[fit] for v in x], y[fit], [v[cal] for v in x], y[cal],
                            PoolPicker(rows.where("y is null"), certain, per_round), rounds)
    return {"prior": prior, "views": views, "given": given}


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang", source: str = "source", n_chars: str = "n_chars",
          keep_columns: bool = False) -> DataFrame:
    """doc_id, held_out, text_score, meta_score, score, predicted of every row.

    Null text counts as empty, null metadata as a value of its own; repeated
    rows stay rows; an empty table gives an empty table.  ``score`` is the
    probability of quality 1 and ``predicted`` whether it reaches 0.5.  With
    ``keep_columns`` the input's own columns come back with one more, the score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    views = (text, lang, source, n_chars)
    if keep_columns:
        own, more = len(docs.columns), ["score double"]
        picked = docs.toDF(*[f"c{k}" for k in range(own)])  # Python stages take plain names only
        at = [docs.columns.index(c) for c in views]
    else:
        picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                             (F.col(doc_id).isNotNull() & (fold(doc_id, 5) == 0)).alias("held_out"),
                             *(F.col(c).alias(f"__{k}") for k, c in enumerate(views)))
        own, more, at = 2, ["text_score double", "meta_score double", "score double", "predicted int"], [2, 3, 4, 5]
    kept = picked.schema[:own]
    names = [f.name for f in kept] + [x.split()[0] for x in more]

    def run(batches):
        m = shared.value
        for b in batches:
            t, la, so, n = (b.column(k).to_pylist() for k in at)
            if m["views"] is None or not t:
                p = [np.full(len(t), m["prior"])] * 2
                s = np.full(len(t), m["prior"])
            else:
                x = (np.array([text_features(v) for v in t], float),
                     np.array([meta_features(*v) for v in zip(la, so, n)], float))
                p = [f.predict(v) for f, v in zip(m["views"], x)]
                s = combine(m["prior"], p)
            got = [s] if keep_columns else [*p, s, (s >= 0.5).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*b.columns[:own], *map(pa.array, got)], names=names)

    scored = picked.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + more))
    return scored.toDF(*docs.columns, *free_names(docs, "__score")) if keep_columns else scored


def quality(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """Train on ``labels`` and score all ``docs``."""
    return score(docs, train(docs, labels, **kw))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **kw) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, all columns kept."""
    scored = score(docs, train(docs, labels, **kw), keep_columns=True)
    mark = scored.columns[-1]
    return scored.where(column(scored, mark) >= threshold).drop(mark)
