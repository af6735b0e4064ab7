"""Language-model scoring with a log-bilinear neural model.

The model predicts a token's symbol from the two symbols before it: context
vectors, each scaled by a position vector, add up to a predicted vector whose
product with the symbol's own vector, plus a bias, is its score.  Symbols are
the ``vocabulary`` most frequent training tokens (with the end of a text) and
classes of all other tokens by spelling; a token of a class has the class's
probability times its smoothed share in the class.  The vocabulary grows with the
training tokens (``vocabulary_of``).

Training is noise-contrastive estimation in numpy, in two rounds: one over a fold
of the training documents for a common start, one over all of them.  In a round
every task passes over its own documents from the same start; the parameters,
weighted by tokens, are averaged in a tree of groups of 32.  Every training token
is used, and the counts cover all documents.

Scoring is normalised exactly: batched matrix products give the log-normaliser of
each pair of context symbols that occurs, summed over all symbols.  A worker remembers
them in a table of fixed size, where a pair may take another's place and is then
computed again; all other work of a token is one product of two short vectors.

Token counts live in a table, not on the driver.  The ``head`` tokens that occur
often (``HEAD`` of them at most, by a threshold on the count) are broadcast;
the others are joined with their counts, a row an occurrence.  No joined
token can be hot, as it occurs less often than the threshold.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import clean_text, fold, spill

#: Symbols of their own: at least LEAST, and GROWTH times the cube root of the training tokens.
LEAST = 1000
GROWTH = 2.5
CLASSES = 32
DIM = 24
HEAD = 200_000
NOISE = 64
BATCH = 1024
RATE = 0.15
GROUP = 32
SEED = 17
#: Places of a worker's table of log-normalisers, as a power of two (12 bytes each).
SLOT_BITS = 21
END = b""  # no word is empty
LOG10 = float(np.log(10))

_NORMALISERS: dict = {}


def vocabulary_of(n_train: int) -> int:
    """How many tokens have a symbol of their own, the end included."""
    return max(LEAST, int(round(GROWTH * n_train ** (1 / 3))))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def spelling_class(word: bytes) -> int:
    """Class of a word without a symbol of its own: whether it ends in
    punctuation, and a hash of its first two bytes."""
    return (word[-1] in b".,;:!?") * (CLASSES // 2) + zlib.crc32(word[:2]) % (CLASSES // 2)


# --- counts ---------------------------------------------------------------

def token_counts(docs: DataFrame) -> DataFrame:
    """(word, n_all, n_train) over docs (t, train); the end is the empty word."""

    def run(batches):
        both = Counter(), Counter()

        def out():
            words = list(dict.fromkeys(chain(*both)))
            held, train = ([c[w] for w in words] for c in both)
            for c in both:
                c.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array([a + b for a, b in zip(held, train)], pa.int64()),
                 pa.array(train, pa.int64())], names=["word", "n_all", "n_train"])

        for b in batches:
            for t, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                c = both[1 if own else 0]
                c.update(words_of(t))
                c[END] += 1
                if len(c) > 500_000:
                    yield out()
        yield out()

    return (docs.select("t", "train").mapInArrow(run, "word binary, n_all long, n_train long")
            .groupBy("word").agg(F.sum("n_all").alias("n_all"), F.sum("n_train").alias("n_train")))


def class_totals(rest: DataFrame) -> np.ndarray:
    """(tokens, kinds) of each spelling class over (word, n_train)."""

    def run(batches):
        held = np.zeros((2, CLASSES), np.int64)
        for b in batches:
            k = [spelling_class(w) for w in b.column(0).to_pylist()]
            n = b.column(1).to_numpy()
            held[0] += np.bincount(k, n, CLASSES).astype(np.int64) if k else 0
            held[1] += np.bincount(k, n > 0, CLASSES).astype(np.int64) if k else 0
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), *map(pa.array, held)],
                                         names=["k", "n", "v"])

    rows = (rest.select("word", "n_train").mapInArrow(run, "k long, n long, v long")
            .groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect())
    out = np.zeros((CLASSES, 2))
    for r in rows:
        out[r["k"]] = r["n"], r["v"]
    return out


# --- model ----------------------------------------------------------------

class Model:
    """Parameters: context and symbol vectors, position vectors, biases."""

    def __init__(self, n: int, noise: np.ndarray, dim: int = DIM, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.context = rng.normal(0, 0.1, (n + 1, dim)).astype(np.float32)  # the last: before the text
        self.symbol = rng.normal(0, 0.1, (n, dim)).astype(np.float32)
        self.place = np.stack([np.ones(dim), np.full(dim, 0.5)]).astype(np.float32)
        self.bias = np.log(noise).astype(np.float32)
        self.noise = noise

    NAMES = ("context", "symbol", "place", "bias")

    def pack(self) -> np.ndarray:
        return np.concatenate([getattr(self, x).ravel() for x in self.NAMES])

    def unpack(self, flat: np.ndarray) -> "Model":
        at = 0
        for x in self.NAMES:
            old = getattr(self, x)
            setattr(self, x, flat[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self

    def predicted(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.context[a] * self.place[0] + self.context[b] * self.place[1]


class Normalisers:
    """Logs of the sums over all symbols after context pairs, remembered by pair."""

    def __init__(self, model: Model, slot_bits: int = SLOT_BITS):
        self.m, self.shift = model, np.uint64(64 - slot_bits)
        self.pair = np.full(1 << slot_bits, -1, np.int64)
        self.z = np.zeros(1 << slot_bits, np.float32)

    def _slots(self, pair: np.ndarray) -> np.ndarray:
        return ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def compute(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(a), np.float32)
        some = max(1, (1 << 20) // len(self.m.bias))  # scores at a time
        for k in range(0, len(a), some):
            s = self.m.predicted(a[k:k + some], b[k:k + some]) @ self.m.symbol.T
            s += self.m.bias
            top = s.max(axis=1)
            s -= top[:, None]
            np.exp(s, out=s)
            out[k:k + some] = top + np.log(s.sum(axis=1))
        return out

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = len(self.m.context)
        pair = a.astype(np.int64) * n + b
        slot = self._slots(pair)
        out = self.z[slot]
        miss = np.nonzero(self.pair[slot] != pair)[0]
        if len(miss):
            new, at = np.unique(pair[miss], return_inverse=True)
            z = self.compute(new // n, new % n)
            out[miss] = z[at]
            slot, first = np.unique(self._slots(new), return_index=True)  # one pair a place
            self.pair[slot], self.z[slot] = new[first], z[first]
        return out


def _scatter(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of each index: (indices, sums)."""
    order = np.argsort(index.astype(np.int16 if index.max() < 1 << 15 else np.int32), kind="stable")
    index = index[order]
    first = np.nonzero(np.diff(index, prepend=-1))[0]
    return index[first], np.add.reduceat(rows[order], first, axis=0)


class Trainer:
    """AdaGrad steps of noise-contrastive estimation on (a, b, w) triples."""

    def __init__(self, model: Model, rng, rate: float = RATE):
        self.m, self.rng, self.rate = model, rng, rate
        self.past = {x: np.full_like(getattr(model, x), 0.1) for x in Model.NAMES}
        self.cum = np.cumsum(model.noise)
        self.shift = np.log(NOISE * model.noise).astype(np.float32)

    def _step(self, name: str, at, grad) -> None:
        past, value = self.past[name], getattr(self.m, name)
        past[at] += grad * grad
        value[at] -= self.rate * grad / np.sqrt(past[at])

    def batch(self, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> None:
        m = self.m
        neg = np.minimum(np.searchsorted(self.cum, self.rng.random(NOISE) * self.cum[-1]), len(m.bias) - 1)
        ca, cb, q, qn = m.context[a], m.context[b], m.symbol[w], m.symbol[neg]
        r = ca * m.place[0]
        r += cb * m.place[1]
        pos = np.einsum("ij,ij->i", r, q) + (m.bias - self.shift)[w]
        gp = -1 / (1 + np.exp(np.clip(pos, -30, 30)))
        s = r @ qn.T
        s += (m.bias - self.shift)[neg]
        np.clip(s, -30, 30, out=s)
        np.negative(s, out=s)
        np.exp(s, out=s)
        s += 1
        gn = np.reciprocal(s, out=s)
        dr = gn @ qn
        dr += gp[:, None] * q
        # the gradients are sums over the batch
        n, d = len(w), r.shape[1]
        rows = np.empty((n + NOISE, d + 1), np.float32)
        np.multiply(r, gp[:, None], out=rows[:n, :d])
        rows[:n, d] = gp
        rows[n:, :d] = gn.T @ r
        rows[n:, d] = gn.sum(0)
        i, g = _scatter(np.concatenate([w, neg]), rows)
        dplace = np.stack([np.einsum("ij,ij->j", dr, ca), np.einsum("ij,ij->j", dr, cb)])
        rows = np.empty((2 * n, d), np.float32)
        np.multiply(dr, m.place[0], out=rows[:n])
        np.multiply(dr, m.place[1], out=rows[n:])
        j, h = _scatter(np.concatenate([a, b]), rows)
        self._step("symbol", i, g[:, :-1])
        self._step("bias", i, g[:, -1])
        self._step("context", j, h)
        self._step("place", slice(None), dplace)


def triples(ids: np.ndarray, lengths: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols one and two places before each symbol of texts laid end to end."""
    first = np.cumsum(lengths) - lengths
    a, b = np.empty_like(ids), np.empty_like(ids)
    a[1:], b[2:] = ids[:-1], ids[:-2]
    a[first], b[first] = before, before
    second = first[lengths > 1] + 1
    b[second] = before
    return a, b


class Head:
    """The broadcast tokens: place by word, symbol, and both log10 shares."""

    def __init__(self, words, symbol, base, within, known):
        self.place = {w: k for k, w in enumerate(words)}
        self.symbol, self.base, self.within, self.known = symbol, base, within, known

    def read(self, texts: list):
        """(places with -1 for other tokens, words, lengths) of texts with ends."""
        rows = [words_of(t) for t in texts]
        for r in rows:
            r.append(END)
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        words = [w for r in rows for w in r]
        return np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words)), words, lengths

    def symbols(self, place: np.ndarray, words: list, n_own: int) -> np.ndarray:
        out = self.symbol[place]
        other = np.nonzero(place < 0)[0]
        out[other] = [n_own + spelling_class(words[k]) for k in other.tolist()]
        return out


# --- Spark ----------------------------------------------------------------

def train(docs: DataFrame, start: Model, shared, n_own: int, round_: int) -> np.ndarray:
    """Parameters averaged over all partitions of ``docs`` (t), by tokens."""
    spark = docs.sparkSession
    flat = spark.sparkContext.broadcast((start.pack(), start.noise, start.context.shape[1]))

    def run(batches):
        part = TaskContext.get().partitionId()
        head = shared.value
        values, noise, dim = flat.value
        model = Model(len(noise), noise, dim).unpack(values.copy())
        fit, seen = Trainer(model, np.random.default_rng([SEED, round_, part])), 0
        for batch in batches:
            t = batch.column(0).to_pylist()
            for lo in range(0, len(t), 512):
                place, words, lengths = head.read(t[lo:lo + 512])
                w = head.symbols(place, words, n_own)
                a, b = triples(w, lengths, len(noise))
                for k in range(0, len(w), BATCH):
                    fit.batch(a[k:k + BATCH], b[k:k + BATCH], w[k:k + BATCH])
                seen += len(w)
        if seen:
            yield _row(part, seen, model.pack().astype(np.float64) * seen)

    parts = spill(docs.select("t").mapInArrow(run, "part long, n double, p binary"), "models")
    n = parts.count()
    while n > GROUP:  # each group adds up GROUP rows at most
        def add(key, table):
            p = sum(np.frombuffer(x, np.float64) for x in table.column("p").to_pylist())
            return pa.Table.from_batches([_row(key[0].as_py(), sum(table.column("n").to_pylist()), p)])

        parts = spill(parts.groupBy(F.floor(F.col("part") / GROUP).alias("g"))
                      .applyInArrow(add, "part long, n double, p binary"), "models")
        n = parts.count()
    rows = sorted(parts.collect())
    if not rows:
        return start.pack()
    return sum(np.frombuffer(r["p"], np.float64) for r in rows) / sum(r["n"] for r in rows)


def _row(part, n, p):
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([float(n)]), pa.array([p.tobytes()], pa.binary())],
        names=["part", "n", "p"])


class Fitted(NamedTuple):
    """What the training documents gave: counts of all tokens (word, n_all, n_train), which
    of them are broadcast (``frequent``, ``head``), totals, tokens and kinds of each class, the model."""

    counts: DataFrame
    frequent: Column
    head: Broadcast  # of a Head
    n_train: int
    kinds: int
    classes: np.ndarray
    n_own: int
    model: Model


def lm_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", modulus: int = 7,
              held: int = 2, vocabulary: int | None = None, head_size: int = HEAD) -> DataFrame:
    """Score all documents by a model of those whose crc32(id) mod ``modulus``
    is not ``held``.

    One row per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.  Tokens are the words, ASCII lower-cased,
    and one end.  ``base_score`` is the add-one unigram log10 probability,
    ``score`` the model's.  Null texts count as empty; a null id is not held out;
    repeated rows are documents of their own; other columns are ignored.  An
    empty table gives an empty table; without training documents every token
    is new to the model.  ``vocabulary`` sets the number of symbols by hand.
    """
    is_held = F.col(doc_id).isNotNull() & (fold(doc_id, modulus) == held)
    base_docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), is_held.alias("held_out"),
                            clean_text(text).alias("t"))
    return score(base_docs, fit(base_docs, modulus, held, vocabulary, head_size))


def fit(base_docs: DataFrame, modulus: int = 7, held: int = 2, vocabulary: int | None = None,
        head_size: int = HEAD) -> Fitted:
    """Counts and model over (doc_id, held_out, t) rows."""
    spark = base_docs.sparkSession
    counts = spill(token_counts(base_docs.select("t", (~F.col("held_out")).alias("train"))), "counts")
    total = counts.agg(F.coalesce(F.sum("n_train"), F.lit(0)).alias("n"),
                       F.count(F.when(F.col("n_train") > 0, 1)).alias("v")).first()
    n_train, kinds = total["n"], total["v"]

    # the lowest power of two that at most head_size tokens reach
    levels = sorted(((r["l"], r["c"]) for r in counts.groupBy(
        F.floor(F.log2("n_all")).cast("int").alias("l")).agg(F.count("*").alias("c")).collect()), reverse=True)
    least, reached = None, 0
    for level, c in levels:
        if reached + c > head_size:
            break
        least, reached = 1 << level, reached + c
    frequent = F.col("n_all") >= F.lit(least if least is not None else 1 << 62)
    # head_size rows at most, and the end
    head = sorted((-r["n_train"], bytes(r["word"])) for r in counts.where(frequent | (F.col("word") == F.lit(END)))
                  .select("word", "n_train").collect())
    own = [w for n, w in head if n < 0 and w != END][:(vocabulary or vocabulary_of(n_train)) - 1] + [END]
    n_own, own_id = len(own), {w: k for k, w in enumerate(own)}
    own_table = spark.createDataFrame([(bytearray(w),) for w in own], "word binary")
    classes = class_totals(counts.join(F.broadcast(own_table), "word", "left_anti"))

    words = [w for _, w in head] or [END]
    n_of = np.array([-n for n, _ in head] or [0], float)
    symbol = np.array([own_id.get(w, -1) for w in words])
    other = np.nonzero(symbol < 0)[0]
    k_of = np.array([spelling_class(words[i]) for i in other], np.int64)
    symbol[other] = n_own + k_of
    within = np.zeros(len(words))
    within[other] = np.log10((n_of[other] + 1) / (classes.sum(1)[k_of] + 1))
    shared = spark.sparkContext.broadcast(
        Head(words, symbol, np.log10((n_of + 1) / (n_train + kinds + 1)), within, n_of > 0))

    own_n = np.zeros(n_own)
    for n, w in head:
        if w in own_id:
            own_n[own_id[w]] = -n
    noise = np.concatenate([own_n, classes[:, 0]]) + 1.0
    model = Model(len(noise), noise / noise.sum())
    learn = base_docs.where("not held_out")
    # a short round over one fold for a common start, then one over everything
    model.unpack(train(learn.where(fold("doc_id", modulus) == (held + 1) % modulus).select("t"),
                       model, shared, n_own, 0))
    model.unpack(train(learn.select("t"), model, shared, n_own, 1))
    return Fitted(counts, frequent, shared, n_train, kinds, classes, n_own, model)


def score(base_docs: DataFrame, fitted: Fitted) -> DataFrame:
    """The scores of (doc_id, held_out, t) rows under what was fitted."""
    spark = base_docs.sparkSession
    counts, frequent, shared, n_train, kinds, classes, n_own, model = fitted
    shared_model, name = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    schema = ("doc_id long, held_out boolean, row long, n_tokens long, n_known long, base double, "
              "score double, tail array<struct<word: binary, k: int>>")

    def run(batches):
        head, m = shared.value, shared_model.value
        if name not in _NORMALISERS:
            _NORMALISERS.clear()
            _NORMALISERS[name] = Normalisers(m)
        normalisers = _NORMALISERS[name]
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                b = batch.slice(lo, 512)
                place, words, lengths = head.read(b.column(3).to_pylist())
                w = head.symbols(place, words, n_own)
                a, c = triples(w, lengths, len(m.bias))
                lp = np.empty(len(w))
                for k in range(0, len(w), 1 << 14):
                    s = slice(k, k + (1 << 14))
                    lp[s] = (np.einsum("ij,ij->i", m.predicted(a[s], c[s]), m.symbol[w[s]]) + m.bias[w[s]]
                             - normalisers.find(a[s], c[s]))
                first = np.cumsum(lengths) - lengths
                seen = place >= 0
                add = lambda v: np.add.reduceat(v, first)  # noqa: E731  every text has a token
                at = np.nonzero(~seen)[0]
                ends = np.searchsorted(at, np.append(first, len(w)))
                tails = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array([words[k] for k in at.tolist()], pa.binary()),
                     pa.array(w[at] - n_own, pa.int32())], names=["word", "k"]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2), pa.array(lengths),
                     pa.array(add((seen & head.known[place]).astype(np.int64))),
                     pa.array(add(np.where(seen, head.base[place], 0.0))),
                     pa.array(add(lp / LOG10 + np.where(seen, head.within[place], 0.0))),
                     tails], names=[x.split()[0] for x in schema.split(", ")[:7]] + ["tail"])

    scored = spill(base_docs.select("doc_id", "held_out", F.monotonically_increasing_id().alias("row"), "t")
                   .mapInArrow(run, schema), "scored")
    share = F.element_at(F.array(*[F.lit(float(n + v + 1)) for n, v in classes]), F.col("k") + 1)
    c = F.coalesce(F.col("n_train"), F.lit(0))
    rest = (scored.select("row", F.explode("tail").alias("x")).select("row", "x.word", "x.k")
            .join(counts.where(~frequent).select("word", "n_train"), "word", "left")
            .groupBy("row").agg(
                F.count_if(c > 0).alias("known"),
                F.sum(F.log10((c + 1) / F.lit(float(n_train + kinds + 1)))).alias("b"),
                F.sum(F.log10((c + 1) / share)).alias("s")))
    none = F.lit(0.0)
    return (scored.drop("tail").join(rest, "row", "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
                    F.lit(n_train).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("b", none)).alias("base_score"),
                    (F.col("score") + F.coalesce("s", none)).alias("score")))
