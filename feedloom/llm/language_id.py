"""Language identification by words first, character n-grams after.

A text is its runs of letters (with combining marks), lower-cased.  A known word
adds its log frequency in each language.  An unseen word is read by character
n-grams, its ends marked: from every place in it the longest known n-gram (``ORDER``
characters, then one fewer, down to one) adds its log frequency, divided by its
length, so that each character counts about once.  The language with the largest
sum is predicted; ``score`` is its share of the likelihoods.

Counts cover every training document.  A word is known where it makes up ``SHARE``
of some language's words or more, an n-gram where it makes up ``SHARE`` of the
n-grams of its order in some language's list of distinct words.  So there are at
most 1 / SHARE known words, and n-grams an order, for each language at any size of the
corpus, which bounds what is collected and broadcast.  In a small corpus every word
seen is known.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean_text, fold, spill
from .numeric import GramTable

ORDER = 5
SHARE = 1e-5
#: Added to each count of a known word or n-gram.
SMOOTHING = 0.5
UNDETERMINED = "und"
#: Words of which a Python worker remembers the log frequencies, or n-grams at a time.
MAX_WORDS = 300_000
WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*+")

_SCORERS: dict = {}


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode(), 42)


def grams(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, word, place) of every n-gram of one order; a word's ends are spaces."""
    flat = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    n = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(n)
    word = np.repeat(np.arange(len(words)), n)
    at = np.arange(len(flat))
    at = at[(at + order <= ends[word]) & ((order > 1) | (flat != 32))]  # an end alone is no n-gram
    h = np.full(len(at), order, np.uint64)
    for k in range(order):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + flat[at + k]
    return (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB), word[at], at


# --- counts ---------------------------------------------------------------

def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over docs (lang, t)."""

    def run(batches):
        held: dict[str, Counter] = {}

        def out():
            rows = [(a, w, n) for a, c in held.items() for w, n in c.items()]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.int64())], names=["lang", "word", "n"])

        for b in batches:
            for a, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(a, Counter()).update(words_of(t))
                if sum(map(len, held.values())) > 500_000:
                    yield out()
        yield out()

    return (docs.select("lang", "t").mapInArrow(run, "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def gram_counts(counts: DataFrame, languages: list[str]) -> DataFrame:
    """(g, l, o, n): in how many places of language l's distinct words gram g of order o is."""
    place = {a: k for k, a in enumerate(languages)}

    def run(batches):
        held: list[tuple[int, str]] = []

        def out():
            lang = np.array([k for k, _ in held], np.int64)
            words = [w for _, w in held]
            held.clear()
            for o in range(1, ORDER + 1):
                h, word, _ = grams(words, o)
                for k in np.unique(lang):
                    g, n = np.unique(h[lang[word] == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g.view(np.int64)), pa.array(np.full(len(g), k)),
                         pa.array(np.full(len(g), o)), pa.array(n.astype(np.int64))],
                        names=["g", "l", "o", "n"])

        size = 0
        for b in batches:
            for a, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.append((place[a], w))
                size += len(w) + 2
                if size > 2_000_000:
                    yield from out()
                    size = 0
        if held:
            yield from out()

    return (counts.select("lang", "word").mapInArrow(run, "g long, l long, o long, n long")
            .groupBy("g", "l", "o").agg(F.sum("n").alias("n")))


def _known(table: DataFrame, key: str, total: dict, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, orders, counts by language) of the rows (key, l, o, n) that reach ``share``
    of their (order, language) somewhere: at most languages / share keys an order."""
    least = F.lit(0.0)
    for (o, k), n in total.items():
        least = F.when((F.col("o") == o) & (F.col("l") == k), F.lit(share * n)).otherwise(least)
    found = (table.groupBy(key, "o")
             .agg(F.max(F.col("n") >= least).alias("known"),
                  F.collect_list(F.struct(F.col("l"), F.col("n"))).alias("by"))  # a row a language
             .where("known").select(F.col(key).alias("key"), "o", F.explode("by").alias("x"))
             .select("key", "o", "x.l", "x.n").toArrow())
    key, o, lang, n = (found.column(c).to_numpy() for c in ("key", "o", "l", "n"))
    keys, first, at = np.unique(key, return_index=True, return_inverse=True)
    counts = np.zeros((len(keys), 1 + max((k for _, k in total), default=0)))
    counts[at, lang] = n
    return keys.view(np.uint64), o[first], counts


def _log_frequencies(orders: np.ndarray, counts: np.ndarray, total: dict) -> np.ndarray:
    """log frequencies by language, a last row of zeros standing for no evidence."""
    out = np.zeros((len(orders) + 1, counts.shape[1]))
    for o in np.unique(orders):
        at = np.nonzero(orders == o)[0]
        n = np.array([total.get((int(o), k), 0) for k in range(counts.shape[1])])
        out[at] = np.log((counts[at] + SMOOTHING) / (n + SMOOTHING * len(at)))
    return out


# --- model ----------------------------------------------------------------

class Model:
    """Known words and n-grams with their log frequencies by language."""

    def __init__(self, languages, words, grams):
        """``words`` and ``grams``: (keys, orders, counts, totals by (order, language))."""
        self.languages = languages
        self.words = GramTable(words[0])
        self.word_logs = _log_frequencies(*words[1:]).astype(np.float32)
        self.grams = GramTable(grams[0])
        logs = _log_frequencies(*grams[1:])
        logs[:-1] /= np.maximum(grams[1], 1)[:, None]
        self.gram_logs = logs.astype(np.float32)

    def evidence(self, words: list[str]) -> np.ndarray:
        """Log frequencies of distinct words, by language."""
        at = self.words.find(np.fromiter(map(word_hash, words), np.uint64, len(words)))
        out = self.word_logs[at].astype(float)
        unseen = np.nonzero(at < 0)[0]
        if not len(unseen):
            return out
        some = [words[k] for k in unseen.tolist()]
        best = np.full(sum(map(len, some)) + 2 * len(some), -1, np.int64)
        for o in range(ORDER, 0, -1):
            h, _, place = grams(some, o)
            left = best[place] < 0
            best[place[left]] = self.grams.find(h[left])
        word = np.repeat(unseen, np.fromiter(map(len, some), np.int64, len(some)) + 2)
        for k in range(out.shape[1]):
            out[:, k] += np.bincount(word, self.gram_logs[best, k], len(words))
        return out


class Scorer:
    """Sums of evidence of texts under a model, remembering words."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self):
        self.place: dict[str, int] = {}
        self.logs = np.zeros((0, len(self.model.languages)), np.float32)

    def sums(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(evidence by text and language, whether a text has a letter)."""
        if len(self.place) > MAX_WORDS:
            self._forget()
        rows = [words_of(t) for t in texts]
        new = [w for w in dict.fromkeys(w for r in rows for w in r) if w not in self.place]
        for k in range(0, len(new), 50_000):
            some = new[k:k + 50_000]
            self.place.update(zip(some, range(len(self.logs), len(self.logs) + len(some))))
            self.logs = np.concatenate([self.logs, self.model.evidence(some).astype(np.float32)])
        n = np.fromiter(map(len, rows), np.int64, len(rows))
        doc = np.repeat(np.arange(len(rows)), n)
        at = np.fromiter((p for r in rows for p in map(self.place.__getitem__, r)), np.int64, len(doc))
        return np.stack([np.bincount(doc, self.logs[at, k], len(rows))
                         for k in range(self.logs.shape[1])], axis=1), n > 0


def train(docs: DataFrame, text: str = "text", lang: str = "lang", share: float = SHARE) -> Model | None:
    """The model of all rows of ``docs`` with a language; none without a word."""
    own = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"),
                                                     clean_text(text).alias("t"))
    counts = spill(word_counts(own), "words")
    total = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(total)  # a row a language
    if not languages:
        return None
    ids = F.lit(0).cast("long")
    for k, a in enumerate(languages):
        ids = F.when(F.col("lang") == a, F.lit(k).cast("long")).otherwise(ids)
    word_total = {(0, k): total[a] for k, a in enumerate(languages)}
    words = _known(counts.select(F.xxhash64("word").alias("g"), ids.alias("l"),
                                 F.lit(0).cast("long").alias("o"), "n"), "g", word_total, share)
    table = spill(gram_counts(counts, languages), "grams")
    gram_total = {(r["o"], r["l"]): r["n"] for r in table.groupBy("o", "l").agg(F.sum("n").alias("n")).collect()}
    return Model(languages, (*words, word_total), (*_known(table, "g", gram_total, share), gram_total))


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text",
            modulus: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row's whole text.

    A null text, or one without a letter, is ``und`` with score 0, as is every text
    where nothing was learnt.  Equal sums go to the first language by code point.
    """
    spark = docs.sparkSession
    shared, name = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches):
        m = shared.value
        if m is not None and name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[name] = Scorer(m)
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                b = whole.slice(lo, 512)
                lang, score = [UNDETERMINED] * b.num_rows, np.zeros(b.num_rows)
                if m is not None:
                    s, letters = _SCORERS[name].sums(b.column(2).to_pylist())
                    best = s.argmax(1)
                    share = 1 / np.exp(s - s.max(1, keepdims=True)).sum(1)
                    lang = [m.languages[k] if a else UNDETERMINED for k, a in zip(best.tolist(), letters.tolist())]
                    score = np.where(letters, share, 0.0)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()),
                                                  pa.array(score, pa.float64())],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])

    held_out = F.col(doc_id).isNotNull() & (fold(doc_id, modulus) == held)
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"), clean_text(text))
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double"))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             modulus: int = 4, held: int = 2, share: float = SHARE) -> DataFrame:
    """Predict the language of every row from the rows outside the held-out fold.

    The fold is crc32(id) mod ``modulus`` = ``held``; a row with a null id is not held out.
    Rows without a language teach nothing.  Repeated rows stay rows; other columns
    are ignored; an empty table gives an empty table.
    """
    learn = docs.where(F.col(doc_id).isNull() | (fold(doc_id, modulus) != held))
    return predict(docs, train(learn, text, lang, share), doc_id, text, modulus, held)
