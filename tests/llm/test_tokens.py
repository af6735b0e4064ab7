"""Token files and packing: exact round trips."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import packing, token_files
from feedloom.llm.common import scratch
from feedloom.llm.tokens import Encoder, default_tokenizer

ENC = Encoder(default_tokenizer(), max_chunks=50)


def plain(text):
    return ENC.tokenizer.encode(text or "", add_special_tokens=False).ids


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t.,'!a1é\xa0\x1cß　"), st.characters(codec="utf-8")),
                        max_size=30), max_size=5))
def test_encoder_equals_the_tokenizer(texts):
    assert [ids_of(x) for x in ENC.encode(texts)] == [plain(t) for t in texts]


def test_encoder_equals_the_tokenizer_on_documents(sf):
    texts = [r["text"] for r in sf("documents").select("text").collect()] + [None, "", "<|endoftext|> a"]
    assert [ids_of(x) for x in ENC.encode(texts)] == [plain(t) for t in texts]


@pytest.mark.parametrize("nothing", [False, True])
def test_token_files_round_trip(spark, nasty, no_docs, nothing):
    docs = no_docs if nothing else nasty
    folder = scratch(spark, "test")
    total = token_files.write_token_files(docs, folder, default_tokenizer())
    got = token_files.read_token_files(spark, folder, with_ids=True).orderBy("start").collect()
    want = sorted([(r["doc_id"], plain(r["text"]) + [2]) for r in docs.collect()],
                  key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert [r["doc_id"] for r in got] == [w[0] for w in want]
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == sorted((str(i), x) for i, x in want)
    at = 0
    for r in got:
        ids = np.array(r["ids"], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids))
        at += len(ids)
    assert total == at


def placed(counts, capacity):
    segments, n = packing.plan_bins(dict(counts), capacity)
    bins, seen = defaultdict(list), Counter()
    for length, rank, m, first, offset in segments:
        for k in range(m):
            bins[first + k].append((offset, length))
            seen[length, rank + k] += 1
    assert all(v == 1 for v in seen.values())
    assert Counter(length for length, _ in seen) == Counter({k: v for k, v in counts.items() if v})
    assert sorted(bins) == list(range(n))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return n


def best_fit_decreasing(counts, capacity):
    room = []
    for size in sorted((s for s, c in counts.items() for _ in range(c)), reverse=True):
        fits = [k for k in range(len(room)) if room[k] >= size]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= size
        else:
            room.append(capacity - size)
    return len(room)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(
    st.integers(1, c), st.integers(0, 12), max_size=10))))
def test_plan_is_whole_and_as_good_as_best_fit_decreasing(case):
    capacity, counts = case
    n = placed(counts, capacity)
    assert n <= best_fit_decreasing(counts, capacity)


@pytest.mark.parametrize("capacity", [7, 1024])
def test_packing_places_every_token_once(spark, nasty, no_docs, capacity):
    rows = packing.pack_documents(nasty, default_tokenizer(), capacity, with_ids=True).collect()
    want = Counter((r["doc_id"], tuple(plain(r["text"]) + [2])) for r in nasty.collect())
    by_doc, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"]
    tokens = Counter()
    for i, v in by_doc.items():
        assert sum(r["length"] for r in v) == sum(len(x) * c for (j, x), c in want.items() if j == i)
        for r in v:
            tokens[i] += r["length"]
            assert r["length"] == capacity or r["piece"] == 0 and r["start"] == 0
    for i in (6, 11):  # one row each: pieces join to the document
        v = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in v] == list(range(len(v)))
        assert tuple(x for r in v for x in ids_of(r["ids"])) in {x for (j, x) in want if j == i}
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(bins) == list(range(len(bins)))
    assert packing.pack_documents(no_docs, default_tokenizer(), capacity).count() == 0


def test_packing_query_is_near_the_lower_bound(spark):
    import __spark_entry__ as E

    rows = E.queries()["op10_best_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    n, total = len({r["sequence_id"] for r in rows}), sum(r["length"] for r in rows)
    assert n <= math.ceil(total / 1024) * 1.01 + 1


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)] and packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)]
    random.seed(0)
