"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pricegrain.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(CAPITALS))


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    queries = {}
    for item, text in items:
        queries.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, query in queries.items():
        scored = []
        for doc, c in held:
            m = 25 + 75 * sum(c.values()) * n // total
            s = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, times in query.items() if t in c)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, rank + 1, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, parts=1):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, term string").repartition(parts)
    q = spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, rank int")
    return sorted((tuple(r) for r in search.search_documents(d, q).collect()), key=str)


def corpus(seed, n, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" if i % 3 else f"É{i}ß" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    docs = [(i * 7 % n, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 3, 20, 80])))) for i in range(n)]
    items = [(i, ", ".join(rng.choices(vocabulary, k=rng.choice([1, 4, 30])))) for i in range(20)]
    return docs, items


@pytest.mark.parametrize("shard_bytes,query_bytes,block", [(1 << 25, 1 << 24, 64), (3000, 200, 4), (1, 1 << 24, 2)])
def test_brute_force(spark, monkeypatch, shard_bytes, query_bytes, block):
    monkeypatch.setattr(search, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(search, "QUERY_BYTES", query_bytes)
    monkeypatch.setattr(search, "BLOCK", block)
    docs, items = corpus(block, 400)
    assert found(spark, docs, items, 3) == brute(docs, items)


def test_odd_rows(spark):
    docs = [(None, "alpha beta"), (1, None), (2, ""), (3, "..., --"), (4, "Alpha ALPHA été"), (4, "alpha"), (5, "alpha beta"), (5, "alpha beta"), (6, "été_ÉTÉ"), (7, "x " * 30_000 + "beta"), (8, "z" * 40_000), (2**40, "gamma"), (-3, "alpha beta")]
    items = [(None, "alpha"), (None, "gamma"), (1, None), (2, "..."), (3, "BETA été"), (3, "beta"), (4, "nothing here"), (5, "z" * 40_000), (2**50, "x")]
    assert found(spark, docs, items, 2) == brute(docs, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, "..")], [(1, "a")]) == []


def test_long_texts_are_split_at_blanks(monkeypatch):
    monkeypatch.setattr(search, "PIECE", 10)
    text = ("word " * 20 + "w" * 50 + " end").encode()
    assert [w for p in search.pieces(text) for w in p.split()] == text.split()


def test_numbers_round_trip():
    values = np.array([0, 1, 127, 128, 300, 16_383, 16_384, 1 << 21, (1 << 31) - 1])
    data, ends = search.pack(values)
    assert search.unpack(data.tobytes()).tolist() == values.tolist() and ends[-1] == len(data)


def test_norms_beyond_64_bits():
    lengths = np.array([1, 10**8], np.int64)
    assert search.norms(lengths, 10**11, 10**13).tolist() == [25 + 75 * x * 10**11 // 10**13 for x in (1, 10**8)]


def list_of(docs, tf, n_docs, block=4):
    """Postings of one term; every document is of norm 25."""
    docs, tf = np.array(docs), np.array(tf)
    cuts = range(0, len(docs), block)
    data = [search.pack(np.stack([np.diff(docs[a : a + block], prepend=0), tf[a : a + block]], axis=1).ravel())[0].tobytes() for a in cuts]
    best = np.array([search.saturated(tf[a : a + block], 25).max() for a in cuts])
    return search.Postings(np.array([docs[a : a + block][-1] for a in cuts]), best, np.array([len(docs[a : a + block]) for a in cuts]), data, np.full(n_docs, 25))


def test_blocks_that_cannot_matter_stay_unread():
    rare, common = list_of([500, 501, 502], [9, 9, 9], 1000), list_of(range(1000), [1] * 1000, 1000)
    docs, scores = search.best_of([(100_000, rare), (1, common)], 1000, 3)
    assert docs.tolist() == [500, 501, 502] and len(set(scores.tolist())) == 1
    assert common.open.sum() == len(common.open) - 1
