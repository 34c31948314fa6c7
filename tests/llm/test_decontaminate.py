"""The registered decontamination query against a comparison of every item at every place."""

import re

import numpy as np

from pricegrain.llm.decontaminate import MIN_EQUAL, MIN_ITEM_SHARE, MIN_WORDS
from pricegrain.llm.queries import op4_decontamination

SMALL = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def most_equal(equal, need):
    """Equal words of the best stretch that is equal enough, by trying all."""
    total = np.concatenate(([0], np.cumsum(equal)))
    best = 0
    for a in range(len(equal)):
        for z in range(a + 1, len(equal) + 1):
            m = int(total[z] - total[a])
            if m >= max(need, best + 1) and m >= MIN_EQUAL * (z - a):
                best = m
    return best


def test_query_matches_brute_force(spark):
    docs = {r["doc_id"]: words(r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = {r["item_id"]: words(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    numbers = {}
    coded = lambda ws: np.array([numbers.setdefault(w, len(numbers)) for w in ws], np.int64)
    docs, items = {d: coded(w) for d, w in docs.items()}, {i: coded(w) for i, w in items.items()}
    want = {}
    for d, doc in docs.items():
        for i, item in items.items():
            m, need = len(item), min(MIN_WORDS, MIN_ITEM_SHARE * len(item))
            if not m or not len(doc):
                continue
            padded = np.concatenate((np.full(m - 1, -1), doc, np.full(m - 1, -1)))
            equal = np.lib.stride_tricks.sliding_window_view(padded, m) == item
            for k in np.flatnonzero(equal.sum(1) >= need).tolist():
                lo, hi = max(0, m - 1 - k), min(m, len(doc) + m - 1 - k)
                if best := most_equal(equal[k][lo:hi], need):
                    want[d, i] = max(want.get((d, i), 0), best)
    got = {(r["doc_id"], r["item_id"]): r["n_equal"] for r in op4_decontamination(spark, SMALL).collect()}
    assert want and got == want
