"""Operator 4: benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrain.llm.common import map_batches

#: The masks; a 0 is a word that may differ. Every overlap that counts (see below) has a hit of one of
#: them (the tests prove it), with further ones for items of 10 words (1111001111) and others for items of 5.
MASKS = ("11111", "101111", "110111", "111011", "111101")
MASKS_BY_WORDS = {5: ("1111", "10111", "11011", "11101"), 10: (*MASKS, "1110011")}
#: Items of fewer words than this have to stand whole, since 80 % of them are all: their mask has no free place.
LEAST_WORDS = 5
#: An overlap counts from so many equal words, or this share of the item's; and this share of it must be equal.
MIN_WORDS, MIN_ITEM_SHARE, MIN_EQUAL = 13, 0.8, 0.75
#: Bytes of benchmark text that one pass over the documents looks up.
BLOCK_BYTES = 4 << 20
#: Bytes of a document handled at a time, and bits of the filter before the search.
CHUNK, FILTER_BITS = 1 << 20, 22
#: Hits that are spelt out at a time, and what makes the difference of two places positive.
HITS, SHIFTED = 1 << 20, 1 << 31

ONE = np.uint64(1)
BASE = 0x9E3779B97F4A7C15
WORD_BYTE = np.array([chr(b).isalnum() and b < 128 or b >= 128 for b in range(256)])
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class WordHasher:
    """64-bit hashes of all words of a text by one prefix sum over its bytes."""

    def __init__(self):
        self.powers = self.inverses = np.empty(0, np.uint64)

    def grow(self, n: int) -> None:
        if n > len(self.powers):
            n = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                self.powers = np.multiply.accumulate(np.concatenate(([ONE], np.full(n - 1, BASE, np.uint64))))
                self.inverses = np.multiply.accumulate(np.concatenate(([ONE], np.full(n - 1, pow(BASE, -1, 1 << 64), np.uint64))))

    def part(self, b: np.ndarray) -> np.ndarray:
        is_word = np.zeros(len(b) + 2, np.int8)
        is_word[1:-1] = WORD_BYTE[b]
        edge = np.diff(is_word)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.grow(len(b) + 1)
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + ONE) * self.powers[: len(b)], out=total[1:])
        return mixed((total[ends] - total[starts]) * self.inverses[starts])

    def words(self, text: str | None) -> np.ndarray:
        data = (text or "").lower().encode()
        out, at = [np.empty(0, np.uint64)], 0
        while at < len(data):
            end = min(len(data), at + CHUNK)
            if end < len(data):  # cut between words; one longer than a chunk is cut inside
                cut = end
                while cut > at and WORD_BYTE[data[cut - 1]]:
                    cut -= 1
                end = cut if cut > at else end
            out.append(self.part(np.frombuffer(data, np.uint8, end - at, at)))
            at = end
        return np.concatenate(out)


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of every window of the mask's length over the words where the mask has a 1."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, len(mask) * 1_000_003 + int(mask, 2), np.uint64)
    for i, c in enumerate(mask):
        if c == "1":
            total = total * np.uint64(BASE) + words[i : i + n]
    return mixed(total)


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """Equal words and ends of the stretch with most equal words among all that are MIN_EQUAL equal, the first of the shortest.

    With mismatches priced so that a stretch is equal enough from a gain of 0, the longest of each end begins
    at the first place whose gain so far is no higher.
    """
    gain = np.concatenate(([0.0], np.cumsum(np.where(equal, 1.0 - MIN_EQUAL, -MIN_EQUAL))))
    m = np.concatenate(([0], np.cumsum(equal)))
    first = np.searchsorted(-np.minimum.accumulate(gain), -gain, "left")
    end = int(np.argmax(m - m[first]))
    start = int(np.searchsorted(m, m[first[end]], "right")) - 1  # differing words at its ends are not part of it
    return int(m[end] - m[start]), start, end


def masks_of(n_words: int) -> tuple[str, ...]:
    """Masks by which an item of so many words is looked up."""
    return MASKS_BY_WORDS.get(n_words, MASKS) if n_words >= LEAST_WORDS else ("1" * n_words,) * (n_words > 0)


class SeedIndex:
    """Spaced-seed hashes of one block of benchmark items, with their places."""

    def __init__(self, items: list[tuple[int, str]]):
        hasher = WordHasher()
        self.ids = [i for i, _ in items]
        self.words = [hasher.words(t) for _, t in items]
        self.masks = sorted({mask for w in self.words for mask in masks_of(len(w))})
        hashes, item, place = [np.empty(0, np.uint64)], [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        for k, w in enumerate(self.words):
            for mask in masks_of(len(w)):
                h = seed_hashes(w, mask)
                hashes.append(h), item.append(np.full(len(h), k, np.int32)), place.append(np.arange(len(h), dtype=np.int32))
        h = np.concatenate(hashes)
        order = np.argsort(h, kind="stable")
        self.hashes, self.item, self.place = h[order], np.concatenate(item)[order], np.concatenate(place)[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[h >> np.uint64(64 - FILTER_BITS)] = True

    def diagonals(self, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, place in the document less place in the item) of all hits, each once."""
        found = [np.empty(0, np.int64)]
        for mask in self.masks:
            h = seed_hashes(words, mask)
            at = np.flatnonzero(self.filter[h >> np.uint64(64 - FILTER_BITS)])
            left, right = np.searchsorted(self.hashes, h[at], "left"), np.searchsorted(self.hashes, h[at], "right")
            at, left, n = at[left < right], left[left < right], (right - left)[left < right]
            before = np.concatenate(([0], np.cumsum(n)))
            lo = 0
            while lo < len(at):  # as many places at a time as have HITS hits, one at least
                hi = max(lo + 1, int(np.searchsorted(before, before[lo] + HITS, "right")) - 1)
                k = np.repeat(left[lo:hi] - before[lo:hi], n[lo:hi]) + np.arange(before[lo], before[hi])
                found.append(np.unique(self.item[k].astype(np.int64) << 32 | (np.repeat(at[lo:hi], n[lo:hi]) - self.place[k] + SHIFTED)))
                lo = hi
        for d in np.unique(np.concatenate(found)).tolist():
            yield d >> 32, (d & 0xFFFFFFFF) - SHIFTED

    def overlaps(self, words: np.ndarray) -> dict[int, tuple[int, int, int, int]]:
        """Best verified overlap of each item: equal words, length, and its ends in the document."""
        best: dict[int, tuple[int, int, int, int]] = {}
        for k, shift in self.diagonals(words):
            item = self.words[k]
            lo, hi = max(0, shift), min(len(words), shift + len(item))
            equal = words[lo:hi] == item[lo - shift : hi - shift]
            need = min(MIN_WORDS, MIN_ITEM_SHARE * len(item))
            if np.count_nonzero(equal) < need:
                continue
            m, start, end = best_stretch(equal)
            if m >= need:
                best[k] = max(best.get(k, (0, 0, 0, 0)), (m, end - start, lo + start, lo + end))
        return best


def contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents that hold a passage of a benchmark item, up to some substituted words.

    Returns doc_id, item_id, n_equal, n_overlap, first_word, end_word (word places of the best overlap in
    the document) and item_share (equal words to the item's words), one row per document and item; clean
    documents give none. Words are runs of letters and digits, lower-cased. The masks hash windows of words
    without their free positions; a document's hashes are joined to the benchmark's, and where one hits, the
    two are compared word by word at its relative position, over the whole item. An overlap counts from 13 equal
    words, or 80 % of a shorter item, with three quarters of it equal, and every one has a hit. Items of
    fewer than 5 words count where they stand whole; items without a word hold nothing.
    Null and empty texts hold nothing, nor do null items; repeated rows of a document give repeated rows.

    The benchmark is looked up in blocks of a bounded number of bytes, each sent to all tasks for one pass
    over the documents, so that nothing sent grows with either table.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull()).distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        index = spark.sparkContext.broadcast(SeedIndex([(r["item_id"], r["text"]) for r in rows]))

        def run(batches, index=index):
            known, hasher = index.value, WordHasher()
            for batch in batches:
                out = {k: [] for k in ("doc_id", "item_id", "n_equal", "n_overlap", "first_word", "end_word", "item_share")}
                for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                    for k, (m, n, start, end) in known.overlaps(hasher.words(text)).items():
                        for name, value in zip(out, (doc_id, known.ids[k], m, n, start, end, m / len(known.words[k])), strict=True):
                            out[name].append(value)
                yield out

        part = map_batches(d, "doc_id long, item_id long, n_equal long, n_overlap long, first_word long, end_word long, item_share double", run)
        found = part if found is None else found.unionByName(part)
    return found
