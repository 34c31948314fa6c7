"""Operator 2: toxicity by nearest labelled examples under exact TF-IDF cosine."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrain.llm.common import map_batches, materialize, texts
from pricegrain.llm.decontaminate import BASE, ONE, WORD_BYTE, mixed

#: Bounds of the fit: labelled rows learnt from (least hash first), and bytes of their texts together.
MOST_EXAMPLES, MOST_TEXT = 20_000, 128 << 20
#: Words whose first bytes, so many of them, are terms too where those go with the label; and most of these prefixes.
PREFIXES, MOST_PREFIXES = (4, 5, 6), 16_384
#: Lowest G2 of a term that goes with the label, fewest examples that have it, and the weight of all other terms.
LEAST_G2, LEAST_DOCS, OTHERS = 12.0, 3, 0.1
#: Examples of a block of the index, neighbours that vote, what is added to a distance, and weight of the prior.
BLOCK, NEIGHBOURS, SOFT, PRIOR = 64, 9, 0.05, 0.25
#: Postings from which a term's blocks are bounded and skipped, and blocks scored first.
LONG_LIST, FIRST_BLOCKS = 256, 8
#: Lists of one in so many examples are kept example by example, at most so many: they are added up without gathering.
FULL_LIST, MOST_FULL = 16, 512
#: Texts that are looked up together, bytes that are hashed at a time, and what float32 sums of bounds may be off at most.
GROUP, CHUNK, SLACK = 128, 1 << 20, 1e-5


class TermHasher:
    """64-bit hashes of the words of a text, and of their prefixes, by one prefix sum over its bytes."""

    def __init__(self):
        powers = lambda base: np.multiply.accumulate(np.concatenate(([ONE], np.full(CHUNK, base, np.uint64))))
        self.powers, self.inverses = powers(BASE), powers(pow(BASE, -1, 1 << 64))

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and of all prefixes shorter than their word, in any order."""
        data = (text or "").lower().encode()
        words, prefixes, at = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], 0
        while at < len(data):
            end = min(len(data), at + CHUNK)
            if end < len(data):  # cut between words; one longer than a chunk is cut inside
                cut = end
                while cut > at and WORD_BYTE[data[cut - 1]]:
                    cut -= 1
                end = cut if cut > at else end
            b = np.frombuffer(data, np.uint8, end - at, at)
            at = end
            _, w, _, more = self.of_bytes(b)
            words.append(w)
            prefixes.append(more)
        return np.concatenate(words), np.concatenate(prefixes)

    def of_bytes(self, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """Starts and hashes of the words of at most CHUNK bytes, and of the prefixes shorter than their word."""
        is_word = np.zeros(len(b) + 2, np.int8)
        is_word[1:-1] = WORD_BYTE[b]
        edge = np.diff(is_word)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + ONE) * self.powers[: len(b)], out=total[1:])
        at, more = [], []
        for n in PREFIXES:
            s = starts[ends - starts > n]
            at.append(s)
            more.append(mixed((total[s + n] - total[s]) * self.inverses[s] + np.uint64(n)))
        return starts, mixed((total[ends] - total[starts]) * self.inverses[starts]), np.concatenate(at), np.concatenate(more)

    def of_many(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """First text, texts' places from it on and hashes of the words, the same of the prefixes: a run of texts at a time."""
        run, size, first = [], 0, 0
        for i, text in enumerate(texts):
            data = (text or "").lower().encode()
            if run and size + len(data) + 1 > CHUNK:
                yield first, *self.of_run(run)
                run, size = [], 0
            if not run:
                first = i
            if len(data) > CHUNK:
                words, prefixes = self.of(text)
                yield i, np.zeros(len(words), np.int64), words, np.zeros(len(prefixes), np.int64), prefixes
            else:
                run.append(data)
                size += len(data) + 1
        if run:
            yield first, *self.of_run(run)

    def of_run(self, run: list[bytes]) -> tuple[np.ndarray, ...]:
        begin = np.cumsum([0] + [len(d) + 1 for d in run[:-1]])
        at, words, more_at, prefixes = self.of_bytes(np.frombuffer(b" ".join(run), np.uint8))
        return np.searchsorted(begin, at, "right") - 1, words, np.searchsorted(begin, more_at, "right") - 1, prefixes


class HashTable:
    """Places of hashes in a sorted array, found from their leading bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.shift = np.uint64(64 - max(8, min(22, len(hashes).bit_length() + 1)))
        self.begin = np.searchsorted(hashes >> self.shift, np.arange((1 << int(64 - self.shift)) + 1)).astype(np.int32)
        self.most = int(np.diff(self.begin).max())

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of these the array has, and where it has them."""
        top = (hashes >> self.shift).astype(np.int64)
        which, at, end = np.arange(len(hashes)), self.begin[top], self.begin[top + 1]
        found, places = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        for _ in range(self.most):
            some = at < end
            which, hashes, at, end = which[some], hashes[some], at[some], end[some]
            if not len(at):
                break
            same = self.hashes[at] == hashes
            found.append(which[same])
            places.append(at[same])
            which, hashes, at, end = which[~same], hashes[~same], at[~same] + 1, end[~same]
        return np.concatenate(found), np.concatenate(places)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Of those that the array has."""
        return self.find(hashes)[1]


def examples_of(docs: DataFrame, labels: DataFrame, learn_from: Column) -> DataFrame:
    """doc_id, text, toxic of at most MOST_EXAMPLES labelled rows, those of least hash; of an id with several texts the least."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(learn_from & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    chosen = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_EXAMPLES)
    return texts(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def g2(n: np.ndarray, bad: np.ndarray, total: int, toxic: int) -> np.ndarray:
    """G2 of the 2 x 2 table of a term and the label: ``n`` examples have the term, ``bad`` of them are toxic."""
    share = toxic / total
    out = np.zeros(len(n))
    for seen, expected in ((bad, n * share), (n - bad, n * (1 - share)), (toxic - bad, (total - n) * share), (total - toxic - n + bad, (total - n) * (1 - share))):
        some = seen > 0
        out[some] += 2 * seen[some] * np.log(seen[some] / expected[some])
    return out


def label_prefixes(examples: DataFrame, total: int, toxic: int) -> np.ndarray:
    """Hashes of the word prefixes that go with the label, at most MOST_PREFIXES of highest G2."""

    def count(batches):
        hasher = TermHasher()
        for batch in batches:
            found = [np.unique(hasher.of(t)[1]) for t in batch["text"]]
            term, inverse = np.unique(np.concatenate(found), return_inverse=True)
            label = np.repeat(np.array(batch["toxic"], float), [len(f) for f in found])
            yield {"term": term.view(np.int64), "n": np.bincount(inverse, minlength=len(term)), "bad": np.bincount(inverse, label, minlength=len(term)).astype(np.int64)}

    seen = map_batches(examples.select("text", "toxic"), "term long, n long, bad long", count).groupBy("term").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # a bad share above the label's: the rest is counted exactly below, on far fewer rows
    table = seen.filter((F.col("n") >= LEAST_DOCS) & (F.col("bad") > F.col("n") * F.lit(toxic / total))).orderBy(F.desc("bad"), "n", "term").limit(4 * MOST_PREFIXES).toArrow()
    term, n, bad = (table.column(c).to_numpy() for c in ("term", "n", "bad"))
    score = g2(n.astype(float), bad.astype(float), total, toxic)
    best = np.lexsort((term, -score))[:MOST_PREFIXES]
    return np.sort(term[best[score[best] >= LEAST_G2]].view(np.uint64))


class Vectors:
    """Unit TF-IDF vectors over all words, and prefixes that go with the label; words that no example has count in the norm alone."""

    def __init__(self, terms: np.ndarray, prefixes: np.ndarray, weight: np.ndarray | None = None, unseen: float = 0.0):
        self.terms, self.prefixes, self.weight, self.unseen = terms, prefixes, weight, unseen
        self.hasher, self.words, self.more = TermHasher(), HashTable(terms), HashTable(prefixes)
        self.of_prefix = np.searchsorted(terms, prefixes).astype(np.int32)  # an example has each of them

    def counts(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places of the texts, of their terms in the vocabulary, ascending, and how often each occurs: some texts at a time."""
        for owner, term, n, _, _ in self.parts(texts):
            yield owner, term, n

    def parts(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, ...]]:
        """As ``counts``, with the places of the texts and the hashes of the words that no example has, repeats included."""
        for first, at, words, more_at, prefixes in self.hasher.of_many(texts):
            which, places = self.words.find(words)
            strange = np.ones(len(words), bool)
            strange[which] = False
            more, more_places = self.more.find(prefixes)
            owner, term = np.concatenate((at[which], more_at[more])), np.concatenate((places, self.of_prefix[more_places]))
            key, n = np.unique(owner * max(1, len(self.terms)) + term, return_counts=True)
            yield first + key // max(1, len(self.terms)), key % max(1, len(self.terms)), n, first + at[strange], words[strange]

    def unseen_squares(self, owner: np.ndarray, words: np.ndarray, n_texts: int) -> np.ndarray:
        """What the words that no example has add to each text's squared norm."""
        order = np.lexsort((words, owner))
        owner, words = owner[order], words[order]
        edges = np.flatnonzero(np.concatenate(([True], (np.diff(owner) != 0) | (words[1:] != words[:-1]), [True]))) if len(owner) else np.zeros(1, np.int64)
        return np.bincount(owner[edges[:-1]], ((1 + np.log(np.diff(edges))) * self.unseen) ** 2, minlength=n_texts)

    def of(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The terms and weights of each text."""
        out = [(np.empty(0, np.int64), np.empty(0))] * len(texts)
        for owner, term, n, strange_owner, strange in self.parts(texts):
            w = (1 + np.log(n)) * self.weight[term]
            squares = np.bincount(owner, w * w, minlength=len(texts)) + self.unseen_squares(strange_owner, strange, len(texts))
            w /= np.maximum(np.sqrt(squares), 1e-300)[owner]
            edges = np.flatnonzero(np.diff(owner, prepend=-1, append=len(texts)))
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                out[owner[lo]] = term[lo:hi], w[lo:hi]
        return out


def document_counts(docs: DataFrame, terms: np.ndarray, prefixes: np.ndarray) -> tuple[int, np.ndarray]:
    """Documents in all, and documents with each term, over the whole table."""
    shared = docs.sparkSession.sparkContext.broadcast((terms, prefixes))

    def count(batches):
        vectors, n = Vectors(*shared.value), 0
        seen = np.zeros(len(vectors.terms), np.int64)
        for batch in batches:
            for _, term, _ in vectors.counts(batch["text"]):
                seen += np.bincount(term, minlength=len(seen))
            n += len(batch["text"])
        at = np.flatnonzero(seen)
        yield {"term": np.concatenate(([-1], at)), "n": np.concatenate(([n], seen[at]))}

    # as many rows as terms, which MOST_TEXT bounds
    table = map_batches(texts(docs), "term long, n long", count).groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    at, n = table.column("term").to_numpy(), table.column("n").to_numpy()
    out = np.zeros(len(terms), np.int64)
    out[at[at >= 0]] = n[at >= 0]
    return int(n[at < 0].sum()), out


def leading(term: np.ndarray, weight: np.ndarray, lists: np.ndarray) -> tuple[int, int]:
    """A vector's commonest term, which tells languages apart, and the weightiest of those in long lists, the first on ties; 0 without terms."""
    if not len(term):
        return 0, 0
    have = lists[term]
    return int(term[np.argmax(have)]), int(term[np.argmax(np.where(have >= LONG_LIST, weight, 0))])


def vocabulary(counted: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The examples' terms, ascending, and how many examples and toxic ones have each; counted by Spark, so that no posting comes to the driver."""

    def count(batches):
        for batch in batches:
            found = [np.frombuffer(t, np.uint64) for t in batch["terms"]]
            term, inverse = np.unique(np.concatenate(found), return_inverse=True)
            label = np.repeat(np.array(batch["toxic"], float), [len(f) for f in found])
            yield {"term": term.view(np.int64), "n": np.bincount(inverse, minlength=len(term)), "bad": np.bincount(inverse, label, minlength=len(term)).astype(np.int64)}

    seen = map_batches(counted.select("terms", "toxic"), "term long, n long, bad long", count)
    table = seen.groupBy("term").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).toArrow()  # a row a term, which MOST_TEXT bounds
    term, n, bad = (table.column(c).to_numpy() for c in ("term", "n", "bad"))
    order = np.argsort(term.view(np.uint64))
    return term.view(np.uint64)[order], n[order], bad[order]


#: Examples of a part in which the vectors come to the driver.
PART = 1000


def ordered_vectors(counted: DataFrame, terms: np.ndarray, weight: np.ndarray, lists: np.ndarray, total: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """doc_id, toxic, terms and weights of the examples' unit vectors in the order of the index; weighed and sorted by Spark, fetched part by part."""
    shared = counted.sparkSession.sparkContext.broadcast((terms, weight, lists))

    def weigh(batches):
        terms, weight, lists = shared.value
        for batch in batches:
            found = []
            for t, n in zip(batch["terms"], batch["counts"], strict=True):
                term = np.searchsorted(terms, np.frombuffer(t, np.uint64)).astype(np.int32)
                w = (1 + np.log(np.frombuffer(n, np.int32))) * weight[term]
                w /= max(float(np.sqrt((w * w).sum())), 1e-300)
                found.append((term, w, *leading(term, w, lists)))
            yield {
                "doc_id": batch["doc_id"], "toxic": batch["toxic"], "common": [f[2] for f in found], "weighty": [f[3] for f in found], "size": [len(f[0]) for f in found],
                "terms": [f[0].tobytes() for f in found], "weights": [f[1].astype(np.float32).tobytes() for f in found],
            }

    order = ["common", "weighty", "size", "doc_id"]
    vectors = map_batches(counted, "doc_id long, toxic int, common int, weighty int, size int, terms binary, weights binary", weigh)
    parts = vectors.repartitionByRange(max(1, -(-total // PART)), *order).sortWithinPartitions(*order)
    for r in parts.select("doc_id", "toxic", "terms", "weights").toLocalIterator():
        yield r[0], r[1], np.frombuffer(r[2], np.int32), np.frombuffer(r[3], np.float32)
    shared.unpersist()


class BlockMaxIndex:
    """Inverted index over example vectors, with the highest weight that long lists have in each block of examples.

    ``nearest`` is exact: the postings that a long list has in a block are left unread only if the block's bound
    does not reach the last neighbour's similarity. Similar examples stand in the same blocks.
    """

    def __init__(self, doc_id: np.ndarray, toxic: np.ndarray, owner: np.ndarray, term: np.ndarray, weight: np.ndarray, n_terms: int, prior: float):
        """Posting i says that vector ``owner[i]`` has ``weight[i]`` at ``term[i]``; they come in order of the vector."""
        lists = np.bincount(term, minlength=n_terms)
        edges = np.searchsorted(owner, np.arange(len(doc_id) + 1))
        vectors = [(int(i), int(bad), term[lo:hi], weight[lo:hi]) for i, bad, lo, hi in zip(doc_id, toxic, edges[:-1], edges[1:], strict=True)]
        vectors.sort(key=lambda v: (*leading(v[2], v[3], lists), len(v[2]), v[0]))
        self.fill(vectors, len(vectors), lists, prior)

    @classmethod
    def of_ordered(cls, vectors: Iterable[tuple[int, int, np.ndarray, np.ndarray]], n: int, lists: np.ndarray, prior: float) -> BlockMaxIndex:
        """The index of ``n`` vectors (doc_id, toxic, terms, weights) in order of ``leading``, size and doc_id; ``lists`` has the examples of each term."""
        index = cls.__new__(cls)
        index.fill(vectors, n, lists, prior)
        return index

    def fill(self, vectors: Iterable[tuple[int, int, np.ndarray, np.ndarray]], n: int, lists: np.ndarray, prior: float) -> None:
        """Write the postings of one vector after the other where they stay: beside the index, memory holds one vector."""
        self.prior, n_terms = prior, len(lists)
        self.doc_id, self.toxic = np.zeros(n, np.int64), np.zeros(n)
        self.begin = np.concatenate(([0], np.cumsum(lists, dtype=np.int64)))
        self.example, self.weight = np.empty(self.begin[-1], np.int32), np.empty(self.begin[-1], np.float32)
        free = self.begin[:-1].copy()
        for place, (doc_id, bad, term, weight) in enumerate(vectors):
            self.doc_id[place], self.toxic[place] = doc_id, bad
            at = free[term]
            self.example[at], self.weight[at] = place, weight
            free[term] = at + 1
        del free
        self.blocks = -(-n // BLOCK)
        long = np.flatnonzero(lists >= LONG_LIST)
        self.long = np.full(n_terms, -1, np.int32)
        self.long[long] = np.arange(len(long))
        most = np.argsort(-lists[long], kind="stable")[:MOST_FULL]
        most = most[lists[long[most]] * FULL_LIST >= n]
        self.full = np.full(len(long), -1, np.int32)
        self.full[most] = np.arange(len(most))
        self.full_terms, self.full_weight = long[most], None
        self.lists = lists.astype(np.int32)
        self.bound = np.zeros((len(long), self.blocks), np.float32)
        self.block_begin = np.zeros((len(long), self.blocks + 1), np.int32)
        for k, t in enumerate(long):
            lo, hi = self.begin[t], self.begin[t + 1]
            np.maximum.at(self.bound[k], self.example[lo:hi] // BLOCK, self.weight[lo:hi])
            self.block_begin[k] = lo + np.searchsorted(self.example[lo:hi], np.arange(self.blocks + 1) * BLOCK)
        self.read = self.scored = 0  # postings read one by one, and blocks scored

    def add(self, score: np.ndarray, begin: np.ndarray, end: np.ndarray, weights: np.ndarray) -> None:
        """Add the products of the postings in these ranges to their examples' scores."""
        n = end - begin
        total = int(n.sum())
        if total:
            at = np.repeat(begin - np.cumsum(n) + n, n)
            at += np.arange(total)
            products = self.weight.take(at, mode="clip")  # all are in range; this looks them up faster
            products *= np.repeat(weights.astype(np.float32), n)
            score += np.bincount(self.example.take(at, mode="clip"), products, minlength=len(score))
            self.read += total

    def full_lists(self) -> np.ndarray:
        """The longest lists, example by example; each worker makes them for itself, so they are not sent."""
        if self.full_weight is None:
            self.full_weight = np.zeros((len(self.full_terms), self.blocks * BLOCK), np.float32)
            for k, t in enumerate(self.full_terms):
                lo, hi = self.begin[t], self.begin[t + 1]
                self.full_weight[k, self.example[lo:hi]] = self.weight[lo:hi]
        return self.full_weight

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Entries and cosines of the k nearest examples (all that tie with the last), above zero, but for that of doc_id ``without``."""
        return self.nearest_of([(terms, weights)], k, [without])[0]

    def nearest_of(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of a group of vectors, each against the blocks that matter to it.

        Short lists are read first. The blocks of highest bound, by what their examples have so far and the long
        lists' maxima, are scored next, and of the others only those whose bound reaches the k-th similarity found. The
        longest lists are added up for the group in a block that matters to one of it, which brings the bound nearer;
        all others are read vector by vector, where the block still matters.
        """
        if not len(self.doc_id):
            return [(np.empty(0, np.int64), np.empty(0))] * len(vectors)
        n, most = len(vectors), [k + (w is not None) for w in without]
        score = np.zeros((n, self.blocks * BLOCK))
        at_full = np.zeros((n, len(self.full_terms)), np.float32)
        longs, partly = [], []
        for i, (terms, weights) in enumerate(vectors):
            long = self.long[terms]
            short = terms[long < 0]
            self.add(score[i], self.begin[short], self.begin[short + 1], weights[long < 0])
            weights, long = weights[long >= 0], long[long >= 0]
            full = self.full[long]
            at_full[i, full[full >= 0]] = weights[full >= 0]
            longs.append((long, weights))
            partly.append((long[full < 0], weights[full < 0]))
        some, place = np.unique(np.concatenate([long for long, _ in longs]), return_inverse=True)
        of_long = np.zeros((n, len(some)), np.float32)
        of_long[np.repeat(np.arange(n), [len(long) for long, _ in longs]), place] = np.concatenate([w for _, w in longs])
        by_block = score.reshape(n, self.blocks, BLOCK)
        rest = of_long[:, self.full[some] < 0] @ self.bound[some[self.full[some] < 0]]  # what lists read posting by posting can add
        upper = by_block.max(2) + rest + of_long[:, self.full[some] >= 0] @ self.bound[some[self.full[some] >= 0]]
        floor = np.zeros(n)
        done, added = np.zeros((n, self.blocks), bool), np.zeros(self.blocks, bool)
        live = np.ones((n, self.blocks), bool)
        if self.blocks > FIRST_BLOCKS:
            live[:] = False
            np.put_along_axis(live, np.argpartition(-upper, FIRST_BLOCKS, axis=1)[:, :FIRST_BLOCKS], True, axis=1)
        used = np.flatnonzero(at_full.any(0))  # a group is of one language mostly, and has few of the longest lists
        at_full, full_lists = at_full[:, used], self.full_lists()[used]
        while live.any():
            for lo, hi in self.runs(live.any(0) & ~added):
                score[:, lo * BLOCK : hi * BLOCK] += at_full @ full_lists[:, lo * BLOCK : hi * BLOCK]
                added[lo:hi] = True
                upper[:, lo:hi] = by_block[:, lo:hi].max(2) + rest[:, lo:hi]  # nearer, now that the longest lists are in
            live &= upper >= floor[:, None] - SLACK
            for i in np.flatnonzero(live.any(1)).tolist():
                long, weights = partly[i]
                start, end = self.runs(live[i]).T
                self.add(score[i], self.block_begin[long[:, None], start].ravel(), self.block_begin[long[:, None], end].ravel(), np.repeat(weights, len(start)))
                done[i] |= live[i]
                floor[i] = self.floor(by_block[i][done[i]].ravel(), most[i])
            live = ~done & (upper >= floor[:, None] - SLACK)
        self.scored += int(done.sum())
        out = []
        for i in range(n):
            blocks = np.flatnonzero(done[i])
            sims = by_block[i][blocks].ravel()
            at = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            if without[i] is not None:
                sims[self.doc_id[np.minimum(at, len(self.doc_id) - 1)] == without[i]] = 0.0
            found = np.flatnonzero((sims > 0) & (sims >= self.floor(sims, k) - 1e-6))
            at, sims = at[found], sims[found]
            by = np.lexsort((self.doc_id[at], -np.round(sims, 6)))
            out.append((at[by], np.minimum(1.0, sims[by])))
        return out

    @staticmethod
    def runs(chosen: np.ndarray) -> np.ndarray:
        """Begin and end of each run of chosen blocks."""
        return np.flatnonzero(np.diff(chosen.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)

    @staticmethod
    def floor(scores: np.ndarray, k: int) -> float:
        """The k-th highest score, 0 if there are fewer."""
        return float(-np.partition(-scores, k - 1)[k - 1]) if len(scores) >= k else 0.0

    def votes(self, vectors: list[tuple[np.ndarray, np.ndarray]], without: list[int] | None = None) -> list[tuple[float, list[int]]]:
        """Of each vector the share of toxic among the neighbours, weighted by 1 / distance, and the nearest examples' ids."""
        out: list[tuple[float, list[int]]] = [(0.0, [])] * len(vectors)
        # in the order of the examples: those near each other have much the same blocks that matter
        keys = []
        for terms, weights in vectors:
            have = self.lists[terms]
            keys.append((int(terms[np.argmax(have)]), int(terms[np.argmax(np.where(have >= LONG_LIST, weights, 0))]), len(terms)) if len(terms) else (-1, -1, 0))
        order = sorted(range(len(vectors)), key=keys.__getitem__)
        for lo in range(0, len(order), GROUP):
            group = order[lo : lo + GROUP]
            nearest = self.nearest_of([vectors[i] for i in group], NEIGHBOURS, [without[i] if without else None for i in group])
            for i, (at, sims) in zip(group, nearest, strict=True):
                weight = 1 / (1 - sims + SOFT) * SOFT
                share = float((weight * self.toxic[at]).sum() + PRIOR * self.prior) / float(weight.sum() + PRIOR)
                out[i] = share, [int(d) for d in self.doc_id[at[:3]]]
        return out


class Calibration:
    """A rising step function from votes to the share of toxic examples that got such votes (isotonic regression)."""

    def __init__(self, votes: np.ndarray, toxic: np.ndarray, prior: float):
        order = np.lexsort((toxic, votes))
        edges, first = np.unique(votes[order], return_index=True)
        n = np.diff(np.append(first, len(order))).astype(float)
        bad = np.add.reduceat(toxic[order].astype(float), first) if len(first) else np.empty(0)
        pools: list[list[float]] = []  # sum of votes, examples, toxic ones
        for edge, a, b in zip(edges.tolist(), n.tolist(), bad.tolist(), strict=True):
            pools.append([edge * a, a, b])
            while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
                last = pools.pop()
                pools[-1] = [x + y for x, y in zip(pools[-1], last, strict=True)]
        self.votes = np.array([p[0] / p[1] for p in pools])
        self.share = np.array([(p[2] + PRIOR * prior) / (p[1] + PRIOR) for p in pools])
        self.prior = prior

    def __call__(self, votes: np.ndarray) -> np.ndarray:
        """Between two pools' mean votes the share rises evenly."""
        return np.interp(votes, self.votes, np.maximum.accumulate(self.share)) if len(self.votes) else np.full(len(votes), self.prior)


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column) -> tuple[Vectors, BlockMaxIndex, Calibration]:
    """Vocabulary with weights, index of the examples, and calibration by the votes that each example gets from the others."""
    examples = materialize(examples_of(docs, labels, learn_from), "examples")
    sizes = examples.select("doc_id", F.octet_length("text").alias("size")).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()  # at most MOST_EXAMPLES rows
    within = np.cumsum(np.nan_to_num(sizes.column("size").to_numpy())) <= MOST_TEXT
    if not within.all():
        fits = docs.sparkSession.createDataFrame([(int(i),) for i in sizes.column("doc_id").to_numpy()[within]], "doc_id long")
        examples = examples.join(F.broadcast(fits), "doc_id", "left_semi")
    total, toxic = examples.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = toxic / total if total else 0.0
    prefixes = label_prefixes(examples, total, toxic) if 0 < toxic < total else np.empty(0, np.uint64)

    def count(batches):
        hasher, chosen = TermHasher(), HashTable(prefixes)
        for batch in batches:
            found = []
            for text in batch["text"]:
                words, more = hasher.of(text)
                found.append(np.unique(np.concatenate((words, prefixes[chosen.places(more)])), return_counts=True))
            yield {"doc_id": batch["doc_id"], "toxic": batch["toxic"], "terms": [t.tobytes() for t, _ in found], "counts": [n.astype(np.int32).tobytes() for _, n in found]}

    counted = materialize(map_batches(examples.select("doc_id", "toxic", "text"), "doc_id long, toxic int, terms binary, counts binary", count), "counts")
    terms, have, bad = vocabulary(counted)
    n_docs, df = document_counts(docs, terms, prefixes)
    goes = (have >= LEAST_DOCS) & (bad > have * prior)
    if 0 < toxic < total:
        goes[goes] = g2(have[goes].astype(float), bad[goes].astype(float), total, toxic) >= LEAST_G2
    weight = np.log((1 + n_docs) / (1 + df)) * np.where(goes, 1.0, OTHERS)
    index = BlockMaxIndex.of_ordered(ordered_vectors(counted, terms, weight, have, total), total, have, prior)
    # a word that no example has weighs as one of this document alone: its documents are not counted
    vectors = Vectors(terms, prefixes, weight, max(0.0, float(np.log((1 + n_docs) / 2))) * OTHERS)

    model = docs.sparkSession.sparkContext.broadcast((vectors, index))

    def others(batches):
        known, found = model.value
        for batch in batches:
            yield {"vote": [v for v, _ in found.votes(known.of(batch["text"]), batch["doc_id"])], "toxic": batch["toxic"]}

    votes = map_batches(examples.select("doc_id", "text", "toxic"), "vote double, toxic int", others).toArrow()  # at most MOST_EXAMPLES rows
    return model, Calibration(votes.column("vote").to_numpy(), votes.column("toxic").to_numpy(), prior)


def score_toxicity(docs: DataFrame, labels: DataFrame, learn_from: Column, threshold: float = 0.7) -> DataFrame:
    """Toxicity of each whole text by its nearest labelled examples.

    ``learn_from`` marks the rows of ``labels`` that may be learnt from; at most MOST_EXAMPLES of them (least
    hash of the id, as far as their texts have no more than MOST_TEXT bytes together) are the examples. A text's
    vector holds all its words, and word prefixes that go with the label (G2); words that do not go with it weigh
    OTHERS as much. IDF covers all documents; words that no example has weigh as if they were in one document, and
    count in the norm. The share of toxic among the
    neighbours, each weighing 1 / distance, becomes a probability by isotonic regression over the votes that
    the examples get from one another. Returns doc_id, score, predicted (1 from the threshold on), vote and
    evidence, the ids of the nearest examples. Texts without any known word (null and empty ones too) have no
    neighbours and get the score of the label's share, as do all texts when no label could be learnt. Labels
    that are null, or of ids without a document, are not used; an id labelled twice counts as toxic if one label
    says so, and one with several texts has the least; repeated rows of a document give repeated rows and count once
    as an example. Examples of equal similarity all vote. Very long texts are hashed piece by piece.
    """
    model, calibration = fit(docs, labels, learn_from)

    def run(batches):
        vectors, known = model.value
        for batch in batches:
            found = known.votes(vectors.of(batch["text"]))
            scores = calibration(np.array([v for v, _ in found]))
            yield {"doc_id": batch["doc_id"], "score": scores, "predicted": (scores >= threshold).astype(np.int32), "vote": [v for v, _ in found], "evidence": [e for _, e in found]}

    return map_batches(texts(docs), "doc_id long, score double, predicted int, vote double, evidence array<long>", run)
