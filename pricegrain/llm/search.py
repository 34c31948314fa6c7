"""Operator 13: ranked lexical search by Block-Max MaxScore over an index of shards."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricegrain.llm.common import materialize, small_batches, steps, texts

#: Bytes of text whose postings make a shard, and postings of a block.
SHARD_BYTES, BLOCK = 32 << 20, 64
#: Bytes of terms that are sent to the workers at once, and into so many groups a first merge of heaps goes.
QUERY_BYTES, HEAP_GROUPS = 16 << 20, 64
#: A document's share of length in the norm, of 100; the scale of a term's frequency.
LENGTH_SHARE, SCALE = 75, 1_000_000_000
#: Bytes of a long text that are split into terms at a time.
PIECE = 1 << 20
#: Maps A-Z to a-z and each byte of ASCII that is neither letter nor digit to a blank.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: A row for each block of postings; the row of a shard's documents has the empty term.
INDEX = "shard long, term string, block int, last int, n int, tfs array<int>, lengths array<int>, data binary, ids array<long>"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def pieces(text: bytes) -> Iterator[bytes]:
    """A text with blanks between terms, in pieces that end at one."""
    at = 0
    while len(text) - at > PIECE and (cut := text.find(b" ", at + PIECE)) >= 0:
        yield text[at:cut]
        at = cut
    yield text[at:]


class Numbers(dict):
    """Numbers of terms in order of appearance."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers as bytes of seven bits, the last of each below 128; and where each number ends."""
    values = values.astype(np.uint64)
    width = 1 + sum((values >= (1 << 7 * k)).astype(np.int64) for k in range(1, 5))
    ends = np.cumsum(width)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(width.max()) if len(width) else 0):
        has = width > k
        more = (width[has] > k + 1).astype(np.uint8) << 7
        out[ends[has] - width[has] + k] = ((values[has] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more
    return out, ends


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    stop = np.flatnonzero(raw < 128)
    start = np.concatenate(([0], stop[:-1] + 1))
    shift = 7 * (np.arange(len(raw)) - np.repeat(start, stop - start + 1))
    return np.add.reduceat((raw & 127).astype(np.int64) << shift, start)


def competitive(tf: np.ndarray, length: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each block the (tf, length) that no other posting of the block beats in both, and how many; the block's best score is among them, whatever the corpus' totals."""
    starts = np.cumsum(sizes) - sizes
    out_tf, out_length, counts = [], [], []
    for a in range(0, len(sizes), 8192):
        n = sizes[a : a + 8192]
        width = int(n.max())
        at = np.minimum(starts[a : a + 8192, None] + np.arange(width), len(tf) - 1)
        key = np.where(np.arange(width) < n[:, None], (np.int64((1 << 31) - 1) - tf[at].astype(np.int64)) << 32 | length[at].astype(np.int64), np.iinfo(np.int64).max)
        key.sort(axis=1)
        short = key & 0xFFFFFFFF
        before = np.minimum.accumulate(short, axis=1)
        keep = np.ones_like(short, bool)
        keep[:, 1:] = short[:, 1:] < before[:, :-1]
        keep &= key != np.iinfo(np.int64).max
        out_tf.append((1 << 31) - 1 - (key[keep] >> 32))
        out_length.append(short[keep])
        counts.append(keep.sum(axis=1))
    return np.concatenate(out_tf), np.concatenate(out_length), np.concatenate(counts)


class Shard:
    """Documents read so far, their terms as numbers."""

    def __init__(self) -> None:
        self.vocabulary, self.ids, self.lengths, self.terms, self.size = Numbers(), [], [], [], 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        number = self.vocabulary.__getitem__
        parts = [np.fromiter(map(number, words), np.int32, len(words)) for p in pieces(text.translate(PLAIN)) if (words := p.split())]
        if parts:
            self.terms += parts
            self.ids.append(doc_id)
            self.lengths.append(sum(map(len, parts)))
            self.size += len(text)

    def rows(self, shard: int) -> pa.RecordBatch:
        """Documents by id, nulls last; postings by term and document, in blocks of which each can be read alone."""
        n_docs = len(self.ids)
        order = sorted(range(n_docs), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        place = np.empty(n_docs, np.int64)
        place[order] = np.arange(n_docs)
        lengths = np.array(self.lengths, np.int64)[order]
        names = sorted(self.vocabulary)
        number = np.empty(len(names), np.int64)
        number[[self.vocabulary[x] for x in names]] = np.arange(len(names))
        key = number[np.concatenate(self.terms)] * n_docs + np.repeat(place, self.lengths)
        key.sort()
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        tf = np.diff(np.append(at, len(key)))
        term, doc = np.divmod(key[at], n_docs)
        first = np.concatenate(([True], term[1:] != term[:-1]))
        inside = np.arange(len(term)) - np.maximum.accumulate(np.where(first, np.arange(len(term)), 0))
        opens = inside % BLOCK == 0
        starts = np.flatnonzero(opens)
        sizes = np.diff(np.append(starts, len(term)))
        gap = np.where(opens, doc, doc - np.concatenate(([0], doc[:-1])))
        data, ends = pack(np.stack([gap, tf], axis=1).ravel())
        cuts = np.concatenate(([0], ends[2 * (starts + sizes) - 1]))
        tfs, shortest, counts = competitive(tf, lengths[doc], sizes)
        heads = np.concatenate(([0, 0], np.cumsum(counts)))
        no_row = np.zeros(len(starts) + 2, np.int32)
        no_row[1:] = n_docs
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(starts) + 1, shard)),
                pa.concat_arrays([pa.array([""]), pa.array(names, pa.binary()).cast(pa.string()).take(pa.array(term[starts]))]),
                pa.array(np.concatenate(([0], inside[starts] // BLOCK)).astype(np.int32)),
                pa.array(np.concatenate(([n_docs - 1], doc[starts + sizes - 1])).astype(np.int32)),
                pa.array(np.concatenate(([n_docs], sizes)).astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(heads.astype(np.int32)), pa.array(tfs.astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(np.concatenate(([0, n_docs], n_docs + np.cumsum(counts))).astype(np.int32)), pa.array(np.concatenate((lengths, shortest)).astype(np.int32))),
                pa.concat_arrays([pa.array([b""]), pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])]),
                pa.ListArray.from_arrays(pa.array(no_row), pa.array([self.ids[i] for i in order], pa.int64())),
            ],
            names=[c.split()[0] for c in INDEX.split(", ")],
        )


def build_index(docs: DataFrame) -> DataFrame:
    """The index of whole texts as a table of columns INDEX, shard by shard as documents are read, without a shuffle.

    A shard holds the documents of SHARD_BYTES of text, or one longer document. Documents without a term are left out.
    """
    small_batches(docs.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, shard = TaskContext.get().partitionId(), 0, Shard()
        for whole in batches:
            for batch in steps(whole):
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    shard.add(doc_id, text)
                    if shard.size >= SHARD_BYTES:
                        yield from steps(shard.rows(task << 32 | made))
                        made, shard = made + 1, Shard()
        if shard.ids:
            yield from steps(shard.rows(task << 32 | made))

    plain = texts(docs).filter("text is not null").select("doc_id", F.col("text").cast("binary").alias("text"))
    return plain.mapInArrow(build, INDEX)


def norms(lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """Norm m of documents of these lengths, in a corpus of ``n`` documents and ``total`` terms; exact however large."""
    if len(lengths) and int(lengths.max()) * LENGTH_SHARE * n >= 1 << 63:
        return np.array([100 - LENGTH_SHARE + LENGTH_SHARE * int(x) * n // total for x in lengths], np.int64)
    return 100 - LENGTH_SHARE + LENGTH_SHARE * lengths.astype(np.int64) * n // total


def saturated(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return SCALE * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + 8 * norm)


class Postings:
    """One term in one shard: bounds of its blocks, and what has been read of them."""

    def __init__(self, last: np.ndarray, best: np.ndarray, sizes: np.ndarray, data: list[bytes], norm: np.ndarray):
        self.last, self.best, self.data, self.norm = last, best, data, norm
        self.ends = np.cumsum(sizes)
        self.sizes, self.top = sizes, int(best.max())
        # of a block that has not been read all places hold its last document, so that the array stays sorted
        self.docs = np.repeat(last, sizes)
        self.scores = np.zeros(len(self.docs), np.int64)
        self.open = np.ones(len(last), bool)

    def read(self, blocks: np.ndarray) -> None:
        blocks = blocks[self.open[blocks]]
        if not len(blocks):
            return
        self.open[blocks] = False
        values = unpack(b"".join(self.data[b] for b in blocks.tolist()))
        gaps, tf = values[0::2], values[1::2]
        n = self.sizes[blocks]
        starts = np.cumsum(n) - n
        run = np.cumsum(gaps)
        docs = run - np.repeat(run[starts] - gaps[starts], n)
        at = np.repeat(self.ends[blocks] - n - starts, n) + np.arange(len(docs))
        self.docs[at] = docs
        self.scores[at] = saturated(tf, self.norm[docs])

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        self.read(np.flatnonzero(self.open))
        return self.docs, self.scores

    def bounds(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block of each document and the block's bound, 0 beyond the last."""
        block = np.searchsorted(self.last, docs)
        past = block >= len(self.last)
        block[past] = 0
        return np.where(past, -1, block), np.where(past, 0, self.best[block])

    def of(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Scores of the documents, of which ``blocks`` tells the block; only these blocks are read."""
        self.read(np.unique(blocks[blocks >= 0]))
        at = np.minimum(np.searchsorted(self.docs, docs), len(self.docs) - 1)
        return np.where((blocks >= 0) & (self.docs[at] == docs), self.scores[at], 0)


def kth(scores: np.ndarray, k: int) -> int:
    """The k-th largest score, 0 where there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def best_of(lists: list[tuple[int, Postings]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of the k best documents above 0, best first, equal scores by number.

    ``lists`` has (weight, postings). Lists go from the highest bound down. As long as those to come could together
    lift an unseen document to the k-th best score so far, a list is essential and read whole. The others only
    add to candidates: each candidate's bound is that of the blocks it falls into, and blocks are read
    for those alone that can still reach the k-th best.
    """
    lists = sorted(lists, key=lambda x: -x[0] * x[1].top)
    rest = np.append(np.cumsum([w * p.top for w, p in lists][::-1])[::-1], 0)
    scores, floor, i = np.zeros(n_docs, np.int64), 0, 0
    while i < len(lists) and rest[i] >= max(floor, 1):
        weight, postings = lists[i]
        docs, own = postings.all()
        scores[docs] += weight * own
        floor, i = kth(scores, k), i + 1
    found = np.flatnonzero(scores + rest[i] >= max(floor, 1))
    found = found[scores[found] > 0]
    own, left = scores[found], lists[i:]
    if left and len(found):
        blocks, above = zip(*(p.bounds(found) for _, p in left), strict=True)
        blocks = np.stack(blocks)
        above = np.cumsum(np.stack([w * b for (w, _), b in zip(left, above, strict=True)])[::-1], axis=0)[::-1]  # of this list and those after it
        for j, (weight, postings) in enumerate(left):
            live = own + above[j] >= floor
            found, own, blocks, above = found[live], own[live], blocks[:, live], above[:, live]
            own = own + weight * postings.of(found, blocks[j])
            floor = max(floor, kth(own, k))
    order = np.lexsort((found, -own))[:k]
    return found[order], own[order]


def search_shard(table: pa.Table, queries: list[tuple[int | None, list[tuple[str, int]]]], n: int, total: int, k: int) -> pa.Table:
    """The best documents of one shard for each query; a query is its item and (term, weight) pairs."""
    table = table.sort_by([("term", "ascending"), ("block", "ascending")]).combine_chunks()
    column = lambda name: table.column(name).combine_chunks() if table.num_rows else table.column(name)
    terms, sizes, last, data = column("term").to_pylist(), column("n").to_numpy(), column("last").to_numpy().astype(np.int64), column("data").to_pylist()
    lengths = column("lengths")
    flat, offsets = lengths.flatten().to_numpy().astype(np.int64), np.append(0, np.cumsum(lengths.value_lengths().to_numpy()))
    n_docs = int(sizes[0])  # the row of the empty term comes first
    norm = norms(flat[:n_docs], n, total)
    ids = column("ids")[0].values
    tfs = column("tfs").flatten().to_numpy().astype(np.int64)
    found: list[tuple[list, pa.Array, np.ndarray]] = []
    if len(tfs):
        best = np.maximum.reduceat(saturated(tfs, norms(flat[n_docs:], n, total)), offsets[1:-1] - n_docs)
        edges = [1, *(i for i in range(2, len(terms)) if terms[i] != terms[i - 1]), len(terms)]
        held = {terms[a]: Postings(last[a:z], best[a - 1 : z - 1], sizes[a:z].astype(np.int64), data[a:z], norm) for a, z in zip(edges, edges[1:])}
        for item, wanted in queries:
            docs, scores = best_of([(w, held[t]) for t, w in wanted if w and t in held], n_docs, k)
            if len(docs):
                found.append(([item] * len(docs), ids.take(pa.array(docs)), scores))
    items = pa.array([x for f in found for x in f[0]], pa.int64())
    docs = pa.concat_arrays([f[1] for f in found]) if found else pa.array([], pa.int64())
    return pa.table({"item_id": items, "doc_id": docs, "score": pa.array(np.concatenate([f[2] for f in found]) if found else [], pa.int64())})


def ranked(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The k best rows with their rank; each task drops what it can before rows are shuffled."""
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).filter(F.col("rank") <= k)


def search(index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k documents of highest score above 0 for each item of (item_id, text), over an index that was built before.

    Returns item_id, rank, doc_id, score; equal scores go by doc_id, null ids last. Rows of one item_id, null among them, are one item with
    the terms of all; a null or empty text has none. Items without a hit have no row. Rows of one doc_id are documents
    of their own. Document frequencies and totals are those of the whole index.

    Items are sent to the workers in groups of about QUERY_BYTES of terms (an item is not split); each group reads only the
    blocks of its terms, a shard in one task. Each task sends its best documents, which are merged in two rounds.
    """
    spark = items.sparkSession
    plain = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(plain, F.lit(TERM), F.lit(0))).alias("term"))
    terms = materialize(terms.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times")), "query-terms")
    n, total = index.filter("term = ''").agg(F.sum("n"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    size = terms.agg(F.sum(F.octet_length("term") + 16)).first()[0]
    if not n or not size:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    groups = -(-size // QUERY_BYTES)
    terms = terms.withColumn("group", F.pmod(F.xxhash64("item_id"), F.lit(groups)))
    held = index.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n) + 2) / (2 * F.col("df") + 1))).cast("long") * F.col("times")
    weighed = materialize(terms.join(held, "term").select("group", "item_id", "term", weight.alias("weight")), "query-weights")

    def one(group: int) -> DataFrame:
        mine = weighed.filter(F.col("group") == group)
        queries: dict[int | None, list[tuple[str, int]]] = {}
        for r in mine.select("item_id", "term", "weight").toLocalIterator():
            queries.setdefault(r[0], []).append((r[1], r[2]))
        sent = spark.sparkContext.broadcast(list(queries.items()))
        asked = mine.select("term").distinct().unionByName(spark.range(1).select(F.lit("").alias("term")))
        blocks = index.join(asked, "term", "left_semi")
        return blocks.groupBy("shard").applyInArrow(lambda shard: search_shard(shard, sent.value, n, total, k), "item_id long, doc_id long, score long")

    found = reduce(DataFrame.unionByName, [one(g) for g in range(groups)])
    heaps = ranked(found.withColumn("heap", F.pmod(F.xxhash64("doc_id"), F.lit(HEAP_GROUPS))), k, "item_id", "heap").drop("rank", "heap")
    return ranked(heaps, k, "item_id").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Build the index of ``docs``, keep it as a table in the shared folder and search it; see ``build_index`` and ``search``.

    Null texts and those without a term are in no count and never found. A text of any length is split piece by piece and is one
    document of one shard.
    """
    return search(materialize(build_index(docs), "index"), items, k)
