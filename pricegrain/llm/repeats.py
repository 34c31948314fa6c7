"""Operator 8: exact repeated passages by blockwise suffix sorting with a difference cover."""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricegrain.llm.common import IdRanges, append_columns, map_batches, materialize, tasks_for, texts
from pricegrain.llm.decontaminate import BASE, ONE, mixed

#: Bytes of a passage, of the anchor that stands for the windows around it, and of text handled at a time.
LENGTH, ANCHOR, CHUNK = 100, 24, 1 << 17
#: Period of the difference cover, and bytes whose order the cover's samples are ranked by.
PERIOD = 32
SAMPLE = LENGTH - PERIOD
#: Bytes of text whose anchors one task gets on average.
PER_TASK = 32 << 20
#: Windows sorted at a time, and contexts of one anchor from which Spark deals them out by window instead.
MOST_WINDOWS, HOT_GROUP = 1 << 18, 4096
OTHER_BASE = 0xD6E8FEB86659FD93


def difference_cover(period: int) -> np.ndarray:
    """Residues such that any two positions have a common shift that takes both into the set."""
    step = int(np.ceil(np.sqrt(period)))
    return np.unique([*range(step), *range(0, period, step)])


def common_shifts(period: int) -> np.ndarray:
    """[i, j] -> the least shift d with i + d and j + d both in the cover."""
    cover = np.isin(np.arange(period), difference_cover(period))
    table = np.full((period, period), -1, np.int64)
    at = np.arange(period)
    for d in range(period - 1, -1, -1):
        inside = cover[(at + d) % period]
        table[inside[:, None] & inside[None, :]] = d
    assert (table >= 0).all()
    return table


class Anchors:
    """Cuts documents into windows grouped by their anchor.

    The anchor of a window of LENGTH bytes is its ANCHOR-byte string of least hash, the first on ties. It
    depends on the window alone, so equal windows have equal anchors at equal places.
    """

    def __init__(self):
        n = CHUNK + 1
        powers = lambda base: np.multiply.accumulate(np.concatenate(([ONE], np.full(n, base, np.uint64))))
        self.p1, self.i1, self.p2, self.i2 = (powers(b) for b in (BASE, pow(BASE, -1, 1 << 64), OTHER_BASE, pow(OTHER_BASE, -1, 1 << 64)))

    def of(self, b: np.ndarray, ends: np.ndarray, starts: np.ndarray):
        """Anchor hash, context hash, place of the first window, number of windows, anchor's place in it.

        ``b`` holds the documents end to end; places count from its start.
        """
        m = len(b)
        x = b.astype(np.uint64) + ONE
        t1, t2 = np.zeros(m + 1, np.uint64), np.zeros(m + 1, np.uint64)
        np.cumsum(x * self.p1[:m], out=t1[1:])
        np.cumsum(x * self.p2[:m], out=t2[1:])
        h = mixed((t1[ANCHOR:] - t1[:-ANCHOR]) * self.i1[: m + 1 - ANCHOR])
        low = h >> np.uint64(24) << np.uint64(24) | np.arange(len(h), dtype=np.uint64)
        width, want = 1, LENGTH - ANCHOR + 1
        while 2 * width <= want:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[: m - LENGTH + 1], low[want - width :][: m - LENGTH + 1])
        valid = np.zeros(m + 1, np.int32)
        fit = ends - starts >= LENGTH
        np.add.at(valid, starts[fit], 1)
        np.add.at(valid, ends[fit] - LENGTH + 1, -1)
        at = np.flatnonzero(np.cumsum(valid)[: m - LENGTH + 1])
        anchor = (low[at] & np.uint64((1 << 24) - 1)).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))) if len(at) else np.empty(0, np.int64)
        n = np.diff(np.append(new, len(at)))
        first, anchor = at[new], anchor[new]
        off = anchor - first
        c = mixed(((t2[first + n - 1 + LENGTH] - t2[first]) * self.i2[first]) ^ (n * 256 + off).astype(np.uint64))
        return h[anchor], c, first, n, off


def packed_chunks(ids: list[int], datas: list[bytes]):
    """(buffer, document number, start and end in the buffer, start in the document) for up to CHUNK bytes; longer documents overlap by LENGTH - 1."""
    parts: list[tuple[int, int, int]] = []
    size = 0

    def whole():
        lengths = np.array([e - s for _, s, e in parts])
        ends = np.cumsum(lengths)
        return np.frombuffer(b"".join(datas[k][s:e] for k, s, e in parts), np.uint8), np.array([k for k, _, _ in parts]), ends - lengths, ends, np.array([s for _, s, _ in parts])

    for k, data in enumerate(datas):
        at = 0
        while len(data) - at >= LENGTH:
            end = min(len(data), at + CHUNK)
            if parts and size + end - at > CHUNK:
                yield whole()
                parts, size = [], 0
            parts.append((k, at, end))
            size += end - at
            if end == len(data):
                break
            at = end - LENGTH + 1
    if parts:
        yield whole()


def runs(doc: np.ndarray, p0: np.ndarray, n: np.ndarray):
    """Join neighbouring ranges of windows, sorted by document and place."""
    if not len(doc):
        return doc, p0, n
    cut = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (p0[1:] > (p0 + n)[:-1]))))
    ends = np.maximum.reduceat(p0 + n, cut)
    return doc[cut], p0[cut], ends - p0[cut]


ANCHOR_ROWS = "dup boolean, akey long, c long, doc long, p0 long, no int"


def anchor_rows(keyed: DataFrame) -> DataFrame:
    """One row per anchor of each document; of equal contexts within a batch all but the first are marked and joined to ranges."""

    def run(batches):
        anchors = Anchors()
        for batch in batches:
            ids = np.array(batch["doc"], np.int64)
            found = []
            for b, k, starts, ends, offset in packed_chunks(batch["doc"], [(t or "").encode() for t in batch["text"]]):
                akey, c, first, n, off = anchors.of(b, ends, starts)
                part = np.searchsorted(starts, first, "right") - 1
                found.append((akey.view(np.int64), c.view(np.int64), ids[k[part]], first - starts[part] + offset[part], n, off))
            if not found:
                continue
            akey, c, doc, p0, n, off = map(np.concatenate, zip(*found, strict=True))
            order = np.lexsort((p0, doc, c, akey))
            akey, c, doc, p0, n, off = (x[order] for x in (akey, c, doc, p0, n, off))
            dup = np.concatenate(([False], (akey[1:] == akey[:-1]) & (c[1:] == c[:-1])))
            order = np.lexsort((p0[dup], doc[dup]))
            d, p, w = runs(doc[dup][order], p0[dup][order], n[dup][order])
            one = ~dup
            yield {
                "dup": np.repeat([False, True], [one.sum(), len(d)]), "akey": np.concatenate((akey[one], d * 1_000_003 + p)), "c": np.concatenate((c[one], np.zeros(len(d), np.int64))),
                "doc": np.concatenate((doc[one], d)), "p0": np.concatenate((p0[one], p)), "no": np.concatenate((n[one] * 128 + off[one], w)).astype(np.int32),
            }

    return map_batches(keyed, ANCHOR_ROWS, run)


def first_contexts(rows: DataFrame, parts: int) -> DataFrame:
    """Mark the contexts that occurred before; keep the first ones only where their anchor has others.

    Rows come sorted by anchor, context, document and place, so that the first of equal contexts leads. Two
    contexts count as equal when both their hashes, of the anchor and of the context, are.
    """
    names = ("akey", "c", "doc", "p0", "no")

    def run(batches):
        last = None  # of the batch before: anchor, context, and its first context if that is the only one yet

        for batch in batches:
            dup = batch["dup"].astype(bool)
            passed = {k: batch[k][dup] for k in names}
            akey, c, doc, p0, no = (batch[k][~dup] for k in names)
            out = [np.ones(dup.sum(), bool)], [passed["akey"]], [passed["doc"]], [passed["p0"]], [passed["no"]]
            if len(akey):
                before_a, before_c = (last[0], last[1]) if last else (~akey[0], 0)
                a_prev, c_prev = np.concatenate(([before_a], akey[:-1])), np.concatenate(([before_c], c[:-1]))
                new_a = akey != a_prev
                new_c = new_a | (c != c_prev)
                run_no = np.cumsum(new_a)  # 0: the anchor of the batch before goes on
                contexts = np.bincount(run_no, new_c, minlength=run_no[-1] + 1).astype(int)
                lone = last[2] if last else None
                if contexts[0] and lone is not None:
                    for column, value in zip(out, (False, *lone), strict=True):
                        column.append(np.array([value]))
                    lone = None
                many = contexts >= 2
                many[0] = True  # what goes on with a new context has another before it
                tail_open = run_no[-1] > 0 and not many[run_no[-1]]
                again, amb = ~new_c, new_c & many[run_no]
                for flag, value in ((again, True), (amb, False)):
                    for column, x in zip(out, (np.full(flag.sum(), value), akey[flag], doc[flag], p0[flag], no[flag]), strict=True):
                        column.append(x)
                out[4][-2][:] = no[again] // 128
                if tail_open:
                    i = np.flatnonzero(new_a)[-1]
                    lone = (akey[i], doc[i], p0[i], no[i])
                elif run_no[-1] > 0:
                    lone = None
                last = (akey[-1], c[-1], lone)
            yield {k: np.concatenate(x) for k, x in zip(("dup", "akey", "doc", "p0", "no"), out, strict=True)}

    dealt = rows.repartition(parts, "akey").sortWithinPartitions("akey", "c", "doc", "p0")
    return map_batches(dealt, "dup boolean, akey long, doc long, p0 long, no int", run, arrow=("dup", *names))


class CoverSort:
    """Suffix sorting of the windows of some contexts, one bucket of anchors at a time.

    Windows are sorted by their first and last PERIOD bytes. Ties are settled by the ranks of the sample
    positions, those in the difference cover: two tied windows share a shift below PERIOD that takes both
    into the sample, and a sample's SAMPLE bytes reach from there to the last PERIOD bytes. So ties of any
    length cost one comparison, and memory holds ranks for the sample only.
    """

    def __init__(self):
        self.cover = np.isin(np.arange(PERIOD), difference_cover(PERIOD))
        self.shift = common_shifts(PERIOD)

    def repeated(self, group: np.ndarray, contexts: list[bytes], n: np.ndarray, off: np.ndarray) -> np.ndarray:
        """For each window, context after context: whether an equal one of its group stands before it.

        Contexts must come in order of document and place.
        """
        text = np.frombuffer(b"".join(contexts) + bytes(8), np.uint8)
        lengths = n + LENGTH - 1
        starts = np.cumsum(lengths) - lengths
        words = np.zeros(len(text) - 7, np.uint64)
        for i in range(8):
            words = words << np.uint64(8) | text[i : len(text) - 7 + i].astype(np.uint64)
        ranks = self.sample_ranks(words, starts, lengths)
        owner = np.repeat(np.arange(len(n)), n)
        x = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + starts[owner]
        bucket = group[owner]
        keys = [words[x + k] for k in range(0, PERIOD, 8)] + [words[x + LENGTH - PERIOD + k] for k in range(0, PERIOD, 8)]
        order = np.lexsort((*keys[::-1], bucket))
        tied = bucket[order][1:] == bucket[order][:-1]
        for key in keys:
            key = key[order]
            tied &= key[1:] == key[:-1]
        tie = np.cumsum(np.concatenate(([True], ~tied)))
        again = np.zeros(len(x), bool)
        left = np.flatnonzero(np.concatenate((tied, [False])) | np.concatenate(([False], tied)))
        while len(left):
            ties, first = np.unique(tie[left], return_index=True)
            pivot = left[first[np.searchsorted(ties, tie[left])]]
            a, b = x[order[pivot]], x[order[left]]
            d = self.shift[a % PERIOD, b % PERIOD]
            same = ranks[a + d] == ranks[b + d]
            again[order[left[same & (left != pivot)]]] = True
            left = left[~same]
        return again

    def sample_ranks(self, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        inside = np.zeros(len(words) + 1, np.int32)
        np.add.at(inside, starts, 1)
        np.add.at(inside, starts + lengths - SAMPLE + 1, -1)
        at = np.flatnonzero((np.cumsum(inside)[:-1] > 0) & self.cover[np.arange(len(words)) % PERIOD])
        keys = [words[at + k] for k in (*range(0, SAMPLE - 7, 8), SAMPLE - 8)]
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(at), bool)
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        ranks = np.full(len(words), -1, np.int64)
        ranks[at[order]] = np.cumsum(new)
        return ranks


def context_rows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """akey, doc, p0, no, hot and the bytes of each wanted context."""
    lists = wanted.groupBy("doc").agg(F.collect_list(F.struct("akey", "p0", "no", "hot")).alias("places"))  # no longer than the document

    def cut(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = {k: [] for k in ("akey", "doc", "p0", "no", "hot", "bytes")}
            for doc, packed, places in zip(batch["doc"], batch["packed"], batch["places"], strict=True):
                data = unpack(packed)
                for r in places:
                    for name, value in zip(out, (r["akey"], doc, r["p0"], r["no"], r["hot"], data[r["p0"] : r["p0"] + r["no"] // 128 + LENGTH - 1]), strict=True):
                        out[name].append(value)
            yield out

    return map_batches(docs.join(lists, "doc"), "akey long, doc long, p0 long, no int, hot boolean, bytes binary", cut)


def repeated_in_groups(contexts: DataFrame, parts: int) -> DataFrame:
    """doc, p0, no: ranges of windows that occurred before, among contexts of one anchor."""

    def run(batches):
        sorter = CoverSort()
        names = ("akey", "doc", "p0", "no", "bytes")
        held = {k: [] for k in names}

        def done():
            no = np.array(held["no"], np.int64)
            n, off = no // 128, no % 128
            doc, p0, akey = (np.array(held[k], np.int64) for k in ("doc", "p0", "akey"))
            order = np.lexsort((p0, doc, akey))
            n, off, doc, p0, akey = (x[order] for x in (n, off, doc, p0, akey))
            again = sorter.repeated(np.cumsum(np.concatenate(([0], akey[1:] != akey[:-1]))), [held["bytes"][i] for i in order], n, off)
            owner = np.repeat(np.arange(len(n)), n)
            place = p0[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            d, p = doc[owner][again], place[again]
            order = np.lexsort((p, d))
            d, p, w = runs(d[order], p[order], np.ones(len(d), np.int64))
            return {"doc": d, "p0": p, "no": w}

        windows = 0
        for batch in batches:
            for row in zip(*(batch[k] for k in names), strict=True):
                if windows > MOST_WINDOWS and row[0] != held["akey"][-1]:
                    yield done()
                    held, windows = {k: [] for k in names}, 0
                for k, value in zip(names, row, strict=True):
                    held[k].append(value)
                windows += row[3] // 128
        if held["akey"]:
            yield done()

    return map_batches(contexts.select("akey", "doc", "p0", "no", "bytes").repartition(parts, "akey").sortWithinPartitions("akey"), "doc long, p0 long, no int", run)


def repeated_by_window(contexts: DataFrame) -> DataFrame:
    """The same for anchors with very many contexts: windows are dealt out one by one, minima taken before the shuffle."""
    windows = contexts.select("doc", "p0", "bytes", F.explode(F.sequence(F.lit(0), F.floor(F.col("no") / 128).cast("int") - 1)).alias("i"))
    windows = windows.select(F.md5(F.substring("bytes", F.col("i") + 1, F.lit(LENGTH))).alias("window"), F.struct("doc", (F.col("p0") + F.col("i")).alias("p")).alias("place"))
    first = windows.groupBy("window").agg(F.min("place").alias("first"))
    return windows.join(first, "window").filter(F.col("place") > F.col("first")).select("place.doc", F.col("place.p").alias("p0"), F.lit(1).alias("no"))


def with_unique_keys(docs: DataFrame, carry: list[str]) -> DataFrame:
    """doc, doc_id, text, carried: ``doc`` is the id, or where ids repeat or are null the row's number in order of id and text."""
    d = texts(docs, F.struct(*carry or [F.lit(0).alias("none")]).alias("carried"))
    if not d.filter("doc_id is null").head(1) and not d.groupBy("doc_id").count().filter("count > 1").head(1):
        return d.withColumn("doc", F.col("doc_id"))
    ranges = IdRanges(d, "doc_id")
    d = d.withColumn("range", ranges.of(F.col("doc_id")))
    before = d.groupBy("range").count().select("range", (F.sum("count").over(Window.orderBy("range")) - F.col("count")).alias("before"))  # at most MAX_RANGES rows
    number = F.row_number().over(Window.partitionBy("range").orderBy("doc_id", "text"))
    return materialize(d.withColumn("number", number).join(F.broadcast(before), "range").select("doc_id", "text", "carried", (F.col("before") + F.col("number")).alias("doc")), "keyed")


def repeated_ranges(keyed: DataFrame) -> DataFrame:
    """doc, p0, no: ranges of window starts whose LENGTH bytes also start earlier."""
    size = keyed.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = tasks_for(keyed.sparkSession, size, PER_TASK)
    seen = materialize(first_contexts(anchor_rows(keyed.select("doc", "text")), parts), "contexts")
    unsure = seen.filter(~F.col("dup")).drop("dup")
    hot = unsure.groupBy("akey").count().filter(F.col("count") > HOT_GROUP).select("akey", F.lit(True).alias("hot"))
    contexts = materialize(context_rows(packed(keyed.select("doc", "text")), unsure.join(hot, "akey", "left")), "context-bytes")
    known = seen.filter("dup").select("doc", "p0", "no")
    return known.unionByName(repeated_in_groups(contexts.filter("hot is null"), parts)).unionByName(repeated_by_window(contexts.filter("hot")))


def packed(keyed: DataFrame) -> DataFrame:
    """The rows with the text compressed, as it is shuffled."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield {"packed": [pack((t or "").encode()) for t in batch["text"]]}

    return append_columns(keyed, ["text"], {"packed": "binary"}, run).drop("text")


def remove_repeats(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Each whole text without the bytes of LENGTH-byte strings that also start earlier.

    Earlier is a smaller doc_id, or an earlier start in the same document; strings may overlap and are
    judged on the input. Returns doc_id, n_bytes, n_removed, n_spans, kept (binary), and carried, a struct of
    the columns named in ``carry``. A null text counts as
    empty; texts shorter than LENGTH stay whole. Rows of one doc_id, and rows without, count as documents of
    their own, in order of text, null ids first. Very long texts are cut into overlapping pieces.

    Windows are grouped by an anchor in them, which equal windows share. A group of windows that equals one
    before it as a whole is settled by its hash; what is left, where repeats begin and end, is settled byte
    by byte by sorting the windows of one bucket of anchors after the other (``CoverSort``).
    """
    keyed = with_unique_keys(docs, carry or [])
    ranges = repeated_ranges(keyed).groupBy("doc").agg(F.collect_list(F.struct("p0", "no")).alias("ranges"))  # no longer than the document
    names = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept": "binary"}

    def cut(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for data, found in zip(map(unpack, batch["packed"]), batch["ranges"], strict=True):
                kept, at, removed, spans = [], 0, 0, 0
                for p0, no in sorted((r["p0"], r["no"]) for r in found or ()):
                    end = p0 + no - 1 + LENGTH
                    if p0 > at or not spans:
                        spans += 1
                        kept.append(data[at:p0])
                        removed += end - p0
                    else:
                        removed += max(0, end - at)
                    at = max(at, end)
                kept.append(data[at:])
                rows.append((len(data), removed, spans, b"".join(kept)))
            yield dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))

    return append_columns(packed(keyed).join(ranges, "doc", "left").select("doc_id", "carried", "packed", "ranges"), ["packed", "ranges"], names, cut).drop("packed", "ranges")

