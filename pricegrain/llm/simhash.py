"""Operator 7: SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

import math
from itertools import accumulate, combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrain.llm.common import map_batches, materialize, tasks_for, texts
from pricegrain.llm.graph import components

#: Words of a shingle, seed of its hash, bits that may differ.
SHINGLE, SEED, RADIUS = 4, 42, 4
#: Shingles hashed at a time, variants held at a time, and fingerprints that a bucket has on average.
CHUNK, MOST_VARIANTS, PER_BUCKET = 1 << 16, 1 << 20, 256
#: Fingerprints from which a bucket is split by the next bits of the variants, and bits of such a step.
HOT_BUCKET, MORE_BITS = 262_144, 8
#: Fingerprints of buckets that one task has on average.
PER_TASK = 1 << 21


def fingerprint_of(text: str | None) -> int:
    """64-bit SimHash: a bit is 1 if set in over half of the shingles' hashes, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    n = max(1, len(words) - SHINGLE + 1)
    width = min(SHINGLE, len(words))
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        hashes = np.array([xxhash.xxh64_intdigest(joined[starts[i] : starts[i + width] - 1], SEED) for i in range(at, min(n, at + CHUNK))], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def simhashes(docs: DataFrame) -> DataFrame:
    """doc_id, fp: the fingerprint as a signed 64-bit number."""

    def run(batches):
        for batch in batches:
            yield {"doc_id": batch["doc_id"], "fp": np.array([fingerprint_of(t) for t in batch["text"]], np.uint64).astype(np.int64)}

    return map_batches(texts(docs), "doc_id long, fp long", run)


def flips(bits: int, most: int) -> list[tuple[int, int]]:
    """(mask, number of bits) of every way to flip up to ``most`` of the low ``bits`` bits."""
    return [(sum(1 << b for b in c), k) for k in range(most + 1) for c in combinations(range(bits), k)]


def roots_of(pairs: np.ndarray) -> dict[int, int]:
    """Union-find over unique index pairs: node to the root of its tree."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs.tolist():
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


class Bucket:
    """Variants of one prefix bucket: which fingerprints share one."""

    def __init__(self, half: int):
        self.half = half
        self.masks: dict[tuple[int, int], np.ndarray] = {}

    def low_masks(self, bits: int, most: int) -> np.ndarray:
        key = (bits, most)
        if key not in self.masks:
            self.masks[key] = np.array([m for m, _ in flips(bits, most)], np.uint64)
        return self.masks[key]

    def edges(self, fps: np.ndarray, prefixes: np.ndarray, used: np.ndarray, bits: int):
        """Yield arrays (a, b) of fingerprints that share a variant.

        Row i stands for the variants of ``fps[i]`` whose first ``bits`` bits are ``prefixes[i]``, which
        took ``used[i]`` flips. Too many variants at once are split by the next bits of the variant.
        """
        low = 64 - bits
        size = np.array([len(self.low_masks(low, self.half - d)) for d in range(self.half + 1)])
        if size[used].sum() > MOST_VARIANTS and bits < 64:
            step = min(6, low)
            own = (fps >> np.uint64(low - step)) & np.uint64((1 << step) - 1)
            for tail in range(1 << step):
                more = used + np.bitwise_count(own ^ np.uint64(tail)).astype(np.int64)
                keep = more <= self.half
                if keep.sum() > 1:
                    yield from self.edges(fps[keep], prefixes[keep] << np.uint64(step) | np.uint64(tail), more[keep], bits + step)
            return
        variants, owners = [], []
        for d in range(self.half + 1):
            if not (at := np.flatnonzero(used == d)).size:
                continue
            masks = self.low_masks(low, self.half - d)
            base = prefixes[at] if not low else (fps[at] & np.uint64((1 << low) - 1) if not bits else prefixes[at] << np.uint64(low) | fps[at] & np.uint64((1 << low) - 1))
            variants.append((base[:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(at, len(masks)))
        v, o = np.concatenate(variants), np.concatenate(owners)
        order = np.argsort(v)
        v, o = v[order], o[order]
        same = np.flatnonzero(v[1:] == v[:-1])
        if same.size:
            a, b = o[same].astype(np.int64), o[same + 1].astype(np.int64)
            pairs = np.unique(np.minimum(a, b) * len(fps) + np.maximum(a, b))
            pairs = np.stack([pairs // len(fps), pairs % len(fps)], 1)
            tree = [(x, r) for x, r in roots_of(pairs).items() if x != r]
            yield fps[[x for x, _ in tree]], fps[[r for _, r in tree]]


def deepened(dealt: DataFrame, bits: int, half: int) -> DataFrame:
    """The same variants, in buckets of the first ``bits`` + MORE_BITS bits of the variant."""
    low = 64 - bits - MORE_BITS
    own = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << MORE_BITS) - 1))
    marks = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(k).alias("more")) for m, k in flips(MORE_BITS, half)])
    prefix = F.shiftleft("prefix", MORE_BITS).bitwiseOR(own.bitwiseXOR(F.col("m.mask")))
    deeper = dealt.select("fp", "prefix", "used", F.explode(marks).alias("m")).filter(F.col("used") + F.col("m.more") <= half)
    return deeper.select("fp", prefix.alias("prefix"), (F.col("used") + F.col("m.more")).alias("used"))


def ball_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: pairs of fingerprints that links at ``radius`` or fewer bits join, enough to keep all components.

    Every fingerprint has all variants within half the radius; two that share one differ in at most the
    radius, and two that differ in at most the radius share one. The shuffle on variants carries each
    fingerprint once for every prefix that its variants have; the task of a prefix spells the variants out,
    sorts them and joins the owners of each, so no pair needs a second look. Its links leave the task as
    trees: each fingerprint with the root of its tree. A variant has at most
    1 + 64 + 2016 owners, whatever the table holds. The number of prefix bits follows the table's size; a
    prefix of more than HOT_BUCKET fingerprints is split by further bits until none is so large, or until
    the prefix is nearly the whole variant.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    half = radius // 2
    n = fps.count()
    bits = max(0, min(40, math.ceil(math.log2(max(1, n) / PER_BUCKET))))
    low = 64 - bits
    marks = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(k).alias("used")) for m, k in flips(bits, half)])
    dealt = fps.select("fp", F.explode(marks).alias("m")).select("fp", ((F.shiftrightunsigned("fp", low) if bits else F.lit(0)).cast("long").bitwiseXOR(F.col("m.mask"))).alias("prefix"), F.col("m.used").cast("long").alias("used"))
    # sizes of the buckets from those of the fingerprints' own prefixes, without spelling the variants out
    own = fps.groupBy((F.shiftrightunsigned("fp", low) if bits else F.lit(0)).cast("long").alias("own")).count()
    sizes = own.select(F.col("count"), F.explode(marks).alias("m"), "own").groupBy(F.col("own").bitwiseXOR(F.col("m.mask")).alias("prefix")).agg(F.sum("count").alias("count"))
    found = None
    while True:
        hot = None
        if bits + MORE_BITS < 56:
            hot = materialize(sizes.filter(F.col("count") > HOT_BUCKET).select("prefix"), "hot-buckets")
            hot = hot if hot.head(1) else None
        part = links_in_buckets(dealt if hot is None else dealt.join(hot, "prefix", "left_anti").select(dealt.columns), bits, half, tasks_for(fps.sparkSession, n * len(flips(bits, half)), PER_TASK))
        found = part if found is None else found.unionByName(part)
        if hot is None:
            return found.distinct()
        dealt = materialize(deepened(dealt.join(hot, "prefix", "left_semi"), bits, half), "hot-fingerprints")
        sizes = dealt.groupBy("prefix").count()
        n = dealt.count() // len(flips(bits + MORE_BITS, half))
        bits += MORE_BITS


def links_in_buckets(dealt: DataFrame, bits: int, half: int, parts: int) -> DataFrame:
    """a, b: links that the fingerprints of each prefix make, which come with the flips it took."""

    def run(batches):
        bucket = Bucket(half)
        held: list[list[np.ndarray]] = []

        def done():
            fp, prefix, used = (np.concatenate(x) for x in zip(*held, strict=True))
            cuts = np.flatnonzero(np.diff(prefix)) + 1
            for one in np.split(np.arange(len(fp)), cuts):
                if len(one) > 1:
                    for a, b in bucket.edges(fp[one].view(np.uint64), prefix[one].view(np.uint64), used[one], bits):
                        yield {"a": a.view(np.int64), "b": b.view(np.int64)}

        for batch in batches:
            rows = [np.ascontiguousarray(batch[k], np.int64) for k in ("fp", "prefix", "used")]
            first = np.searchsorted(rows[1], rows[1][-1])  # the last prefix may go on in the next batch
            if held and first:
                held.append([r[:first] for r in rows])
                yield from done()
                held = [[r[first:] for r in rows]]
            elif held and held[-1][1][-1] != rows[1][0]:
                yield from done()
                held = [rows]
            elif first:
                held = [[r[:first] for r in rows]]
                yield from done()
                held = [[r[first:] for r in rows]]
            else:
                held.append(rows)
        if held:
            yield from done()

    return map_batches(dealt.repartition(parts, "prefix").sortWithinPartitions("prefix"), "a long, b long", run, arrow=("fp", "prefix", "used"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Fingerprint and component of each whole text.

    Returns doc_id, fp (signed), fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id
    that links reach. Texts with equal fingerprints are linked, those without words (null, empty, white
    space) too: their fingerprint is zero. A text of fewer words than a shingle is one shingle. Equal
    fingerprints are treated once, as classes, so groups of copies cost no more than their members. Null ids
    never become a component_id unless a component has no other.
    """
    prints = materialize(simhashes(docs), "fingerprints")
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(ball_links(classes.select("fp"), radius))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
