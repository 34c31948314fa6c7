"""Operator 5: document fingerprints as threshold-scaled sketches. DataFrame and SQL functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricegrain.llm.common import IdRanges

#: Words of a shingle, and one in how many hashes a sketch keeps.
SHINGLE, SCALE = 5, 8
#: Hashes below this stay: the lowest 1 / SCALE of all 64-bit values.
THRESHOLD = -(2**63) + 2**64 // SCALE


def named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where lambdas refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sketch(text: Column) -> Column:
    """Sorted distinct hashes, below the threshold, of the word shingles of a text; where none is, the smallest.

    Words are what white space parts, A-Z lower-cased. A text of fewer words than a shingle is one shingle;
    one without words has an empty sketch. The fallback leaves only texts without words an empty sketch, and
    ``merged`` takes it out again as soon as the other document has a hash below the threshold, so that the
    sketch of two documents' shingles follows from their sketches.
    """
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lower, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def kept(w: Column) -> Column:
        last = F.greatest(F.size(w) - SHINGLE, F.lit(0))
        hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
        return F.when(F.size(w) > 0, named(hashes, lambda h: named(F.filter(h, lambda x: x < F.lit(THRESHOLD)), lambda low: F.when(F.size(low) > 0, low).otherwise(F.array(F.array_min(h)))))).otherwise(F.array().cast("array<bigint>"))

    return F.array_sort(F.array_distinct(named(words, kept)))


def as_text(sketch: Column) -> Column:
    """16 hexadecimal digits for each hash, in order of the signed values."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Resemblance of two sketches: common hashes among all; two empty ones are alike."""
    common = F.size(F.array_intersect(a, b))
    both = F.size(a) + F.size(b) - common
    return F.when(both > 0, common / both).otherwise(F.lit(1.0))


def contained(a: Column, b: Column) -> Column:
    """Share of a's hashes that b has, an estimate of how much of the first document the second holds: fit for very unequal lengths. An empty sketch is contained in any."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.lit(1.0))


def merged(a: Column, b: Column) -> Column:
    """The sketch of both documents' shingles together."""
    both = F.array_sort(F.array_union(a, b))
    low = F.filter(both, lambda x: x < F.lit(THRESHOLD))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def with_next(docs: DataFrame, ranges: IdRanges) -> DataFrame:
    """Each row with the text and sketch of the next in order of doc_id, after the last those of the first.

    Rows are dealt by range of ids; the first of each range also goes, as a guest, to the range before.
    Equal ids follow one another in order of text.
    """
    d = docs.withColumn("range", ranges.of(F.col("doc_id")))
    firsts = d.groupBy("range").agg(F.min("doc_id").alias("first_id"))
    # at most MAX_RANGES rows: a bound that holds at any size, also for the window without partitions and the broadcast
    order = Window.orderBy("range")
    before = F.coalesce(F.lag("range").over(order), F.max("range").over(Window.partitionBy()))
    firsts = firsts.select("first_id", before.alias("before"))
    own = F.struct(F.col("range").alias("home"), F.lit(False).alias("guest"))
    d = d.join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("first_id")), "left").select("*", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("before").alias("home"), F.lit(True).alias("guest"))))).alias("p"))
    follow = Window.partitionBy("p.home").orderBy("p.guest", "doc_id", "text")
    return d.withColumns({"next_text": F.lead("text").over(follow), "next_sketch": F.lead("sketch").over(follow)}).filter(~F.col("p.guest"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of each whole text and of its edited text, and how alike they and the next document's are.

    The edited text has its last floor(n / 2) code points replaced by the first as many (or all) of the next
    document in order of doc_id; after the last comes the first. Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, and containment both ways: in_edited and
    edited_in, in_next and next_in. A null text
    counts as empty and has an empty fingerprint, equal to that of any text without words; a table of one
    row is its own next; repeated ids follow one another; null ids come first.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    d = d.withColumn("sketch", sketch(F.col("text")))
    d = with_next(d, IdRanges(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id"))
    n = F.char_length("text").cast("long")
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n - half).cast("int")), F.substring("next_text", F.lit(1), half))
    d = d.select("doc_id", n.alias("n_chars"), "sketch", "next_sketch", edited.alias("edited")).withColumn("edited_sketch", sketch(F.col("edited")))
    return d.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        contained(F.col("sketch"), F.col("edited_sketch")).alias("in_edited"), contained(F.col("edited_sketch"), F.col("sketch")).alias("edited_in"),
        contained(F.col("sketch"), F.col("next_sketch")).alias("in_next"), contained(F.col("next_sketch"), F.col("sketch")).alias("next_in"),
    )
