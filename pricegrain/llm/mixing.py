"""Operator 10: mixing sources to target weights. DataFrame and SQL functions only."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from pricegrain.llm.common import IdRanges, materialize, not_above, tasks_for

#: Fixed values of the mix: weights of the sources in turn, share of all sizes, and most repeats.
WEIGHTS, SHARE, REPEATS = (3, 1, 2), 1.5, 2
#: Words of a block, slots of an output shard, rounds of the permutation, prime and factors of its arithmetic hash.
BLOCK, SHARD, ROUNDS = 64, 65_536, 12
PRIME, FACTOR, STEP, HIGH = 2_147_483_647, 48_271, 69_621, 40_692
#: Most sources that can be mixed; what is sent about them is bounded by it. Slots that one task spells out.
MOST_SOURCES, PER_TASK = 32_768, 1 << 20


def hashed(x: Column, salt: Column | int) -> Column:
    """A pseudorandom number from 0 to PRIME - 1 for a number below PRIME squared."""
    y = F.pmod((F.pmod(x, F.lit(PRIME)) + F.lit(1)) * F.lit(FACTOR) + F.call_function("div", x, F.lit(PRIME)) * F.lit(HIGH) + F.lit(salt) * F.lit(STEP), F.lit(PRIME))
    return F.pmod(y * (y + F.lit(STEP)), F.lit(PRIME))


def permuted(df: DataFrame, index: str, n: str, source_no: str) -> DataFrame:
    """``df`` with its column ``index`` replaced by its place in a pseudorandom permutation of 0..n-1, one for each source (swap-or-not shuffle).

    Every round is two projections of its own, so that what one computes is not repeated in the next.
    """
    rest = [c for c in df.columns if c != index]
    d = df.withColumnRenamed(index, "x")
    for r in range(ROUNDS):
        key = F.lit(r).cast("long") + F.col(source_no) * F.lit(ROUNDS)
        d = d.select(*rest, "x", F.pmod(hashed(key, 7) * F.lit(PRIME) + hashed(key, 13) - F.col("x"), F.col(n)).alias("partner"))
        swaps = F.pmod(hashed(F.greatest("x", "partner") + F.lit(r * 1_000_003), F.col(source_no)), F.lit(2)) == 1
        d = d.select(*rest, F.when(swaps, F.col("partner")).otherwise(F.col("x")).alias("x"))
    return d.withColumnRenamed("x", index)


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: words of the whole text (null: 0)."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
    )


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_no, source_size, target: one row per source.

    Sources in code-point order, null last, weigh 3, 1, 2 in turn and share 150 % of all sizes. Targets
    stop at twice the source's size; what is over goes to the others by weight until none is above.
    Filling in order of cap by weight gives that fixed point in one pass.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everywhere = Window.partitionBy()
    up_to = Window.orderBy("ratio", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    numbered = by.withColumn("source_no", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))).cast("long") - 1)
    weighed = numbered.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("source_no") % len(WEIGHTS)).cast("int") + 1)).withColumn("ratio", F.lit(float(REPEATS)) * F.col("source_size") / F.col("weight"))
    level = (
        weighed.withColumn("rest", F.lit(SHARE) * F.sum("source_size").over(everywhere) - F.lit(REPEATS) * F.coalesce(F.sum("source_size").over(up_to), F.lit(0)))
        .withColumn("heavy", F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(up_to), F.lit(0)))
        .withColumn("fits", F.col("rest") <= F.col("ratio") * F.col("heavy"))
        .withColumn("first", F.min(F.when(F.col("fits"), F.struct("ratio", "source_no", "rest", "heavy"))).over(everywhere))
    )
    capped = F.struct("ratio", "source_no") < F.struct("first.ratio", "first.source_no")
    return level.select("source", "source_no", "source_size", F.when(capped | F.col("first").isNull(), F.lit(float(REPEATS)) * F.col("source_size")).otherwise(F.col("weight") * F.col("first.rest") / F.col("first.heavy")).alias("target"))


def slot_plan(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """source_no, source, source_size, target, blocks, slots: the slots of the mix that each source shall fill.

    Slots are whole blocks, rounded on the cumulated targets, so that no source has more than twice its blocks.
    """
    t = targets.withColumn("upper", F.floor(F.sum("target").over(Window.orderBy("source_no")) / block + 0.5))
    slots = F.col("upper") - F.coalesce(F.lag("upper").over(Window.orderBy("source_no")), F.lit(0))
    return t.select("source_no", "source", "source_size", "target", F.ceil(F.col("source_size") / block).alias("blocks"), slots.alias("slots"))


def shard_counts(spark: SparkSession, plan: list[Row], shard: int = SHARD) -> DataFrame:
    """shard, source_no, n: multinomial draws, as many in each output shard as it has slots.

    Every slot of a shard draws its source from a hash of its number, with the plan's slots as weights.
    """
    uppers = list(accumulate(r["slots"] for r in plan))
    total = uppers[-1] if uppers else 0
    draws = spark.range(0, total, numPartitions=tasks_for(spark, total, PER_TASK))
    point = F.floor(hashed(F.col("id"), 11) * F.lit(float(total)) / F.lit(float(PRIME))).cast("long")
    return draws.select(F.floor(F.col("id") / shard).alias("shard"), not_above(uppers, point, "bigint").cast("long").alias("source_no")).groupBy("shard", "source_no").agg(F.count(F.lit(1)).alias("n"))


def mixture(spark: SparkSession, plan: list[Row], shard: int = SHARD) -> DataFrame:
    """shard, source_no, slot, block: the mix, a row for each slot with the block that fills it.

    A source's slots are numbered through all shards. Draws beyond what a source shall fill, by chance few,
    go to the sources that drew too little, in order. Slot j takes the block at place j modulo the number of
    blocks in the source's permutation, so that all blocks are used alike.
    """
    counts = materialize(shard_counts(spark, plan, shard), "shard-counts")
    drawn = dict(counts.groupBy("source_no").agg(F.sum("n")).collect())  # at most MOST_SOURCES rows
    at = lambda values, i: F.get(F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>"), i)
    wanted = [r["slots"] for r in plan] or [0]
    got = [drawn.get(i, 0) for i in range(len(wanted))]
    over = [0, *accumulate(max(0, g - w) for g, w in zip(got, wanted, strict=True))]
    short = list(accumulate(max(0, w - g) for g, w in zip(got, wanted, strict=True)))
    before = F.sum("n").over(Window.partitionBy("source_no").orderBy("shard")) - F.col("n")
    total = sum(wanted)
    # dealt out before they are spelt out: counts are few and would meet in one task
    dealt = counts.select("shard", "source_no", "n", before.alias("before")).repartition(tasks_for(spark, total, PER_TASK), "shard", "source_no")
    no, slot = F.col("source_no").cast("int"), F.col("slot")
    slots = dealt.select("shard", "source_no", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)).alias("slot"))
    slots = slots.select("shard", "source_no", "slot", (slot - at(wanted, no) + at(over, no)).alias("spare"), (slot >= at(wanted, no)).alias("moves"))
    slots = slots.withColumn("to", F.when(F.col("moves"), not_above(short, F.col("spare"), "bigint")).otherwise(no))
    moved = at(got, F.col("to")) + F.col("spare") - F.when(F.col("to") > 0, at(short, F.col("to") - 1)).otherwise(F.lit(0))
    slots = slots.select("shard", F.col("to").cast("long").alias("source_no"), F.when(F.col("moves"), moved).otherwise(slot).alias("slot"))
    slots = slots.withColumn("blocks", at([r["blocks"] for r in plan] or [1], F.col("source_no").cast("int")))
    return permuted(slots.withColumn("block", F.pmod("slot", "blocks")), "block", "blocks", "source_no").select("shard", "source_no", "slot", "block")


def mix(docs: DataFrame, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """Words that a weighted mix of all sources takes from each document.

    A source's words, document after document in order of doc_id, are packed into blocks of ``block`` words
    (the last may be short). The mix draws its sources shard by shard and its blocks by permuted index
    (``mixture``); blocks are joined to it by index, and none is used more than twice. Returns doc_id, source,
    size, source_size, target, taken, first_word: the place of the document's first word in its source.
    Texts that are null or empty have size 0 and take 0; the null source is a source of its own, last in
    order; null ids come first; repeated rows follow one another; a very long text takes part in many blocks.
    An empty table gives no rows. More than MOST_SOURCES sources are an error.
    """
    spark = docs.sparkSession
    sizes = materialize(document_sizes(docs), "sizes")
    targets = materialize(slot_plan(source_targets(sizes), block), "plan")
    plan = targets.orderBy("source_no").limit(MOST_SOURCES + 1).collect()
    if len(plan) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    # written, so that no filter of the join below is pushed through the permutation's rounds
    used = materialize(mixture(spark, plan, shard).groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("uses")), "used-blocks")

    ranges = IdRanges(sizes, "doc_id")
    placed = sizes.withColumn("range", ranges.of(F.col("doc_id")))
    # words before a document: those of earlier ranges, then those of its own range
    by_range = placed.groupBy("source", "range").agg(F.sum("size").alias("words"))
    before = by_range.select("source", "range", (F.sum("words").over(Window.partitionBy("source").orderBy("range")) - F.col("words")).alias("before"))
    known = before.alias("b").join(F.broadcast(targets).alias("p"), F.col("b.source").eqNullSafe(F.col("p.source"))).select("b.source", "b.range", "b.before", "p.source_no")
    own = F.sum("size").over(Window.partitionBy("source", "range").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    d = placed.withColumn("own", own).alias("d").join(known.alias("k"), F.col("d.source").eqNullSafe(F.col("k.source")) & (F.col("d.range") == F.col("k.range")))
    d = materialize(d.select("d.doc_id", "k.source_no", "d.size", (F.col("k.before") + F.col("d.own")).alias("first_word")), "placed")

    end = F.col("first_word") + F.col("size")
    b = F.col("block")
    touched = d.filter("size > 0").select("*", F.explode(F.sequence(F.floor(F.col("first_word") / block), F.floor((end - 1) / block))).alias("block"))
    held = touched.select("doc_id", "source_no", "size", "first_word", "block", (F.least(end, (b + 1) * F.lit(block)) - F.greatest(F.col("first_word"), b * F.lit(block))).alias("words"))
    taken = held.join(used, ["source_no", "block"], "left").groupBy("doc_id", "source_no", "size", "first_word").agg(F.sum(F.col("words") * F.coalesce("uses", F.lit(0))).alias("taken"))
    # rows without words are in no block, and may be alike
    every = taken.unionByName(d.filter("size = 0").withColumn("taken", F.lit(0).cast("long")))
    return every.join(F.broadcast(targets), "source_no").select("doc_id", "source", "size", "source_size", "target", "taken", "first_word")
