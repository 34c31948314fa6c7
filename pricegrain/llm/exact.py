"""Operator 11: exact dedup by a tree merge of sorted digest runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrain.llm.common import materialize, tasks_for, texts

#: Characters that do not count when texts are compared.
BLANKS = r"[\x20\x09-\x0D]"
#: A round merges up to 2 ** FAN_BITS runs; rows that a run holds before there are more runs than shuffle partitions.
FAN_BITS, RUN_ROWS = 4, 1_000_000
#: What tells texts apart: a 64-bit digest, by which runs are sorted and cut, and what verifies that equal digests are equal texts.
SORTED_BY, VERIFIED_BY = "digest", ["sha", "n_bytes"]
TEXT = [SORTED_BY, *VERIFIED_BY]


def short_digest(normalised: Column) -> Column:
    return F.xxhash64(normalised)


def digests(docs: DataFrame) -> DataFrame:
    """A row for each document: where it was read, a number of its own, its digests; texts go no further than this."""
    plain = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", F.length("text").alias("n_chars"), F.regexp_replace("text", BLANKS, "").alias("plain"))
    return plain.select(
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"), "doc_id", F.col("n_chars").cast("long").alias("n_chars"),
        short_digest(F.col("plain")).alias(SORTED_BY), F.unhex(F.sha2("plain", 256)).alias("sha"), F.octet_length("plain").alias("n_bytes"),
    )


def merged(runs: DataFrame, *slot: str) -> DataFrame:
    """One entry per text and slot: the best row of all its entries, and how many rows they stand for."""
    return runs.groupBy(*slot, *TEXT).agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Of texts that are equal but for blanks the longest row stays, of these the one of smallest doc_id.

    Returns doc_id, keep_id, group_size, kept, text_sha256, one row per input row. A null text counts as
    empty. Null ids come after all others; of rows that agree in length and id one stays, that which was read first.
    Only ids and digests are kept of a text, however long; other columns are not read.

    Rows are dealt to runs as they are read, and each run is sorted by digest, one entry for each text. A round
    merges 2**b runs each: task (group of runs, range of digests) gets that range of its runs, so that
    runs grow longer while ranges get shorter and a task's share stays the same. Entries meet by the 64-bit
    digest and are one only if SHA-256 and length agree too. A text however frequent is one entry of a run, and so
    2**b entries of a merge. On the way back the last level's entries tell those before them, down to the rows.
    """
    spark = docs.sparkSession
    rows = materialize(digests(docs), "digests")
    n, parts = rows.agg(F.count(F.lit(1)), F.max("part")).first()
    runs = max(1, min(tasks_for(spark, n, RUN_ROWS), (parts or 0) + 1))
    bits = max(1, (runs - 1).bit_length())
    rounds = -(-bits // FAN_BITS)
    step = -(-bits // rounds)

    rows = rows.withColumn("run", (F.col("part") % runs).cast("int"))
    best = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    levels = [materialize(merged(rows.select("run", *TEXT, best.alias("best"), F.lit(1).cast("long").alias("n")), "run"), "runs")]
    for k in range(1, rounds + 1):
        group, part = F.shiftright("run", step), F.shiftrightunsigned(SORTED_BY, 64 - step * k)
        entries = levels[-1].withColumn("run", group).withColumn("slot", (F.shiftleft("run", step * k) + part).cast("int"))
        level = merged(entries.repartitionById(1 << (step * rounds), F.col("slot")).sortWithinPartitions("slot", *TEXT), "slot", "run")
        levels.append(materialize(level.select("run", *TEXT, "best", "n"), "runs"))

    told = levels.pop().select("run", *TEXT, F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), F.col("n").alias("group_size"))
    while levels:
        below = levels.pop().select(F.col("run").alias("below"), F.shiftright("run", step).alias("run"), *TEXT)
        told = below.join(told, ["run", *TEXT]).drop("run").withColumnRenamed("below", "run")
    return rows.join(told, ["run", *TEXT]).select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
