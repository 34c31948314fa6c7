"""Row numbers and running values within groups of any size: ranges of rows, a summary of each, offsets carried across."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricegrain.storage import checkpoint, free_name


def carried(rows: DataFrame, table: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Rows with a column of a table that has one row a key, null where it has none; null keys are equal."""
    names = {k: free_name(rows, f"of_{k}") for k in keys}
    right = table.select(*[F.col(k).alias(n) for k, n in names.items()], column)
    return rows.join(right, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]), "left").drop(*names.values())


def ranged(df: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, str]:
    """``df`` as a table cut into ranges of (group, order), with a column that numbers the ranges in order, and its name.

    The table is written, since another run would cut elsewhere. Rows that are equal in group and order share a range.
    """
    at = free_name(df, "range")
    return checkpoint(df.repartitionByRange(*group, *order).withColumn(at, F.spark_partition_id()), "ranges"), at


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``, the place from 1 of each row in its group, ascending, nulls first.

    Each range numbers its own rows of a group; to that comes how many rows of the group earlier ranges have. So a group is in
    no single task, however large; what meets in one is a count for each range.
    """
    rows, at = ranged(df, group, order)
    here, before = free_name(rows, "here"), free_name(rows, "before")
    counts = rows.groupBy(*group, at).agg(F.count(F.lit(1)).alias(here))
    earlier = Window.partitionBy(*group).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.sum(here).over(earlier)).filter(F.col(before).isNotNull()).drop(here)
    local = rows.withColumn(here, F.row_number().over(Window.partitionBy(*group, at).orderBy(*order)))
    return carried(local, counts, [*group, at], before).select(*df.columns, (F.col(here) + F.coalesce(before, F.lit(0))).cast("long").alias(name))


def running_sum(df: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``, the sum of ``value`` up to and with each row of its group, in the order of ``numbered``."""
    rows, at = ranged(df, group, order)
    here, before = free_name(rows, "here"), free_name(rows, "before")
    sums = rows.groupBy(*group, at).agg(F.sum(value).alias(here))
    earlier = Window.partitionBy(*group).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn(before, F.sum(here).over(earlier)).filter(F.col(before).isNotNull()).drop(here)
    upto = Window.partitionBy(*group, at).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn(here, F.sum(value).over(upto))
    return carried(local, sums, [*group, at], before).select(*df.columns, (F.col(here) + F.coalesce(before, F.lit(0))).alias(name))


def islands(df: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``, the number from 1 of each run of equal ``value`` in its group. A null begins a run, and so does what follows it.

    Ranges number their own runs. What a range tells the next is its first and last value and how many runs it has; a run that goes on
    across an edge counts once.
    """
    rows, at = ranged(df, group, order)
    here, before, new = (free_name(rows, n) for n in ("here", "before", "new"))
    w = Window.partitionBy(*group, at).orderBy(*order)
    begins = F.coalesce((F.lag(value).over(w) != F.col(value)).cast("long"), F.lit(1).cast("long"))
    local = rows.withColumn(new, begins).withColumn(here, F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    place = F.struct(*order)
    opened, closed, runs, goes_on = (free_name(rows, n) for n in ("opened", "closed", "runs", "goes_on"))
    edges = local.groupBy(*group, at).agg(F.min_by(value, place).alias(opened), F.max_by(value, place).alias(closed), F.sum(new).alias(runs))
    across = Window.partitionBy(*group).orderBy(at)
    edges = edges.withColumn(goes_on, F.coalesce((F.lag(closed).over(across) == F.col(opened)).cast("long"), F.lit(0).cast("long")))
    # the runs of ranges before, less one for each edge that a run goes across, this range's own among them
    total = F.sum(F.col(runs) - F.col(goes_on)).over(across.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(runs)
    edges = edges.select(*group, at, total.alias(before))
    return carried(local, edges, [*group, at], before).select(*df.columns, (F.col(here) + F.col(before)).alias(name))


def first_seen(df: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``, 1 on one row of each value that is not null in its group, else 0; its sum counts the distinct values.

    Beside another distinct count this keeps rows where they are; two of these in one aggregate make Spark copy and shuffle the rows.
    """
    place = F.row_number().over(Window.partitionBy(*group, value).orderBy(F.lit(1)))
    return df.withColumn(name, (F.col(value).isNotNull() & (place == 1)).cast("long"))


def value_counts(df: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """How often each value that is not null occurs in its group, counted before rows are shuffled."""
    return df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias(name))


def upper_medians(df: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """group, name, n: of n values of a group, sorted, the one at n div 2 from 0, the upper of two middle ones; nulls do not count.

    Values are counted first, so that what a group sorts is its distinct values (prices in cents: as many as there are prices),
    not its rows.
    """
    counts = value_counts(df, group, value, "times")
    upto = Window.partitionBy(*group).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumns({"upto": F.sum("times").over(upto), "n": F.sum("times").over(Window.partitionBy(*group))})
    middle = F.floor(F.col("n") / 2)
    return ranked.filter((F.col("upto") > middle) & (F.col("upto") - F.col("times") <= middle)).select(*group, F.col(value).alias(name), "n")
