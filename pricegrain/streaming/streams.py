"""Incremental ingest as Structured Streaming jobs.

Change capture and the snapshot are ``SnapshotTable.merge``, a ``foreachBatch`` sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrain.storage import free_name

KEYS = ["product_id", "store_id", "price_date"]


def stream_dedup(obs: DataFrame, delay: str = "1 day") -> DataFrame:
    """One row per product, store and date while the watermark remembers the key; ``append_absent`` drops what came before that."""
    return obs.withColumn("fetched_at", F.col("fetched_at").cast("timestamp")).withWatermark("fetched_at", delay).dropDuplicatesWithinWatermark(KEYS)


def history_on(path: str, batch: DataFrame) -> DataFrame | None:
    """Keys of the stored history on the dates that a batch brings; None where nothing is stored yet. Folders of other dates are not read."""
    days = [r[0] for r in batch.select("price_date").distinct().collect()]  # as many as a batch has dates
    at = F.col("price_date")
    try:
        old = batch.sparkSession.read.schema(batch.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return old.filter(at.isin([d for d in days if d is not None]) | (at.isNull() if None in days else F.lit(False))).select(*KEYS)


def append_absent(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that appends only keys the stored history lacks, dates in folders of their own.

    Of several rows of a key in a batch the first checked stays, of these that of least price and promo; what is stored
    stays before all. A batch that comes again adds nothing, also where it was stored in part.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        rest = [c for c in batch.columns if c not in KEYS]
        first = [c for c in ("fetched_at", "cents", "promo") if c in rest]
        row = F.min(F.struct(*first, *[c for c in rest if c not in first]))
        new = batch.groupBy(*KEYS).agg(row.alias("row")).select(*[F.col(c) if c in KEYS else F.col("row").getField(c).alias(c) for c in batch.columns])
        old = history_on(path, batch)
        if old is not None:
            same = [new[k].eqNullSafe(old[k]) for k in KEYS]
            new = new.join(old, same[0] & same[1] & same[2], "left_anti")
        new.repartition("price_date").write.mode("append").partitionBy("price_date").parquet(path)
        batch.unpersist()

    return write


def stream_window_avg(obs: DataFrame, keys: list[str], width: str = "7 days", delay: str = "1 day", at: str = "fetched_at") -> DataFrame:
    """Sum and number of prices in tumbling windows. In append mode a window is told once, when the watermark has passed its end; rows that come later are dropped."""
    name = free_name(obs, "at")
    w = obs.withColumn(name, F.col(at).cast("timestamp")).withWatermark(name, delay).groupBy(F.window(name, width), *keys)
    return w.agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), *keys, "cents", "n")
