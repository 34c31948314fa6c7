"""Streams over the driver's tables, replayed in slices that arrive one after the other, and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrain.plans.mapping import Tables
from pricegrain.storage import scratch
from pricegrain.streaming import streams
from pricegrain.streaming.snapshot import SnapshotTable

#: Rows of all observations that a part of the snapshot gets at most on average.
ROWS_A_PART = 1_000_000
#: Slices of a replay; each is one micro-batch.
SLICES = 4


def slice_of(at: Column, first: Column, last: Column) -> Column:
    """Which of equal parts of the time from the first to the last day a day falls in."""
    return F.floor(F.lit(SLICES) * F.datediff(at, first) / (F.datediff(last, first) + 1)).cast("int")


def sliced(rows: DataFrame, at: str) -> DataFrame:
    """Rows with the slice they belong to by time."""
    bounds = rows.agg(F.min(F.to_date(at)).alias("first_day"), F.max(F.to_date(at)).alias("last_day"))
    return rows.join(F.broadcast(bounds), F.lit(True)).withColumn("slice", slice_of(F.to_date(at), F.col("first_day"), F.col("last_day"))).drop("first_day", "last_day")


def replay(t: Tables, rows: DataFrame, name: str, job: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None]) -> None:
    """Land slice after slice in a folder; after each the stream runs on from its checkpoint until nothing is left."""
    path = scratch(t.spark, name)
    rows.write.partitionBy("slice").parquet(f"{path}/sliced")
    schema = rows.drop("slice").schema
    for k in range(SLICES):
        t.spark.read.schema(rows.schema).parquet(f"{path}/sliced").filter(F.col("slice") == k).drop("slice").write.mode("append").parquet(f"{path}/in")
        stream = job(t.spark.readStream.schema(schema).parquet(f"{path}/in"))
        stream.writeStream.outputMode("append").option("checkpointLocation", f"{path}/state").foreachBatch(sink).trigger(availableNow=True).start().awaitTermination()


def offers(t: Tables) -> DataFrame:
    return sliced(t.offers().select("product_id", "store_id", "cents", "promo", "price_date", F.col("fetched_at").cast("timestamp").alias("fetched_at")), "fetched_at")


#: Snapshots that this application has replayed, by application and folder: what queries ask of one table is replayed once.
_replayed: dict[tuple[str, str], SnapshotTable] = {}


def maintained(t: Tables) -> SnapshotTable:
    """The snapshot after all offers have come in as micro-batches."""
    key = t.spark.sparkContext.applicationId, t.sf_dir
    if key not in _replayed:
        table = SnapshotTable(t.spark, scratch(t.spark, "snapshot"), parts=max(16, t.raw("lineitem").count() // ROWS_A_PART))
        replay(t, offers(t), "offers", lambda obs: obs, table.merge)
        _replayed[key] = table
    return _replayed[key]


def day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def stream_changes(t: Tables) -> DataFrame:
    return maintained(t).history().select("product_id", "store_id", "cents", "promo", day("fetched_at"), "was", "change_type")


def stream_snapshot(t: Tables) -> DataFrame:
    return maintained(t).snapshot().select("product_id", "store_id", "cents", "promo", day("price_date"), day("last_checked_at"), day("last_changed_at"))


def stream_flags(t: Tables) -> DataFrame:
    return maintained(t).flags().select("product_id", "store_id", day("price_date"), "flag_type")


def stream_dedup(t: Tables) -> DataFrame:
    path = scratch(t.spark, "dedup")
    replay(t, offers(t), "offers", lambda obs: obs, streams.append_absent(path))
    return t.spark.read.parquet(path).select("product_id", "store_id", F.col("price_date").cast("string").alias("price_date"), "cents", "promo", day("fetched_at"))


def delayed(t: Tables) -> DataFrame:
    """Fuel observations; what one station reports within an hour of another arrives a slice late, so that some come after their window has closed."""
    names = t.raw("events").select("event_type").distinct().withColumn("product_id", F.expr("row_number() over (order by event_type)").cast("long"))
    rows = t.raw("events").join(F.broadcast(names), "event_type").select("product_id", F.col("user_id").alias("store_id"), F.floor(F.col("value") * 100.0 + 0.5).alias("cents"), F.col("ts").cast("timestamp").alias("fetched_at"))
    return sliced(rows, "fetched_at").withColumn("slice", F.least(F.lit(SLICES - 1), F.col("slice") + F.when(F.hour("fetched_at") == F.col("store_id") % 24, 1).otherwise(0)))


def stream_window_avg(t: Tables) -> DataFrame:
    path = scratch(t.spark, "windows")
    replay(t, delayed(t), "events", lambda obs: streams.stream_window_avg(obs, ["product_id"], "1 day"), lambda batch, n: batch.write.mode("overwrite").parquet(f"{path}/batch={n}"))
    schema = "window_start timestamp, product_id long, cents long, n long"
    return t.spark.read.schema(schema + ", batch long").parquet(path).select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "product_id", "cents", "n")


_CUT = f"floor({SLICES} * ({{d}} - first_day) / (last_day - first_day + 1))::INT"
#: Observations with their slice, compared with the one before; the snapshot and the flags after each slice.
SNAP = f"""
obs AS (SELECT o.*, {_CUT.format(d="fetched_at")} AS slice FROM (SELECT l_partkey AS product_id, l_suppkey AS store_id, floor(l_extendedprice / l_quantity * 1e2 + 5e-1)::BIGINT AS cents, CASE WHEN l_discount >= 0.09::DOUBLE THEN 'PROMO' END AS promo, date_trunc('year', l_shipdate)::DATE AS price_date, l_shipdate::DATE AS fetched_at FROM lineitem) o, (SELECT min(l_shipdate)::DATE AS first_day, max(l_shipdate)::DATE AS last_day FROM lineitem)),
hist AS (SELECT *, CASE WHEN rn = 1 THEN 'new' ELSE 'changed' END AS change_type FROM (SELECT *, row_number() OVER w AS rn, lag(cents) OVER w AS was, lag(promo) OVER w AS was_promo FROM obs WINDOW w AS (PARTITION BY product_id, store_id ORDER BY fetched_at, cents, promo NULLS FIRST)) WHERE rn = 1 OR cents IS DISTINCT FROM was OR promo IS DISTINCT FROM was_promo),
checked AS (SELECT product_id, store_id, max(fetched_at) AS last_checked_at FROM obs GROUP BY ALL),
final AS (SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY product_id, store_id ORDER BY fetched_at DESC, cents DESC, promo DESC NULLS LAST) = 1),
snaps AS (SELECT k, hist.* FROM hist JOIN (SELECT unnest(range({SLICES})) AS k) ks ON slice <= k QUALIFY row_number() OVER (PARTITION BY k, product_id, store_id ORDER BY fetched_at DESC, cents DESC, promo DESC NULLS LAST) = 1),
live AS (SELECT * FROM snaps SEMI JOIN (SELECT DISTINCT product_id, slice AS k FROM obs) USING (product_id, k)),
mids AS (SELECT k, product_id, list_sort(list(cents))[count(*) // 2 + 1] AS med FROM live WHERE cents > 0 GROUP BY ALL HAVING count(*) >= 3),
mads AS (SELECT k, product_id, med, list_sort(list(abs(cents - med)))[count(*) // 2 + 1] AS mad FROM live JOIN mids USING (k, product_id) WHERE cents > 0 GROUP BY ALL),
regular AS (SELECT k, product_id, sum(cents)::DOUBLE / count(*) AS mean FROM live WHERE promo IS NULL GROUP BY ALL)"""
CHANGES_SQL = "SELECT product_id, store_id, cents, promo, fetched_at::VARCHAR AS fetched_at, was, change_type FROM hist"
SNAPSHOT_SQL = "SELECT product_id, store_id, cents, promo, price_date::VARCHAR AS price_date, last_checked_at::VARCHAR AS last_checked_at, fetched_at::VARCHAR AS last_changed_at FROM final JOIN checked USING (product_id, store_id)"
FLAGS_SQL = """SELECT DISTINCT product_id, store_id, price_date::VARCHAR AS price_date, flag_type FROM (
SELECT product_id, store_id, price_date, 'outlier_price' AS flag_type FROM live JOIN mads USING (k, product_id) WHERE cents > 0 AND mad > 0 AND 6745e-4 * abs(cents - med) / mad > 3
UNION ALL SELECT product_id, store_id, price_date, 'promo_too_deep' FROM live JOIN regular USING (k, product_id) WHERE promo IS NOT NULL AND cents < mean * 2e-1
UNION ALL SELECT product_id, store_id, price_date, 'price_spike' FROM hist WHERE was > 0 AND abs(cents - was)::DOUBLE / was > 5e-1)"""
DEDUP_SQL = "SELECT product_id, store_id, price_date::VARCHAR AS price_date, cents, promo, fetched_at::VARCHAR AS fetched_at FROM obs QUALIFY row_number() OVER (PARTITION BY product_id, store_id, price_date ORDER BY slice, fetched_at, cents, promo NULLS FIRST) = 1"
#: Rows as they arrive, the watermark that holds for each slice (a day before the newest row of earlier ones), and what is left of each window when it has closed.
WINDOWS = f"""
fuel AS (SELECT event_type, row_number() OVER (ORDER BY event_type) AS product_id FROM (SELECT DISTINCT event_type FROM events)),
arrived AS (SELECT product_id, floor(value * 1e2 + 5e-1)::BIGINT AS cents, ts, least({SLICES - 1}, {_CUT.format(d="ts::DATE")} + (hour(ts) = user_id % 24)::INT) AS slice FROM events JOIN fuel USING (event_type), (SELECT min(ts)::DATE AS first_day, max(ts)::DATE AS last_day FROM events)),
marks AS (SELECT k, max(ts) - INTERVAL 1 DAY AS mark FROM (SELECT unnest(range(1, {SLICES + 1})) AS k) ks JOIN arrived ON slice < k GROUP BY k),
kept AS (SELECT a.*, date_trunc('day', ts) AS day FROM arrived a LEFT JOIN marks ON k = slice WHERE mark IS NULL OR date_trunc('day', ts) + INTERVAL 1 DAY > mark)"""
WINDOWS_SQL = f"SELECT day::DATE::VARCHAR AS day, product_id, sum(cents)::BIGINT AS cents, count(*) AS n FROM kept WHERE day + INTERVAL 1 DAY <= (SELECT mark FROM marks WHERE k = {SLICES}) GROUP BY ALL"
