"""A snapshot of prices that micro-batches maintain: history, newest prices and flags, committed together."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrain.operators.ingest import KEY, compare, history_of, merged
from pricegrain.operators.quality import FLAG, flag_moves, flag_outliers, flag_promo_depth

SNAPSHOT = "product_id long, store_id long, cents long, promo string, price_date date, last_checked_at timestamp, last_changed_at timestamp"
HISTORY = "product_id long, store_id long, cents long, promo string, price_date date, fetched_at timestamp, was long, change_type string"
FLAGS = "product_id long, store_id long, price_date date, flag_type string, details string"


class SnapshotTable:
    """Folders of a snapshot under ``path``, hashed by product (``parts``) and by store (``splits``).

    A batch rewrites the buckets that it touches and no others, under its own version; history grows by one folder. What a
    reader sees is told by the newest manifest, one small file that is moved into place when all else is written, so a
    batch counts wholly or not at all. A batch that comes again after a failure overwrites what it left; one that
    was committed is left out. Splits keep a product of very many stores out of one bucket.
    """

    def __init__(self, spark: SparkSession, path: str, parts: int = 16, splits: int = 2):
        self.spark, self.path, self.parts, self.splits = spark, path, parts, splits

    def part(self) -> Column:
        return F.pmod(F.xxhash64("product_id"), F.lit(self.parts)).cast("int")

    def bucket(self) -> Column:
        return self.part() * self.splits + F.pmod(F.xxhash64("store_id"), F.lit(self.splits)).cast("int")

    def committed(self) -> tuple[int, dict[tuple[str, int], int]]:
        """The last batch, -1 for none, and the version of each bucket; as many rows as there are buckets."""
        try:
            rows = self.spark.read.schema("kind string, bucket int, version long, batch long").parquet(f"{self.path}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return -1, {}
        last = rows.agg(F.max("batch")).first()[0]
        if last is None:
            return -1, {}
        return last, {(r.kind, r.bucket): r.version for r in rows.filter(F.col("batch") == last).collect()}

    def of(self, kind: str, schema: str, versions: dict[tuple[str, int], int], buckets: set[int] | None = None) -> DataFrame:
        """Rows of the given buckets, or all; only their folders are listed and read."""
        folders = [f"{self.path}/{kind}/version={v}/bucket={b}" for (k, b), v in versions.items() if k == kind and (buckets is None or b in buckets)]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def snapshot(self) -> DataFrame:
        return self.of("snapshot", SNAPSHOT, self.committed()[1])

    def flags(self) -> DataFrame:
        return self.of("flags", FLAGS, self.committed()[1])

    def history(self) -> DataFrame:
        """Changes of all committed batches."""
        last = self.committed()[0]
        if last < 0:
            return self.spark.createDataFrame([], HISTORY)
        return self.spark.read.schema(HISTORY + ", batch long").parquet(f"{self.path}/history").filter(F.col("batch") <= last).drop("batch")

    def put(self, kind: str, rows: DataFrame, bucket: Column, version: int) -> None:
        rows.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{kind}/version={version}")

    def kept(self, rows: DataFrame) -> DataFrame:
        """``rows`` kept by product for a batch: what compares, groups or joins them by product, or product and store, moves them no more."""
        kept = rows.repartition(max(self.parts, int(self.spark.conf.get("spark.sql.shuffle.partitions"))), "product_id").persist()
        kept.write.format("noop").mode("overwrite").save()  # the plans that read it know how it is dealt out only when it is filled
        return kept

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """A ``foreachBatch`` sink of observations: history, snapshot and flags after the batch."""
        SnapshotTable(batch.sparkSession, self.path, self.parts, self.splits)._merge(batch, batch_id)

    def _merge(self, batch: DataFrame, batch_id: int) -> None:
        last, versions = self.committed()
        if batch_id <= last:
            return
        obs = self.kept(batch.select(*KEY, F.col("cents").cast("long").alias("cents"), "promo", "price_date", F.col("fetched_at").cast("timestamp").alias("fetched_at")))
        touched = {r[0] for r in obs.select(self.bucket()).distinct().collect()}  # at most parts x splits
        if not touched:
            obs.unpersist()
            return
        old = self.kept(self.of("snapshot", SNAPSHOT, versions, touched))
        steps = compare(obs, old).persist()
        history_of(steps).write.mode("overwrite").parquet(f"{self.path}/history/batch={batch_id}")
        self.put("snapshot", merged(steps, old), self.bucket(), batch_id)
        versions |= {("snapshot", b): batch_id for b in touched}

        parts = {b // self.splits for b in touched}
        near = {b for p in parts for b in range(p * self.splits, (p + 1) * self.splits)}
        current = self.kept(self.of("snapshot", SNAPSHOT, versions, near).select(*KEY, "cents", "promo", "price_date").join(obs.select("product_id").distinct(), "product_id", "left_semi"))
        # the snapshot has one row a key and moves are grouped, so no flag comes twice
        new = flag_outliers(current).unionByName(flag_promo_depth(current)).unionByName(flag_moves(history_of(steps)))
        known = self.of("flags", FLAGS, versions, parts)
        added = new.join(known, [*FLAG, "flag_type"], "left_anti")
        self.put("flags", known.unionByName(added.select(known.columns)), self.part(), batch_id)
        written = self.spark.read.schema("bucket int").parquet(f"{self.path}/flags/version={batch_id}").select("bucket").distinct().collect()
        versions |= {("flags", r[0]): batch_id for r in written}

        rows = [(kind, bucket, version) for (kind, bucket), version in versions.items()]
        self.spark.createDataFrame(rows, "kind string, bucket int, version long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/batch={batch_id}")
        for df in (steps, old, current, obs):
            df.unpersist()
