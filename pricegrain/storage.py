"""Tables that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of our own only in local mode, where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="pricegrain-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/pricegrain/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, keys: list[str], buckets: int | None = None) -> DataFrame:
    """``df`` as a table in as many buckets as there are shuffle partitions, or as said, each sorted by the keys.

    What joins or groups it by the keys reads it where it lies, without a shuffle.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"pricegrain_{uuid.uuid4().hex}"
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", scratch(spark, "bucketed")).saveAsTable(name)
    return spark.table(name)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as a column of ``df`` has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name
