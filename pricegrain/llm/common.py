"""What the corpus operators share: scratch tables, Arrow batches, ordered ranges of ids."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only in local mode, where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="pricegrain-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/pricegrain/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of a table's rows that a Python worker handles at a time; a single longer row is handled alone.
STEP_BYTES = 4 << 20
#: Rows of an Arrow batch, and Spark's own sizes, which say that a session leaves them open.
BATCH_ROWS, LEFT_OPEN = 2000, ("10000", "64MB", "67108864", "67108864b")


def steps(batch: pa.RecordBatch, most_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of at most ``most_bytes``, or of one row."""
    if batch.num_rows > 1 and batch.nbytes > most_bytes:
        half = batch.num_rows // 2
        yield from steps(batch.slice(0, half), most_bytes)
        yield from steps(batch.slice(half), most_bytes)
    elif batch.num_rows:
        yield batch


def column_lists(batches: Iterator[pa.RecordBatch], arrow: tuple[str, ...] = ()) -> Iterator[dict[str, list]]:
    """Slice after slice as dicts of name to values; those named in ``arrow`` as numpy arrays."""
    for whole in batches:
        for batch in steps(whole):
            yield {name: batch.column(i).to_numpy(zero_copy_only=False) if name in arrow else batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
        del whole


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand over Arrow batches of about STEP_BYTES and few rows, where the session leaves their size open."""
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", STEP_BYTES)):
        if spark.conf.get(key, None) in (None, *LEFT_OPEN):
            spark.conf.set(key, str(value))


def map_batches(
    df: DataFrame,
    schema: str | T.StructType,
    fn: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]],
    arrow: tuple[str, ...] = (),
) -> DataFrame:
    """``mapInArrow`` over column lists: ``fn`` gets and yields dicts of name to values, STEP_BYTES at a time."""
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    out = to_arrow_schema(struct)

    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(column_lists(batches, arrow)):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in out], schema=out)

    return df.mapInArrow(run, struct)


def append_columns(df: DataFrame, read: list[str], new: dict[str, str], fn: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]]) -> DataFrame:
    """``df`` with the columns that ``fn`` makes of those in ``read``, slice by slice and row by row, in one pass.

    ``new`` has names, unlike those of ``df``, and types. What is not read passes through as it is.
    """
    struct = T.StructType([*df.schema.fields, *T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in new.items())).fields])
    out = to_arrow_schema(struct)
    at = [df.columns.index(c) for c in read]
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: list[pa.RecordBatch] = []

        def lists() -> Iterator[dict[str, list]]:
            for batch in batches:
                for part in steps(batch):
                    whole[:] = [part]
                    yield {name: part.column(i).to_pylist() for name, i in zip(read, at, strict=True)}

        for columns in fn(lists()):
            own = [c.cast(f.type) for c, f in zip(whole[0].columns, out, strict=False)]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(columns[k], type=out.field(k).type) for k in new)], schema=out)

    return df.mapInArrow(run, struct)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as a column of ``df`` has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads, so that other columns of any name do no harm."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def crc_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null ids fall into bucket 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


#: Most ranges of ids, and ids looked at for each; what is sent about them is bounded by both.
MAX_RANGES, IDS_PER_RANGE = 32_768, 20


class IdRanges:
    """Ranges of an integer key with about as many rows each: range ``k`` lies wholly before range ``k + 1``.

    Bounds are quantiles of a sample by hash, of at most about MAX_RANGES x IDS_PER_RANGE keys, so that
    neither gaps nor outliers fill one range. Null keys are range 0, before all others.
    """

    def __init__(self, df: DataFrame, key: str, rows_per_range: int = 512):
        n = df.count()
        count = max(1, min(MAX_RANGES, n // rows_per_range))
        one_in = max(1, n // (count * IDS_PER_RANGE))
        ids = np.array([], np.int64)
        if count > 1:
            sampled = df.filter(F.col(key).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(one_in)) == 0)).select(F.col(key).cast("long").alias("k"))
            ids = np.sort(sampled.toArrow().column("k").to_numpy())
        at = np.unique(np.arange(1, count) * len(ids) // count) if len(ids) else np.array([], np.int64)
        self.bounds = np.unique(ids[at]).tolist()

    def of(self, key: Column) -> Column:
        """Number of the key's range, by binary search among the bounds."""
        if not self.bounds:
            return F.when(key.isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long")
        return F.when(key.isNull(), F.lit(0)).otherwise(not_above(self.bounds, key, "bigint") + 1).cast("long")


def not_above(bounds: list, key: Column, kind: str) -> Column:
    """How many of the sorted ``bounds``, a list of bounded length, are no larger than the key, by binary search."""
    values = F.split(F.lit(",".join(map(repr, bounds))), ",").cast(f"array<{kind}>")
    widths = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*map(F.lit, widths)), F.lit(0), lambda at, w: F.when(F.get(values, at + w - 1) <= key, at + w).otherwise(at))


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Partitions of a shuffle whose size is known: as set, and more where a task would get too many rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))
