"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A side is broadcast up to this many rows of a few numbers each; beyond it the join shuffles.
BROADCAST_ROWS = 400_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.  Where the session names none, a temporary one if the master is local; else an error."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="vellum-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def _drop(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session is gone; the folder's owner clears it
        pass


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage: write to the shared folder and read again.  What is left there goes when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/vellum-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_drop, spark, path)
    written = spark.read.schema(df.schema).parquet(path)
    written._vellum_path = path
    return written


def drop(df: DataFrame) -> None:
    """Delete a materialised table that nothing reads any more."""
    if path := df.__dict__.pop("_vellum_path", None):
        _drop(df.sparkSession, path)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a materialised table for broadcast if it is proven small; else leave the join to shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def light_side(df: DataFrame, column: str, limit: int = 48 << 20, each: int = 8) -> DataFrame:
    """Mark a materialised table for broadcast if its rows and the bytes of ``column`` are counted and few.

    The column is binary, or an array of texts, binaries or parts of about ``each`` bytes.
    """
    kind = df.schema[column].dataType
    if kind.typeName() != "array":
        held = F.length(column)
    elif kind.elementType.typeName() in ("binary", "string"):
        held = F.aggregate(column, F.lit(0).cast("long"), lambda s, x: s + F.length(x))
    else:
        held = F.size(column) * F.lit(each)
    rows, size = df.agg(F.count("*"), F.sum(held)).first()
    return F.broadcast(df) if rows * 48 + (size or 0) <= limit else df


def row_key(*columns: str) -> Column:
    """A number for a row's id and text, by which rows that repeat an id are told apart."""
    return F.xxhash64(*(F.col(c).cast("string") for c in columns))


def drop_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """docs without the rows whose ``row_key`` of doc_id and text is in the materialised ``keys`` (key)."""
    gone = small_side(keys.select(F.col("key").alias("vellum_key")).distinct())
    return docs.join(gone, row_key("doc_id", "text") == F.col("vellum_key"), "left_anti").select(docs.columns)


def sample_per(rows: DataFrame, group: str, key: str, most: int, total: int) -> DataFrame:
    """At most ``most`` rows of every group and about ``total`` of all (one of each at least), the first by a hash of ``key``.

    ``rows`` hold a key and group once.  Only rows whose hash is small enough for their group's size are ranked (three times
    as many as are wanted), so that a very frequent group is not sorted in one task.
    """
    counts = materialise(rows.groupBy(group).agg(F.count("*").alias("_n")))
    most = max(1, min(most, total // max(1, counts.count())))
    share = F.pmod(F.xxhash64(key), F.lit(1 << 40)) / float(1 << 40)
    near = rows.join(small_side(counts), group).where(share < (3.0 * most + 20) / F.col("_n"))
    order = Window.partitionBy(group).orderBy(share, key)
    return near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).select(key, group)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow function whose worker gives freed memory back when a task ends, as workers outlive tasks and stages."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def byte_slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text each (at least a row)."""
    texts = batch.column(column)
    if batch.num_rows == 0:
        return
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
