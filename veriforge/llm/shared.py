"""Session helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import time
import uuid
import weakref
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null key in an ordering; nulls come first in ascending order.
NULL_KEY = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.  Unset, a folder of our own serves a local master (as
    in tests); on a cluster there is none that all machines see, so that is an error."""
    sc = spark.sparkContext
    if not (named := spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()):
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named := os.path.join(tempfile.gettempdir(), "veriforge-shared"))
    return named.rstrip("/")


_written: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def _path(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialize(df: DataFrame, tag: str, rows_per_batch: int | None = None) -> DataFrame:
    """Write df once to the shared folder and read it back.

    Lineage is cut, the columns stay prunable, and a lost executor costs only its unfinished write tasks: what has been
    committed is read from shared storage.  The files go when the session ends, or with `discard`.  rows_per_batch: how many rows
    Python workers get at once meanwhile, if fewer than the session's setting.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    usual = spark.conf.get(_ROWS)
    try:
        if rows_per_batch and not 0 < int(usual) <= rows_per_batch:
            spark.conf.set(_ROWS, rows_per_batch)
        df.write.parquet(path)
    finally:
        spark.conf.set(_ROWS, usual)
    at, files = _path(spark, path)
    files.deleteOnExit(at)
    back = spark.read.schema(df.schema).parquet(path)
    _written[back] = path
    return back


def discard(*done: DataFrame) -> None:
    """Remove what `materialize` wrote for tables that nothing reads any more."""
    for df in done:
        if (path := _written.pop(df, None)) is not None:
            at, files = _path(df.sparkSession, path)
            files.delete(at, True)


def release(spark: SparkSession) -> None:
    """Spark removes the shuffle files of finished steps once the driver has collected what refers to them; it is asked to do so
    now, as the next step writes as much again.  The cleaner works in the background and gets a moment."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


#: What a worker keeps from task to task of one operator, by what it was made of.  Tasks of the other operators drop it.
KEPT: dict = {}


def giving_back(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, before which the worker drops what another operator kept in it, and after which it returns its free memory to the machine."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if KEPT:
            KEPT.clear()
            trimmed()
        yield from run(batches)
        trimmed()

    return task


def trimmed() -> None:
    """Free memory goes from this process to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
        trim(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def apart(docs: DataFrame, *own: str) -> DataFrame:
    """docs as (own columns, others): all other columns in one struct, so that their names can't clash with any that are added."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    return docs.select(*own, F.struct(*rest).alias("others") if rest else F.lit(None).cast("int").alias("others"))


def together(df: DataFrame, names: list[str], own: Iterable[str]) -> DataFrame:
    """The columns names again, from df as `apart` made it."""
    own = set(own)
    return df.select(*(F.col(c) if c in own else F.col("others").getField(c).alias(c) for c in names))


def ranges(df: DataFrame, key: str, per_partition: int = 2) -> tuple[DataFrame, int]:
    """df with order_key (key, nulls lowest) and range_no, ascending with the key: about per_partition ranges of like row
    count for each shuffle partition.

    Only the key column is read to place the splits; the driver gets one number for each range, whatever the input holds.
    The splits become a binary tree of comparisons, so that a row costs log2(ranges) of them and no shuffle or Python.
    """
    n = max(1, per_partition * partitions(df.sparkSession))
    keyed = df.withColumn("order_key", F.coalesce(F.col(key).cast("long"), F.lit(NULL_KEY)))
    cuts = sorted({int(x) for x in keyed.select(F.col("order_key").cast("double").alias("k")).approxQuantile("k", [i / n for i in range(1, n)], 0.25 / n)}) if n > 1 else []

    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"IF(order_key < {cuts[mid]}L, {tree(lo, mid)}, {tree(mid + 1, hi)})"

    return keyed.withColumn("range_no", F.expr(tree(0, len(cuts)).replace("-9223372036854775808L", "(-9223372036854775807L - 1L)"))), len(cuts) + 1
