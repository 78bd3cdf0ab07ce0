"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from loomtab.session import scratch

CACHE = "loomtab_worker_cache"
BYTES_PER_STEP = 1 << 20
BYTES_PER_BATCH = 2 << 20


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches bounded by bytes: a few long texts or many short ones take the same memory.

    The bound is a setting of the session and stays set, since it is read when the plan runs.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def map_batches(df: DataFrame, run: Callable, schema: StructType | str, cached: bool = False) -> DataFrame:
    """``mapInArrow`` over bounded batches; ``cached`` says that ``run`` uses the worker's cache, which other operators let go.

    What a task has freed goes back to the system, as workers live on.
    """
    bound_batches(df.sparkSession)

    def tidy(batches):
        if not cached:
            sys.modules.pop(CACHE, None)
        yield from run(batches)
        give_back()

    return df.mapInArrow(tidy, schema)


def tidy_groups(step: Callable) -> Callable:
    """A function of one group or two that drops the worker's cache and returns freed memory."""
    def one(table: pa.Table) -> pa.Table:
        sys.modules.pop(CACHE, None)
        out = step(table)
        give_back()
        return out

    def two(table: pa.Table, other: pa.Table) -> pa.Table:
        sys.modules.pop(CACHE, None)
        out = step(table, other)
        give_back()
        return out

    return two if step.__code__.co_argcount == 2 else one


def give_back() -> None:
    """Return freed memory of this process to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def schema_of(df: DataFrame, more: str) -> StructType:
    """The fields of ``df`` and those that ``more`` declares."""
    return StructType(df.schema.fields + StructType.fromDDL(more).fields)


def worker_cache(name: str, make: Callable):
    """One object per Python worker process, kept over its tasks; ``make`` builds it when another or none is kept.

    Functions travel by value, so a plain module global would be built anew in each task.
    """
    home = sys.modules.setdefault(CACHE, types.ModuleType(CACHE))
    if getattr(home, "name", None) != name:
        home.name, home.kept = name, None
        home.kept = make()
    return home.kept


def steps(sizes, limit: int = BYTES_PER_STEP):
    """Cut positions 0..len(sizes) into runs whose sizes add to about ``limit``; a larger one stands alone."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary per run of ``values`` between two bounds."""
    offsets = (np.asarray(bounds) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written below the shared folder and read back: a lineage cut that survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_tasks(spark: SparkSession, df: DataFrame) -> int:
    """Number of partitions of a scan, as many as there are tasks to deal rows to."""
    return max(df.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
