"""Python functions on columns, partitions, items, batches and rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from loomtab.operators.ordered import hot_groups


def series_udf(fn: Callable[[pd.Series], pd.Series], kind: str):
    """A vectorised column function with a declared type (Arrow batches)."""
    def run(values: pd.Series) -> pd.Series:
        return fn(values)
    return F.pandas_udf(run, kind)


def sorted_partition_map(df: DataFrame, by: Sequence[str], order: Sequence[str],
                         fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """A generator over rows sorted by (by, order), whole groups per partition, keeping its own state.

    Rows stream through in batches. A group beyond the one-task bound stops the
    call: ``running`` and ``framed`` compute such features without one task
    per group.
    """
    if hot_groups(df, by) is not None:
        raise ValueError("a group exceeds the one-task bound: use running or framed")
    return df.repartition(*by).sortWithinPartitions(*by, *order).mapInPandas(fn, schema)


def map_items(df: DataFrame, key: str, item: str, fn: Callable[..., Any], result: str, parallelism: int | None = None,
              on_error: str = "keep", **bound: Any) -> DataFrame:
    """(key, result, error): one call per item with fixed arguments bound.

    Failed items carry the error text, or stop the job with ``on_error='raise'``.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for k, x in zip(f[key], f[item]):
                try:
                    rows.append((k, fn(x, **bound), None))
                except Exception as e:
                    if on_error == "raise":
                        raise
                    rows.append((k, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[key, "result", "error"])

    rows = df.select(key, item)
    return (rows.repartition(parallelism) if parallelism else rows).mapInPandas(run, f"`{key}` {kind}, result {result}, error string")


class BatchClient(Protocol):
    def submit(self, item: Any) -> Any: ...
    def wait(self, handle: Any) -> int: ...


def submit_and_wait(df: DataFrame, key: str, batch_size: int, make_client: Callable[[], BatchClient]) -> DataFrame:
    """(batch, key, result, error): per batch every item is submitted, then all are awaited; -1 where it failed.

    ``key`` is a dense item number, so a batch holds at most ``batch_size`` rows;
    batches run side by side as tasks allow.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(f: pd.DataFrame) -> pd.DataFrame:
        client, handles, rows = make_client(), [], []
        for item in f[key]:
            try:
                handles.append((item, client.submit(item), None))
            except Exception as e:
                handles.append((item, None, str(e)))
        for item, handle, error in handles:
            value = -1
            if error is None:
                try:
                    value = client.wait(handle)
                except Exception as e:
                    error = str(e)
            rows.append((f["batch"].iloc[0], item, value, error))
        return pd.DataFrame(rows, columns=["batch", key, "result", "error"])

    batched = df.select(F.floor(F.col(key) / batch_size).alias("batch"), key)
    return batched.groupBy("batch").applyInPandas(run, f"batch long, `{key}` {kind}, result long, error string")


def batch_totals(results: DataFrame) -> DataFrame:
    return results.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("result") >= 0).alias("succeeded"),
                       F.count_if(F.col("result") < 0).alias("failed"))


def chunk_function(size: int, overlap: int):
    """A table function ``(text) -> (pos, chunk)`` for lateral joins."""
    step = size - overlap

    class Chunks:
        def eval(self, text: str):
            for pos, at in enumerate(range(0, len(text or ""), step)):
                yield pos, text[at:at + size]

    return F.udtf(Chunks, returnType="pos int, chunk string", useArrow=True)
