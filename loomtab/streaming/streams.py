"""Structured Streaming forms of the file-arrival, refresh and windowed work.

Every run uses ``availableNow``: it takes what has landed, commits its progress
in the checkpoint and ends, so a scheduler can call it again. Sinks written from
``foreachBatch`` put each batch in its own folder and overwrite it on a retry.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loomtab.operators.windows import top_per_group


def arriving(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a landing folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def append_run(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
               max_records: int | None = None) -> None:
    """Process what has landed into a Parquet table, exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.trigger(availableNow=True).start(path).awaitTermination()


def batch_run(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process what has landed by a function of (batch, id)."""
    (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)
     .trigger(availableNow=True).start().awaitTermination())


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Idempotent: a retried batch replaces its own folder."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


# ---- windows -----------------------------------------------------------------

def tumbling(stream: DataFrame, ts: str, keys: Sequence[str], value: str, distinct: str, every: str, delay: str) -> DataFrame:
    """Count, sum and approximate distinct users per window; exact distinct is not possible on a stream."""
    agg = stream.withWatermark(ts, delay).groupBy(F.window(ts, every), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.approx_count_distinct(distinct).alias("approx_distinct"))
    return agg.select(F.col("window.start").alias("start"), *keys, "n", "total", "approx_distinct")


def sliding(stream: DataFrame, ts: str, keys: Sequence[str], value: str, length: str, every: str, delay: str) -> DataFrame:
    agg = stream.withWatermark(ts, delay).groupBy(F.window(ts, length, every), *keys).agg(
        F.avg(value).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"), F.count(F.lit(1)).alias("n"))
    return agg.select(F.col("window.start").alias("start"), *keys, "mean", "low", "high", "n")


def sessions(stream: DataFrame, ts: str, keys: Sequence[str], value: str, gap: str, delay: str) -> DataFrame:
    agg = stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("s"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return agg.select(*keys, F.col("s.start").alias("start"), "n", "total")


BEAT = "_beat"
"""Column that only a heartbeat row fills: group by it as well, and take the groups where it is NULL."""


def with_beat(schema: str) -> str:
    return f"{schema}, {BEAT} boolean"


def heartbeat(spark: SparkSession, path: str, schema: str, ts: str, at: str) -> None:
    """Land one row that holds a late time and its mark, so every open window before it closes.

    The mark keeps it apart from all data, rows with NULL keys included.
    """
    row = spark.range(1).select(F.lit(at).cast("timestamp").alias(ts), F.lit(True).alias(BEAT))
    empty = spark.createDataFrame([], with_beat(schema))
    empty.unionByName(row, allowMissingColumns=True).select(*empty.columns).write.mode("append").parquet(path)


def first_within(stream: DataFrame, ts: str, keys: Sequence[str], delay: str) -> DataFrame:
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


# ---- tables kept by batches ------------------------------------------------------

class KeptTable:
    """A table that follows batches: each adds a folder of its own, every ``every``-th one merges what is there into a snapshot.

    A snapshot counts once its job has committed (its success mark is there). The reader takes the newest one and the batches after it, so
    it touches at most ``every`` folders, whatever the number of batches. A retried batch replaces its folder, and its snapshot is made
    again from the snapshot before and the batches since, which are only removed once the next snapshot counts: the same table comes out.
    ``merge`` gives the same rows for merged parts as for all rows at once.
    """

    def __init__(self, spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], every: int = 8):
        self.spark, self.path, self.merge, self.every = spark, path, merge, every
        self.home = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.files = self.home.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def folders(self, kind: str) -> list[int]:
        """Numbers of the finished folders of a kind."""
        if not self.files.exists(self.home):
            return []
        names = [s.getPath() for s in self.files.listStatus(self.home)]
        found = [(p.getName().split("=", 1), p) for p in names if p.getName().startswith(f"{kind}=")]
        return sorted(int(n[1]) for n, p in found if self.files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def parts(self, upto: int | None = None, before: int | None = None) -> list[str]:
        """The newest snapshot (of a batch lower than ``before``) and the batches after it, up to ``upto``."""
        snapshots = [n for n in self.folders("snapshot") if before is None or n < before]
        after = snapshots[-1] if snapshots else -1
        batches = [n for n in self.folders("batch") if n > after and (upto is None or n <= upto)]
        return [f"{self.path}/snapshot={after}"] * bool(snapshots) + [f"{self.path}/batch={n}" for n in batches]

    def add(self, batch: DataFrame, batch_id: int) -> None:
        self.merge(batch).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        if (batch_id + 1) % self.every:
            return
        kept = self.parts(batch_id, batch_id)
        # Partition columns are not looked for: a folder's name is no value.
        self.merge(self.opened(kept)).write.mode("overwrite").parquet(f"{self.path}/snapshot={batch_id}")
        older = [n for n in self.folders("snapshot") if n < batch_id]
        for kind, last in (("batch", older[-1] if older else -1), ("snapshot", older[-1] - 1 if older else -1)):
            for n in self.folders(kind):
                if n <= last:
                    self.files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}={n}"), True)

    def opened(self, parts: list[str]) -> DataFrame:
        frames = [self.spark.read.parquet(p) for p in parts]
        return reduce(lambda a, b: a.unionByName(b), frames)

    def read(self) -> DataFrame | None:
        """The merged rows, None before the first batch."""
        parts = self.parts()
        return self.merge(self.opened(parts)) if parts else None


def _summary(key: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.groupBy(key).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def refresh_summary(stream: DataFrame, path: str, checkpoint: str, key: str, value: str) -> DataFrame:
    """Count and sum per key that follow new files: batches add their partial sums to a kept table."""
    kept = KeptTable(stream.sparkSession, path, _summary(key))
    batch_run(stream.select(key, F.lit(1).cast("long").alias("n"), F.col(value).alias("total")), checkpoint, kept.add)
    return kept.read()


def read_summary(spark: SparkSession, path: str, key: str) -> DataFrame:
    return KeptTable(spark, path, _summary(key)).read()


def latest_rows(stream: DataFrame, path: str, checkpoint: str, key: str, ts: str) -> DataFrame:
    """Newest row per key: a kept table of each batch's newest rows."""
    kept = KeptTable(stream.sparkSession, path, lambda df: top_per_group(df, [key], [F.desc(ts)], 1))
    batch_run(stream, checkpoint, kept.add)
    return kept.read()


def split_late(stream: DataFrame, accepted: str, rejected: str, marks: str, checkpoint: str, ts: str, delay_seconds: int) -> None:
    """Rows older than the newest time of earlier batches minus the delay go to a side table."""
    spark = stream.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        known = spark.read.schema("newest timestamp, batch int").option("recursiveFileLookup", "false").parquet(marks) \
            .where(F.col("batch") < batch_id).agg(F.max("newest")).first()[0] if batch_id else None
        late: Column = F.lit(False) if known is None else \
            F.unix_micros(ts) < F.unix_micros(F.lit(known)) - delay_seconds * 1_000_000
        tagged = batch.withColumn("_late", late).persist()
        write_batch(tagged.where("not _late").drop("_late"), accepted, batch_id)
        write_batch(tagged.where("_late").drop("_late"), rejected, batch_id)
        write_batch(tagged.agg(F.max(ts).alias("newest")), marks, batch_id)
        tagged.unpersist()

    batch_run(stream, checkpoint, handle)


def progressive_sum(stream: DataFrame, path: str, checkpoint: str, value: str) -> DataFrame:
    """Running total over all batches: one row per batch in a kept table."""
    kept = KeptTable(stream.sparkSession, path, lambda df: df.agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    batch_run(stream.select(F.col(value).alias("total"), F.lit(1).cast("long").alias("n")), checkpoint, kept.add)
    return kept.read()


LOTS = 1024
"""Lots of keys of ``row_window_mean``."""


def row_window_mean(stream: DataFrame, key: str, ts: str, value: str, rows: int) -> DataFrame:
    """(key, ts, mean of the last ``rows`` rows): row-count windows with state per key.

    Keys are dealt by a hash to a fixed number of lots, and a lot is one state: the last values of each of its keys, one list after the other. All keys of a lot
    are worked on at once, so neither the calls nor the states grow with the keys. A mean over a missing value is NULL.
    """
    import numpy as np
    import pandas as pd

    kind = stream.schema[key].dataType.simpleString()
    lots = LOTS

    def step(k, frames, state):
        got = pd.concat(list(frames)).sort_values(ts)
        keys, held, sizes = state.get if state.exists else ([], [], [])
        # What is held comes before what is new; NULL is a key like others.
        every = pd.Series([*keys, *got[key].astype(object).where(got[key].notna(), None)], dtype=object)
        code, names = pd.factorize(every, use_na_sentinel=False)
        new = got[value].to_numpy(dtype=float, na_value=np.nan)
        own = np.concatenate([np.repeat(code[:len(keys)], np.array(sizes, np.int64)), code[len(keys):]]).astype(np.int64)
        values = np.concatenate([np.array(held, float), new])
        order = np.argsort(own, kind="stable")
        x, c = values[order], own[order]
        first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        many = np.diff(np.append(first, len(c)))
        turn = np.arange(len(c)) - np.repeat(first, many)
        total = np.zeros(len(x))
        for back in range(min(rows, many.max()) - 1, -1, -1):  # from the oldest on
            at = np.flatnonzero(turn >= back)
            total[at] += x[at - back]
        mean = np.empty(len(x))
        mean[order] = total / np.minimum(turn + 1, rows)
        last = np.arange(len(c)) >= np.repeat(first + many - rows, many)
        state.update(([None if n is None or n != n else n for n in names], x[last].tolist(), np.minimum(many, rows).tolist()))
        yield pd.DataFrame({key: got[key].to_numpy(), ts: got[ts].to_numpy(), "mean": mean[len(held):]})

    # Rows without a key are a lot of their own, so that keys stay whole numbers in pandas.
    lot = F.when(F.col(key).isNull(), F.lit(lots)).otherwise(F.pmod(F.xxhash64(key), F.lit(lots))).cast("int").alias("_lot")
    return stream.select(key, ts, value, lot).groupBy("_lot").applyInPandasWithState(
        step, f"`{key}` {kind}, `{ts}` timestamp, mean double", f"keys array<{kind}>, held array<double>, sizes array<int>", "append", "NoTimeout")
