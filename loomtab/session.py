"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

# A group with more rows than this, by its own count, is cut over several tasks.
HOT_ROWS = "loomtab.hot.rows"
HOT_ROWS_DEFAULT = 5_000_000


def build_session(app: str = "loomtab", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def setting(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``, or the directory set with ``setCheckpointDir``.

    Only where the driver and all tasks are one machine (a local master, as in unit tests) and none is
    named, a local folder is made and set. Elsewhere a missing folder is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("loomtab.scratch.dir", None)
    if not named:
        given = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = given.get() if given.isDefined() else None
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="loomtab-")
        spark.conf.set("loomtab.scratch.dir", named)
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/loomtab/{label}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage through the reliable checkpoint directory."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows in a table below the shared folder, read back: unlike a checkpoint the plan runs once, and columns can be pruned."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores ahead of costly row work, where they come from fewer files than there are cores.

    A large table already comes in more splits and is left as it is; no shuffle is added to it. Files are
    counted, no size is estimated and nothing is run.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores, key)
