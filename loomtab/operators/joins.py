"""Joins with logic of their own. Plain joins are left to ``DataFrame.join``.

No side is hinted as broadcast: the planner and adaptive execution pick it from
the measured size and split skewed partitions of the large side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loomtab.operators.ordered import carry_last, keyed_join


def checked_join(facts: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join that may not change the number of fact rows.

    Instead of counting the facts twice, the (smaller) dimension is proved to
    have unique keys with one aggregate; a left join then keeps every row once.
    """
    clash = dim.groupBy(*on).count().where("count > 1").limit(1)
    if not clash.isEmpty():
        raise ValueError(f"join on {list(on)} would change the row count: repeated dimension keys")
    return facts.join(dim, list(on), how)


def asof_join(entities: DataFrame, features: DataFrame, key: str, entity_ts: str, feature_ts: str,
              columns: Sequence[str], ttl_seconds: int = 0) -> DataFrame:
    """Per entity row the newest feature row at or before it and within the ttl.

    Both sides are stacked and the last feature is carried forward in time
    order, so there is no pairwise blow-up; hot keys are cut by the running
    primitive. ``ttl_seconds=0`` sets no age limit.
    """
    payload = F.struct(F.col(feature_ts).alias("ts"), *[F.col(c) for c in columns])
    row = F.struct(*[F.col(c) for c in entities.columns])
    right = features.select(F.col(key).alias("_k"), F.col(feature_ts).alias("_ts"), F.lit(0).alias("_side"),
                            F.xxhash64(payload).alias("_tie"), payload.alias("_f"))
    left = entities.select(F.col(key).alias("_k"), F.col(entity_ts).alias("_ts"), F.lit(1).alias("_side"),
                           F.xxhash64(row).alias("_tie"), row.alias("_e"))
    both = right.unionByName(left, allowMissingColumns=True)
    seen = carry_last(both, ["_k"], ["_ts", "_side", "_tie"], {"_last": F.col("_f")}).where("_side = 1")
    fresh = F.lit(True) if ttl_seconds <= 0 else (
        F.unix_micros("_ts") - F.unix_micros("_last.ts") <= ttl_seconds * 1_000_000)
    return seen.select("_e.*", *[F.when(fresh, F.col(f"_last.{c}")).alias(c) for c in columns],
                       F.when(fresh, F.col("_last.ts")).alias("feature_ts"))


def latest_as_of(df: DataFrame, key: str, published: str, as_of: str, tie: str, columns: Sequence[str]) -> DataFrame:
    """Per key the newest row published on or before ``as_of``."""
    newest = F.max_by(F.struct(published, *columns), F.struct(published, tie)).alias("_r")
    return (df.where(F.col(published) <= F.lit(as_of).cast("timestamp")).groupBy(key).agg(newest)
            .select(key, "_r.*"))


def grid_range_join(points: DataFrame, regions: DataFrame, lat: str, lon: str, cell: float) -> DataFrame:
    """Points to every region box (south, north, west, east) that holds them.

    Boxes are spelled out as grid cells, points carry the cell they fall in; an
    equi join on the cell is followed by the exact test.
    """
    def index(col: Column) -> Column:
        return F.floor(col / cell).cast("long")

    boxes = (regions
             .withColumn("_gy", F.explode(F.sequence(index(F.col("south")), index(F.col("north")))))
             .withColumn("_gx", F.explode(F.sequence(index(F.col("west")), index(F.col("east"))))))
    spots = points.withColumns({"_gy": index(F.col(lat)), "_gx": index(F.col(lon))})
    inside = F.col(lat).between(F.col("south"), F.col("north")) & F.col(lon).between(F.col("west"), F.col("east"))
    return spots.join(boxes, ["_gy", "_gx"]).where(inside).drop("_gy", "_gx")


def newest_copy_wins(a: DataFrame, b: DataFrame, key: str, updated: str) -> DataFrame:
    """Two copies of a table: per key the later ``updated`` survives, NULL loses, ties go to ``a``."""
    rest = [c for c in a.columns if c != key]
    both = a.withColumn("_rank", F.lit(1)).unionByName(b.withColumn("_rank", F.lit(0)))
    rank = F.struct(F.col(updated).isNotNull(), F.col(updated), F.col("_rank"))
    picked = both.groupBy(key).agg(F.max_by(F.struct(*rest), rank).alias("_r"))
    return picked.select(key, "_r.*")


def align_forecasts(history: DataFrame, forecasts: dict[str, DataFrame], date: str = "date",
                    value: str = "value") -> DataFrame:
    """One column per forecast, joined on the date; each starts at the last historical point."""
    last = history.agg(F.max_by(F.struct(date, value), date).alias("p")).select(f"p.{date}", f"p.{value}")
    parts = [f.select(date, value).unionByName(last).withColumn("_m", F.lit(name)) for name, f in forecasts.items()]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    wide = stacked.groupBy(date).agg(*[F.max(F.when(F.col("_m") == n, F.col(value))).alias(n) for n in forecasts])
    return wide.dropna(subset=list(forecasts))


def with_group_stats(df: DataFrame, by: Sequence[str], *stats: Column) -> DataFrame:
    """Rows with aggregates of their group: partial aggregation plus a join, so
    no task holds a whole group as a window would."""
    return keyed_join(df, df.groupBy(*by).agg(*stats), by)
