"""Connected components of a link table, without collecting links or components anywhere."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from loomtab.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node that has a link to another one.

    Alternating large-star and small-star steps: a node's neighbours above it move to its smallest
    neighbour, then those below it. Minima are combined before the shuffle, the smallest neighbour comes
    back by a join that adaptive execution may split, so a node with very many links is no single task's
    work. Each round is a reliable checkpoint. NULL ends, loops and repeated links are dropped; no links, no rows.
    """
    edges = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                        .where(f"{a} is not null and {b} is not null and u <> v").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) \
                .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now


def star_edges(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the boolean matrix connects, at most one for each row and column."""
    m = linked.shape[1]
    columns = np.arange(m)
    while True:
        rows = np.where(linked, columns[None, :], m).min(axis=1, initial=m)
        then = np.minimum(columns, np.where(linked, rows[:, None], m).min(axis=0, initial=m))
        if (then == columns).all():
            break
        columns = then
    met = rows < m
    a = np.concatenate([left[met], right])
    b = np.concatenate([right[rows[met]], right[columns]])
    return a[a != b], b[a != b]
