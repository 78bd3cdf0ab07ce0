"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells.

Equal vectors are folded first. Each label with more than ``CELL`` vectors is cut into cells by
spherical k-means, fitted on a bounded sample and applied to every vector. A vector belongs to the cell of its
nearest centre and also visits each cell whose border is within ``margin`` of it; a link can only be lost
if both ends are farther than that from the border between them. Linked unit vectors are at most sqrt(2 - 2 cosine) apart and
the border lies between them, so with half of that, the default, none can. A cell is cut into blocks, and each pair of blocks is one product of two small matrices that
gives link counts per vector and edges that connect what is linked, never the pairs themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomtab.llm.common import map_batches
from loomtab.llm.components import components, star_edges
from loomtab.session import materialize

CELL = 1000
MAX_CELLS = 4096
"""Centres on the driver and in every task. Beyond it cells grow and have more blocks; nothing is left out."""
SAMPLE_PER_CELL = 40
ROUNDS = 8
BLOCK = 1024


def spherical_means(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres of unit rows: farthest rows of a spread start, then assignments and means in turn."""
    centres = rows[np.linspace(0, len(rows) - 1, min(k, len(rows))).astype(int)].copy()
    for _ in range(rounds):
        nearest = np.argmax(rows @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 1e-12, sums / np.maximum(size, 1e-12)[:, None], centres)
    return np.unique(centres, axis=0)


def fit_cells(nodes: DataFrame, label: str, cell: int = CELL) -> dict:
    """Centres by (label, length of the vector), for groups above ``cell`` vectors; at most ``MAX_CELLS`` centres in all."""
    sizes = nodes.groupBy(label, F.size("vector").alias("dim")).count().where(F.col("count") > cell) \
        .orderBy(F.desc("count"), label, "dim").limit(MAX_CELLS // 2).collect()
    total = sum(r["count"] for r in sizes)
    cell = max(cell, -(-2 * total // MAX_CELLS))
    wanted = {(r[label], r["dim"]): (r["count"], -(-r["count"] // cell)) for r in sizes}
    if not wanted:
        return {}
    spark = nodes.sparkSession
    share = spark.createDataFrame([(g, d, min(1.0, SAMPLE_PER_CELL * k / n), k) for (g, d), (n, k) in wanted.items()], f"{label} {nodes.schema[label].dataType.simpleString()}, dim int, share double, k int")
    sample = nodes.withColumn("dim", F.size("vector")).join(F.broadcast(share), [label, "dim"]) \
        .where(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < F.col("share") * 1_000_000).select(label, "dim", "k", "node", "vector")

    def fit(table: pa.Table) -> pa.Table:
        order = np.argsort(table["node"].to_numpy())
        rows = units(table["vector"].combine_chunks(), table["dim"][0].as_py())[order]
        centres = spherical_means(rows, table["k"][0].as_py())
        return pa.table({label: table[label].slice(0, 1), "dim": table["dim"].slice(0, 1), "centres": pa.array([centres.ravel().tolist()], pa.list_(pa.float64()))})

    found = sample.groupBy(label, "dim").applyInArrow(fit, f"{label} {nodes.schema[label].dataType.simpleString()}, dim int, centres array<double>").collect()
    return {(r[label], r["dim"]): np.array(r["centres"]).reshape(-1, r["dim"]) for r in found}


def units(lists, dim: int) -> np.ndarray:
    """Rows of length one in double precision."""
    rows = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow and no underflow in the squares
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def borders(rows: np.ndarray, own: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distance of each row to the plane between its own centre and every other one (0 for its own)."""
    dots = rows @ centres.T
    gap = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 1e-300))
    return (dots[np.arange(len(rows)), own][:, None] - dots) / gap[own]


def visits(nodes: DataFrame, label: str, cells: dict, margin: float) -> DataFrame:
    """``cell`` and ``own`` cell of every vector, one row for each cell that it visits."""
    def run(batches):
        for batch in batches:
            names, vectors = batch.column(1).to_pylist(), batch.column(2)
            dims = pa.compute.list_value_length(vectors).to_pylist()
            own, seen = [0] * len(names), [[0]] * len(names)
            groups: dict = {}
            for i, group in enumerate(zip(names, dims)):
                if group in cells:
                    groups.setdefault(group, []).append(i)
            for group, at in groups.items():
                rows, centres = units(vectors.take(pa.array(at)), group[1]), cells[group]
                nearest = np.argmax(rows @ centres.T, axis=1)
                near = borders(rows, nearest, centres) <= margin
                near[np.arange(len(at)), nearest] = True
                for i, o, m in zip(at, nearest.tolist(), near):
                    own[i], seen[i] = o, np.flatnonzero(m).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32()), pa.array(seen, pa.list_(pa.int32()))], [*batch.schema.names, "own", "cells"])

    kind = nodes.schema[label].dataType.simpleString()
    rows = map_batches(nodes.select("node", label, "vector", "copies"), run, f"node long, {label} {kind}, vector {nodes.schema['vector'].dataType.simpleString()}, copies long, own int, cells array<int>")
    return rows.withColumn("dim", F.size("vector")).withColumn("cell", F.explode("cells")).drop("cells")


def compare(label: str, cells: dict, cosine: float, margin: float):
    def run(table: pa.Table) -> pa.Table:
        group, cell = (table[label][0].as_py(), table["dim"][0].as_py()), table["cell"][0].as_py()
        rows = units(table["vector"].combine_chunks(), group[1])
        node, copies, own = table["node"].to_numpy(), table["copies"].to_numpy(), table["own"].to_numpy()
        part, first = table["part"].to_numpy(), table["i"][0].as_py()
        left = np.flatnonzero(part == first)
        right = left if table["i"][0].as_py() == table["j"][0].as_py() else np.flatnonzero(part != first)
        linked = rows[left] @ rows[right].T >= cosine
        linked &= node[left][:, None] != node[right][None, :]
        mine_l, mine_r = own[left] == cell, own[right] == cell
        linked &= mine_l[:, None] | mine_r[None, :]
        # A pair with one end at home is also met in the other end's cell if that cell is near enough: it counts once.
        counted = linked
        if group in cells and not (mine_l.all() and mine_r.all()):
            centres = cells[group]
            reach = borders(rows, own, centres) <= margin
            reach[np.arange(len(rows)), own] = True
            twice = np.zeros_like(linked)
            twice |= mine_l[:, None] & ~mine_r[None, :] & reach[left][:, own[right]] & (own[right] < cell)[None, :]
            twice |= ~mine_l[:, None] & mine_r[None, :] & reach[right][:, own[left]].T & (own[left] < cell)[:, None]
            counted = linked & ~twice
        out = np.zeros(len(rows), np.int64)
        np.add.at(out, left, counted @ copies[right])
        if right is not left:
            np.add.at(out, right, counted.T @ copies[left])
        a, b = star_edges(linked, node[left], node[right])
        with_links = np.flatnonzero(out)
        return pa.table({"a": pa.array(np.concatenate([node[with_links], a]), pa.int64()),
                         "b": pa.array([None] * len(with_links) + b.tolist(), pa.int64()),
                         "links": pa.array(out[with_links].tolist() + [0] * len(a), pa.int64())})
    return run


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.98,
                 margin: float | None = None, cell: int = CELL) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Only vectors of one label and one length are compared. A NULL label, a NULL, empty or zero vector, and one with a NULL,
    NaN or infinite component links with nothing: no links, its own component, kept. Copies link to each other and are
    counted one by one, but compared once. A NULL key takes part; it is the component's id only where there is no other,
    and such a row is kept if it is alone. Of rows that share key and vector all are treated alike. Other columns are not read.
    """
    if margin is None:
        margin = max(0.0, 2 - 2 * cosine) ** 0.5 / 2 + 1e-6
    own = df.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    fine = F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("vector", lambda x: x != 0)
    own = own.withColumn("node", F.when(F.coalesce(fine, F.lit(False)), F.xxhash64("label", "vector")))
    nodes = materialize(own.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("key").alias("least")))
    cells = fit_cells(nodes, "label", cell)
    seen = materialize(visits(nodes, "label", cells, margin))
    where = ["label", "dim", "cell"]
    parts = seen.groupBy(*where).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    dealt = seen.join(parts, where).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
    met = materialize(dealt.groupBy(*where, "i", "j").applyInArrow(compare("label", cells, cosine, margin), "a long, b long, links long"))
    links = met.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(met.where("b is not null").select("a", "b"))
    named = nodes.join(links, "node", "left").join(roots, "node", "left").select("node", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    named = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "n_links", "component_id")
    out = own.select("key", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id"))
    kept = F.when(F.col("key").isNull(), F.coalesce("n_links", F.lit(0)) == 0).otherwise(F.col("key") == component)
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.cast("long").alias("component_id"), kept.alias("kept"))
