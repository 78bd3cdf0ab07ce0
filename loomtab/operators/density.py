"""Clusters by density: a hierarchy of dense regions, its most persistent ones, and soft membership in them.

The graph joins every row with its ``neighbors`` nearest; an edge weighs the largest of its length and the core distances (to the
farthest of those neighbours) of its two ends. Cutting it at a falling weight splits regions; a region of at least ``min_size`` rows
is a cluster. Small groups are contracted along their cheapest edges: such a chain grows from its cheapest edge outwards in order of weight,
so the edge at which each group joins follows from one running sum, up to the cheapest edge that leaves the chain. A cluster is born when
``min_size`` rows are together, and small groups whose chain ends at a cluster join it at their own cheapest edge. So the number of rounds
depends on ``min_size``, not on the rows. What is left are the born clusters, at most a ``min_size``-th of the rows, and the spanning forest
between them, found by the same contraction. That forest alone is read in order, one task for each of its trees. Weights are
compared with the keys of both ends, so ties have one result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from loomtab.operators.neighbors import nearest
from loomtab.operators.ordered import running
from loomtab.session import written

LISTED = 100_000
"""Entries of lists of clusters that leave a task together, about."""
TINY = 1e-9
"""Weights below this one count as this one, so that copies have a finite density."""


def density(weight: float) -> float:
    return 1.0 / max(weight, TINY)


def mutual_reachability(df: DataFrame, key: str, vector: str, neighbors: int) -> DataFrame:
    """Edges (a, b, weight), a < b, of the graph of ``neighbors`` nearest rows."""
    near = written(nearest(df, key, vector, neighbors).select(F.col(key).alias("a"), F.col("neighbor").alias("b"), "distance"), "near")
    core = near.groupBy("a").agg(F.max("distance").alias("core"))
    both = near.join(core, "a").join(core.select(F.col("a").alias("b"), F.col("core").alias("core_b")), "b")
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.greatest("distance", "core", "core_b").alias("weight")).distinct()


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b", "w").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))


def _cheapest(edges: DataFrame) -> DataFrame:
    """(a, b, w): the cheapest edge at each group."""
    return _both_ways(edges).groupBy("a").agg(F.min(F.struct("w", "b")).alias("m")).select("a", "m.b", "m.w")


def _roots(picked: DataFrame) -> DataFrame:
    """(a, root) of groups that point to another: the end of the chain, or the smaller of the two groups that pick each other."""
    back = picked.select(F.col("a").alias("b"), F.col("b").alias("back"))
    links = written(picked.join(back, "b", "left").select("a", F.when((F.col("back") == F.col("a")) & (F.col("a") < F.col("b")), F.col("a")).otherwise(F.col("b")).alias("root")), "roots")
    while True:
        ahead = links.select(F.col("a").alias("root"), F.col("root").alias("further"))
        new = written(links.join(ahead, "root", "left").select("a", F.coalesce("further", "root").alias("root"), (F.col("further") != F.col("root")).alias("moved")), "roots")
        links = new.select("a", "root")
        if new.where("moved").isEmpty():
            return links


def _contracted(edges: DataFrame, named: DataFrame) -> DataFrame:
    """Edges between groups after renaming (a -> root), the cheapest of each pair."""
    for end in ("a", "b"):
        edges = edges.join(named.select(F.col("a").alias(end), F.col("root").alias(f"_{end}")), end, "left").withColumn(end, F.coalesce(f"_{end}", end)).drop(f"_{end}")
    kept = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "w")
    return written(kept.groupBy("a", "b").agg(F.min("w").alias("w")), "edges")


def _leaving(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, out): the cheapest edge from each chain to anything else."""
    ends = edges
    for end in ("a", "b"):
        ends = ends.join(roots.select(F.col("a").alias(end), F.col("root").alias(f"_{end}")), end, "left")
    ends = ends.where(~F.col("_a").eqNullSafe(F.col("_b")))
    both = ends.select(F.col("_a").alias("root"), "w").unionByName(ends.select(F.col("_b").alias("root"), "w"))
    return both.where("root IS NOT NULL").groupBy("root").agg(F.min("w").alias("out"))


def _born(edges: DataFrame, keys: DataFrame, min_size: int) -> tuple[DataFrame, DataFrame]:
    """Cluster that each row is born in or joins first and the edge that does it, and the edges between these clusters."""
    rows = written(keys.select("key", F.col("key").alias("group"), F.lit(None).cast(edges.schema["w"].dataType).alias("at")), "rows")
    groups = written(keys.select(F.col("key").alias("a"), F.lit(1).cast("long").alias("n"), F.lit(min_size <= 1).alias("big")), "groups")
    while True:
        small = groups.where("not big").select("a", "n")
        picked = written(_cheapest(edges).join(small, "a"), "picked")
        if picked.isEmpty():
            return rows.join(groups.where("big").select(F.col("a").alias("group")), "group", "left_semi"), edges
        roots = _roots(picked.select("a", "b"))
        joined = picked.join(roots, "a").join(groups.select(F.col("a").alias("root"), F.col("big").alias("old")), "root")
        # The root of a chain without a big cluster comes first, its partner next, and so on by weight.
        placed = joined.select("a", "root", "n", "old", F.when(F.col("a") == F.col("root"), F.lit(None)).otherwise(F.col("w")).alias("at"), "w")
        summed = written(running(placed.where("not old"), ["root"], ["at"], {"sum": ("sum", F.col("n"))}), "sums")
        # What is beyond the cheapest edge to another chain is not decided yet, unless a cluster was born before it.
        reach = _leaving(edges, roots)
        summed = summed.join(reach, "root", "left").withColumn("sure", F.col("at").isNull() | F.col("out").isNull() | (F.col("at") < F.col("out")))
        births = summed.groupBy("root").agg(F.min(F.when(F.col("sure") & (F.col("sum") >= min_size), F.col("at"))).alias("birth"))
        grown = summed.join(births, "root").where("sure OR birth IS NOT NULL").select(
            "a", "root", F.greatest("at", "birth").alias("at"), F.col("birth").isNotNull().alias("big"), F.lit(False).alias("old"), "n")
        met = written(placed.where("old").select("a", "root", F.col("w").alias("at"), F.lit(True).alias("big"), F.lit(True).alias("old"), "n").unionByName(grown), "met")
        rows = written(rows.join(met.select(F.col("a").alias("group"), "root", F.when(F.col("big"), F.col("at")).alias("_now")), "group", "left")
                       .select("key", F.coalesce("root", "group").alias("group"), F.coalesce("at", "_now").alias("at")), "rows")
        merged = met.where("not old").groupBy(F.col("root").alias("a")).agg(F.sum("n").alias("n"), F.max("big").alias("big"))
        rest = groups.join(met.select("a"), "a", "left_anti")
        groups = written(rest.unionByName(merged), "groups")
        edges = _contracted(edges, met.select("a", "root"))


def _forest(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges of the cheapest spanning forest, and (a, tree) of every node; ends are the nodes themselves."""
    left = written(edges.select("a", "b", "w", F.col("a").alias("x"), F.col("b").alias("y")), "left")
    trees = written(nodes.select("a", F.col("a").alias("tree")), "trees")
    found = None
    while not left.isEmpty():
        best = _both_ways(left.withColumn("w", F.struct("w", "x", "y"))).groupBy("a").agg(F.min(F.struct("w", "b")).alias("m")).select("a", "m.b", "m.w")
        best = written(best, "best")
        new = best.select("w.w", "w.x", "w.y").distinct()
        found = new if found is None else found.unionByName(new)
        roots = _roots(best.select("a", "b"))
        trees = written(trees.join(roots.select(F.col("a").alias("tree"), "root"), "tree", "left").select("a", F.coalesce("root", "tree").alias("tree")), "trees")
        for end in ("a", "b"):
            left = left.join(roots.select(F.col("a").alias(end), F.col("root").alias(f"_{end}")), end).withColumn(end, F.col(f"_{end}")).drop(f"_{end}")
        left = written(left.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "w", "x", "y")
                       .groupBy("a", "b").agg(F.min(F.struct("w", "x", "y")).alias("m")).select("a", "b", "m.w", "m.x", "m.y"), "left")
    if found is None:
        found = left.select("w", "x", "y")
    return found, trees


def merge_tree(tree: str, nodes: Sequence, edges: Sequence[tuple]) -> dict:
    """node -> (parent, edge at which it ends, edge at which it was made), None where there is none; edges are ((weight, a, b), node, node)."""
    top = {n: n for n in nodes}
    out = {n: [None, None, None] for n in nodes}
    sets = {n: n for n in nodes}

    def root(n):
        while sets[n] != n:
            sets[n] = n = sets[sets[n]]
        return n

    for number, (w, a, b) in enumerate(sorted(edges)):
        a, b = root(a), root(b)
        name = f"{tree}+{number}"
        for side in (a, b):
            out[top[side]][:2] = [name, w]
        out[name] = [None, None, w]
        sets[b] = a
        top[a] = name
    return out


def _climbed(rows: DataFrame, tree: DataFrame) -> DataFrame:
    """Rows (group, at, ...) with ``exit``: the smallest cluster around the group that has not ended at that edge."""
    jumps = [written(tree.where("parent is not null").select("node", F.col("parent").alias("to")), "jumps")]
    ends = tree.select(F.col("node").alias("to"), F.col("ends").alias("then"))
    while not jumps[-1].isEmpty():
        last = jumps[-1]
        jumps.append(written(last.join(last.select(F.col("node").alias("to"), F.col("to").alias("further")), "to").select("node", F.col("further").alias("to")), "jumps"))
    at = rows.withColumn("exit", F.col("group"))
    for jump in reversed(jumps[:-1]):
        far = jump.join(ends, "to").select(F.col("node").alias("exit"), "to", "then")
        at = at.join(far, "exit", "left").withColumn("exit", F.when(F.col("then") < F.col("at"), F.col("to")).otherwise(F.col("exit"))).drop("to", "then")
    last = tree.select(F.col("node").alias("exit"), "parent", "ends")
    at = at.join(last, "exit").withColumn("exit", F.when(F.col("ends") < F.col("at"), F.col("parent")).otherwise(F.col("exit")))
    return at.drop("parent", "ends")


def chosen_clusters(tree: dict, exits: dict, single: bool, top: int | None = None) -> tuple[dict, Iterator[tuple]]:
    """(leaf -> its own cluster or None, lists of all clusters). ``tree`` has weights.

    ``exits`` has (rows, sum of densities, highest density) of the rows that leave at a node. A cluster is chosen where it persists longer
    than all chosen below it. The whole tree is no choice if ``single``. All leaves of a cluster join the others at the same densities, so there is
    a list for each cluster, made as it is read: (cluster, [(other, density at which the two are one, highest density of the other)]), itself first and
    those it joins first next. ``top`` ends a list.
    """
    children: dict = {}
    for node, (parent, *_) in tree.items():
        children.setdefault(parent, []).append(node)
    order, stack = [], list(children.get(None, ()))
    while stack:
        node = stack.pop()
        order.append(node)
        stack += children.get(node, ())
    size, best, high, inner_best, chosen = {}, {}, {}, {}, {}
    for node in reversed(order):
        parent, ends, made = tree[node]
        n, total, highest = exits.get(node, (0, 0.0, 0.0))
        below = sorted(children.get(node, ()))
        size[node] = n + sum(size[c] for c in below)
        high[node] = max([highest, *(high[c] for c in below)])
        persists = total + sum(size[c] * density(made) for c in below) - size[node] * (density(ends) if ends < math.inf else 0.0)
        inner_best[node] = sum(best[c] for c in below)
        chosen[node] = (persists >= inner_best[node] or not below) and not (parent is None and single)
        best[node] = persists if chosen[node] else inner_best[node]
    inside = {}
    for node in order:
        inside[node] = inside.get(tree[node][0]) or (node if chosen[node] else None)

    def picks(node) -> Iterator:
        """Chosen clusters at and below a node, from the smallest name of a branch on."""
        todo = [node]
        while todo:
            at = todo.pop()
            if chosen[at]:
                yield at
            else:
                todo += sorted(children.get(at, ()), reverse=True)

    def met(own) -> Iterator[tuple]:
        yield own, math.inf, high[own]
        at = own
        while (parent := tree[at][0]) is not None:
            joined = density(tree[parent][2])
            for p in sorted(p for c in children[parent] if c != at for p in picks(c)):
                yield p, joined, high[p]
            at = parent

    leaves = {node: inside[node] for node in order if not children.get(node)}
    return leaves, ((own, list(islice(met(own), top))) for own in dict.fromkeys(o for o in leaves.values() if o))


def density_clusters(df: DataFrame, key: str, vector: str, neighbors: int = 15, min_size: int = 50, top: int | None = None) -> DataFrame:
    """(key, cluster, memberships) of every row; ``cluster`` is NULL for noise.

    A membership is how dense the row and the cluster are where they become one, as a share of the cluster's highest density; the shares of all clusters
    that a row ever joins (``top``: of that many it joins first) are scaled so that they add up to the largest of them. A cluster is named by the tree
    it stems from. Rows in groups of fewer than ``min_size``, alone in their part of the graph, have no memberships. If all rows
    are one part, the cluster of all rows is no choice. Keys must be unique and not NULL, vectors of one length.
    """
    keys = df.select(F.col(key).alias("key"))
    edges = written(mutual_reachability(df, key, vector, neighbors).select("a", "b", F.struct("weight", "a", "b").alias("w")), "edges")
    rows, between = _born(edges, keys, min_size)
    rows = written(rows, "born")
    nodes = rows.select(F.col("group").alias("a")).distinct()
    spanning, trees = _forest(between, nodes)
    trees = written(trees.select(F.col("a").cast("string").alias("node"), F.col("tree").cast("string").alias("tree")), "trees")
    spanning = written(spanning.select(F.col("w.weight").alias("weight"), F.col("w.a").alias("ea"), F.col("w.b").alias("eb"),
                                       F.col("x").cast("string").alias("x"), F.col("y").cast("string").alias("y")).join(trees.select(F.col("node").alias("x"), "tree"), "x"), "spanning")
    single = trees.select("tree").distinct().limit(2).count() < 2

    def grow(own: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        made = merge_tree(own["tree"].iloc[0], own["node"].tolist(), [((w, a, b), x, y) for w, a, b, x, y in zip(links["weight"], links["ea"], links["eb"], links["x"], links["y"])])
        names = list(made)
        edge = lambda e: None if e is None else dict(zip(("weight", "a", "b"), e))
        return pd.DataFrame({"tree": own["tree"].iloc[0], "node": names, **{c: [made[n][0] if i == 0 else edge(made[n][i]) for n in names] for i, c in enumerate(("parent", "ends", "made"))}})

    kind = rows.schema["at"].dataType.simpleString()
    tree = written(trees.groupBy("tree").cogroup(spanning.groupBy("tree")).applyInPandas(grow, f"tree string, node string, parent string, ends {kind}, made {kind}"), "tree")
    dense = 1 / F.greatest("at.weight", F.lit(TINY))
    left = _climbed(rows.select("key", F.col("group").cast("string").alias("group"), "at"), tree.select("node", "parent", "ends"))
    exits = written(left.groupBy("exit").agg(F.count(F.lit(1)).alias("n"), F.sum(dense).alias("total"), F.max(dense).alias("high")), "exits")
    known = tree.select("tree", "node", "parent", F.col("ends.weight").alias("ends"), F.col("made.weight").alias("made")).join(exits.withColumnRenamed("exit", "node"), "node", "left")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(batches).to_pandas()
        nodes = {n: (p, math.inf if pd.isna(e) else e, m) for n, p, e, m in zip(t["node"], t["parent"].where(t["parent"].notna(), None), t["ends"], t["made"])}
        leaves, lists = chosen_clusters(nodes, {n: (int(c), s, h) for n, c, s, h in zip(t["node"], t["n"], t["total"], t["high"]) if c == c}, single, top)
        yield sent([*leaves], [*leaves.values()], [None] * len(leaves))
        names, held = [], []
        for own, near in lists:
            names.append(own), held.append([dict(zip(("cluster", "joined", "high"), c)) for c in near])
            if len(held) * len(near) >= LISTED:
                yield sent([None] * len(names), names, held)
                names, held = [], []
        if names:
            yield sent([None] * len(names), names, held)

    entry = pa.list_(pa.struct([("cluster", pa.string()), ("joined", pa.float64()), ("high", pa.float64())]))

    def sent(leaves: list, own: list, near: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(leaves, pa.string()), pa.array(own, pa.string()), pa.array(near, entry)], ["group", "_own", "near"])

    # A row for each leaf with its cluster, and one for each cluster with its list.
    told = written(known.groupBy("tree").applyInArrow(choose, "group string, _own string, near array<struct<cluster: string, joined: double, high: double>>"), "chosen")
    out = rows.select("key", F.col("group").cast("string").alias("group"), "at").join(told.where("group IS NOT NULL").select("group", "_own"), "group", "left")
    out = out.join(told.where("group IS NULL").select("_own", "near"), "_own", "left").drop("_own")
    out = out.withColumn("shares", F.transform("near", lambda c: F.least(dense, c["joined"]) / c["high"]))
    out = out.withColumn("scale", F.array_max("shares") / F.aggregate("shares", F.lit(0.0), lambda a, x: a + x))
    first = F.get("near", F.lit(0))
    out = out.withColumn("own", F.when(first["joined"] == float("inf"), first["cluster"])).join(tree.select(F.col("node").alias("own"), "ends"), "own", "left")
    out = out.select(F.col("key").alias("_key"), F.when(F.col("ends").isNull() | (F.col("at") < F.col("ends")), F.col("own")).alias("cluster"),
                     F.transform(F.arrays_zip("near", "shares"), lambda z: F.struct(z["near"]["cluster"].alias("cluster"), (z["shares"] * F.col("scale")).alias("membership"))).alias("memberships"))
    empty = F.array().cast("array<struct<cluster: string, membership: double>>")
    return keys.join(out, keys["key"] == out["_key"], "left").select(F.col("key").alias(key), "cluster", F.coalesce("memberships", empty).alias("memberships"))


def reduced(df: DataFrame, key: str, vector: str, components: int) -> DataFrame:
    """(key, vector) in the plane of the widest spread."""
    rows = df.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    return PCA(k=components, inputCol="_v", outputCol="_p").fit(rows).transform(rows).select(key, vector_to_array("_p").alias(vector))
