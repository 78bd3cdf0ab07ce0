"""Clusters by density against one pass over all edges in order."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtab.operators import density as D


def plain(keys, edges, min_size, top=8):
    """row -> (rows of its cluster or None, {rows of a cluster: membership}), by merging edge after edge."""
    sets = {k: {"rows": [k], "node": None} for k in keys}
    nodes, exits = {}, {}
    for w, a, b in sorted((w, a, b) for a, b, w in edges):
        x, y = sets[a], sets[b]
        if x is y:
            continue
        if x["node"] is not None and y["node"] is not None:
            name = len(nodes)
            nodes[name] = [None, math.inf, w]
            for side in (x, y):
                nodes[side["node"]][:2] = [name, w]
        elif x["node"] is None and y["node"] is None:
            name = None
            if len(x["rows"]) + len(y["rows"]) >= min_size:
                name = len(nodes)
                nodes[name] = [None, math.inf, None]
                exits.update({r: (name, w) for r in x["rows"] + y["rows"]})
        else:
            big, small = (x, y) if x["node"] is not None else (y, x)
            name = big["node"]
            exits.update({r: (name, w) for r in small["rows"]})
        made = {"rows": x["rows"] + y["rows"], "node": name}
        for r in made["rows"]:
            sets[r] = made

    def above(n):
        out = [n]
        while nodes[out[-1]][0] is not None:
            out.append(nodes[out[-1]][0])
        return out

    inside = {n: {r for r, (e, _) in exits.items() if n in above(e)} for n in nodes}
    roots = [n for n in nodes if nodes[n][0] is None]
    lam = D.density
    best, picks = {}, {}
    for n in sorted(nodes, key=lambda n: (len(inside[n]), -len(above(n)))):
        below = [c for c in nodes if nodes[c][0] == n]
        persists = sum(lam(exits[r][1]) if exits[r][0] == n else lam(nodes[n][2]) for r in inside[n]) - len(inside[n]) * (lam(nodes[n][1]) if nodes[n][1] < math.inf else 0)
        if (persists >= sum(best[c] for c in below) or not below) and not (n in roots and len(roots) < 2):
            best[n], picks[n] = persists, [n]
        else:
            best[n], picks[n] = sum(best[c] for c in below), [p for c in below for p in picks[c]]
    chosen = [p for r in roots for p in picks[r]]
    high = {n: max(lam(exits[r][1]) for r in inside[n]) for n in nodes}
    out = {}
    for r in keys:
        if r not in exits:
            out[r] = (None, {})
            continue
        node, w = exits[r]
        own = [c for c in chosen if c in above(node)]
        near = []
        for c in chosen:
            if c in above(node):
                near.append((-math.inf, c))
            else:
                meet = next((n for n in above(c) if n in above(node)), None)
                if meet is not None:
                    near.append((-lam(nodes[meet][2]), c))
        shares = {frozenset(inside[c]): min(lam(w), -d) / high[c] for d, c in near}
        scale = max(shares.values()) / sum(shares.values()) if shares else 0
        out[r] = (frozenset(inside[own[0]]) if own else None, {c: s * scale for c, s in shares.items()})
    return out


def compare(spark, df, neighbors, min_size):
    edges = [tuple(r) for r in D.mutual_reachability(df, "id", "v", neighbors).collect()]
    keys = [r[0] for r in df.select("id").collect()]
    want = plain(keys, edges, min_size)
    got = D.density_clusters(df, "id", "v", neighbors, min_size, top=10 ** 6).collect()
    assert sorted(r["id"] for r in got) == sorted(keys)
    named = {}
    for r in got:
        named.setdefault(r["cluster"], set()).add(r["id"])
    for r in got:
        cluster, shares = want[r["id"]]
        assert (None if r["cluster"] is None else frozenset(named[r["cluster"]])) == cluster
        mine = {frozenset(named[m["cluster"]]): m["membership"] for m in r["memberships"]}
        assert set(mine) == set(shares)
        for c in mine:
            assert mine[c] == pytest.approx(shares[c], rel=1e-9)
    return {k: v for k, v in named.items() if k is not None}, want


def frame(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, v array<double>").repartition(6)


def test_clusters_and_noise(spark):
    r = np.random.default_rng(0)
    points = np.concatenate([r.normal(c, s, (n, 2)) for c, s, n in ((0, 0.3, 60), (4, 0.5, 80), (9, 0.2, 40))] + [r.uniform(-5, 15, (25, 2))])
    found, want = compare(spark, frame(spark, points), 8, 15)
    assert len(found) >= 3 and sum(c is None for c, _ in want.values()) > 3
    for first, last in ((0, 60), (60, 140), (140, 180)):  # each cloud is one cluster, but for its fringe
        assert max(len(rows & set(range(first, last))) for rows in found.values()) > 0.8 * (last - first)


@pytest.mark.parametrize("seed,min_size,neighbors", [(2, 5, 4), (4, 3, 1)])
def test_many_small_and_tied(spark, seed, min_size, neighbors):
    r = random.Random(seed)
    points = [(r.randint(0, 14), r.randint(0, 14)) for _ in range(160)]  # ties and copies
    compare(spark, frame(spark, points), neighbors, min_size)


def test_no_cluster_is_left_out(spark, monkeypatch):
    monkeypatch.setattr(D, "LISTED", 20)
    r = np.random.default_rng(5)
    between = [(x, 0) for x in np.arange(0, 72, 0.7) + r.uniform(-0.1, 0.1, 103) if 1 < x % 6 < 5]
    df = frame(spark, np.concatenate([*(r.normal((6 * i, 0), 0.1, (12, 2)) for i in range(13)), between]))
    want = plain(range(df.count()), [tuple(q) for q in D.mutual_reachability(df, "id", "v", 4).collect()], 10)
    got = D.density_clusters(df, "id", "v", 4, 10).collect()
    assert max(len(shares) for _, shares in want.values()) > 8
    for q in got:
        assert sorted(m["membership"] for m in q["memberships"]) == pytest.approx(sorted(want[q["id"]][1].values()))


def test_a_long_chain_and_few_rows(spark):
    chain = [(sum(1 + i / 50 for i in range(n)), 0.0) for n in range(70)]  # steps grow: each row picks the one before
    compare(spark, frame(spark, chain), 2, 9)
    assert [(r["cluster"], r["memberships"]) for r in D.density_clusters(frame(spark, [(0, 0), (1, 1), (2, 2)]), "id", "v", 2, 50).collect()] == [(None, [])] * 3
    assert D.density_clusters(frame(spark, [(0, 0)]).limit(0), "id", "v").count() == 0


def test_embeddings_row_by_row(spark):
    from loomtab.sources.tables import Tables

    own = D.reduced(Tables(spark, "/root/testdata/sf0.1").embeddings, "vec_id", "embedding", 5).select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    assert own.count() == 2000
    compare(spark, own.persist(), 15, 20)
