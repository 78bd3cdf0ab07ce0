"""Most similar bit sets against a full comparison."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtab.operators import bits as B


def plain(rows, asked, k, size):
    def places(items):
        import hashlib
        return {int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % size for x in items or [] if x is not None}

    sets = [(key, places(items)) for key, items in rows]
    out = []
    for key, items in asked:
        own = places(items)
        scored = sorted((-(len(own & s) / len(own | s) if own | s else 0.0), other) for other, s in sets if other != key)
        out += [(key, r + 1, other, -s) for r, (s, other) in enumerate(scored[:k])]
    return out


def drawn(n, seed=0):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, r.sample(words, r.choice([0, 1, 2, 5, 40, 120]))) for i in range(n)]
    near = [(n + i, [w for w in rows[i][1] if r.random() < 0.9]) for i in range(n // 3)]
    copies = [(2 * n + i, ["a", "b", "c"]) for i in range(n // 3)]
    return [*rows, *near, *copies, (9000, None), (9001, [None, "x"]), (9002, ["x", "x"])]


@pytest.mark.parametrize("k,size", [(3, 2048), (5, 64), (10_000, 256)])
def test_topk_as_a_full_comparison(spark, monkeypatch, k, size):
    for name, value in (("BAND", 16), ("HELD", 60), ("QUERY_BLOCK", 40)):
        monkeypatch.setattr(B, name, value)
    rows = drawn(150)
    df = spark.createDataFrame(rows, "id long, w array<string>").repartition(4)
    asked = [r for r in rows if r[0] % 3 == 0] + [(9000, None)]
    got = B.tanimoto_topk(df, "id", "w", k, spark.createDataFrame(sorted(set((i, tuple(w) if w else None) for i, w in asked), key=str), "id long, w array<string>"), size).collect()
    want = plain(rows, list({i: (i, w) for i, w in asked}.values()), k, size)
    assert sorted(map(tuple, got)) == sorted(want)


def test_bands_are_skipped():
    r = np.random.default_rng(0)
    rows = np.zeros((6000, 512), np.uint8)
    for i, n in enumerate(r.integers(1, 500, 6000)):
        rows[i, r.choice(512, n, replace=False)] = 1
    asked = rows[::100].astype(np.float32)
    best = B.Best(len(asked), 3)
    compared = B.visit(best, asked, rows[::100].sum(axis=1, dtype=np.int64), np.arange(6000), rows)
    assert compared < 0.75 * len(asked) * 6000
    shared = asked @ rows.T
    full = shared / (asked.sum(axis=1)[:, None] + rows.sum(axis=1)[None, :] - shared)
    for q in range(len(asked)):
        want = np.lexsort((np.arange(6000), -full[q]))[:3]
        assert best.key[best.query == q].tolist() == want.tolist()


def test_copies_give_k_rows_and_nothing_gives_none(spark):
    df = spark.range(3000).selectExpr("id", "array('same', 'words') AS w")
    got = B.tanimoto_topk(df, "id", "w", 4, df.where("id % 50 = 0")).collect()
    assert len(got) == 60 * 4 and all(r["similarity"] == 1.0 and r["neighbor"] < 5 for r in got)
    assert B.tanimoto_topk(df, "id", "w", 4, df.limit(0)).count() == 0
    assert B.tanimoto_topk(df.limit(0), "id", "w", 4, df.limit(2)).count() == 0


def test_offers_are_made_once_a_round_and_sets_once(spark, monkeypatch):
    r, offers = np.random.default_rng(0), []
    rows = (r.random((4096, 64)) < r.random((4096, 1))).astype(np.uint8)
    asked = rows[::50].astype(np.float32)

    class Counted(B.Best):
        def offer(self, *args):
            offers.append(1)
            super().offer(*args)

    best = Counted(len(asked), 3)
    B.visit(best, asked, rows[::50].sum(axis=1, dtype=np.int64), np.arange(4096), rows)
    assert len(offers) <= 4096 // B.BAND
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def words(i):
        made.add(1)
        return [str(i % 7), str(i)]

    monkeypatch.setattr(B, "QUERY_BLOCK", 5)
    df = spark.range(100).select("id", words("id").alias("w"))
    assert B.tanimoto_topk(df, "id", "w", 3, df.where("id % 4 = 0")).count() == 75
    assert made.value <= 250  # the rows once, the queries once, whatever the blocks
