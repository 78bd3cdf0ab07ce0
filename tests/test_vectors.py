import itertools

import numpy as np
from pyspark.sql import functions as F

from loomtab.operators import neighbors as N, retrieval as V


def _frame(spark, x, by=None):
    rows = [(i, [float(v) for v in row], int(by[i]) if by is not None else 0) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<double>, g int")


def _brute(x, k, groups, queries=None):
    out = set()
    q = x if queries is None else queries
    for i in range(len(q)):
        d = sorted((round(float(np.linalg.norm(q[i] - x[j])), 9), j) for j in range(len(x))
                   if (queries is not None or i != j) and (groups is None or groups[i] == groups[j]))
        out |= {(i, r + 1, j) for r, (_, j) in enumerate(d[:k])}
    return out


def _got(df, key="id"):
    return {(r[key], r["rank"], r["neighbor"]) for r in df.collect()}


def test_pruned_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.3, (40, 4)) for c in (0, 3, 6)])
    assert _got(N.nearest(_frame(spark, x), "id", "v", 3, n_pivots=6)) == _brute(x, 3, None)


def test_groups_and_pivots(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(2)
    x, g = rng.normal(0, 1, (90, 3)), np.arange(90) % 3
    assert _got(N.nearest(_frame(spark, x, g), "id", "v", 4, by=["g"], n_pivots=5)) == _brute(x, 4, g)


def test_no_row_is_copied_for_a_comparison(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 50)
    x = np.random.default_rng(11).normal(0, 1, (500, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    found = N.nearest(df, "id", "v", 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan  # rows are read where they are written
    assert _got(found) == _brute(x, 3, None)


def test_copies_repeated_keys_and_mirrored(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(12)
    x, g = np.concatenate([rng.normal(0, 1, (60, 3)), np.tile(rng.normal(0, 1, (2, 3)), (30, 1))]), np.arange(120) % 2
    near, far = N.nearest_and_opposite(_frame(spark, x, g), "id", "v", 3, 4, ["g"])
    assert _got(near) == _brute(x, 3, g) == _got(N.nearest(_frame(spark, x, g), "id", "v", 3, by=["g"]))
    mirrored = {(i, r + 1, j) for i in range(len(x)) for r, (_, j) in enumerate(sorted((round(float(np.linalg.norm(-x[i] - x[j])), 9), j) for j in range(len(x)) if g[i] == g[j])[:4])}
    assert _got(far) == mirrored
    twice = _frame(spark, x[:40]).unionByName(_frame(spark, x[:40]))
    want = {(i, j) for i, _, j in _brute(x[:40], 2, None)}
    assert {(r["id"], r["neighbor"]) for r in N.nearest(twice, "id", "v", 4).collect()} >= {(i, j) for i, r, j in _brute(x[:40], 1, None)}
    assert {(r["id"], r["neighbor"]) for r in N.nearest(twice, "id", "v", 8).collect()} >= want


def test_copies_are_folded(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(3)
    x = np.concatenate([np.tile(rng.normal(0, 1, (1, 3)), (80, 1)), rng.normal(0, 1, (40, 3))])
    assert _got(N.nearest(_frame(spark, x), "id", "v", 3, n_pivots=4)) == _brute(x, 3, None)


def test_other_queries(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 8)
    rng = np.random.default_rng(4)
    x, q = rng.normal(0, 1, (50, 3)), rng.normal(0, 1, (20, 3))
    assert _got(N.nearest(_frame(spark, x), "id", "v", 2, queries=_frame(spark, q), n_pivots=4)) == _brute(x, 2, None, q)


def test_scan_and_join_agree(spark, tables):
    e = tables.embeddings
    q = e.limit(15).select("vec_id", "embedding").withColumnRenamed("vec_id", "q")
    for metric in ("cosine", "l2"):
        a = {(r.q, r["rank"], r.vec_id) for r in N.top_by_scan(e, "vec_id", "embedding", q, "q", 4, metric).collect()}
        b = {(r.q, r["rank"], r.vec_id) for r in N.top_by_scan(e, "vec_id", "embedding", q, "q", 4, metric, query_block=4).collect()}
        assert a == b and len(a) == 60


def test_own_vector_is_at_distance_zero(spark, tables):
    first = tables.embeddings.where("vec_id = 0").withColumnRenamed("vec_id", "q")
    top = N.top_by_scan(tables.embeddings, "vec_id", "embedding", first, "q", 1, "l2").first()
    assert top.vec_id == 0 and abs(top.score) < 1e-4


def test_jaccard_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    sets = [sorted(set(rng.integers(0, 25, rng.integers(3, 14)).tolist())) for _ in range(70)] + [[1, 2, 3]] * 5
    df = spark.createDataFrame([(i, [f"t{v}" for v in s]) for i, s in enumerate(sets)], "id long, s array<string>")
    for t in (0.3, 0.6, 0.9, 1.0):
        got = {}
        for r in V.jaccard_pairs(df, "id", "s", t).collect():
            got[(r.a, r.b)] = (round(r.similarity, 9), r.n_pairs)
        rep, copies = {}, {}
        for i, s in enumerate(sets):
            rep.setdefault(tuple(s), i)
            copies[tuple(s)] = copies.get(tuple(s), 0) + 1
        want = {(i, i): (1.0, c * (c - 1) // 2) for s, i in rep.items() if (c := copies[s]) > 1}
        for (s, i), (u, j) in itertools.combinations(sorted(rep.items(), key=lambda p: p[1]), 2):
            sim = len(set(s) & set(u)) / len(set(s) | set(u))
            if sim >= t - 1e-12:
                want[(i, j)] = (round(sim, 9), copies[s] * copies[u])
        assert got == want


def test_late_interaction_in_blocks(spark, tables):
    patches = tables.embeddings.select((F.col("vec_id") % 7).alias("page"), "embedding")
    tokens = tables.embeddings.limit(12).select((F.col("vec_id") % 3).alias("q"), F.col("embedding").alias("t"))
    one = V.late_interaction(patches, "page", "embedding", tokens, "q", "t", 3).collect()
    assert V.late_interaction(patches, "page", "embedding", tokens.limit(0), "q", "t", 3).count() == 0
    many = V.late_interaction(patches, "page", "embedding", tokens, "q", "t", 3, token_block=4).collect()
    key = lambda r: (r.q, r["rank"], r.page, round(r.score, 9))
    assert sorted(map(key, one)) == sorted(map(key, many))


def test_pieces_for_all_pivots_are_bounded():
    import pandas as pd

    frame = pd.DataFrame({"_id": range(10_000)})
    pieces = list(N._pieces(iter([frame, frame.iloc[:0], frame.iloc[:7]]), 600))
    assert max(len(p) for p in pieces) * 600 <= N.VISITS and sum(len(p) for p in pieces) == 10_007
    assert [len(p) for p in N._pieces(iter([frame.iloc[:3]]), 10 * N.VISITS)] == [1, 1, 1]


def test_small_pieces_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    monkeypatch.setattr(N, "VISITS", 20)
    x = np.random.default_rng(8).normal(0, 1, (100, 4))
    assert _got(N.nearest(_frame(spark, x), "id", "v", 3, n_pivots=6)) == _brute(x, 3, None)


def test_jaccard_of_long_sets_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(V, "SET_BLOCK", 9)
    rng = np.random.default_rng(6)
    sets = []
    for n in (20, 40, 300, 700, 2000):
        base = rng.choice(9000, n, replace=False)
        sets += [sorted({*base[: n - n // 10 * c].tolist(), *range(9000 + c * 50, 9000 + c * 50 + n // 20 * c)}) for c in range(5)]
    df = spark.createDataFrame([(i, [f"t{v}" for v in s]) for i, s in enumerate(sets)], "id long, s array<string>")
    want = {(i, j): round(s, 9) for j in range(len(sets)) for i in range(j) if (s := len({*sets[i]} & {*sets[j]}) / len({*sets[i]} | {*sets[j]})) >= 0.6}
    assert len(want) > 25 and {(r.a, r.b): round(r.similarity, 9) for r in V.jaccard_pairs(df, "id", "s", 0.6).where("a <> b").collect()} == want


def test_jaccard_sketches_rule_out_sets_of_common_words():
    # All pairs share rare-enough words, hardly any is alike: before, each such pair was written out.
    rng = np.random.default_rng(7)
    n, width = np.full(200, 120), 512
    rows = (np.array([np.bincount(rng.choice(1 << 20, 400, replace=False)[rng.choice(400, 120, replace=False)] % width, minlength=width) for _ in range(200)]) & 1).astype(np.uint8)
    bits = [np.packbits(r).tobytes() for r in rows]
    found = {(a, b) for i, j in V._alike(n, bits, n, bits, 0.6) for a, b in zip(i.tolist(), j.tolist())}
    assert {(i, i) for i in range(200)} <= found and len(found) < 220


def _okapi(docs, queries, k):
    """docs: (key, tokens or None); texts of one key and length are one document, scores of a key add up."""
    import collections
    import math

    one, n, total = {}, 0, 0
    for key, t in docs:
        one.setdefault((key, len(t or [])), collections.Counter()).update(w for w in t or [] if w is not None)
        rows = 1 + sum(w is None for w in t or [])
        n, total = n + rows, total + rows * len(t or [])
    df = collections.Counter(w for c in one.values() for w in c)
    idf = {w: math.log(n - m + 0.5) - math.log(m + 0.5) for w, m in df.items()}
    idf = {w: 0.25 * sum(idf.values()) / len(idf) if v < 0 else v for w, v in idf.items()}
    out = {}
    for q, asked in queries:
        scores = collections.Counter()
        for (key, size), c in one.items():
            hit = [w for w in asked if w in c]
            if hit:
                scores[key] += sum(idf[w] * c[w] * 2.5 / (c[w] + 1.5 * (0.25 + 0.75 * size * n / total)) for w in hit)
        for r, (key, v) in enumerate(sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0] is not None, x[0] or 0))[:k]):
            out[q, r + 1] = key, round(v, 6)
    return out


def test_keyword_search_as_a_plain_version(spark, monkeypatch):
    import random

    monkeypatch.setattr(V, "QUERY_WEIGHTS", 9)  # queries in blocks
    r = random.Random(6)
    text = lambda n: [r.choice([None, *"abcdefgh", f"w{r.randint(0, 30)}"]) for _ in range(n)]
    single = [(i, text(r.choice([0, 1, 9, 30]))) for i in range(80)] + [(80, None), (81, ["a", "b"]), (82, ["b", "a"])]
    queries = [(q, [f"w{q}", *r.sample("abcdefgh", 3), "a", "nowhere"]) for q in range(12)]
    asked = spark.createDataFrame(queries, "q long, t array<string>")
    for docs in (single, single + [(3, single[3][1]), (3, text(9)), (5, text(4)), (None, text(9)), (None, text(9))]):
        df = spark.createDataFrame(docs, "id long, t array<string>").repartition(4)
        found = V.bm25_topk(df, "id", F.col("t"), asked, "q", F.col("t"), 5)
        assert {(x["q"], x["rank"]): (x["id"], round(x["score"], 6)) for x in found.collect()} == _okapi(docs, queries, 5)
        if docs is single:  # scores of documents never meet in a shuffle, only the best of each task
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert "Join" not in plan and "Aggregate" not in plan
    assert V.bm25_topk(df.limit(0), "id", F.col("t"), asked, "q", F.col("t"), 5).count() == 0 == V.bm25_topk(df, "id", F.col("t"), asked.limit(0), "q", F.col("t"), 5).count()
