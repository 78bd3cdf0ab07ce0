"""Alignment of many pairs against one table and one way back per pair."""

import random

import numpy as np
import pytest

from loomtab.operators import align as A
from loomtab.plans import q_text  # noqa: F401 - registers the queries
from loomtab.plans.registry import QUERIES
from loomtab.sources.tables import Tables


def plain(x, y):
    if not x or not y:
        return 0.0
    n, m = len(x), len(y)
    score = [[-2 * (i + j) if not i or not j else 0 for j in range(m + 1)] for i in range(n + 1)]
    pair = lambda i, j: 2 if x[i - 1] == y[j - 1] else -1
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            score[i][j] = max(score[i - 1][j - 1] + pair(i, j), score[i - 1][j] - 2, score[i][j - 1] - 2)
    i, j, same, width = n, m, 0, 0
    while i or j:
        width += 1
        if i and j and score[i][j] == score[i - 1][j - 1] + pair(i, j):
            same += x[i - 1] == y[j - 1]
            i, j = i - 1, j - 1
        elif i and score[i][j] == score[i - 1][j] - 2:
            i -= 1
        else:
            j -= 1
    return same / width


def changed(r, s, n, letters):
    out = list(s)
    for _ in range(n):
        at = r.randrange(len(out) + 1)
        out[at:at + r.choice([0, 1, 1])] = r.choice(["", r.choice(letters)])
    return "".join(out)


@pytest.mark.parametrize("letters", ["ab", "ACGT", "\u6f22x\U0001d518 \u00e9z"])
def test_identities_as_the_plain_table(monkeypatch, letters):
    monkeypatch.setattr(A, "CLASS", 8)
    monkeypatch.setattr(A, "CELLS", 200)
    r = random.Random(len(letters))
    pairs = [("", "a"), (None, "a"), ("a", ""), ("a", "a"), ("a", "b"), ("ab", "a")]
    for _ in range(250):
        x = "".join(r.choices(letters, k=r.randint(1, 40)))
        pairs.append((x, changed(r, x, r.randint(0, 12), letters) if r.random() < 0.6 else "".join(r.choices(letters, k=r.randint(1, 40)))))
    got = A.identities([p[0] for p in pairs], [p[1] for p in pairs])
    assert got.tolist() == pytest.approx([plain(*p) for p in pairs], abs=1e-12)
    assert np.allclose(A.identities([p[0] for p in pairs], [p[0] for p in pairs]), [float(bool(p[0])) for p in pairs])


@pytest.mark.parametrize("threshold", [0.6, 0.8, 0.9, 0.97, 1.0])
def test_no_alike_pair_is_lost(spark, threshold):
    r = random.Random(3)
    own = ["".join(r.choices("ACGT", k=n)) for n in (3, 5, 9, 30, 31, 60, 61, 62, 90, 120) for _ in range(4)]
    rows = [(i, s) for i, s in enumerate(own)]
    rows += [(1000 + 50 * k + i, changed(r, s, max(1, len(s) * k // 25), "ACGT")) for i, s in enumerate(own) for k in (1, 3)]
    rows += [(5000, own[20]), (5001, own[20]), (5002, None), (5003, ""), (5004, "A"), (5005, "AC"), (5006, "ACGT" * 20), (5007, "ACGT" * 21)]
    found, members = A.alike(spark.createDataFrame(rows, "id long, s string").repartition(4), "id", "s", threshold)
    first = {}
    for i, s in sorted(rows):
        first.setdefault(s, i)
    want = {(a, b): plain(x, y) for x, a in first.items() for y, b in first.items() if a < b and x and y}
    want = {p: v for p, v in want.items() if v >= threshold}
    got = {(q["a"], q["b"]): q["identity"] for q in found.collect()}
    assert got == pytest.approx(want, abs=1e-12) and (threshold > 0.9 or len(want) > 30)
    assert {q["id"]: q["a"] for q in members.collect()} == {i: first[s] if s else i for i, s in rows}


def test_only_likely_pairs_are_aligned():
    r = random.Random(1)
    rows = ["".join(r.choices("ACGT", k=200)) for i in range(60)]
    near = [changed(r, s, 8, "ACGT") for s in rows]
    pairs = [(x, y) for x in rows for y in near]
    kept = A.may_reach([p[0] for p in pairs], [p[1] for p in pairs], 0.1 / 0.9, 5)
    assert kept[::61].all() and kept.sum() < 90  # of 3,600
    odd = [("", ""), ("a", "a"), ("aaaaaaa", "aaaaaaaa"), ("abcdefgh" * 9, "abcdefgh" * 8 + "abxdefgh"), ("q" * 50, "r" * 50)]
    assert A.may_reach([p[0] for p in odd], [p[1] for p in odd], 0.1, 5).tolist() == [True, True, True, True, False]


def test_queries_on_whole_tables(spark, sf_dir):
    texts = {r["item_id"]: r["text"] for r in Tables(spark, sf_dir).benchmark.collect()}
    want = {(a, b): round(plain(texts[a], texts[b]) + 1e-9, 6) for a in texts for b in texts if a < b and a // 8 == b // 8}
    got = {(r["a"], r["b"]): r["identity"] for r in QUERIES["pairwise_identity"](spark, sf_dir).collect()}
    assert got == pytest.approx(want, abs=1.1e-6) and len(got) > 20
    every = {2 * i: s for i, s in texts.items()} | {2 * i + 1: s.replace("and ", "") for i, s in texts.items()}
    first = {s: i for i, s in sorted(every.items(), reverse=True)}
    near = {i: 0 for i in first.values()}
    close = [(x, y) for x in first for y in first if first[x] < first[y] and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(set(x.split()) & set(y.split())) > 5]
    for x, y in close:
        if plain(x, y) >= 0.8:
            near[first[x]] += 1
            near[first[y]] += 1
    assert {r["id"]: (r["representative"], r["n_alike"]) for r in QUERIES["similar_sequences"](spark, sf_dir).collect()} == {i: (first[s], near[first[s]]) for i, s in every.items()}
