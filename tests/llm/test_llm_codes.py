"""Vector codes against plain rounds over whole numbers."""

import hashlib
import math

import numpy as np
import pytest

import odd
from loomtab.llm import queries, vector_codes  # noqa: F401 - registers the queries
from loomtab.plans.registry import QUERIES
from loomtab.sources.tables import Tables


def plain(rows, parts=16, entries=64, rounds=2):
    """(key, label, codes, error) of each row and the codebooks, by Python's whole numbers."""
    kept = [(k, lab, v) for k, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for *_, v in kept), default=0) // parts)
    made = []
    for key, lab, v in kept:
        whole = [math.floor(256 * x) for x in v] + [0] * (width * parts - len(v))
        made.append((key, lab, [tuple(whole[p * width:(p + 1) * width]) for p in range(parts)]))
    seeds = sorted(made, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[s[2][p] for s in seeds] for p in range(parts)]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest(p, part):
        return min(range(len(books[p])), key=lambda e: (far(part, books[p][e]), e))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for *_, cut in made:
                held.setdefault(nearest(p, cut[p]), []).append(cut[p])
            for e, points in held.items():
                books[p][e] = tuple(sum(c) // len(points) for c in zip(*points))
    out = []
    for key, lab, cut in made:
        codes = [nearest(p, cut[p]) for p in range(parts)]
        out.append((key, lab, codes, sum(far(cut[p], books[p][e]) for p, e in enumerate(codes))))
    return out, books


def spelled(books):
    return hashlib.sha256(",".join(str(x) for part in books for entry in part for x in entry).encode()).hexdigest()


@pytest.mark.parametrize("n,width,entries,scale", [(1, 4, 1, 30), (5, 4, 5, 30), (900, 4, 64, 30), (600, 1, 8, 40), (400, 3, 16, 2), (300, 4, 64, 2 ** 22), (200, 2, 1, 9)])
def test_trees_assign_as_a_full_search(n, width, entries, scale):
    r = np.random.default_rng(n)
    sets = r.normal(0, scale, (3, n, width)).round().astype(np.int64)
    sets[:, ::3] = sets[:, :1]  # many copies of one point
    forest = vector_codes.Forest.build(sets)
    books = sets[:, -entries:].copy()
    for _ in range(3):
        far = ((sets[:, :, None] - books[:, None]) ** 2).sum(axis=3)
        want = far.argmin(axis=2)
        label, count, sums, _ = forest.assign(books)
        got = np.empty(3 * n, np.int64)
        got[forest.order] = label
        assert (got.reshape(3, n) == want).all()
        assert (count == np.concatenate([np.bincount(w, minlength=entries) for w in want])).all()
        codes, error = forest.codes(books)
        assert (codes == want.T).all() and (error == far.min(axis=2).sum(axis=0)).all()
        used = count > 0
        books.reshape(-1, width)[used] = sums[used] // count[used, None]


def test_trees_cover_and_separate():
    sets = np.random.default_rng(1).normal(0, 50, (2, 800, 3)).round().astype(np.int64)
    f = vector_codes.Forest.build(sets)
    assert sorted(f.order) == list(range(1600)) and (f.points == sets.reshape(-1, 3)[f.order]).all()
    for node in range(len(f.first)):
        inside = f.points[f.first[node]:f.first[node] + f.size[node]]
        reach = np.sqrt(((inside - f.points[f.centre[node]]) ** 2).sum(axis=1).max())
        assert reach <= f.radius[node] <= reach * (1 + 1e-9) + 1e-9
        below = range(f.child[node], f.child[node] + f.children[node])
        if not below:
            continue
        half = 2.0 ** (math.ceil(math.log2(reach)) - 1)
        centres = f.points[f.centre[list(below)]]
        assert (centres[0] == f.points[f.centre[node]]).all()
        apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2)) + np.eye(len(centres)) * 1e9
        assert (apart > half).all() and all(f.radius[c] <= half * (1 + 1e-9) for c in below)
        assert sum(f.size[c] for c in below) == f.size[node]


def test_whole_subtrees_are_assigned_in_separate_clusters():
    r = np.random.default_rng(0)
    sets = (r.integers(0, 8, (1, 4000, 1)) * 1000 + r.integers(0, 20, (1, 4000, 4))).astype(np.int64)
    forest = vector_codes.Forest.build(sets)
    assert forest.assign(np.repeat(np.arange(8) * 1000 + 10, 4).reshape(1, 8, 4))[3] < 400


def rows():
    r = np.random.default_rng(3)
    made = [(i, i % 3 if i % 7 else None, r.normal(0, 0.3, 32).astype(np.float32).tolist()) for i in range(150)]
    nan, inf = float("nan"), float("inf")
    made += [(200, 1, None), (201, 1, [None] * 32), (202, None, [nan] + [0.0] * 31), (203, 1, [inf] * 32), (204, 1, [0.0] * 32), (205, 1, [-0.001] * 32)]
    made += [(206, 5, [0.5] * 20), (207, 5, []), (None, 5, [1.0] * 32), (None, None, [1.5] * 32), (3, 1, [0.25] * 32), made[4], made[4], (300, 9, [100.0] * 33)]
    return made


def frame(spark, data):
    return spark.createDataFrame([(k, lab, v, "e", 1, "n") for k, lab, v in data], "vec_id long, label int, embedding array<float>, key string, codes int, error string").repartition(5)


@pytest.mark.parametrize("block", [7, 4096])
def test_codes_of_odd_rows(spark, block):
    for data in (rows(), rows()[:70], rows()[:1], [(i, 1, [0.5, 0.25]) for i in range(9)], [(1, 2, []), (2, 2, [])]):
        coded, books = vector_codes.encode(frame(spark, data), block=block)
        want, plain_books = plain(data)
        assert vector_codes.books_digest(books) == spelled(plain_books)
        assert odd.plain((r["key"], r["label"], r["codes"], r["error"]) for r in coded.collect()) == odd.plain(want)
        sums = {}
        for _, lab, _, error in want:
            sums[lab] = sums.get(lab, 0) + error
        assert odd.plain(r for r in vector_codes.with_label_error(coded).select("key", "label", "label_error").collect()) == odd.plain((k, lab, sums[lab]) for k, lab, *_ in want)


def test_nothing_to_encode_and_too_large(spark):
    empty, books = vector_codes.encode(frame(spark, [(1, 1, None), (2, 1, [float("nan")])]))
    assert empty.count() == 0 and books.size == 0
    assert vector_codes.encode(frame(spark, rows()).limit(0))[0].count() == 0
    coded, _ = vector_codes.encode(frame(spark, [(1, 1, [1e30] * 16), (2, 1, [1e5] * 16)]))
    assert [r["key"] for r in coded.collect()] == [2]
    with pytest.raises(ValueError):
        vector_codes.encode(frame(spark, rows()), entries=300)


def test_op12_whole_table(spark, sf_dir):
    got = {r["vec_id"]: r for r in QUERIES["op12_vector_codes"](spark, sf_dir).collect()}
    data = [(r["vec_id"], r["label"], list(r["embedding"])) for r in Tables(spark, sf_dir).embeddings.collect()]
    want, books = plain(data)
    sums = {}
    for _, lab, _, error in want:
        sums[lab] = sums.get(lab, 0) + error
    assert len(got) == len(want)
    for key, lab, codes, error in want:
        r = got[key]
        assert (r["code"], r["error"], r["label_error"]) == ("".join(f"{c:02x}" for c in codes), error, sums[lab])
        assert r["codebooks_sha256"] == spelled(books)
