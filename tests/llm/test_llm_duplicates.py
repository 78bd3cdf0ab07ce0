"""Line runs, SimHash groups, near vectors and repeated windows against plain versions."""

import random
import re

import numpy as np
import pytest
import xxhash

import odd
from loomtab.llm import components, lines, queries, simhash, suffixes, vectors  # noqa: F401 - registers the queries
from loomtab.plans.registry import QUERIES
from loomtab.sources.tables import Tables

LAST = suffixes.LAST


def spread_labels(linked):
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label)))
        if (new == label).all():
            return label
        label = new


def print_of(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(data):
    prints = np.array([print_of(t) for _, t in data], np.uint64)
    label = spread_labels(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3)
    least = {}
    for (i, _), g in zip(data, label.tolist()):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return [(i, f"{int(p):016x}", least.get(g)) for (i, _), p, g in zip(data, prints, label.tolist())]


def test_simhash_of_odd_rows(spark):
    assert odd.plain(simhash.near_duplicates(odd.frame(spark)).collect()) == odd.plain(groups(odd.rows()))
    assert simhash.near_duplicates(odd.frame(spark).limit(0)).count() == 0


def test_op3_whole_table(spark, sf_dir):
    data = [(r["doc_id"], r["text"]) for r in Tables(spark, sf_dir).documents.collect()]
    assert odd.plain(QUERIES["op3_simhash_groups"](spark, sf_dir).collect()) == odd.plain(groups(data))


@pytest.mark.parametrize("dense", [100_000, 20])
@pytest.mark.parametrize("segments", [2, 4])
def test_links_of_crowded_segments(spark, dense, segments):
    rng = np.random.default_rng(0)
    values = set()
    for base in rng.integers(-2**63, 2**63 - 1, 3):
        for _ in range(150):
            x = int(base) % (1 << 64)
            for bit in rng.choice(64, rng.integers(0, 5), replace=False):
                x ^= 1 << int(bit)
            values.add(x - (1 << 64) if x >> 63 else x)
    values = np.array(sorted(values))
    df = spark.createDataFrame([(int(v),) for v in values], "fingerprint long")
    found = {r["node"]: r["root"] for r in components.components(simhash.link_edges(df, 3, segments, dense)).collect()}
    bits = values.view(np.uint64)
    want = values[spread_labels(np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 3)]
    assert [found.get(int(v), int(v)) for v in values] == want.tolist()


def test_keep_one_row_per_group(spark):
    data = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, "q"), (None, "r"), (5, None), (4, "")]
    left = simhash.keep_one(odd.frame(spark, data))
    assert left.columns == odd.frame(spark, data).columns
    assert odd.plain((r["doc_id"], r["text"]) for r in left.collect()) == odd.plain([(1, "a b c"), (4, ""), (None, "q"), (None, "r")])


def test_components_of_chains_and_stars(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(5, 5), (None, 3), (7, 6), (6, 7), (200, 300)]
    r.shuffle(edges)
    got = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 200: 200, 300: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def runs_removed(data, run, words=50):
    """Plain version: windows of non-blank lines, of ``run`` lines or of ``words`` words, in order of (id, hash of the text, place)."""
    seen, out = {}, []
    documents = {(i, t) for i, t in data if t is not None}
    signed = lambda t: (h := xxhash.xxh64_intdigest(t.encode(), 42)) - (1 << 64 if h >> 63 else 0)
    order = sorted(documents, key=lambda d: (d[0] is None, d[0] or 0, signed(d[1])))
    kept = {}
    for i, t in order:
        all_lines = t.split("\n")
        filled = [n for n, x in enumerate(all_lines) if x.strip(" ")]
        gone = set()
        for size in range(1, run + 1):
            for p in range(len(filled) - size + 1):
                window = tuple(all_lines[n].strip(" ") for n in filled[p:p + size])
                if size < run and len(re.findall(r"[^\x20\x09-\x0D]+", " ".join(window))) < words:
                    continue
                if seen.setdefault(window, (i, t, p)) != (i, t, p):
                    gone.update(filled[p:p + size])
        kept[i, t] = ("\n".join(x for n, x in enumerate(all_lines) if n not in gone), len(all_lines), len(gone))
    for i, t in data:
        out.append((i, *(kept[i, t] if t is not None else (None, 0, 0))))
    return out


def test_line_runs_of_odd_rows(spark):
    r = random.Random(4)
    pool = [f"line {n}" for n in range(12)] + ["", "  ", " line 3 "]
    data = odd.rows() + [(r.choice([None, n, n, 9]), "\n".join(r.choices(pool, k=r.randint(0, 25)))) for n in range(100, 200)]
    data += [(300, "same\n" * 50), (301, "same\n" * 50), (302, "x\ny\nz\nx\ny\nz\nx")] * 2
    long = [" ".join(r.choices("abcdefgh", k=n)) for n in (2, 3, 4, 5, 6)]
    data += [(r.choice([n, 400, None]), "\n".join(r.choices([*long, "x\u00a0y", "", "\t"], k=r.randint(0, 9)))) for n in range(400, 460)]
    for run, words in ((1, 50), (3, 50), (3, 5), (4, 8)):
        got = lines.without_repeated_runs(odd.frame(spark, data), run=run, words=words).select("row.doc_id", "kept", "n_lines", "n_removed").collect()
        assert odd.plain(got) == odd.plain(runs_removed(data, run, words))
    assert lines.without_repeated_runs(odd.frame(spark).limit(0)).count() == 0


def test_line_runs_stay_in_the_engine(spark):
    plan = lines.without_repeated_runs(odd.frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def covered(data, width):
    first, out = {}, []
    rank = lambda i: LAST if i is None else i
    for i, t in data:
        b = (t or "").encode()
        for p in range(len(b) - width + 1):
            first[b[p:p + width]] = min(first.get(b[p:p + width], LAST), rank(i))
    for i, t in data:
        b = (t or "").encode()
        hit = np.zeros(len(b) + 1, int)
        for p in range(len(b) - width + 1):
            if first[b[p:p + width]] < rank(i):
                hit[p] += 1
                hit[p + width] -= 1
        inside = np.cumsum(hit[:-1]) > 0
        edge = np.diff(inside.astype(int), prepend=0, append=0)
        out.append((i, len(b), np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), bytes(x for x, y in zip(b, inside) if not y)))
    return out


@pytest.mark.parametrize("width", [50, 16])
@pytest.mark.parametrize("crowded", [20_000, 3])
def test_repeated_windows(spark, width, crowded):
    r = random.Random(5)
    base = ["".join(r.choices("ab c", k=r.randint(1, 200))) for _ in range(20)] + ["a" * 300, "ab" * 200, "é" * 90, "", "x" * 49, "x" * 50, "x" * 51]
    data = odd.rows()
    for i in range(1000, 1120):
        t = "".join(r.choice(base) for _ in range(r.randint(1, 4)))
        at = r.randint(0, len(t))
        data.append((r.choice([None, i, i, i, 5]), t[:at] + r.choice(["", "Q", "zz"]) + t[at + r.randint(0, 3):]))
    got = suffixes.repeated_spans(odd.frame(spark, data), threshold=width, crowded=crowded).collect()
    assert odd.plain(got) == odd.plain(covered(data, width))


def test_repeated_windows_of_a_long_text_and_none(spark):
    r = random.Random(6)
    long = "".join(r.choices("abcdefgh ", k=700_000))
    got = {x["doc_id"]: x for x in suffixes.repeated_spans(spark.createDataFrame([(2, long), (1, long[300_000:300_100]), (3, "z" + long + "z")], "doc_id long, text string")).collect()}
    assert (got[2]["starts"], got[2]["stops"]) == ([300_000], [300_100])
    assert (got[3]["starts"], got[3]["stops"]) == ([1], [700_001]) and got[1]["starts"] == []
    assert suffixes.repeated_spans(odd.frame(spark).limit(0)).count() == 0


def test_without_repeats_keeps_columns(spark):
    data = [(1, "é" * 60), (2, "a" + "é" * 60 + "b"), (3, None), (4, "")]
    left = suffixes.without_repeats(odd.frame(spark, data))
    assert left.columns == odd.frame(spark).columns
    assert odd.plain((r["doc_id"], r["text"], r["kept"]) for r in left.collect()) == odd.plain([(1, "é" * 60, "k"), (2, "ab", "k"), (3, None, "k"), (4, "", "k")])


def test_op7_whole_table(spark, sf_dir):
    data = [(r["doc_id"], r["text"]) for r in Tables(spark, sf_dir).documents.collect()]
    got = {r["doc_id"]: r for r in QUERIES["op7_repeated_windows"](spark, sf_dir).collect()}
    import hashlib
    for i, n, starts, _, kept in covered(data, 50):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, n - len(kept), len(starts), hashlib.sha256(kept).hexdigest())


def near(data, cosine=0.98):
    fine = [i for i, (_, v, g) in enumerate(data) if g is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    size = np.array([len(data[i][1]) for i in fine])
    unit = np.array([list(data[i][1]) + [0] * (64 - len(data[i][1])) for i in fine], float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    group = np.array([data[i][2] for i in fine])
    linked = (unit @ unit.T >= cosine) & (group[:, None] == group[None, :]) & (size[:, None] == size[None, :])
    np.fill_diagonal(linked, False)
    label, out = spread_labels(linked), [(k, 0, k, True) for k, _, _ in data]
    least = {}
    for a, i in enumerate(fine):
        least[label[a]] = min(least.get(label[a], 1 << 60), data[i][0])
    for a, i in enumerate(fine):
        out[i] = (data[i][0], int(linked[a].sum()), least[label[a]], data[i][0] == least[label[a]])
    return out


VECTORS = "vec_id long, embedding array<float>, label int, cell string, node string, row int"


def test_near_vectors_exact_with_the_full_margin(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 8))
    data = [(i, [float(np.float32(x)) for x in base[rng.integers(30)] + rng.normal(size=8) * rng.choice([0, .02, .1, .2])], int(rng.integers(2))) for i in range(1500)]
    data += [(5000, None, 1), (5001, [0.0] * 8, 1), (5002, [float("nan")] * 8, 1), (5003, [1.0] * 8, None), (5004, [1.0] * 8, 1), (5005, [2.0] * 8, 1),
             (5006, [1.0, None] + [1.0] * 6, 1), (5007, [], 1), (5008, [1.0, 1.0], 1), (5009, [3.0, 3.0], 1), (5010, [float("inf")] * 8, 1), (5011, [1e-30] * 8, 1)]
    df = spark.createDataFrame([(*x, "c", "n", 1) for x in data], VECTORS).repartition(3)
    assert odd.plain(vectors.near_vectors(df, margin=0.21, cell=100).collect()) == odd.plain(near(data))
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_copies_count_one_by_one(spark):
    data = [(i, [1.0, 2.0], 0, "c", "n", 1) for i in range(2500)] + [(9000, [1.0, 2.001], 0, "c", "n", 1)]
    got = vectors.near_vectors(spark.createDataFrame(data, VECTORS)).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(2500, 0)} and sum(r["kept"] for r in got) == 1


def test_recall_on_the_given_vectors(spark):
    df = Tables(spark, "/root/testdata/sf0.1").embeddings
    want = near([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()])
    assert odd.plain(vectors.near_vectors(df, cell=100).collect()) == odd.plain(want)
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert odd.plain(vectors.near_vectors(df, cosine=0.9, cell=100).collect()) == odd.plain(near(rows, cosine=0.9))
