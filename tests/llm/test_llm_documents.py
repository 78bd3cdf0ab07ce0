"""Page texts, grades, sketches and the pipeline against plain versions and held-out documents."""

import collections
import hashlib
import html
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import odd
import test_llm_duplicates as duplicates
from loomtab.llm import pages, quality, queries, sketches  # noqa: F401 - registers the queries
from loomtab.plans.registry import QUERIES
from loomtab.sources.tables import Tables
from test_llm_tokens import packed


def text_of(page):
    return {r["page_id"]: r["text"] for r in page.collect()}


def test_page_cases(spark):
    cases = [
        (1, "http://a.x/1", "<body><nav>Home</nav><article><h1>A &amp; B</h1><p>one\n two<p>three <b>bold</b><aside>side</aside></article><footer>f</footer>", "A & B\none two\nthree bold"),
        (2, None, None, ""), (3, "no host", "", ""),
        (4, "http://b.x/", "<p>a<br>b <b>c</b>  d<script>x</script><p title=\"a>b\">e</p><!-- q --> tail &lt;x&gt; <p", "a b c d\ne\ntail <x>"),
        (5, "http://b.x/", "<div class='cookie-notice'>Accept</div><div id=content><p>kept &copy; 5 &#233;</p></div><form>f<input></form><ul class=comments><li>me</li></ul>", "kept © 5 é"),
        (6, "http://b.x/", "plain text &amp with < sign", "plain text & with < sign"),
        (7, "http://b.x/", "<main><header><h1>T</h1></header><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></main><p>out", "T\nx\ny\n1\n2"),
        (8, "http://b.x/", "<div " * 2000 + "<p>deep</p>", "deep"),
        (8, "http://b.x/", "<style>p{}</style><p>again</p><p>again</p>", "again\nagain"),
        (None, "http://b.x/", "<p>no id</p>", "no id"),
    ]
    df = spark.createDataFrame([(i, u, h, "t", "n") for i, u, h, _ in cases], "page_id long, url string, html string, text string, noise string")
    assert odd.plain((r["page_id"], r["url"], r["text"]) for r in pages.extract_text(df).collect()) == odd.plain((i, u, t) for i, u, _, t in cases)
    assert pages.extract_text(df.limit(0)).count() == 0


def test_branches_that_repeat_on_a_host_go(spark):
    page = "<body><div id=top>Welcome to us</div><div class=text><p>story {0} about {1}</p><p>more {1}</p></div><div>All rights of the house</div>"
    df = spark.createDataFrame([(i, f"http://Same.host/{i}", page.format(i, i * 7919)) for i in range(40)], "page_id long, url string, html string")
    got = text_of(pages.extract_text(df))
    assert all(got[i] == f"story {i} about {i * 7919}\nmore {i * 7919}" for i in range(40))
    few = text_of(pages.extract_text(df.limit(3)))
    assert all("Welcome" in t for t in few.values())  # no evidence from so few pages


def test_names_do_not_remove_the_article(spark):
    cases = [
        ("<body class='no-sidebar has-header'><p>text {0}</p><div class=sidebar>x</div></body>", "text {0}"),
        ("<body><div class='page with-sidebar'><p>text {0}</p><p>more {0}</p></div><div class=sidebar>x</div></body>", "text {0}\nmore {0}"),
        ("<article class='post social'><p>text {0}</p><ul class=share><li>x</ul></article>", "text {0}"),
        ("<main class=has-banner><div class='content related'>text {0}</div></main><p>out", "text {0}"),
        ("<div class=with-menu><article>text {0}</article><div class=related><article>x</article></div></div>", "text {0}"),
    ]
    article = "<main><article class=social>t 5 and 6</article><div class=comments>" + "<article>said</article>" * 30 + "</div></main>"
    assert pages.main_text(article, set()).startswith("t 5 and 6")
    for case, want in cases:
        for n in (1, 12):  # without and with evidence
            df = spark.createDataFrame([(i, f"http://h.x/{i}", case.format(i * 7919 + 1000)) for i in range(n)], "page_id long, url string, html string")
            assert text_of(pages.extract_text(df)) == {i: want.format(i * 7919 + 1000) for i in range(n)}, case


def test_what_is_no_article_goes():
    nine = " ".join(f"Sentence {i} of a reader who has much to say about it." for i in range(9))
    cases = [
        (f"<article><p>One short paragraph.</p><div class='comments'><p>{nine}</p></div></article>", "One short paragraph."),
        (f"<article><p>One short paragraph.</p></article><div class='comments'>{nine}</div>", "One short paragraph."),
        (f"<body><div class=content><p>Short.</p></div><div id=reader-comments><p>{nine}</p></div></body>", "Short."),
        ("<p title=Bob's>First part.</p><p>Second, it's here.</p><p>Third.</p>", "First part.\nSecond, it's here.\nThird."),
        ("<p title=a\"b>x</p><a href=/?q=it's>y</a><p data-x = 'it>s'>z</p>", "x\ny\nz"),
        ("<div hidden><p>secret</p></div><p>shown</p><p hidden=until-found>also</p><p class='hidden-gem'>gem</p>", "shown\ngem"),
        ("<input disabled value=it's><p>a</p><br/><p contenteditable>b</p>", "a\nb"),
        ("<article><p>The main one is longer.</p></article><article class='teaser'><p>Read also</p></article>", "The main one is longer."),
        ("<main><h1>Title</h1><article><p>The text.</p><article><p>quoted</p></article></article><article><p>Next</p></article></main>", "Title\nThe text.\nquoted"),
        (f"<article><p>Short.</p></article><div class=comments><article><p>{nine}</p></article></div>", "Short."),
        ("<div class=social><p>All there is.</p></div>", "All there is."),
        ("<p class='a=b' id=\"c'd\">quotes</p><p x=\"un>closed</p>", "quotes\nclosed"),
    ]
    for page, want in cases:
        assert pages.main_text(page, set()) == want, page


def paged(spark, pages_of):
    return spark.createDataFrame(list(enumerate(pages_of)), "page_id long, html string").selectExpr("page_id", "'http://h.x/' || page_id as url", "html").repartition(7)


def test_copies_of_pages_count_once(spark):
    page = "<body><div id=top>Welcome to us</div><div class=text><p>story {0}</p></div></body>"
    few = text_of(pages.extract_text(paged(spark, [page.format(i % 3) for i in range(60)])))
    assert few == {i: f"Welcome to us\nstory {i % 3}" for i in range(60)}  # three pages give no evidence
    many = text_of(pages.extract_text(paged(spark, [page.format(min(i, 9)) for i in range(3000)])))
    assert many == {i: f"story {min(i, 9)}" for i in range(3000)}
    tree = pages.style_tree(paged(spark, [page.format(min(i, 9)) for i in range(3000)]))
    once = pages.style_tree(paged(spark, [page.format(i) for i in range(10)]))
    rounded = lambda t: {(r["host"], r["path"]): (r["pages"], round(r["importance"], 9)) for r in t.collect()}
    assert rounded(tree) == rounded(once)


def test_branches_that_repeat_inside_the_article_go(spark):
    page = "<body><article><h1>title {0}</h1><p>story {0}</p><div><p>Written by us</p></div></article></body>"
    got = text_of(pages.extract_text(paged(spark, [page.format(i * 7919) for i in range(40)])))
    assert got == {i: f"title {i * 7919}\nstory {i * 7919}" for i in range(40)}
    same = text_of(pages.extract_text(paged(spark, [f"<!-- {i} --><article><p>one</p></article>" for i in range(40)])))
    assert set(same.values()) == {"one"}  # the article itself never goes


def test_op5_whole_table(spark, sf_dir):
    got = {r["page_id"]: r for r in QUERIES["op5_page_texts"](spark, sf_dir).collect()}
    rows = Tables(spark, sf_dir).pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(x)).strip() for x in re.split("<[^>]*>", article)]
        assert got[r["page_id"]]["text"] == "\n".join(x for x in parts if x)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def test_paragraphs_of_equal_polynomial_hash():
    made = sketches.digests([t.encode() for t in odd.twins()])[0]
    assert len(set(made.tolist())) == 2


def paragraphs(text):
    seen, out = collections.Counter(), set()
    for line in text.split("\n"):
        held = []
        runs = []
        for word in re.findall(r"[^ \t\x0b\x0c\r]+", line):
            held.append(word)
            if word[-1] in ".!?" or len(held) == sketches.WORDS:
                runs.append(" ".join(held))
                held = []
        for run in runs + [" ".join(held)] * bool(held):
            out.add((run, seen[run]))
            seen[run] += 1
    return out


def alike(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def sketched(data):
    data = sorted(data, key=lambda d: (d[0] is not None, d[0] or 0))
    out = {}
    for n, (i, t) in enumerate(data):
        t, following = t or "", data[n - 1][1] or ""
        cut = len(t) // 3
        edit = t[:len(t) - cut] + following[:cut]
        out[i] = (len(t), hashlib.sha256(edit.encode()).hexdigest(), alike(t, edit), alike(t, following))
    return out


def check_sketches(df, data):
    want, prints = sketched(data), {}
    got = df.collect()
    assert len(got) == len(data)
    texts = dict(data)
    for r in got:
        n, digest, near_edited, near_next = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, digest)
        assert abs(r["near_edited"] - near_edited) < 1e-9 and abs(r["near_next"] - near_next) < 1e-9
        assert prints.setdefault(texts[r["doc_id"]] or "", r["fingerprint"]) == r["fingerprint"]


def test_sketches_of_odd_rows(spark):
    data = [(i, re.sub(r"[ \t]+", " ", t) if t else t) for i, t in enumerate(odd.texts())] + [(None, "no id at all.")]
    check_sketches(sketches.edit_fingerprints(odd.frame(spark, data)), data)
    check_sketches(sketches.edit_fingerprints(odd.frame(spark, data[:1])), data[:1])
    assert sketches.edit_fingerprints(odd.frame(spark, data).limit(0)).count() == 0
    repeated = sketches.edit_fingerprints(odd.frame(spark, [(1, "a b."), (1, "a b."), (1, "c."), (2, None)])).collect()
    assert len(repeated) == 4


def test_op10_whole_table(spark, sf_dir):
    data = [(r["doc_id"], r["text"]) for r in Tables(spark, sf_dir).documents.collect()]
    check_sketches(QUERIES["op10_edit_sketches"](spark, sf_dir), data)


def test_peeling_recovers_the_difference():
    rng = np.random.default_rng(0)
    common, left, right = (rng.integers(1, 1 << 63, n).astype(np.uint64) for n in (5000, 9, 6))
    a = sketches.sketch(np.append(common, left), np.zeros(5009, np.int64), 1, 60)
    b = sketches.sketch(np.append(common, right), np.zeros(5006, np.int64), 1, 60)
    digest, _, side, done = a.minus(b).peel()
    assert done.all() and set(digest[side == 1].tolist()) == set(left.tolist()) and set(digest[side == -1].tolist()) == set(right.tolist())
    small = sketches.sketch(common, np.zeros(5000, np.int64), 1, 24).minus(sketches.sketch(common[:0], common[:0].astype(np.int64), 1, 24))
    assert not small.peel()[3].any()


@pytest.fixture(scope="module")
def rated(spark):
    t = Tables(spark, "/root/testdata/sf0.1")
    return t, quality.ratings(t.labels)


def test_grades_of_held_out_documents(spark, rated):
    t, grades = rated
    held = grades.where("doc_id % 4 = 0")
    model = quality.train(t.documents, grades.where("doc_id % 4 <> 0"))
    got = quality.grade_documents(t.documents.join(held, "doc_id", "left_semi"), model).select("row.doc_id", "tails", "expected_grade").join(held, "doc_id").collect()
    good = [r["tails"][1] >= 0.5 for r in got if r["grade"] == 2]
    poor = [r["tails"][1] >= 0.5 for r in got if r["grade"] < 2]
    assert np.mean(good) > 0.99 and np.mean(poor) < 0.15
    assert all(r["tails"][0] >= r["tails"][1] and abs(sum(r["tails"]) - r["expected_grade"]) < 1e-9 for r in got)


def test_grades_of_odd_rows(spark, rated):
    t, grades = rated
    model = quality.train(t.documents, grades, bound=500)
    got = quality.grade_documents(odd.frame(spark), model)
    assert got.select("row.*").columns == odd.frame(spark).columns and got.count() == len(odd.rows())
    assert got.where("tails[1] between 0 and 1").count() == len(odd.rows())
    assert quality.grade_documents(odd.frame(spark).limit(0), model).count() == 0
    nothing = quality.train(t.documents, grades.where("doc_id < 0"))
    assert quality.grade_documents(odd.frame(spark), nothing).where("tails[1] < 0.5").count() == 0
    one = quality.train(t.documents, spark.createDataFrame([(1, 2), (2, 2), (3, None), (None, 1), (10**9, 0)], "doc_id long, grade int"))
    assert quality.grade_documents(odd.frame(spark), one).where("element_at(tails, -1) < 0.5").count() == 0


@pytest.mark.parametrize("quality_,toxic", [("0", "toxic"), ("quality", "1"), ("0", "1"), ("1", "0"), ("quality", "0"), ("quality * 5", "toxic * 9"), ("CAST(NULL AS INT)", "toxic")])
def test_op9_on_labels_without_some_grades(spark, sf_dir, tmp_path, quality_, toxic):
    t = Tables(spark, sf_dir)
    t.documents.write.parquet(str(tmp_path / "documents.parquet"))
    t.labels.selectExpr("doc_id", f"CAST({quality_} AS INT) AS quality", f"CAST({toxic} AS INT) AS toxic").write.parquet(str(tmp_path / "labels.parquet"))
    got = QUERIES["op9_quality_grades"](spark, str(tmp_path)).collect()
    assert len(got) == t.documents.count()
    for r in got:
        assert 1 >= r["p_grade_1"] >= r["p_grade_2"] >= 0 and r["kept"] == (r["p_grade_2"] >= 0.5)
        assert r["expected_grade"] == pytest.approx(r["p_grade_1"] + r["p_grade_2"])
    assert any(r["kept"] for r in got)  # where the highest grade was not rated, the highest rated one decides


def test_fit_as_a_dense_one():
    """Plain small steps over a dense table reach the same loss, and the gradient vanishes where weights are not 0."""
    r = np.random.default_rng(0)
    n, width = 300, 40
    dense = r.random((n, width)) < 0.2
    dense[:, 0] = True
    truth = r.normal(0, 1.5, width)
    scale = 1 / np.sqrt(dense.sum(axis=1))
    grade = np.searchsorted([-0.6, 0.7], dense @ truth * scale + r.normal(0, 0.3, n)).astype(np.int64)
    places = np.sort(r.choice(1 << quality.BITS, width, replace=False))
    numbers, bounds = places[np.nonzero(dense)[1]].astype(np.int32), np.append(0, np.cumsum(dense.sum(axis=1)))
    penalty = 1e-3
    importance = np.sqrt(n / (3 * np.bincount(grade, minlength=3)))[grade]
    importance /= importance.mean()
    above = grade[:, None] >= np.array([1, 2])

    def loss(w, t):
        p = 1 / (1 + np.exp(t[None, :] - (dense @ w * scale)[:, None]))
        return -(importance[:, None] * np.where(above, np.log(p), np.log(1 - p))).sum() / n + penalty * np.abs(w).sum()

    def gradient(w, t):
        gap = (1 / (1 + np.exp(t[None, :] - (dense @ w * scale)[:, None])) - above) * importance[:, None] / n
        return dense.T @ (gap.sum(axis=1) * scale), -gap.sum(axis=0)

    w, t = np.zeros(width), np.array([-1.0, 1.0])
    for _ in range(20_000):
        gw, gt = gradient(w, t)
        w, t = np.sign(w - 2 * gw) * np.maximum(np.abs(w - 2 * gw) - 2 * penalty, 0), np.sort(t - 2 * gt)
    weights, thresholds = quality.fit(numbers, bounds, grade, 3, rounds=2000, penalty=penalty)
    assert not weights[np.setdiff1d(np.arange(1 << quality.BITS), places)].any() and (np.diff(thresholds) >= 0).all()
    found = weights[places]
    assert loss(found, thresholds) <= loss(w, t) * (1 + 1e-4)
    gw, _ = gradient(found, thresholds)
    assert np.abs(gw + penalty * np.sign(found))[found != 0].max() < 1e-4 and (np.abs(gw)[found == 0] <= penalty + 1e-4).all()


def test_stages_keep_columns_and_take_odd_rows(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents
    strange = spark.createDataFrame([(i if i is None else i + 10**6, t, None, None, None) for i, t in odd.rows()], docs.schema)
    for docs in (docs.unionByName(strange), docs.limit(0)):
        kept = docs
        for name, stage in corpus_pipeline.STAGES:
            before = kept
            kept = stage(spark, kept, sf_dir)
            if name != "packing":
                assert kept.columns == docs.columns and [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
                kept = spark.createDataFrame(kept.collect(), docs.schema)
                assert kept.count() <= before.count()
        assert kept.columns[:3] == ["doc_id", "start", "length"]
        kept.collect()


def test_pipeline_takes_effect(spark, sf_dir):
    t = Tables(spark, "/root/testdata/sf0.01")
    kept = corpus_pipeline.accept_quality(spark, t.documents, "/root/testdata/sf0.01")
    judged = t.labels.join(kept.select("doc_id", F.lit(True).alias("kept")), "doc_id", "left").fillna(False, ["kept"]).collect()
    assert np.mean([r["kept"] for r in judged if r["quality"] == 1 and not r["toxic"]]) > 0.98
    assert np.mean([r["kept"] for r in judged if r["toxic"] or not r["quality"]]) < 0.1
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() == out.select("doc_id", "start").distinct().count() > 0


PASSAGE = " ".join(f"word{i}" for i in range(60))


def test_documents_of_which_only_white_space_is_left_go(spark, sf_dir):
    data = [(1, "a\nb\nc"), (2, "a\n\nb\n \nc"), (3, "a\nb\nc\n\u3000\n"), (4, "\n\n"), (5, "a\nb\nc\n\nd"), (6, None)]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_line_runs(spark, odd.frame(spark, data), sf_dir).collect()}
    assert got == {1: "a\nb\nc", 4: "\n\n", 5: "\nd", 6: None}
    data = [(1, PASSAGE), (2, f"\n{PASSAGE}\n\u00a0"), (3, f"x {PASSAGE}\n"), (4, "")]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.cut_passages(spark, odd.frame(spark, data), sf_dir).collect()}
    assert got == {1: PASSAGE, 3: "x ", 4: ""}


def plain_run(docs, accepted, library):
    """Rows (doc_id, start, length, ids_crc32, doc_tokens) of the pipeline; ids are neither NULL nor repeated."""
    data = [(i, t) for i, t in docs if i in accepted]
    data = [(i, t) for i, t, _, gone in duplicates.runs_removed(data, 3) if not gone or t.strip()]
    data = [(i, t) for (i, t), (_, _, root) in zip(data, duplicates.groups(data)) if root == i]
    first, left = {}, []
    for i, t in sorted(data):
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - corpus_pipeline.PASSAGE_BYTES + 1):
            if first.setdefault(b[p:p + corpus_pipeline.PASSAGE_BYTES], i) < i:
                gone[p:p + corpus_pipeline.PASSAGE_BYTES] = True
        t = np.frombuffer(b, np.uint8)[~gone].tobytes().decode(errors="ignore")
        if not b or t.strip():
            left.append((i, t))
    out = []
    for i, t in left:
        ids = library.encode(t, add_special_tokens=False).ids + [0]
        for a in range(0, len(ids), 1024):
            piece = np.array(ids[a:a + 1024], "<u4")
            out.append((i, a, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
    return out


def test_pipeline_row_by_row(spark, sf_dir, vocabulary):
    docs = [(r["doc_id"], r["text"]) for r in Tables(spark, sf_dir).documents.collect()]
    t = Tables(spark, sf_dir)
    tails = quality.grade_documents(t.documents, quality.train(t.documents, quality.ratings(t.labels))).select("row.doc_id", "tails").collect()
    got = corpus_pipeline.run(spark, sf_dir).collect()
    want = plain_run(docs, {r["doc_id"] for r in tails if r["tails"][-1] >= 0.5}, Tokenizer.from_file(vocabulary("byte_bpe_50k.json")))
    assert odd.plain(tuple(r)[:5] for r in got) == odd.plain(want)
    packed([(r["length"], r["sequence_id"], r["offset"]) for r in got], 1024)
