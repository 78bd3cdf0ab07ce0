"""Vector search, keyword search, fusion and pair similarity."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from loomtab.functions import expr as X
from loomtab.operators import metrics as M, neighbors as N, retrieval as V, text as T
from loomtab.operators.bits import tanimoto_topk
from loomtab.operators.ordered import row_index
from loomtab.plans.registry import R, query, rnd
from loomtab.session import spread

_WS = r"CASE WHEN trim(regexp_replace(lower(text), '\s+', ' ', 'g')) = '' THEN [] ELSE string_split(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), ' ') END"
_E = "(SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def _means(t):
    dims = F.posexplode("embedding").alias("i", "x")
    m = t.embeddings.select("label", dims).groupBy("label", "i").agg(F.avg("x").alias("x"))
    return m.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("s")).select("label", F.col("s.x").alias("q"))


_M = """m AS (SELECT label AS ql, list(x ORDER BY i) AS q FROM (SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY ALL) GROUP BY label)"""


def _char_model():
    def encode(texts):
        out = np.zeros((len(texts), 64), dtype=np.float32)
        for i, s in enumerate(texts):
            codes = np.frombuffer(s.encode("utf-8"), np.uint8)
            out[i] = np.bincount(codes % 64, minlength=64)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return encode


@query("batch_embed", f"SELECT doc_id, CAST(64 AS INTEGER) AS dim, {R('1.0', 3)} AS norm FROM documents")
def _(t):
    v = V.embed_batches(t.documents, "doc_id", "text", _char_model, "char64")
    return v.select("doc_id", F.size("vector").alias("dim"), rnd(X.norm("vector"), 3).alias("norm"))


@query("batch_embed_hashed", f"SELECT doc_id, CAST(256 AS INTEGER) AS dim, {R('1.0', 3)} AS norm FROM documents WHERE regexp_matches(text, '\\S')")
def _(t):
    docs = spread(t.documents.where(F.col("text").rlike(r"\S")), "doc_id").select("doc_id", T.whitespace_tokens("text").alias("tok"))
    return V.hashed_vectors(docs, "doc_id", "tok").select("doc_id", F.size("vector").alias("dim"), rnd(X.norm("vector"), 3).alias("norm"))


@query("vector_topk_cosine", f"""WITH {_M}, s AS (SELECT ql, vec_id, list_cosine_similarity(q, v) AS score FROM m, {_E})
SELECT ql AS label, CAST(row_number() OVER (PARTITION BY ql ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, {R('score', 6)} AS score FROM s QUALIFY rank <= 10""")
def _(t):
    return N.top_by_scan(t.embeddings, "vec_id", "embedding", _means(t).withColumnRenamed("q", "embedding"), "label", 10).withColumn("score", rnd("score", 6))


@query("vector_topk_l2_filtered", f"""WITH {_M}, s AS (SELECT ql, vec_id, list_distance(q, v) AS score FROM m, {_E} WHERE label = 3)
SELECT ql AS label, CAST(row_number() OVER (PARTITION BY ql ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, {R('score', 6)} AS score FROM s QUALIFY rank <= 5""")
def _(t):
    near = N.top_by_scan(t.embeddings.where("label = 3"), "vec_id", "embedding", _means(t).withColumnRenamed("q", "embedding"), "label", 5, metric="l2")
    return near.withColumn("score", rnd("score", 6))


@query("knn_join", f"""SELECT a.vec_id, CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS INTEGER) AS rank, b.vec_id AS neighbor,
 {R('list_distance(a.v, b.v)', 6)} AS distance FROM {_E} a JOIN {_E} b ON a.label = b.label AND a.vec_id <> b.vec_id QUALIFY rank <= 5""")
def _(t):
    return N.nearest(t.embeddings, "vec_id", "embedding", 5, by=["label"]).withColumn("distance", rnd("distance", 6))


@query("self_join_pairs", f"""WITH p AS (SELECT a.label, a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.v, b.v) AS s FROM {_E} a JOIN {_E} b ON a.label = b.label AND a.vec_id < b.vec_id)
SELECT label, CAST(count(*) AS BIGINT) AS n_pairs, {R('avg(s)', 6)} AS mean, arg_max(a, s) AS best_a, arg_max(b, s) AS best_b, {R('max(s)', 6)} AS best_cos,
 arg_min(a, s) AS worst_a, arg_min(b, s) AS worst_b, {R('min(s)', 6)} AS worst_cos FROM p GROUP BY label""")
def _(t):
    out = V.pair_summary(t.embeddings, "vec_id", "embedding", ["label"], 64)
    return out.withColumns({c: rnd(c, 6) for c in ("mean", "best_cos", "worst_cos")})


@query("late_interaction", f"""WITH {_M}, s AS (SELECT ql // 2 AS query_id, ql, vec_id % 40 AS page_id, max(list_dot_product(q, v)) AS m FROM m, {_E} GROUP BY ALL),
g AS (SELECT query_id, page_id, sum(m) AS score FROM s GROUP BY ALL)
SELECT CAST(query_id AS INTEGER) AS query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, page_id) AS INTEGER) AS rank, page_id, {R('score', 6)} AS score FROM g QUALIFY rank <= 5""")
def _(t):
    tokens = _means(t).select(F.floor(F.col("label") / 2).cast("int").alias("query_id"), "q")
    patches = t.embeddings.select((F.col("vec_id") % 40).alias("page_id"), "embedding")
    return V.late_interaction(patches, "page_id", "embedding", tokens, "query_id", "q", 5).withColumn("score", rnd("score", 6))


_BM = f"""d AS (SELECT doc_id, {_WS} AS t FROM documents), n AS (SELECT count(*) AS n, avg(len(t)) AS av FROM d),
tf AS (SELECT doc_id, len_ AS len, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS len_, unnest(t) AS term FROM d) GROUP BY ALL),
i AS (SELECT term, ln(n - count(*) + 0.5) - ln(count(*) + 0.5) AS idf FROM tf, n GROUP BY term, n), mi AS (SELECT avg(idf) AS mean FROM i),
q AS (SELECT item_id, unnest({_WS}) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, sum(CASE WHEN idf < 0 THEN 0.25 * mean ELSE idf END * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / av))) AS score
  FROM q JOIN tf USING (term) JOIN i USING (term), n, mi GROUP BY ALL)"""


def _bm25(t, k):
    return V.bm25_topk(spread(t.documents, "doc_id"), "doc_id", T.whitespace_tokens("text"), t.benchmark, "item_id", T.whitespace_tokens("text"), k)


@query("bm25_topk", f"""WITH {_BM} SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id) AS INTEGER) AS rank, doc_id, {R('score', 5)} AS score FROM s QUALIFY rank <= 10""")
def _(t):
    return _bm25(t, 10).withColumn("score", rnd("score", 5))


def _ranked(t):
    d = t.documents.select("source", "doc_id", (-F.col("n_chars")).alias("a"), F.md5(F.col("doc_id").cast("string")).alias("b"))
    one = row_index(d, ["source"], ["a", "doc_id"], "rank").select("source", "doc_id", (F.col("rank") + 1).alias("rank"))
    two = row_index(d, ["source"], ["b"], "rank").select("source", "doc_id", (F.col("rank") + 1).alias("rank"))
    return one, two


_RANKED = """a AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents),
b AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR))) AS rank FROM documents),
truth AS (SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source)"""


@query("rrf", f"WITH {_RANKED} SELECT source, doc_id, {R('sum(1.0 / (60 + rank))', 8)} AS score FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY ALL")
def _(t):
    return V.fuse_ranks(list(_ranked(t)), "source", "doc_id").withColumn("score", rnd("score", 8))


def _scores(name):
    return f"""SELECT '{name}' AS model, {R('avg(CASE WHEN rank <= 10 THEN 1.0 ELSE 0 END)', 6)} AS recall, {R('avg(CASE WHEN rank <= 10 THEN 1 / log2(rank + 1) ELSE 0 END)', 6)} AS ndcg,
 {R('avg(1.0 / rank)', 6)} AS mrr FROM truth JOIN {name} USING (source, doc_id)"""


@query("recall_ndcg_mrr", f"WITH {_RANKED} SELECT recall, ndcg, mrr FROM ({_scores('a')})")
def _(t):
    truth = t.documents.groupBy("source").agg(F.min("doc_id").alias("doc_id"))
    out = M.retrieval_metrics(_ranked(t)[0], truth, 10, "source", "doc_id")
    return out.select(*[rnd(c, 6).alias(c) for c in out.columns])


@query("compare_runs", f"WITH {_RANKED} {_scores('a')} UNION ALL {_scores('b')} ORDER BY recall DESC")
def _(t):
    truth = t.documents.groupBy("source").agg(F.min("doc_id").alias("doc_id"))
    parts = [M.retrieval_metrics(r, truth, 10, "source", "doc_id").withColumn("model", F.lit(n)) for n, r in zip("ab", _ranked(t))]
    out = parts[0].unionByName(parts[1])
    return out.select("model", *[rnd(c, 6).alias(c) for c in ("recall", "ndcg", "mrr")]).orderBy(F.desc("recall"))


@query("jaccard_pairs", f"""WITH s AS (SELECT doc_id, list_sort(list_distinct({_WS})) AS s FROM documents WHERE regexp_matches(text, '\\S')),
g AS (SELECT s, min(doc_id) AS id, count(*) AS c FROM s GROUP BY s), t AS (SELECT id, c, len(s) AS n, unnest(s) AS x FROM g),
p AS (SELECT a.id AS a, b.id AS b, any_value(a.c * b.c) AS n_pairs, count(*) / (any_value(a.n) + any_value(b.n) - count(*)) AS similarity FROM t a JOIN t b ON a.x = b.x AND a.id < b.id GROUP BY a.id, b.id)
SELECT a, b, {R('similarity', 6)} AS similarity, CAST(n_pairs AS BIGINT) AS n_pairs FROM p WHERE similarity >= 0.6
UNION ALL SELECT id, id, 1.0, CAST(c * (c - 1) // 2 AS BIGINT) FROM g WHERE c > 1""")
def _(t):
    docs = spread(t.documents, "doc_id").select("doc_id", T.whitespace_tokens("text").alias("w"))
    return V.jaccard_pairs(docs, "doc_id", "w", 0.6).withColumn("similarity", rnd("similarity", 6))


@query("tanimoto_topk", f"""WITH b AS (SELECT doc_id, list_distinct(list_transform(list_distinct(coalesce({_WS}, [])), lambda x: CAST('0x' || substr(md5(x), 1, 8) AS BIGINT) % 2048)) AS s FROM documents),
t AS (SELECT doc_id, unnest(s) AS x FROM b),
p AS (SELECT a.doc_id AS q, c.doc_id AS d, count(*) AS n FROM t a JOIN t c ON a.x = c.x WHERE a.doc_id % 50 = 0 GROUP BY 1, 2),
r AS (SELECT a.doc_id, c.doc_id AS neighbor, coalesce(coalesce(n, 0) / nullif(len(a.s) + len(c.s) - coalesce(n, 0), 0), 0.0) AS similarity
 FROM b a JOIN b c ON a.doc_id % 50 = 0 AND a.doc_id <> c.doc_id LEFT JOIN p ON p.q = a.doc_id AND p.d = c.doc_id)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, neighbor) AS INTEGER) AS rank, neighbor, {R('similarity', 6)} AS similarity
FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, neighbor) <= 10""")
def _(t):
    docs = spread(t.documents, "doc_id").select("doc_id", T.whitespace_tokens("text").alias("w"))
    return tanimoto_topk(docs, "doc_id", "w", 10, docs.where("doc_id % 50 = 0")).withColumn("similarity", rnd("similarity", 6))


@query("metadata_filters", """
WITH p AS (SELECT event_id, value AS price, event_id % 100 AS reviews, event_id % 2 = 0 AS host, 40.0 + (event_id % 40) / 100.0 AS lat, -3.0 + (user_id % 40) / 100.0 AS lon FROM events)
SELECT event_id FROM p WHERE price BETWEEN 2 AND 80 AND reviews >= 20 AND host
 AND 1.609344 * 2 * 3959.0 * asin(sqrt(pow(sin((radians(40.2) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(40.2)) * pow(sin((radians(-2.8) - radians(lon)) / 2), 2))) <= 10""")
def _(t):
    places = t.events.select("event_id", F.col("value").alias("price"), (F.col("event_id") % 100).alias("reviews"), (F.col("event_id") % 2 == 0).alias("host"),
                             (40.0 + (F.col("event_id") % 40) / 100.0).alias("lat"), (-3.0 + (F.col("user_id") % 40) / 100.0).alias("lon"))
    return places.where(V.metadata_filter((2, 80), {"reviews": 20}, ["host"])).where(V.within_km("lat", "lon", (40.2, -2.8), 10)).select("event_id")


@query("squared_distance_pairs", f"""SELECT a.vec_id, b.vec_id AS other, {R('pow(list_distance(a.v, b.v), 2)', 6)} AS distance FROM {_E} a JOIN {_E} b ON b.vec_id = a.vec_id + 1""")
def _(t):
    a = t.embeddings.select("vec_id", (F.col("vec_id") + 1).alias("other"), F.col("embedding").alias("x"))
    b = t.embeddings.select(F.col("vec_id").alias("other"), F.col("embedding").alias("y"))
    return a.join(b, "other").select("vec_id", "other", rnd(X.squared_distance("x", "y"), 6).alias("distance"))
