"""Sorts, samples, splits, set operations and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtab.operators import sets as U, splits as P
from loomtab.plans.registry import query


def _n(name="n"):
    return F.count(F.lit(1)).alias(name)


@query("sort_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 3")
def _(t):
    return t.orders.orderBy(F.desc("o_orderkey")).limit(3).select("o_orderkey", "o_totalprice")


@query("sample_fraction", "SELECT o_orderkey, o_totalprice FROM orders WHERE md5(CAST(o_orderkey AS VARCHAR) || '42') < '33333333'")
def _(t):
    return P.sample_fraction(t.orders, "o_orderkey", 0.2, 42).select("o_orderkey", "o_totalprice")


@query("sample_exact_n", "SELECT event_id, value FROM events ORDER BY md5(CAST(event_id AS VARCHAR) || '7') LIMIT 500")
def _(t):
    return P.sample_exact(t.events, "event_id", 500, 7).select("event_id", "value")


@query("stratified_cap", """
SELECT event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY md5(CAST(event_id AS VARCHAR) || '7'))
 <= floor(count(*) OVER (PARTITION BY event_type) * (3000 / CAST(count(*) OVER () AS DOUBLE)))""")
def _(t):
    return P.stratified_cap(t.events, "event_type", "event_id", 3000, 7).select("event_id", "event_type")


@query("balanced_sample", "SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || '3')) <= 40")
def _(t):
    return P.balanced_sample(t.documents.select("doc_id", "lang"), "lang", "doc_id", 40, 3)


@query("stratified_split", """
SELECT doc_id, toxic, CASE WHEN row_number() OVER (PARTITION BY toxic ORDER BY md5(CAST(doc_id AS VARCHAR) || '5'))
  <= floor(count(*) OVER (PARTITION BY toxic) * 0.2) THEN 'test' ELSE 'train' END AS split FROM labels""")
def _(t):
    return P.stratified_split(t.labels, "toxic", "doc_id", 0.2, 5).select("doc_id", "toxic", "split")


@query("time_split", """
SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= CAST(floor((SELECT count(*) FROM events) * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM events""")
def _(t):
    return P.time_split(t.events, ["ts", "event_id"], 0.2).select("event_id", "split")


@query("three_way_split", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '11')) AS r, count(*) OVER () AS n FROM orders),
c AS (SELECT *, CAST(floor(n * 0.1) AS BIGINT) AS a FROM r)
SELECT o_orderkey, CASE WHEN r <= a THEN 'test' WHEN r <= a + CAST(floor((n - a) * (0.3::DOUBLE / 0.9::DOUBLE)) AS BIGINT) THEN 'validation' ELSE 'train' END AS split FROM c""")
def _(t):
    return P.three_way_split(t.orders, "o_orderkey", 11).select("o_orderkey", "split")


@query("half_split_shuffled", """
SELECT conv_id, CAST(row_number() OVER (ORDER BY md5(CAST(conv_id AS VARCHAR) || '2')) > count(*) OVER () // 2 AS INTEGER) AS half
FROM (SELECT DISTINCT conv_id FROM conversations)""")
def _(t):
    return P.half_split(t.conversations.select("conv_id").distinct(), "conv_id", 2)


@query("group_mod_split", """
SELECT event_id, CASE WHEN CAST(('0x' || left(md5(CAST(user_id AS VARCHAR)), 7)) AS BIGINT) % 4 = 0 THEN 'validation' ELSE 'train' END AS split FROM events""")
def _(t):
    return P.group_mod_split(t.events, "user_id").select("event_id", "split")


@query("date_shift_validation", """
WITH m AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')
SELECT o_orderkey FROM orders, m WHERE o_orderdate < TIMESTAMP '2001-01-01' AND CAST(o_orderdate AS DATE) > lo - 365 AND CAST(o_orderdate AS DATE) <= hi - 365""")
def _(t):
    edge = F.lit("2001-01-01").cast("timestamp")
    train, test = t.orders.where(F.col("o_orderdate") < edge), t.orders.where(F.col("o_orderdate") >= edge)
    return P.date_shift_validation(train, test, "o_orderdate").select("o_orderkey")


@query("k_fold", "SELECT vec_id, CAST(floor((row_number() OVER (ORDER BY vec_id) - 1) * 5 / CAST(count(*) OVER () AS DOUBLE)) AS INTEGER) AS fold FROM embeddings")
def _(t):
    return P.k_fold(t.embeddings.select("vec_id"), ["vec_id"], 5)


def _binary(t):
    return t.labels.select("doc_id", F.col("quality").cast("double").alias("quality"), "toxic")


_SIZES = "count(*) FILTER (toxic = 0) AS a, count(*) FILTER (toxic = 1) AS b FROM labels"


@query("oversample", f"""WITH s AS (SELECT {_SIZES}) SELECT 0 AS toxic, CAST(a AS BIGINT) AS n FROM s UNION ALL
SELECT 1, CAST(greatest(b, least(floor(a * 0.5), a)) AS BIGINT) FROM s""")
def _(t):
    return P.oversample(_binary(t), "toxic", "doc_id", 0.5, 1).groupBy("toxic").agg(_n())


@query("undersample", f"""WITH s AS (SELECT {_SIZES}), k AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY md5(CAST(doc_id AS VARCHAR) || '1')) AS r FROM labels)
SELECT doc_id, toxic FROM k, s WHERE toxic = 1 OR r <= CAST(floor(b / 0.5) AS BIGINT)""")
def _(t):
    return P.undersample(_binary(t), "toxic", "doc_id", 0.5, 1).select("doc_id", "toxic")


@query("smote", f"""WITH s AS (SELECT {_SIZES}) SELECT false AS synthetic, CAST(a + b AS BIGINT) AS n, true AS inside FROM s UNION ALL
SELECT true, CAST(least(floor(a * 0.5), a) - b AS BIGINT), true FROM s""")
def _(t):
    rows = t.labels.join(t.documents.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"), F.size(F.split("text", " ")).cast("double").alias("words")), "doc_id")
    out = P.smote(rows, "toxic", "doc_id", ["n_chars", "words"], 5, 0.5, 1)
    span = rows.where("toxic = 1").agg(F.struct(F.min("n_chars").alias("a"), F.max("n_chars").alias("b"))).scalar()
    inside = (F.col("toxic") == 0) | F.col("n_chars").between(span["a"], span["b"])
    return out.groupBy("synthetic").agg(_n(), F.bool_and(inside).alias("inside"))


@query("mix_ratio", """
WITH a AS (SELECT doc_id FROM documents WHERE lang = 'en'), b AS (SELECT doc_id FROM documents WHERE lang <> 'en')
SELECT doc_id, 'a' AS origin FROM a UNION ALL SELECT doc_id, 'b' FROM b QUALIFY row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || '4'))
  <= CAST(floor((SELECT count(*) FROM a) * 0.25) AS BIGINT)""")
def _(t):
    d = t.documents.select("doc_id", "lang")
    return P.mix_ratio(d.where("lang = 'en'"), d.where("lang <> 'en'"), "doc_id", 0.75, 4).select("doc_id", "origin")


@query("length_cap", """
WITH c AS (SELECT doc_id, least(length(text), 10000) AS n, sum(least(length(text), 10000)) OVER (ORDER BY doc_id) AS e FROM documents),
b AS (SELECT sum(n) * 0.5 AS total FROM c)
SELECT doc_id, CAST(n AS INTEGER) AS n FROM c, b WHERE e - n < CAST(floor(total) AS BIGINT)""")
def _(t):
    d = t.documents.select("doc_id", "text")
    total = d.agg(F.sum(F.least(F.length("text"), F.lit(10_000))) * 0.5).first()[0]
    return P.length_cap(d, "text", ["doc_id"], int(total), 10_000).select("doc_id", F.length("text").alias("n"))


# ---- set operations --------------------------------------------------------

@query("union_all", "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return a.unionByName(t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")))


@query("union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def _(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct()


@query("drop_duplicate_rows", "SELECT DISTINCT text, lang FROM documents")
def _(t):
    return t.documents.select("text", "lang").dropDuplicates()


@query("dedup_by_key_first", "SELECT doc_id, sha256(text) AS sha FROM documents QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1")
def _(t):
    return U.first_per_key(t.documents.select("doc_id", F.sha2("text", 256).alias("sha")), ["sha"], ["doc_id"])


@query("dedup_struct_entries", """
SELECT event_id, '[' || props || CASE WHEN event_id % 2 = 1 THEN ',{"k": 1}' ELSE '' END || ']' AS kept FROM events WHERE props <> '{"k": 1}'""")
def _(t):
    listed = F.concat(F.lit("["), "props", F.lit(","), "props",
                      F.when(F.col("event_id") % 2 == 1, F.lit(',{"k": 1}')).otherwise(""), F.lit("]"))
    entries = U.distinct_entries(listed, "struct<k:int>")
    text = F.concat(F.lit("["), F.array_join(F.transform(entries, lambda e: F.format_string('{"k": %d}', e["k"])), ","), F.lit("]"))
    return t.events.where("""props <> '{"k": 1}'""").select("event_id", text.alias("kept"))


@query("id_remap_contiguous", """
WITH declared AS (SELECT p_partkey, p_name FROM part WHERE p_partkey % 3 <> 0), u AS (SELECT p_partkey FROM declared UNION SELECT l_partkey FROM lineitem)
SELECT p_partkey, CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS BIGINT) AS new_id, coalesce(p_name, 'class_' || CAST(p_partkey AS VARCHAR)) AS p_name
FROM u LEFT JOIN declared USING (p_partkey)""")
def _(t):
    return U.contiguous_ids(t.part.where("p_partkey % 3 <> 0"), t.lineitem.select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "p_name")


