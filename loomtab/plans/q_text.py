"""Text operators over the given documents, pages and conversations."""

from __future__ import annotations

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from loomtab.functions import expr as X
from loomtab.operators import align as A, text as T, words as N
from loomtab.operators.skipgram import skip_gram, synonyms
from loomtab.plans.registry import R, query, rnd
from loomtab.session import spread

STOP = ["the", "of", "and", "in", "to", "a", "is", "that", "it", "for"]
_STOP = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"
_WS = r"CASE WHEN trim(regexp_replace(lower(text), '\s+', ' ', 'g')) = '' THEN [] ELSE string_split(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), ' ') END"


_HIDDEN = ["(?s)<!--.*?-->", *(f"(?s)<{tag}[ >].*?</{tag}>" for tag in ("script", "style", "head", "noscript", "nav", "footer"))]
_SHOWN = "html"
for _pattern in _HIDDEN:
    _SHOWN = f"regexp_replace({_SHOWN}, '{_pattern}', '<>', 'g')"
_DECODED = "s"
for _mark, _sign in (("&quot;?", '"'), ("&lt;?", "<"), ("&gt;?", ">"), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&")):
    _DECODED = f"regexp_replace({_DECODED}, '{_mark}', '{_sign}', 'g')"


@query("html_to_text", f"""SELECT page_id, array_to_string(list_filter(list_transform(string_split_regex({_SHOWN}, '<[^>]*>'), lambda s: trim({_DECODED}, E' \\t\\n\\r')), lambda s: s <> ''), chr(10)) AS text
FROM pages""")
def _(t):
    return T.html_to_text(t.pages, "page_id", "html")


@query("link_extract", r"""
WITH h AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS site, unnest(regexp_extract_all(html, '<a href="([^"]+)"', 1)) AS href,
 generate_subscripts(regexp_extract_all(html, '<a href="([^"]+)"', 1), 1) AS i FROM pages),
a AS (SELECT page_id, regexp_replace(CASE WHEN href LIKE 'http%' THEN href ELSE site || href END, '/+$', '') AS link, min(i) AS i FROM h GROUP BY ALL)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos, link FROM a""")
def _(t):
    return T.extract_links(t.pages, "page_id", "url", "html")


@query("link_extract_markdown", """
SELECT page_id, CAST(2 AS INTEGER) AS n_links, regexp_replace(split_part(url, '#', 1), '/+$', '') AS first_link FROM pages""")
def _(t):
    md = F.concat(F.lit("see [a]("), "url", F.lit(") and [b](/x/#top) or [again]("), "url", F.lit(")"))
    links = T.markdown_links(md)
    return t.pages.select("page_id", F.size(links).alias("n_links"), F.get(links, F.lit(0)).alias("first_link"))


@query("link_scope_filter", r"""
WITH e AS (SELECT a.page_id, a.url AS seed, 'https://' || regexp_extract(a.url, '^[a-z]+://([^/?#]+)', 1) || CASE WHEN a.page_id % 3 = 0 THEN '/en/' ELSE '/xx/' END || CAST(a.page_id AS VARCHAR) AS link FROM pages a)
SELECT page_id, link FROM e WHERE link LIKE '%/en/%' AND regexp_replace(link, '/+$', '') <> regexp_replace(split_part(seed, '#', 1), '/+$', '')""")
def _(t):
    host = F.try_parse_url(F.col("url"), F.lit("AUTHORITY"))
    link = F.concat(F.lit("https://"), host, F.when(F.col("page_id") % 3 == 0, "/en/").otherwise("/xx/"), F.col("page_id").cast("string"))
    edges = t.pages.select("page_id", F.col("url").alias("seed"), link.alias("link"))
    return edges.where(T.in_scope(F.col("seed"), F.col("link"), F.lit("/en/"))).select("page_id", "link")


@query("link_reachability", """
WITH RECURSIVE n AS (SELECT count(*) AS c FROM pages), e AS (SELECT page_id AS src, (page_id * 3 + 1) % c AS dst FROM pages, n UNION ALL SELECT page_id, (page_id * 7 + 2) % c FROM pages, n),
r(id, depth) AS (SELECT CAST(0 AS BIGINT), 0 UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.id WHERE r.depth < 6)
SELECT id, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY id""")
def _(t):
    n = t.pages.agg(F.count(F.lit(1))).scalar()
    k = F.col("page_id")
    edges = t.pages.select(k.alias("src"), F.explode(F.array((k * 3 + 1) % n, (k * 7 + 2) % n)).alias("dst"))
    seeds = t.pages.where("page_id = 0").select(k.alias("id"))
    return T.reachable(edges, seeds, 6)


_LINES = r"""l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
c AS (SELECT doc_id, ls, list_transform(ls, lambda s: CASE WHEN trim(s) = '' OR (starts_with(trim(s), '# ') AND contains(trim(s), '|')) THEN false
  WHEN starts_with(trim(s), '#') OR starts_with(trim(s), '```') THEN true
  ELSE len(list_filter(regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(trim(s), '!?\[[^\]]*\]\([^)]*\)', '', 'g'), 'https?://\S+', '', 'g'), '`[^`]*`', '', 'g'), '[\p{L}\p{N}\p{M}_]+'),
       lambda w: regexp_full_match(w, '[a-zA-Z]{4,}'))) >= 3 END) AS ok FROM l)"""


@query("strip_page_chrome", f"""WITH {_LINES} SELECT doc_id, CASE WHEN list_position(ok, true) IS NULL OR list_position(ok, true) = 0 THEN ''
 ELSE regexp_replace(array_to_string(ls[list_position(ok, true):], chr(10)), '^\\s+|\\s+$', '', 'g') END AS text FROM c""")
def _(t):
    return spread(t.documents, "doc_id").select("doc_id", T.strip_chrome("text").alias("text"))


@query("tokenize_words", rf"""SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}\p{{M}}_]+'), lambda w: NOT list_contains({_STOP}, w)), ' ') AS words FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.array_join(T.word_tokens("text", STOP), " ").alias("words"))


@query("tokenize_lemmas", rf"""WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}\p{{M}}_]+')) AS token FROM documents), d AS (SELECT DISTINCT token FROM w)
SELECT CASE WHEN token LIKE '%ing' THEN left(token, length(token) - 3) ELSE token END AS token, CAST(count(*) AS BIGINT) AS n FROM w GROUP BY 1""")
def _(t):
    words = T.token_rows(spread(t.documents, "doc_id"), [], T.word_tokens("text"))
    lemmas = words.where(F.col("token").endswith("ing")).distinct().withColumn("lemma", F.expr("substring(token, 1, length(token) - 3)"))
    return T.lemmatize(words, lemmas).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query("whitespace_tokens", f"SELECT doc_id, CAST(len({_WS}) AS INTEGER) AS n, array_to_string({_WS}, '|') AS tokens FROM documents")
def _(t):
    tok = spread(t.documents, "doc_id").select("doc_id", T.whitespace_tokens("text").alias("t"))
    return tok.select("doc_id", F.size("t").alias("n"), F.array_join("t", "|").alias("tokens"))


@query("bag_of_words", f"""WITH w AS (SELECT item_id, unnest({_WS}) AS token FROM benchmark), d AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS token_id FROM (SELECT DISTINCT token FROM w))
SELECT item_id, CAST(token_id AS BIGINT) AS token_id, token, CAST(count(*) AS BIGINT) AS n FROM w JOIN d USING (token) GROUP BY ALL""")
def _(t):
    return T.bag_of_words(t.benchmark, "item_id", T.whitespace_tokens("text"))


@query("lda_topics")
def _(t):
    words = spread(t.documents, "doc_id").select("doc_id", T.word_tokens("text", STOP).alias("words"))
    counter = CountVectorizer(inputCol="words", outputCol="features", minDF=1).fit(words)
    model = LDA(k=5, maxIter=5, seed=1).fit(counter.transform(words))
    names = t.spark.createDataFrame(list(enumerate(counter.vocabulary)), "term_id int, word string")
    top = model.describeTopics(5).select("topic", F.posexplode("termIndices").alias("pos", "term_id"))
    return top.join(names, "term_id").select("topic", "pos", "word")


@query("word2vec")
def _(t):
    words = spread(t.documents, "doc_id").select(T.word_tokens("text", STOP).alias("words"))
    vectors, known = skip_gram(words, "words", dims=200, min_count=1, seed=1)
    seed = known.orderBy(F.desc("n"), "word").first()
    return synonyms(vectors, known, seed and seed["word"], 10)


@query("chunk_fixed_overlap", """
SELECT doc_id, CAST(i // 200 AS INTEGER) AS pos, substring(text, CAST(i + 1 AS BIGINT), 250) AS chunk FROM (SELECT doc_id, text, unnest(range(0, length(text), 200)) AS i FROM documents)""")
def _(t):
    return T.chunk_rows(spread(t.documents, "doc_id"), ["doc_id"], T.chunks_with_overlap("text", 250, 50))


@query("chunk_block_skip", """
SELECT doc_id, CAST(i // 512 AS INTEGER) AS pos, CASE WHEN length(text) < 1024 THEN text ELSE substring(text, CAST(i + 1 AS BIGINT), 1024) END AS chunk
FROM (SELECT doc_id, text, unnest(CASE WHEN length(text) < 1024 THEN [0] ELSE range(0, length(text), 512) END) AS i FROM documents)""")
def _(t):
    return T.chunk_rows(spread(t.documents, "doc_id"), ["doc_id"], T.chunks_by_skip("text", 1024, 512))


@query("chunk_delimiter_merge", "SELECT doc_id, text FROM documents WHERE text <> ''")
def _(t):
    # Joined back in order, the chunks must give the text.
    chunks = T.chunk_by_delimiter(t.documents, "doc_id", "text")
    whole = chunks.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "chunk"))).alias("c"))
    return whole.select("doc_id", F.array_join("c.chunk", "").alias("text"))


@query("word_information", f"""WITH d AS (SELECT doc_id, {_WS} AS t FROM documents), w AS (SELECT doc_id, unnest(t) AS a, generate_subscripts(t, 1) AS i FROM d),
k AS (SELECT a FROM w GROUP BY a HAVING count(*) >= 20), f AS (SELECT w.* FROM w SEMI JOIN k USING (a)),
p AS (SELECT x.a, y.a AS b, count(*) AS n FROM f x JOIN f y ON x.doc_id = y.doc_id AND y.i BETWEEN x.i + 1 AND x.i + 3 GROUP BY ALL),
s AS (SELECT a, b, sum(n) AS n FROM (SELECT a, b, n FROM p UNION ALL SELECT b, a, n FROM p) GROUP BY ALL),
o AS (SELECT a, sum(n) AS of_a FROM s GROUP BY a), m AS (SELECT s.a, s.b, ln(CAST(s.n AS DOUBLE) * (SELECT sum(n) FROM s) / (CAST(x.of_a AS DOUBLE) * y.of_a)) AS m FROM s JOIN o x ON x.a = s.a JOIN o y ON y.a = s.b)
SELECT a, CAST(count(*) AS BIGINT) AS n, {R('sum(m)', 5)} AS total FROM m WHERE m > 0 GROUP BY a""")
def _(t):
    docs = spread(t.documents, "doc_id").select(T.whitespace_tokens("text").alias("t"))
    pairs, words = N.cooccurrences(docs, "t", 3, 20, numbered=True)
    told = N.positive_information(pairs).groupBy("a").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("m"), 5).alias("total"))
    return told.join(words, told["a"] == words["number"]).select(words["word"].alias("a"), "n", "total")


@query("word_vectors")
def _(t):
    docs = spread(t.documents, "doc_id").select(T.whitespace_tokens("text").alias("t"))
    vectors = N.word_vectors(docs, "t", dims=20, window=3, min_count=20)
    return vectors.select("word", F.size("vector").alias("dims"), rnd(X.norm("vector"), 2).alias("size"))


@query("chunk_recursive", f"""WITH w AS (SELECT doc_id, {_WS} AS t FROM documents)
SELECT doc_id, true AS within, md5(array_to_string(list_sort(list_distinct(t)), ' ')) AS words FROM w WHERE len(t) > 0""")
def _(t):
    # Every word of a document is in its chunks, and none besides.
    chunks = T.chunk_recursive(t.documents, "doc_id", "text", 100, 50).withColumn("w", T.whitespace_tokens("chunk"))
    words = F.array_sort(F.array_distinct(F.flatten(F.collect_list("w"))))
    return chunks.groupBy("doc_id").agg((F.max(F.size("w")) <= 100).alias("within"), F.md5(F.array_join(words, " ")).alias("words"))


@query("pack_fixed_blocks", f"""
WITH w AS (SELECT doc_id, {_WS} AS t FROM documents), f AS (SELECT doc_id, list_concat(t, ['<|end|>']) AS t FROM w WHERE len(t) > 0),
e AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS i FROM f), p AS (SELECT token, row_number() OVER (ORDER BY doc_id, i) - 1 AS p FROM e)
SELECT CAST(p // 512 AS BIGINT) AS block, md5(string_agg(token, ' ' ORDER BY p)) AS digest FROM p WHERE p // 512 < (SELECT count(*) // 512 FROM p) GROUP BY 1""")
def _(t):
    docs = spread(t.documents, "doc_id").select("doc_id", T.whitespace_tokens("text").alias("t"))
    return T.pack_blocks(docs, ["doc_id"], "t", 512).select("block", F.md5(F.array_join("tokens", " ")).alias("digest"))


@query("pack_best_fit", f"""SELECT CAST(sum(len({_WS})) AS BIGINT) AS n_tokens, true AS full_rows, true AS one_short_row FROM documents""")
def _(t):
    docs = spread(t.documents, "doc_id").select("doc_id", T.whitespace_tokens("text").alias("t"))
    rows = T.pack_best_fit(docs, "doc_id", "t", 257)
    n = F.size("tokens")
    return rows.agg((F.sum(n) + F.sum("cut")).alias("n_tokens"), (F.max(n) == 257).alias("full_rows"), (F.count_if(n < 257) <= 1).alias("one_short_row"))


@query("pad_truncate", f"""
WITH w AS (SELECT doc_id, {_WS} AS t FROM documents)
SELECT doc_id, array_to_string(list_concat(t[1:64], list_transform(range(0, greatest(0, 64 - len(t))), lambda x: '[PAD]')), ' ') AS tokens, CAST(least(64, len(t)) AS BIGINT) AS mask_sum FROM w""")
def _(t):
    p = T.pad_truncate("t", 64)
    mask = F.aggregate(p["mask"], F.lit(0).cast("long"), lambda a, x: a + x)
    return t.documents.select("doc_id", T.whitespace_tokens("text").alias("t")).select("doc_id", F.array_join(p["tokens"], " ").alias("tokens"), mask.alias("mask_sum"))


@query("format_prompt", """
SELECT o_orderkey, '### Task: Rate the order.' || chr(10) || '### Status:' || chr(10) || o_orderstatus || chr(10) || '### Priority:' || chr(10) || o_orderpriority || chr(10) || '<|endoftext|>' AS prompt,
 '{"custom_id":"request-' || o_orderkey || '","method":"POST","url":"/v1/chat","body":{"model":"m","messages":[{"role":"user","content":"' || o_orderpriority || '"}],"max_tokens":300}}' AS request FROM orders""")
def _(t):
    key = F.concat(F.lit("request-"), F.col("o_orderkey").cast("string"))
    return t.orders.select(
        "o_orderkey", T.instruction_text("Rate the order.", {"Status": "o_orderstatus", "Priority": "o_orderpriority"}).alias("prompt"),
        T.request_json(key, "/v1/chat", "m", F.col("o_orderpriority"), 300).alias("request"))


@query("strip_leading_number", r"SELECT doc_id, regexp_replace(text, '(?s)^(.*?)[0-9]+\. ', '\1') AS text FROM documents")
def _(t):
    return t.documents.select("doc_id", X.strip_leading_number("text").alias("text"))


@query("concat_group_text", """
SELECT conv_id, string_agg(text, chr(10) || '----' || chr(10) ORDER BY turn) AS text FROM conversations WHERE text IS NOT NULL GROUP BY conv_id HAVING count(*) >= 2""")
def _(t):
    return T.concat_groups(t.conversations, ["conv_id"], ["turn"], "text", "\n----\n").select("conv_id", "text")


@query("sequence_composition", f"""SELECT doc_id, {R("length(regexp_replace(upper(md5(text)), '[^AC]', '', 'g')) / nullif(length(regexp_replace(upper(md5(text)), '[^ABCD]', '', 'g')), 0)", 6)} AS share,
 substring(md5(text), 6, 1) = 'a' AS matches FROM documents""")
def _(t):
    s = F.md5("text")
    return t.documents.select("doc_id", rnd(X.letter_share(s, "AC", "ABCD"), 6).alias("share"), X.letter_matches(s, F.lit(5), F.lit("a")).alias("matches"))


@query("apply_point_edit", "SELECT doc_id, left(md5(text), CAST(doc_id % 32 AS INTEGER)) || 'G' || substring(md5(text), doc_id % 32 + 2) AS edited FROM documents")
def _(t):
    return t.documents.select("doc_id", X.point_edit(F.md5("text"), (F.col("doc_id") % 32).cast("int"), F.lit("G")).alias("edited"))


@query("sequence_column_detect", """
SELECT 'seq' AS "column", CAST(count(*) AS BIGINT) AS n, true AS is_sequence FROM documents UNION ALL SELECT 'text', CAST(count(*) AS BIGINT), false FROM documents
UNION ALL SELECT 'lang', CAST(count(*) AS BIGINT), false FROM documents""")
def _(t):
    seq = F.translate(F.md5("text"), "0123456789abcdef", "ACGTNACGTNACGTNA")
    return T.sequence_columns(t.documents.select(seq.alias("seq"), "text", "lang"))


@query("pairwise_identity")
def _(t):
    items = t.benchmark.select("item_id", "text", F.floor(F.col("item_id") / 8).alias("block"))
    return A.block_identities(items, "item_id", "text", "block").select("a", "b", rnd("identity", 6).alias("identity"))


@query("similar_sequences")
def _(t):
    own = t.benchmark.select((F.col("item_id") * 2).alias("id"), "text")
    changed = t.benchmark.select((F.col("item_id") * 2 + 1).alias("id"), F.regexp_replace("text", "and ", "").alias("text"))
    found, members = A.alike(own.unionByName(changed), "id", "text", 0.8)
    links = found.select("a", "b").unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    return members.join(links, "a", "left").select("id", F.col("a").alias("representative"), F.coalesce("n", F.lit(0)).alias("n_alike"))
