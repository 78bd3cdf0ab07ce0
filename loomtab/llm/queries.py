"""Registered queries of this subpackage: one per operator, with the SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loomtab.llm import ans, bpe, conversations, lines, packing, pages, quality, simhash, sketches, suffixes, vector_codes, vectors, wordbpe
from loomtab.operators.ordered import keyed_join
from loomtab.plans.registry import query
from loomtab.session import scratch
from loomtab.sources.tables import Tables


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_bpe_round_trip")
def op1_bpe_round_trip(t: Tables) -> DataFrame:
    ranks = vocabulary("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(t.documents, ranks)
    counted = ids.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                         F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"))
    return bpe.decode(counted, ranks, keep=("doc_id", "n_tokens", "ids_sha256")) \
        .select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


LINES_SQL = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
filled AS (
  SELECT doc_id, i, trim(line, ' ') AS s, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p
  FROM split WHERE trim(line, ' ') <> ''),
near AS (
  SELECT doc_id, p, s, n, lead(s, 1) OVER o AS s1, lead(n, 1) OVER o AS n1, lead(s, 2) OVER o AS s2
  FROM filled WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
win AS (
  SELECT doc_id, p, [s, s1, s2] AS w FROM near WHERE s2 IS NOT NULL
  UNION ALL SELECT doc_id, p, [s, s1] FROM near WHERE s1 IS NOT NULL AND n + n1 >= 50
  UNION ALL SELECT doc_id, p, [s] FROM near WHERE n >= 50),
firsts AS (SELECT w, min({'d': doc_id, 'p': p}) AS f FROM win GROUP BY w),
gone AS (
  SELECT DISTINCT doc_id, p + k AS p
  FROM (SELECT win.doc_id, win.p, unnest(range(len(w))) AS k FROM win JOIN firsts USING (w) WHERE {'d': win.doc_id, 'p': win.p} <> f)),
marked AS (
  SELECT split.doc_id, split.i, split.line, gone.p IS NOT NULL AS gone
  FROM split LEFT JOIN filled ON filled.doc_id = split.doc_id AND filled.i = split.i
  LEFT JOIN gone ON gone.doc_id = filled.doc_id AND gone.p = filled.p),
kept AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text,
         count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, k.text, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


@query("op2_line_runs", LINES_SQL)
def op2_line_runs(t: Tables) -> DataFrame:
    return lines.without_repeated_runs(t.documents, run=3, words=50).select("row.doc_id", F.col("kept").alias("text"), "n_lines", "n_removed")


@query("op3_simhash_groups")
def op3_simhash_groups(t: Tables) -> DataFrame:
    return simhash.near_duplicates(t.documents, shingle=3, distance=3)


@query("op4_near_vectors")
def op4_near_vectors(t: Tables) -> DataFrame:
    return vectors.near_vectors(t.embeddings, cosine=0.98)


@query("op5_page_texts")
def op5_page_texts(t: Tables) -> DataFrame:
    return pages.extract_text(t.pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op6_token_files")
def op6_token_files(t: Tables) -> DataFrame:
    read = ans.token_files(t.documents, scratch(t.spark, "tokens"), vocabulary("word_bpe_49k.json"), 2)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op7_repeated_windows")
def op7_repeated_windows(t: Tables) -> DataFrame:
    return suffixes.repeated_spans(t.documents, threshold=50).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_packed_sequences")
def op8_packed_sequences(t: Tables) -> DataFrame:
    pieces = packing.token_pieces(t.documents, vocabulary("byte_bpe_50k.json"), 0).drop("ids")
    return packing.pack(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op9_quality_grades")
def op9_quality_grades(t: Tables) -> DataFrame:
    model = quality.train(t.documents, quality.ratings(t.labels))
    graded = quality.grade_documents(t.documents, model)
    return graded.select("row.doc_id", "expected_grade", F.col("tails")[0].alias("p_grade_1"), F.col("tails")[1].alias("p_grade_2"),
                         (F.col("tails")[1] >= 0.5).alias("kept"))


@query("op10_edit_sketches")
def op10_edit_sketches(t: Tables) -> DataFrame:
    return sketches.edit_fingerprints(t.documents)


@query("op11_conversation_repair")
def op11_conversation_repair(t: Tables) -> DataFrame:
    report, rows = conversations.repair(conversations.damage(t.conversations))
    every = t.conversations.select(F.col("conv_id").alias("conv")).distinct()
    found = keyed_join(keyed_join(every, report, ["conv"], "left"), conversations.digests(rows), ["conv"], "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    gaps = F.when(F.col("audit").isNull(), F.lit(0)).otherwise(F.col("gaps")).cast("long").alias("gaps")
    return found.select(F.col("conv").alias("conv_id"), gaps, *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


@query("op12_vector_codes")
def op12_vector_codes(t: Tables) -> DataFrame:
    coded, books = vector_codes.encode(t.embeddings, parts=16, entries=64, rounds=2)
    return vector_codes.with_label_error(coded).select(
        F.col("key").alias("vec_id"), vector_codes.hex_codes("codes").alias("code"), "error", "label_error",
        F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256"))


@query("op13_word_bpe")
def op13_word_bpe(t: Tables) -> DataFrame:
    words = vocabulary("word_bpe_49k.json")
    ids = wordbpe.encode(t.documents, words)
    counted = ids.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                         F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"))
    return wordbpe.decode(counted, words, keep=("doc_id", "n_tokens", "ids_sha256")) \
        .select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
