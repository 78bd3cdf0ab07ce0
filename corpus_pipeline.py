"""From raw documents to packed token sequences: quality, lines, near-duplicates, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of
``documents``. Texts that a stage shortens get their new ``n_chars``, and a document of which nothing is left goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loomtab.llm import lines, packing, quality, simhash, suffixes
from loomtab.llm.common import stored
from loomtab.llm.queries import vocabulary
from loomtab.sources.tables import Tables

ORACLE_SQL = None  # classifier, Hamming groups and packing are beyond SQL; tests/llm holds all stages but the grades against a plain version

PASSAGE_BYTES = 160
"""Shorter repeats are common phrases; a passage of fifty words is about twice as long."""


def says(text: str) -> Column:
    """True for a text with a character that is no white space."""
    return F.col(text).rlike(r"(?U)\S")


def with_text(df: DataFrame, row: str, text: Column, columns: list[str]) -> DataFrame:
    """The columns of a row struct with another text."""
    out = df.select(*[text.alias(c) if c == "text" else F.col(row)[c].alias(c) for c in columns])
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in columns else out


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the top grade is more likely than not."""
    model = quality.train(docs, quality.ratings(Tables(spark, sf_dir).labels))
    return quality.grade_documents(docs, model).where(F.element_at("tails", -1) >= 0.5).select("row.*")


def drop_line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that an earlier one has."""
    found = lines.without_repeated_runs(docs)
    return with_text(found.where((F.col("n_removed") == 0) | says("kept")), "row", F.col("kept"), docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has."""
    found = suffixes.without_repeats(docs.withColumn("_before", F.octet_length("text")), threshold=PASSAGE_BYTES)
    found = found.where((F.coalesce("_before", F.lit(0)) == 0) | says("text"))
    return with_text(found.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row")), "row", F.col("row.text"), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their place in windows of 1024."""
    pieces = packing.token_pieces(docs, vocabulary("byte_bpe_50k.json"), 0).drop("ids")
    return packing.pack(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", accept_quality),
    ("line_runs", drop_line_runs),
    ("near_duplicates", keep_one_of_each_group),
    ("passages", cut_passages),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared folder and read by the next."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
