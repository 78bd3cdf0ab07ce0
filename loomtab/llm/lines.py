"""Deletion of repeated runs of lines by winnowing, in DataFrame functions only.

The lines of a text that are not blank are hashed and numbered. Every window of ``run`` lines, and every shorter one of
``words`` words, selects its smallest hash; equal runs select equal lines, so a run that repeats has a fingerprint that occurs twice.
Around each position of such a fingerprint a match extends to both sides over the windows that selected it: each
is joined with its first occurrence, dealt by fingerprint and window, so that a common line is no one task's work. What
matches on overlaps to the whole of the run, and its lines are deleted wherever they are not the first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from loomtab.session import materialize

RUN = 3
WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"


def window_list(run: int, words: int) -> Column:
    """All windows of a document: fingerprint (smallest line hash), hash, place, and the numbers of the lines."""
    def of(size: int) -> Column:
        count = F.size("hashes") - size
        starts = F.when(count >= 0, F.sequence(F.lit(0), count)).otherwise(F.array().cast("array<int>"))
        if size < run:
            starts = F.filter(starts, lambda i: F.aggregate(F.slice("words", i + 1, size), F.lit(0), lambda a, n: a + n) >= words)
        return F.transform(starts, lambda i: F.struct(
            i.alias("at"), F.array_min(F.slice("hashes", i + 1, size)).alias("fingerprint"), F.xxhash64(F.lit(size), F.slice("hashes", i + 1, size)).alias("window"),
            F.slice("filled", i + 1, size).alias("covers")))

    return reduce(F.concat, [of(size) for size in range(1, run + 1)])


def repeated_lines(rows: DataFrame, run: int, words: int) -> DataFrame:
    """``gone``: the numbers of lines in repeated windows, for each (key, digest) of ``rows`` that has any."""
    numbered = F.transform("lines", lambda x, i: F.struct(F.trim(x).alias("line"), (i + 1).alias("number")))
    size = F.transform("filled", lambda x: F.size(F.regexp_extract_all(x["line"], F.lit(WORD), F.lit(0))) if run > 1 else F.lit(0))
    docs = rows.select("key", "digest", F.filter(numbered, lambda x: x["line"] != "").alias("filled")) \
        .select("key", "digest", F.transform("filled", lambda x: F.xxhash64(x["line"])).alias("hashes"), size.alias("words"), F.col("filled.number").alias("filled"))
    docs = materialize(docs.where(F.size("hashes") > 0).distinct())
    windows = docs.select("key", "digest", F.explode(window_list(run, words)).alias("w")).select("key", "digest", "w.*")
    # A window can only repeat if its selected line is selected at two places.
    selected = F.array_distinct(F.transform(window_list(run, words), lambda w: F.struct(
        w["fingerprint"].alias("fingerprint"), F.array_position(F.slice("hashes", w["at"] + 1, F.size(w["covers"])), w["fingerprint"]).alias("in"), w["at"].alias("at"))))
    places = F.array_distinct(F.transform(selected, lambda p: F.struct(p["fingerprint"].alias("fingerprint"), (p["at"] + p["in"]).alias("at"))))
    again = docs.select(F.explode(places).alias("p")).groupBy(F.col("p.fingerprint").alias("fingerprint")).count().where("count > 1")
    order = F.struct(F.col("key").isNull().alias("last"), "key", "digest", "at")
    candidates = windows.drop("covers").join(again.select("fingerprint"), "fingerprint", "left_semi")
    first = candidates.groupBy("fingerprint", "window").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = windows.join(first, ["fingerprint", "window"]).where(order != F.col("first"))
    return later.groupBy("key", "digest").agg(F.array_distinct(F.flatten(F.collect_list("covers"))).alias("gone"))


def without_repeated_runs(df: DataFrame, key: str = "doc_id", text: str = "text", run: int = RUN, words: int = WORDS) -> DataFrame:
    """All other columns of ``df`` as ``row``, ``kept`` text, ``n_lines`` and ``n_removed`` of every row.

    A line goes if it stands in lines in a row that also stand in a document of a smaller key, or earlier in the
    same document, and are ``run`` lines, or have ``words`` words; lines are compared without blanks around them, blank lines are skipped over and stay. NULL keys
    come last, rows of one key are ordered by the hash of their text, and rows equal in both are decided alike
    (none makes another one repeat). A NULL text stays NULL and has no lines; An empty table gives an empty one.
    """
    if run < 1:
        raise ValueError("a run has one line at least")
    value = F.col(text).cast("string")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text]).alias("row"), F.col(key).alias("key"),
                     F.xxhash64(value).alias("digest"), F.split(value, "\n", -1).alias("lines"))
    found = repeated_lines(rows, run, words).select(F.col("key").alias("_key"), F.col("digest").alias("_digest"), "gone")
    joined = rows.join(found, F.col("key").eqNullSafe(F.col("_key")) & (F.col("digest") == F.col("_digest")), "left")
    left = F.transform(F.array_except(F.sequence(F.lit(1), F.size("lines")), "gone"), lambda i: F.element_at("lines", i))
    return joined.select("row", F.array_join(F.when(F.col("gone").isNull(), F.col("lines")).otherwise(left), "\n").alias("kept"),
                         F.coalesce(F.when(F.col("lines").isNotNull(), F.size("lines")), F.lit(0)).cast("long").alias("n_lines"),
                         F.coalesce(F.when(F.col("gone").isNotNull(), F.size("gone")), F.lit(0)).cast("long").alias("n_removed"))
