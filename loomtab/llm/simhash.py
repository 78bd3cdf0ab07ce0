"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments. Two fingerprints within ``distance`` bits are within ``distance // segments``
bits in one segment at least, so each fingerprint looks up the small Hamming ball around its own
segment value in a table of all segment values, and the whole distance of every match is verified in the join.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loomtab.llm.common import map_batches, schema_of, steps, text_or_empty
from loomtab.llm.components import components, star_edges
from loomtab.session import materialize

BITS = 64
SEGMENTS = 2
DENSE = 1024
"""Fingerprints under one segment value above which their links are not written out one by one."""
BLOCK = 2048


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Majority of the bits of the shingles' XXH64 (seed 42); as a signed number."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z and the six ASCII white-space characters only
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    n, ones = len(shingles), np.zeros(BITS, np.int64)
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    for a in range(0, n, 1 << 16):
        hashes = np.fromiter(map(digest, shingles[a:a + (1 << 16)]), "<u8", min(n - a, 1 << 16))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text", shingle: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``fingerprint`` (long) of every whole text; NULL counts as empty, whose fingerprint is 0."""
    schema = schema_of(df.select(*keep), "fingerprint long")

    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1).cast(pa.binary())
            for a, b in steps(pa.compute.binary_length(column).to_pylist()):
                found = [fingerprint(t, shingle) for t in column.slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in batch.columns[:-1]] + [pa.array(found, pa.int64())], schema.names)

    return map_batches(df.select(*keep, text_or_empty(text).alias("_text")), run, schema)


def segment(value: Column, number: int, segments: int) -> Column:
    """The bits of one segment in their place, marked with the segment's number where all bits are in use."""
    width = -(-BITS // segments)
    low = number * width
    high = min(BITS, low + width)
    bits = F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << (high - low)) - 1)) if high - low < 64 else value
    return bits.bitwiseOR(F.lit(number << 58)) if segments > 1 else bits


def ball(number: int, segments: int, radius: int) -> list[int]:
    """Masks that change at most ``radius`` bits of a segment."""
    width = -(-BITS // segments)
    size = min(BITS, number * width + width) - number * width
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(size), r)]


def link_edges(values: DataFrame, distance: int = 3, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """Edges (a, b) that connect exactly what links of ``distance`` bits or fewer connect; ``values``: distinct fingerprints.

    Under a segment value of up to ``dense`` fingerprints every link is an edge. Larger ones are dealt into blocks
    of index and probe rows, and each pair of blocks gives edges to its own roots only, never all its links.
    """
    if segments < 2 or segments > 8:
        raise ValueError("segments must be 2 to 8")
    radius = distance // segments
    # Few bytes become many rows: without a fixed number of partitions they would all start in a few tasks.
    values = values.repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fingerprint"))
    own = F.array(*[segment(F.col("fingerprint"), s, segments) for s in range(segments)])
    near = F.array(*[segment(F.col("fingerprint"), s, segments).bitwiseXOR(F.lit(m)) for s in range(segments) for m in ball(s, segments, radius)])
    index = values.select(F.explode(own).alias("key"), F.col("fingerprint").alias("b"))
    probes = values.select(F.explode(near).alias("key"), F.col("fingerprint").alias("a"))
    crowded = materialize(index.groupBy("key").count().where(F.col("count") > dense))
    sparse = index.join(crowded, "key", "left_anti")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    found = probes.hint("shuffle_merge").join(sparse, (probes["key"] == sparse["key"]) & (F.col("a") < F.col("b")) & close).select("a", "b")
    if crowded.isEmpty():
        return found

    blocks = F.greatest(F.lit(1), F.ceil(F.col("count") / BLOCK)).cast("int")
    left = probes.join(crowded, "key").select(
        "key", F.pmod(F.xxhash64("a"), blocks).cast("int").alias("p"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("i"),
        F.col("a").alias("value"), F.lit(True).alias("probe"))
    right = index.join(crowded, "key").select(
        "key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("p"), F.pmod(F.xxhash64("b"), blocks).cast("int").alias("i"),
        F.col("b").alias("value"), F.lit(False).alias("probe"))

    def connect(table: pa.Table) -> pa.Table:
        value, probe = table["value"].to_numpy().astype(np.int64), table["probe"].to_numpy()
        inside, asked = np.sort(value[~probe]), np.sort(value[probe])
        out = [np.zeros((2, 0), np.int64)]
        for a in range(0, len(asked), BLOCK):
            part = asked[a:a + BLOCK]
            apart = np.bitwise_count((part[:, None] ^ inside[None, :]).view(np.uint64))  # of signed numbers it would count the absolute value
            out.append(np.array(star_edges(apart <= distance, part, inside)))
        a, b = np.concatenate(out, axis=1)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return found.unionByName(left.unionByName(right).groupBy("key", "p", "i").applyInArrow(connect, "a long, b long"))


def grouped(df: DataFrame, key: str, text: str, shingle: int, distance: int) -> DataFrame:
    """Every row's ``key``, ``digest`` of its text, ``fingerprint`` and ``root``, the smallest fingerprint it reaches."""
    value = text_or_empty(text)
    rows = df.select(F.col(key).alias("key"), F.xxhash64(value).alias("digest"), value.alias("value"))
    prints = materialize(fingerprints(rows, "value", shingle, ("key", "digest")))
    values = prints.select("fingerprint").distinct()
    roots = components(link_edges(values, distance))
    # Written out, so that the join meets plain shuffles, of which a large one can be split.
    named = materialize(values.join(roots, values["fingerprint"] == roots["node"], "left")
                        .select("fingerprint", F.coalesce("root", "fingerprint").alias("root")))
    return prints.join(named, "fingerprint")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` (smallest key reachable over links, its own included) per row.

    Texts that are NULL, empty or white space have fingerprint 0 and are linked like any other. Equal
    fingerprints are one node however often they occur; NULL keys take part but are never the smallest
    (a group of NULL keys only has component NULL). Repeated rows stay repeated. No other column is read.
    """
    rows = grouped(df, key, text, shingle, distance)
    # Written out, so that the join meets plain shuffles, of which a large one can be split.
    least = materialize(rows.groupBy("root").agg(F.min("key").alias("component_id")))
    return rows.join(least, "root").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``df``, all columns, with one row left of each group: the one of the smallest key, NULL after all others.

    Of several rows with that key the one whose text has the smallest hash stays, of rows equal in key and text a single one.
    """
    names = df.columns
    kind = df.schema[key].dataType

    def identity(column: str) -> list[Column]:
        """Plain columns, so that the join and the step after it share one shuffle of the texts."""
        return [F.col(column).isNull().alias("absent"), F.coalesce(column, F.lit(0).cast(kind)).alias("id")]

    order = F.struct(F.col("key").isNull(), "key", "digest")
    kept = grouped(df, key, text, shingle, distance).groupBy("root").agg(F.min(order).alias("first")) \
        .select(F.col("first.key").alias("key"), F.col("first.digest").alias("digest")).select(*identity("key"), "digest")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(key).alias("key"), F.xxhash64(text_or_empty(text)).alias("digest")) \
        .select("row", *identity("key"), "digest")
    same = ["absent", "id", "digest"]
    return rows.join(kept, same, "left_semi").dropDuplicates(same).select("row.*")
