"""Sets as bit sets of fixed length, and the most similar ones by shared bits over all bits.

The similarity of two bit sets is at most the smaller number of set bits over the larger. A task sorts its rows by that number into
bands; each query visits the bands in order of this bound and stops at the first that cannot reach its k-th best any more. Intersections
of a band with the queries that still ask are one product of two matrices of bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from loomtab.operators.ordered import keyed_join
from loomtab.session import written

BITS = 2048
BAND = 512
"""Rows of a band."""
HELD = 16_384
"""Rows that are sorted into bands at a time."""
QUERY_BLOCK = 4096
"""Queries that go to the tasks together."""


def bit_sets(df: DataFrame, key: str, items: str, bits: int = BITS) -> DataFrame:
    """(key, set): one binary of ``bits`` bits per row, set by the first 32 bits of each item's MD5, reduced to ``bits``; a NULL array is the empty set, NULL items set no bit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, rows = batch.column(1).value_parent_indices(), np.zeros((batch.num_rows, bits), bool)
            words = batch.column(1).flatten().dictionary_encode()
            # Each different word of a batch is hashed once.
            place = np.array([int.from_bytes(md5(x.encode(), usedforsecurity=False).digest()[:4], "big") % bits for x in words.dictionary.to_pylist()], np.int64)
            there = words.indices.is_valid()
            rows[row.filter(there).to_numpy(), place[words.indices.filter(there).to_numpy()]] = True
            packed = np.packbits(rows, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in packed], pa.binary())], [key, "set"])

    return df.select(key, items).mapInArrow(run, StructType([df.schema[key], *StructType.fromDDL("set binary").fields]))


def tanimoto_topk(df: DataFrame, key: str, items: str, k: int, queries: DataFrame, bits: int = BITS) -> DataFrame:
    """(key, rank, neighbor, similarity): the k most similar other rows of ``df`` for each row of ``queries``, ties by key.

    Similarity is shared bits over all bits, 0 if neither set has any. A stated query set goes against all rows, in blocks that are
    sent to the tasks. Rows with equal sets are folded: of each set the ``k`` + 1 lowest keys can be anyone's
    neighbours, and one query asks for all its copies. Exact; k rows per query come out, whatever the number of copies.
    """
    kind = df.schema[key].dataType.simpleString()
    own = Window.partitionBy("set").orderBy(key)
    # Both are written: each block of queries reads them again.
    base = written(bit_sets(df, key, items, bits).withColumn("_c", F.row_number().over(own)).where(F.col("_c") <= k + 1).drop("_c"), "sets")
    asked = written(bit_sets(queries, key, items, bits), "asked")
    heads = written(asked.groupBy("set").agg(F.min(key).alias("_head")), "heads")
    blocks = max(1, -(-heads.count() // QUERY_BLOCK))
    dealt = heads.withColumn("_block", F.pmod(F.xxhash64("set"), F.lit(blocks)))
    parts = [_scan(base, key, dealt.where(F.col("_block") == i).select("_head", "set").toPandas(), kind, k + 1) for i in range(blocks)]
    w = Window.partitionBy(key).orderBy(F.desc("similarity"), "neighbor")
    best = Window.partitionBy("_head").orderBy(F.desc("similarity"), "neighbor")
    found = reduce(DataFrame.unionByName, parts).withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1).drop("_r")
    of_copy = keyed_join(asked, heads, ["set"]).select(key, "_head")
    found = of_copy.join(found, "_head").where(F.col(key) != F.col("neighbor"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(key, "rank", "neighbor", "similarity")


def unpacked(sets) -> np.ndarray:
    rows = np.frombuffer(b"".join(sets), np.uint8).reshape(len(sets), -1)
    return np.unpackbits(rows, axis=1)


class Best:
    """The k best (similarity, key) of each query."""

    def __init__(self, queries: int, k: int):
        self.k, self.least = k, np.full(queries, -1.0)
        self.query, self.key, self.similarity = np.zeros(0, np.int64), None, np.zeros(0)

    def offer(self, query: np.ndarray, key: np.ndarray, similarity: np.ndarray) -> None:
        query, similarity = np.concatenate([self.query, query]), np.concatenate([self.similarity, similarity])
        key = key if self.key is None else np.concatenate([self.key, key])
        order = np.lexsort((key, -similarity, query))
        query, key, similarity = query[order], key[order], similarity[order]
        begins = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.zeros(0, np.int64)
        place = np.arange(len(query)) - np.repeat(begins, np.diff(np.append(begins, len(query))))
        kept = place < self.k
        self.query, self.key, self.similarity = query[kept], key[kept], similarity[kept]
        last = place[kept] == self.k - 1
        self.least[self.query[last]] = self.similarity[last]


def visit(best: Best, asked: np.ndarray, sizes: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> int:
    """Offers all rows that can be among the best; how many pairs were compared."""
    count = rows.sum(axis=1, dtype=np.int64)
    order = np.argsort(count, kind="stable")
    keys, rows, count = keys[order], rows[order], count[order]
    cuts = np.arange(0, len(rows), BAND)
    low, high = count[cuts], count[np.append(cuts[1:], len(rows)) - 1]
    bound = np.minimum(1.0, np.minimum(sizes[:, None] / np.maximum(low, 1), high / np.maximum(sizes, 1)[:, None]))
    turn, compared = np.argsort(-bound, axis=1, kind="stable"), 0
    for r in range(len(cuts)):
        band = turn[:, r]
        asks = bound[np.arange(len(band)), band] >= best.least
        if not asks.any():
            break
        found = []  # a query visits one band a round, so all offers of a round go together
        for b in np.unique(band[asks]):
            q = np.flatnonzero(asks & (band == b))
            part = slice(cuts[b], cuts[b] + BAND)
            shared = asked[q] @ rows[part].T.astype(np.float32)
            union = sizes[q][:, None] + count[part][None, :] - shared
            similarity = np.divide(shared, union, out=np.zeros(shared.shape), where=union > 0, dtype=np.float64)
            compared += similarity.size
            m, kth = min(best.k, similarity.shape[1]), best.least[q]
            many = np.flatnonzero(np.count_nonzero(similarity >= kth[:, None], axis=1) > m)
            if len(many):
                kth[many] = np.partition(similarity[many], -m, axis=1)[:, -m]
            i, j = np.nonzero(similarity >= kth[:, None])
            found.append((q[i], keys[part][j], similarity[i, j]))
        best.offer(*map(np.concatenate, zip(*found)))
    return compared


def _scan(base: DataFrame, key: str, held: pd.DataFrame, kind: str, k: int) -> DataFrame:
    schema = f"_head {kind}, neighbor {kind}, similarity double"
    if held.empty:
        return base.sparkSession.createDataFrame([], schema)
    shared = base.sparkSession.sparkContext.broadcast((held["_head"].to_numpy(), list(map(bytes, held["set"]))))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, sets = shared.value
        bits = unpacked(sets)
        asked, sizes, best = bits.astype(np.float32), bits.sum(axis=1, dtype=np.int64), Best(len(sets), k)
        waiting, count = [], 0

        def flush():
            all_ = pd.concat(waiting)
            visit(best, asked, sizes, all_["_key"].to_numpy(), unpacked(list(map(bytes, all_["set"]))))

        for f in frames:
            if len(f):
                waiting.append(f)
                count += len(f)
            if count >= HELD:
                flush()
                waiting, count = [], 0
        if waiting:
            flush()
        if best.key is not None:
            yield pd.DataFrame({"_head": names[best.query], "neighbor": best.key, "similarity": best.similarity})

    return base.select(F.col(key).alias("_key"), "set").mapInPandas(run, schema)
