"""Packing of token pieces into fixed windows by minimum bin slack.

Only the histogram of piece lengths (at most one entry per length up to the capacity) is planned on
the driver. A window takes the longest piece left and the multiset of remaining lengths whose sum
comes closest to the rest: subset sums are bits of one integer, shifted by each length, and the
counts are read back along the stored integers. The window is repeated while the counts last, so the
plan is as long for a billion pieces as for a thousand. Pieces get their place by rank within their length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from loomtab.llm.chunks import chunk_encoder
from loomtab.llm.common import binaries, map_batches, schema_of, steps, stored, text_or_empty

CAPACITY = 1024


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """Multiset of lengths within ``counts`` whose sum is the largest that ``room`` holds."""
    mask = (1 << (room + 1)) - 1
    reach, trail = 1, []
    for length in sorted((c for c in counts if c <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            left -= take
            trail.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            take *= 2
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, {}
    for length, take, before in reversed(trail):
        if not before >> total & 1:
            total -= length * take
            out[length] = out.get(length, 0) + take
    return out


def plan_windows(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, end rank, pieces per window, offset in the window, first window)."""
    left = {n: c for n, c in counts.items() if c}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError(f"a piece must have 1 to {capacity} tokens")
    used = dict.fromkeys(left, 0)
    out, window = [], 0
    while left:
        longest = max(left)
        rest = {n: c - (n == longest) for n, c in left.items() if c > (n == longest)}
        chosen = best_fill(rest, capacity - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[n] // k for n, k in chosen.items())
        offset = 0
        for n in sorted(chosen, reverse=True):
            k = chosen[n]
            out.append((n, used[n], used[n] + k * times, k, offset, window))
            offset += n * k
            used[n] += k * times
            left[n] -= k * times
            if not left[n]:
                del left[n]
        window += times
    return out


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """All columns of ``pieces`` plus ``sequence_id`` (from 0, without gaps) and ``offset`` (gapless within a sequence).

    Every row is placed once, repeated rows too. Lengths must be 1 to ``capacity``; NULL or others raise ValueError.
    An empty table stays empty. The rows are written once with their task and their order in it, so a repeated
    task gives every row the same rank; a length that most rows share is ranked by task, never as one group.
    """
    spark = pieces.sparkSession
    names = pieces.columns
    own = pieces.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(length).cast("int").alias("length"),
                        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    own = stored(own, "pieces")
    counts = {r["length"]: r["count"] for r in own.groupBy("length").count().collect()}
    if None in counts:
        raise ValueError("a piece has no length")
    plan = spark.createDataFrame(plan_windows(counts, capacity), "length int, low long, high long, k long, place long, first long")
    before = own.groupBy("length", "part").count().select(
        "length", "part", (F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count")).alias("before"))
    ranked = own.withColumn("rank", F.row_number().over(Window.partitionBy("length", "part").orderBy("at")) - 1) \
        .join(before, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.join(F.broadcast(plan), ["length"]).where("rank >= low and rank < high")
    return placed.select("row.*", (F.col("first") + F.expr("(rank - low) div k")).alias("sequence_id"),
                         (F.col("place") + F.expr("(rank - low) % k") * F.col("length")).alias("offset"))


def token_pieces(df: DataFrame, tokenizer: str, end: int, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document: ``key``, start, length, ids_crc32, doc_tokens, ids (4 bytes each).

    NULL counts as the empty text, which still has the end id. Whole windows are cut first, the rest is the last piece.
    """
    schema = schema_of(df.select(key), "start long, length long, ids_crc32 long, doc_tokens long, ids binary")

    def run(batches):
        encoder = chunk_encoder(tokenizer)
        for batch in batches:
            column = batch.column(1)
            for a, b in steps(pa.compute.binary_length(column).to_pylist()):
                ids, bounds = encoder.encode(column.slice(a, b - a).to_pylist(), end)
                total = np.diff(bounds)
                count = -(-total // capacity)  # the end id leaves no text without a piece
                row = np.repeat(np.arange(a, b), count)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * capacity
                total = np.repeat(total, count)
                size = np.minimum(capacity, total - start)
                cuts = np.append(0, np.cumsum(size))
                data = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(data[4 * x:4 * y]) for x, y in zip(cuts.tolist(), cuts[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row))] + [pa.array(v, pa.int64()) for v in (start, size, crc, total)]
                                                 + [binaries(ids.astype("<u4"), cuts)], schema.names)

    return map_batches(df.select(key, text_or_empty(text).alias("_text")), run, schema, cached=True)
