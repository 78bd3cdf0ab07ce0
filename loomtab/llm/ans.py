"""Token ids in binary files: static range asymmetric numeral system over shared frequencies.

A folder holds ``frequencies`` (one row per used id, scaled to a power of two) and ``blocks``
(one row per block of whole documents). A block's ids are dealt to interleaved lanes, id ``t`` to
lane ``t % lanes``; all lanes share one stream of 32-bit words. Every ``every`` steps the lane
states and the word position are kept, so a reader can start there, and the ids and the
body have checksums. Blocks and checkpoints are decoded side by side.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomtab.llm.chunks import chunk_encoder
from loomtab.llm.common import binaries, map_batches, schema_of, steps, stored, text_or_empty

BITS = 20
LANES = 64
EVERY = 128
BLOCK_TOKENS = 32 * 1024
PARTITION_TOKENS = 4 << 20
LOW = np.uint64(1 << 31)
HEAD = "<4sBBHIIIIII"  # magic, version, bits, lanes, ids, every, checkpoints, words, checksum of ids, of body
MAGIC = b"rANS"


def scaled(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Frequencies that add to 2**bits, at least 1 for every id that occurs."""
    counts = counts.astype(np.float64)
    used = np.flatnonzero(counts)
    if len(used) > 1 << bits:
        raise ValueError(f"{len(used)} ids do not fit {bits} bits")
    out = np.zeros(len(counts), np.int64)
    if not len(used):
        return out
    out[used] = np.maximum(1, np.floor(counts[used] * ((1 << bits) / counts.sum()))).astype(np.int64)
    order = used[np.argsort(-out[used], kind="stable")]
    rest = (1 << bits) - int(out.sum())
    if rest > 0:
        out[order[0]] += rest
    for i in order:  # the many raised to 1 are taken from the most frequent
        if rest >= 0:
            break
        take = min(-rest, int(out[i]) // 2)
        out[i] -= take
        rest += take
    return out


def encode_blocks(blocks: list[np.ndarray], frequency: np.ndarray, bits: int = BITS) -> list[bytes]:
    n = np.array([len(b) for b in blocks])
    depth = max(1, -(-int(n.max()) // LANES))
    symbols = np.zeros((len(blocks), depth * LANES), np.int64)
    for row, block in zip(symbols, blocks):
        row[:len(block)] = block
    symbols = symbols.reshape(len(blocks), depth, LANES)
    active = (np.arange(depth * LANES) < n[:, None]).reshape(symbols.shape)
    freq = frequency.astype(np.uint64)
    below = (np.cumsum(frequency) - frequency).astype(np.uint64)
    x = np.full((len(blocks), LANES), LOW)
    words, owners, marks = [], [], {}
    made = np.zeros((depth + 1, len(blocks)), np.int64)
    for t in range(depth - 1, -1, -1):
        on = active[:, t]
        s = symbols[:, t]
        f = np.where(on, freq[s], np.uint64(1))
        over = on & ((x >> np.uint64(63 - bits)) >= f)
        owner = np.nonzero(over)[0]
        owners.append(owner)
        words.append(x[over].astype(np.uint32))
        made[t + 1] = np.bincount(owner, minlength=len(blocks))
        x[over] >>= np.uint64(32)
        q = x // f
        x = np.where(on, (q << np.uint64(bits)) + (x - q * f) + below[s], x)
        if t % EVERY == 0:
            marks[t] = x.copy()
    owners, words = np.concatenate(owners[::-1]), np.concatenate(words[::-1])
    words = words[np.argsort(owners, kind="stable")].astype("<u4")
    ends = np.cumsum(np.bincount(owners, minlength=len(blocks)))
    at = np.cumsum(made, axis=0)
    out = []
    for b, block in enumerate(blocks):
        mine = [t for t in sorted(marks) if t == 0 or t * LANES < len(block)]
        body = np.array([at[t, b] for t in mine], "<u4").tobytes() + np.stack([marks[t][b] for t in mine]).astype("<u8").tobytes()
        body += words[ends[b - 1] if b else 0:ends[b]].tobytes()
        out.append(struct.pack(HEAD, MAGIC, 1, bits, LANES, len(block), EVERY, len(mine), int(ends[b] - (ends[b - 1] if b else 0)),
                             zlib.crc32(block.astype("<u4").tobytes()), zlib.crc32(body)) + body)
    return out


def decode_blocks(payloads: list[bytes], frequency: np.ndarray) -> list[np.ndarray]:
    """The ids of each block; a wrong checksum or header raises ValueError."""
    below = np.cumsum(frequency) - frequency
    heads, bodies, base, states, sizes, starts = [], [], 0, [], [], []
    for payload in payloads:
        head = struct.unpack_from(HEAD, payload)
        magic, version, bits, lanes, n, every, marks, count, _, check = head
        body = payload[struct.calcsize(HEAD):]
        if magic != MAGIC or version != 1 or zlib.crc32(body) != check or len(body) != marks * (4 + 8 * lanes) + 4 * count:
            raise ValueError("damaged block")
        if lanes != LANES or every != EVERY or 1 << bits != int(frequency.sum()):
            raise ValueError("block and frequencies do not belong together")
        heads.append(head)
        starts.append(base + np.frombuffer(body, "<u4", marks).astype(np.int64))
        states.append(np.frombuffer(body, "<u8", marks * lanes, 4 * marks).reshape(marks, lanes))
        bodies.append(np.frombuffer(body, "<u4", count, marks * (4 + 8 * lanes)))
        base += count
        sizes.append(np.clip(n - np.arange(marks) * every * lanes, 0, every * lanes))
    bits = heads[0][2]
    slots = np.repeat(np.arange(len(frequency)), frequency)
    words = np.append(np.concatenate(bodies), np.zeros(1, np.uint32)).astype(np.uint64)
    x, at, size = np.concatenate(states).astype(np.uint64), np.concatenate(starts), np.concatenate(sizes)
    freq, below = frequency.astype(np.uint64), below.astype(np.uint64)
    out = np.zeros((len(x), EVERY * LANES), np.uint32)
    lane = np.arange(LANES)
    low = np.uint64((1 << bits) - 1)
    for t in range(-(-int(size.max()) // LANES)):
        on = t * LANES + lane < size[:, None]
        slot = x & low
        s = slots[slot.astype(np.int64)]
        out[:, t * LANES:(t + 1) * LANES] = s
        x = np.where(on, freq[s] * (x >> np.uint64(bits)) + slot - below[s], x)
        need = on & (x < LOW)
        place = np.cumsum(need, axis=1)
        got = words[np.where(need, at[:, None] + place - 1, len(words) - 1)]
        x = np.where(need, (x << np.uint64(32)) | got, x)
        at += place[:, -1]
    result, row = [], 0
    for head in heads:
        ids = out[row:row + head[6]].reshape(-1)[:head[4]]
        row += head[6]
        if zlib.crc32(ids.astype("<u4").tobytes()) != head[8]:
            raise ValueError("damaged ids")
        result.append(ids)
    return result


def token_table(df: DataFrame, tokenizer: str, end: int | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens`` and ``ids`` (little-endian, 2 or 4 bytes each) of whole texts; NULL counts as empty."""
    schema = schema_of(df.select(key), "n_tokens long, ids binary")

    def run(batches):
        encoder = chunk_encoder(tokenizer)
        wide = "<u2" if encoder.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        for batch in batches:
            column = batch.column(1)
            for a, b in steps(pa.compute.binary_length(column).to_pylist()):
                ids, bounds = encoder.encode(column.slice(a, b - a).to_pylist(), end)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(bounds), pa.int64()),
                                                  binaries(ids.astype(wide), bounds)], [key, "n_tokens", "ids"])

    return map_batches(df.select(key, text_or_empty(text).alias("_text")), run, schema, cached=True)


def _unpack(binary, count: int) -> np.ndarray:
    return np.frombuffer(binary, "<u2" if len(binary) == 2 * count else "<u4")


def id_counts(tokens: DataFrame) -> DataFrame:
    """``id`` and ``count`` over all documents, counted inside the tasks first."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                ids = np.concatenate([_unpack(b, n) for n, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())])
                found = np.bincount(ids, minlength=len(total))
                found[:len(total)] += total
                total = found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "count"])

    return map_batches(tokens.select("n_tokens", "ids"), run, "id long, count long", cached=True).groupBy("id").agg(F.sum("count").alias("count"))


def write_tokens(tokens: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write a token table (``key``, ``n_tokens``, ``ids``) in ascending ``key`` order, NULL first.

    Equal keys are ordered by the checksum of their ids, so only equal rows are interchangeable and a repeated
    task writes the same file. A document never leaves its block. An empty table makes an empty folder of blocks.
    The frequency table has at most one row per id of the vocabulary; it alone passes the driver.
    """
    spark = tokens.sparkSession
    counts = id_counts(tokens).collect()
    table = np.zeros(max([r["id"] for r in counts], default=0) + 1, np.int64)
    for r in counts:
        table[r["id"]] = r["count"]
    total = int(table.sum())
    frequency = scaled(table)
    spark.createDataFrame([(int(i), int(frequency[i])) for i in np.flatnonzero(frequency)], "id long, frequency long") \
        .coalesce(1).write.parquet(f"{path}/frequencies")
    parts = max(1, -(-total // PARTITION_TOKENS))
    ordered = tokens.select(key, F.crc32("ids").alias("_crc"), "n_tokens", "ids")
    ordered = ordered.repartitionByRange(parts, key, "_crc").sortWithinPartitions(key, "_crc").select(
        key, F.spark_partition_id().alias("part"), "n_tokens", "ids")
    schema = schema_of(tokens.select(F.array(key).alias("docs")), "part int, block int, start long, tokens array<long>, payload binary")

    def run(batches):
        docs, ids, sizes, held, block, start = [], [], [], 0, 0, 0

        def flush():
            nonlocal docs, ids, sizes, held, block, start
            cuts = list(steps(sizes, BLOCK_TOKENS))
            payloads = encode_blocks([np.concatenate(ids[a:b]) for a, b in cuts], frequency)
            first = start + np.append(0, np.cumsum(sizes))
            out = pa.RecordBatch.from_arrays([
                pa.array([docs[a:b] for a, b in cuts], schema_arrow), pa.array([part] * len(cuts), pa.int32()),
                pa.array(range(block, block + len(cuts)), pa.int32()), pa.array([int(first[a]) for a, _ in cuts], pa.int64()),
                pa.array([sizes[a:b] for a, b in cuts], pa.list_(pa.int64())), pa.array(payloads, pa.binary())], schema.names)
            block, start = block + len(cuts), int(first[-1])
            docs, ids, sizes, held = [], [], [], 0
            return out

        for batch in batches:
            schema_arrow = pa.list_(batch.schema.field(0).type)
            for doc, part, n, b in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (held + n > 32 * BLOCK_TOKENS or n > 4 * BLOCK_TOKENS):
                    yield flush()
                docs.append(doc)
                ids.append(_unpack(b, n))
                sizes.append(n)
                held += n
                if n > 4 * BLOCK_TOKENS:
                    yield flush()
        if ids:
            yield flush()

    map_batches(ordered, run, schema, cached=True).write.option("compression", "none").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the folder: its key, ``start`` (ids before it), ``n_tokens``, ``ids`` (little-endian, 4 bytes each)."""
    blocks = spark.read.parquet(f"{path}/blocks")
    frequencies = {r["id"]: r["frequency"] for r in spark.read.parquet(f"{path}/frequencies").collect()}
    frequency = np.zeros(max(frequencies, default=0) + 1, np.int64)
    for i, f in frequencies.items():
        frequency[i] = f
    # One number per written file part: the ids in it. The ids before a part follow from them.
    sums = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum(F.expr("aggregate(tokens, 0L, (a, x) -> a + x)")).alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(sums):
        before[part] = total
        total += sums[part]

    def run(batches):
        for batch in batches:
            docs, part, start, tokens, payload = (batch.column(i) for i in range(5))
            parts, starts = part.to_pylist(), start.to_pylist()
            for a, b in steps([sum(t) for t in tokens.to_pylist()], 32 * BLOCK_TOKENS):
                decoded = decode_blocks(payload.slice(a, b - a).to_pylist(), frequency)
                sizes = tokens.slice(a, b - a).to_pylist()
                flat = [n for t in sizes for n in t]
                first = [s for i, t in enumerate(sizes) for s in (before[parts[a + i]] + starts[a + i] + np.append(0, np.cumsum(t)[:-1])).tolist()]
                cut = [c for ids, t in zip(decoded, sizes) for c in np.split(ids, np.cumsum(t)[:-1])]
                yield pa.RecordBatch.from_arrays([docs.slice(a, b - a).flatten(), pa.array(first, pa.int64()), pa.array(flat, pa.int64()),
                                                  pa.array([c.astype("<u4").tobytes() for c in cut], pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    schema = schema_of(blocks.select(F.col("docs")[0].alias("doc_id")), "start long, n_tokens long, ids binary")
    return map_batches(blocks.select("docs", "part", "start", "tokens", "payload"), run, schema, cached=True)


def token_files(df: DataFrame, path: str, tokenizer: str, end: int | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode all texts, write them to ``path`` and return what the written files hold."""
    write_tokens(stored(token_table(df, tokenizer, end, key, text), "ids"), path, key)
    return read_tokens(df.sparkSession, path)
