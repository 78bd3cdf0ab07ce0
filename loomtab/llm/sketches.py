"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A paragraph is a line's sentence, cut again after ``WORDS`` words; its digest also counts how often the same
paragraph stood before it in the text. A sketch adds each digest to one cell of each of three tables: a
count, the exclusive or of the digests, the exclusive or of their checks. Subtracting two sketches leaves the
digests in which the texts differ; cells with one of them are peeled until none is left. Where peeling
gets stuck the two sketches are made again with four times the cells. All texts of a batch are sketched together.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loomtab.llm.common import map_batches, schema_of, steps, text_or_empty
from loomtab.llm.hashing import mixed, slice_hashes

CELLS = 24
TABLES = 3
WORDS = 16
PART_BYTES = 32 << 20


def byte_kinds() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(b" \t\n\x0b\x0c\r")] = 1
    out[list(b".!?")] = 2
    return out


def digests(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Digest of every paragraph of every text, and the text it belongs to."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    kind = byte_kinds()[data]
    space = kind == 1
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    ends = np.flatnonzero(~space & np.append(space[1:], True)) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lines = np.append(0, np.cumsum(data == 10))
    opens = np.append(True, (lines[starts[1:]] > lines[ends[:-1]]) | (kind[ends[:-1] - 1] == 2))
    since = np.arange(len(starts)) - np.maximum.accumulate(np.where(opens, np.arange(len(starts)), 0))
    first = np.flatnonzero(since % WORDS == 0)
    a, b = starts[first], ends[np.append(first[1:], len(starts)) - 1]
    bounds = np.append(0, np.cumsum([len(t) + 1 for t in texts]))
    owner = np.searchsorted(bounds, a, "right") - 1
    digest = slice_hashes(data, a, b)
    order = np.lexsort((digest, owner))
    d, o = digest[order], owner[order]
    new = np.append(True, (d[1:] != d[:-1]) | (o[1:] != o[:-1]))
    place = np.arange(len(d))
    times = place - np.maximum.accumulate(np.where(new, place, 0))
    return mixed(d + times.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), o


class Sketch:
    """Cells of many documents side by side."""

    def __init__(self, documents: int, cells: int):
        self.cells = cells
        self.count = np.zeros(documents * cells, np.int64)
        self.key = np.zeros(documents * cells, np.uint64)
        self.check = np.zeros(documents * cells, np.uint64)

    def places(self, digest: np.ndarray, document: np.ndarray) -> np.ndarray:
        each = self.cells // TABLES
        return np.stack([document * self.cells + t * each + (mixed(digest + np.uint64(t + 1)) % np.uint64(each)).astype(np.int64) for t in range(TABLES)])

    def add(self, digest: np.ndarray, document: np.ndarray, sign) -> None:
        check = checks(digest)
        for at in self.places(digest, document):
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, digest)
            np.bitwise_xor.at(self.check, at, check)

    def minus(self, other: Sketch) -> Sketch:
        out = Sketch(0, self.cells)
        out.count, out.key, out.check = self.count - other.count, self.key ^ other.key, self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Digests, their documents and sides (1 or -1) recovered, and by document whether nothing is left over."""
        found = []
        while True:
            pure = np.flatnonzero((np.abs(self.count) == 1) & (checks(self.key) == self.check))
            if not len(pure):
                break
            digest, document, sign = self.key[pure], pure // self.cells, self.count[pure]
            order = np.lexsort((digest, document))
            digest, document, sign = digest[order], document[order], sign[order]
            new = np.append(True, (digest[1:] != digest[:-1]) | (document[1:] != document[:-1]))
            digest, document, sign = digest[new], document[new], sign[new]
            found.append((digest, document, sign))
            self.add(digest, document, -sign)
        done = ~(self.count.reshape(-1, self.cells).any(axis=1) | self.key.reshape(-1, self.cells).any(axis=1))
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), done
        return *(np.concatenate(c) for c in zip(*found)), done

    def hex(self) -> list[str]:
        cell = np.dtype([("count", ">u4"), ("key", ">u8"), ("check", ">u4")])
        out = np.empty(len(self.count), cell)
        out["count"], out["key"], out["check"] = self.count, self.key, self.check
        raw, size = out.tobytes(), cell.itemsize * self.cells
        return [raw[i:i + size].hex() for i in range(0, len(raw), size)]


def checks(digest: np.ndarray) -> np.ndarray:
    return mixed(digest ^ np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)


def sketch(digest: np.ndarray, document: np.ndarray, documents: int, cells: int = CELLS) -> Sketch:
    out = Sketch(documents, cells)
    out.add(digest, document, 1)
    return out


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], documents: int) -> np.ndarray:
    """Paragraphs in both texts over those in either, from the digests that peeling recovers; two without any are alike."""
    sizes = [np.bincount(o, minlength=documents) for _, o in (a, b)]
    differing, left, cells = np.zeros(documents, np.int64), np.arange(documents), CELLS
    while len(left):
        number = np.full(documents, -1)
        number[left] = np.arange(len(left))
        sides = [(d[number[o] >= 0], number[o[number[o] >= 0]]) for d, o in (a, b)]
        difference = sketch(*sides[0], len(left), cells).minus(sketch(*sides[1], len(left), cells))
        _, document, _, done = difference.peel()
        recovered = np.bincount(document, minlength=len(left))
        differing[left[done]] = recovered[done]
        left, cells = left[~done], cells * 4
    total = sizes[0] + sizes[1]
    return np.where(total == 0, 1.0, (total - differing) / np.maximum(total + differing, 1))


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """Number of bounds below ``key``: only the key goes to Python, and no objects are made for each comparison."""
    if not bounds:
        return F.lit(0)
    ends = np.array(bounds, np.int64)

    def find(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(ends, keys.to_numpy()).astype(np.int32))

    return F.pandas_udf(find, "int")(key)


def with_neighbour(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows dealt to ranges of keys and sorted there, with the row before each range in front of it (``halo``)."""
    own = df.select(F.col(key).alias("id"), F.coalesce(F.col(key).cast("long"), F.lit(-2**63)).alias("at"), text_or_empty(text).alias("text"))
    own = own.withColumn("digest", F.xxhash64("text"))
    size = df.agg(F.sum(F.octet_length(text_or_empty(text)))).first()[0] or 0
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    parts = 4 * tasks  # several ranges to a task even out what hashing their numbers deals unevenly
    cuts = own.agg(F.percentile_approx("at", [i / parts for i in range(1, parts)], 100 * parts)).first()[0] if parts > 1 else []
    bounds = sorted(set(cuts or []))
    own = own.withColumn("part", bucket_of(F.col("at"), bounds))
    # One row per range: its last key, and the range that comes after it.
    last = {r["part"]: (r["edge"]["at"], r["edge"]["digest"]) for r in own.groupBy("part").agg(F.max(F.struct("at", "digest")).alias("edge")).collect()}
    filled = sorted(last)
    after = dict(zip(filled, filled[1:] + filled[:1]))
    n = len(bounds) + 1
    at = F.lit([last.get(p, (0, 0))[0] for p in range(n)]).cast("array<bigint>")
    digest = F.lit([last.get(p, (0, 0))[1] for p in range(n)]).cast("array<bigint>")
    follows = F.lit([after.get(p, p) for p in range(n)]).cast("array<int>")
    mine = F.col("part") + 1
    edge = (F.col("at") == F.element_at(at, mine)) & (F.col("digest") == F.element_at(digest, mine))
    dealt = own.withColumn("to", F.explode(F.when(edge, F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("halo")),
                                                               F.struct(F.element_at(follows, mine).alias("part"), F.lit(True).alias("halo"))))
                                           .otherwise(F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("halo"))))))
    dealt = dealt.select("id", "at", "digest", "text", F.col("to.part").alias("part"), F.col("to.halo").alias("halo"))
    return dealt.repartition(tasks, "part").sortWithinPartitions("part", F.desc("halo"), "at", "digest").select("id", "part", "halo", "text")


def edited(text: str, following: str) -> str:
    """The last third of ``text`` gives way to as many characters from the start of ``following``."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


def edit_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next`` per row.

    The next document is the one before in ascending key order (the smallest is followed by the largest, a single one by
    itself); rows of one key are ordered by the hash of their text. A NULL key is smaller than all others, a NULL text
    counts as empty. Two texts without a word are alike (1.0), one with and one without are not (0.0). Repeated rows
    stay repeated. An empty table gives an empty one. Other columns are not read.
    """
    schema = schema_of(df.select(key), "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")

    def run(batches):
        part, before = None, ""
        for batch in batches:
            ids, parts, halos, texts = batch.columns
            for a, b in steps(pa.compute.binary_length(texts).to_pylist()):
                rows, own, changed, follows = [], [], [], []
                for i, p, halo, t in zip(range(a, b), parts.slice(a, b - a).to_pylist(), halos.slice(a, b - a).to_pylist(), texts.slice(a, b - a).to_pylist()):
                    if p != part and not halo:
                        raise AssertionError("a range starts without the row before it")
                    if not halo:
                        rows.append(i)
                        own.append(t)
                        changed.append(edited(t, before))
                        follows.append(before)
                    part, before = p, t
                if not rows:
                    continue
                n = len(rows)
                sides = [digests([t.encode() for t in column]) for column in (own, changed, follows)]
                prints = [sketch(*side, n).hex() for side in sides[:2]]
                sums = [hashlib.sha256(t.encode()).hexdigest() for t in changed]
                columns = [pa.array([len(t) for t in own], pa.int64()), pa.array(sums), *map(pa.array, prints),
                           pa.array(likeness(sides[0], sides[1], n)), pa.array(likeness(sides[0], sides[2], n))]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), *columns], schema.names)

    return map_batches(with_neighbour(df, key, text), run, schema)
