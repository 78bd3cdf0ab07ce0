"""Quality classifier: ordinal regression with cumulative links over hashed text features.

All grades share one weight per hashed feature and have ordered thresholds of their own:
``P(grade >= k) = sigmoid(score - threshold_k)``. Features are the words of a text, their first bytes and a
few coarse measures of the whole text; each counts once however often it stands there. The model is fitted by
accelerated proximal gradient steps with an absolute-value penalty, so words that say nothing weigh nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomtab.llm.common import map_batches, schema_of, steps, text_or_empty
from loomtab.llm.hashing import mixed, slice_hashes

BITS = 18
PREFIXES = (4, 6)
GRADES = 3
RATED = 12_000
"""Rated documents that the model is fitted on at most; which ones follows from a hash of their key."""
ROUNDS = 200
PENALTY = 1e-5
MIN_DOCUMENTS = 3
FIT_STEP = 400_000


def byte_kinds() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(b"abcdefghijklmnopqrstuvwxyz")] = 1
    out[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 3
    out[128:] = 1
    out[list(b" \t\n\x0b\x0c\r")] = 4
    return out


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts one after another, ascending and once per text, and the count before each text."""
    whole = b"\n".join([*texts, b""])
    data = np.frombuffer(whole.lower(), np.uint8)
    kind = byte_kinds()[np.frombuffer(whole, np.uint8)]
    bounds = np.append(0, np.cumsum([len(t) + 1 for t in texts]))
    letter = (kind & 1) == 1
    starts = np.flatnonzero(letter & np.append(True, ~letter[:-1]))
    ends = np.flatnonzero(letter & np.append(~letter[1:], True)) + 1
    owner = np.searchsorted(bounds, starts, "right") - 1
    found, owners = [], []
    for number, size in enumerate((None, *PREFIXES)):
        stop = ends if size is None else np.minimum(ends, starts + size)
        use = np.arange(len(starts)) if size is None else np.flatnonzero(ends - starts > size)
        found.append(mixed(slice_hashes(data, starts[use], stop[use]) + np.uint64(number)) >> np.uint64(64 - BITS))
        owners.append(owner[use])
    word = found[0]
    n = len(texts)
    size = np.maximum(np.diff(bounds) - 1, 1)
    words = np.bincount(owner, minlength=n)
    distinct = np.bincount(np.unique(owner * (1 << BITS) + word.astype(np.int64)) >> BITS, minlength=n)

    def share(where: np.ndarray) -> np.ndarray:
        return np.add.reduceat(np.append(where, 0), bounds[:-1])[:n] / size

    repeated = np.append(False, (word[1:] == word[:-1]) & (owner[1:] == owner[:-1]))
    measures = [share(kind == 3), share((kind & 5) == 0), distinct / np.maximum(words, 1), np.bincount(owner, repeated, n) / np.maximum(words, 1),
                np.minimum(np.log2(words + 1) / 16, 1), np.minimum(np.bincount(owner, ends - starts, n) / np.maximum(words, 1) / 16, 1)]
    for number, value in enumerate(measures):
        found.append(mixed((np.round(value * 20) + 100 * (number + 1)).astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(64 - BITS))
        owners.append(np.arange(n))
    pairs = np.unique((np.concatenate(owners).astype(np.int64) << BITS) | np.concatenate(found).astype(np.int64))
    return (pairs & ((1 << BITS) - 1)).astype(np.int32), np.append(0, np.cumsum(np.bincount(pairs >> BITS, minlength=n)))


def scores(weights: np.ndarray, numbers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    count = np.diff(bounds)
    row = np.repeat(np.arange(len(count)), count)
    return np.bincount(row, weights[numbers], len(count)) / np.sqrt(np.maximum(count, 1))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def tails(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k = 1, 2, ... by row."""
    return sigmoid(score[:, None] - thresholds[None, :])


def fit(numbers: np.ndarray, bounds: np.ndarray, grade: np.ndarray, grades: int, rounds: int = ROUNDS, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds; documents of rare grades weigh more, so that no grade is given up."""
    n, size = len(grade), 1 << BITS
    count = np.diff(bounds)
    scale = 1 / np.sqrt(np.maximum(count, 1))
    cuts = [(a, b, numbers[bounds[a]:bounds[b]], np.repeat(np.arange(b - a), count[a:b])) for a, b in steps(count, FIT_STEP)]

    def spread(value: np.ndarray) -> np.ndarray:
        """Sum over documents of a value for each of their features."""
        return sum(np.bincount(part, value[a:b][row], size) for a, b, part, row in cuts)

    usable = spread(np.ones(n)) >= MIN_DOCUMENTS
    # Rare features get longer steps: the curvature of a weight is bounded by how often it is seen.
    held = np.bincount(grade, minlength=grades)
    importance = np.sqrt(n / (grades * np.maximum(held, 1)))[grade]
    importance /= importance.mean()
    curvature = spread(importance * scale * np.sqrt(count)) * (grades - 1) / n * 0.25
    step = np.where(usable, 1 / np.maximum(curvature, 1e-9), 0)
    weights, thresholds = np.zeros(size), np.linspace(-1, 1, grades - 1)
    ahead, ahead_t, momentum = weights, thresholds, 1.0
    above = (grade[:, None] >= np.arange(1, grades)[None, :]).astype(np.float64)
    for _ in range(rounds):
        z = np.concatenate([np.bincount(row, ahead[part], b - a) for a, b, part, row in cuts]) * scale
        gap = (tails(z, ahead_t) - above) * importance[:, None] / n
        moved = ahead - step * spread(gap.sum(axis=1) * scale)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        new_t = np.sort(ahead_t + gap.sum(axis=0) * 2.0)
        faster = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        push = (momentum - 1) / faster
        if ((ahead - new) * (new - weights)).sum() > 0:  # the momentum points uphill: start it again
            faster, push = 1.0, 0.0
        ahead, ahead_t = new + push * (new - weights), np.sort(new_t + push * (new_t - thresholds))
        weights, thresholds, momentum = new, new_t, faster
    return weights, thresholds


def whole_scale(thresholds: np.ndarray, grade: np.ndarray, grades: int) -> np.ndarray:
    """One threshold for each grade above 0, whichever were rated: a grade above all rated ones is as likely as the highest of these, one that all reach is certain."""
    out = np.full(grades - 1, thresholds[-1])
    out[:len(thresholds)] = thresholds
    out[:grade.min()] = -100.0
    return out


def sample_grades(rated: DataFrame, key: str, grade: str, bound: int, grades: int = GRADES) -> DataFrame:
    """At most about ``bound`` keys and their grades, chosen by a hash of the key; of several grades for a key the lowest. Grades off the scale count as its ends."""
    on_scale = F.least(F.greatest(F.min(grade).cast("int"), F.lit(0)), F.lit(grades - 1))
    one = rated.where(F.col(key).isNotNull() & F.col(grade).isNotNull()).groupBy(F.col(key).alias("key")).agg(on_scale.alias("grade"))
    total = one.count()
    return one.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, bound / max(1, total))))


def train(df: DataFrame, rated: DataFrame, key: str = "doc_id", text: str = "text", grade: str = "grade", bound: int = RATED, grades: int = GRADES) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ``grades`` - 1 thresholds from rated documents; grades are 0, 1, ... The sample is fitted in one task, its size is bounded by ``bound``.

    Documents without a grade and grades without a document are left out. The number of thresholds is that of the scale, whichever
    grades were rated (``whole_scale``). Fewer than two different grades give no model: all weights 0 and thresholds that accept everything.
    """
    sample = sample_grades(rated, key, grade, bound, grades)
    rows = df.select(F.col(key).alias("key"), text_or_empty(text).alias("text")).join(F.broadcast(sample), "key").select("key", "grade", "text")

    def extract(batches):
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for a, b in steps(pa.compute.binary_length(texts).to_pylist()):
                numbers, bounds = features(texts.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                                                  pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(numbers, pa.int32()))], ["key", "grade", "numbers"])

    def solve(table: pa.Table) -> pa.Table:
        lists = table["numbers"].combine_chunks()
        order = sorted(range(table.num_rows), key=lambda i: table["key"][i].as_py())
        lists = lists.take(pa.array(order))
        rating = table["grade"].to_numpy()[order]
        if len(np.unique(rating)) < 2:
            weights, thresholds = np.zeros(1 << BITS), np.full(grades - 1, -100.0)
        else:
            weights, thresholds = fit(lists.flatten().to_numpy(), np.append(0, np.cumsum(pa.compute.list_value_length(lists).to_numpy())), rating, int(rating.max()) + 1)
            thresholds = whole_scale(thresholds, rating, grades)
        used = np.flatnonzero(weights)
        return pa.table({"numbers": pa.array([used.tolist()], pa.list_(pa.int32())), "weights": pa.array([weights[used].tolist()], pa.list_(pa.float64())),
                         "thresholds": pa.array([thresholds.tolist()], pa.list_(pa.float64()))})

    found = map_batches(rows, extract, schema_of(rows.select("key", "grade"), "numbers array<int>")).groupBy(F.lit(0).alias("all")).applyInArrow(
        solve, "numbers array<int>, weights array<double>, thresholds array<double>").collect()
    weights = np.zeros(1 << BITS)
    if not found:
        return weights, np.full(grades - 1, -100.0)
    weights[found[0]["numbers"]] = found[0]["weights"]
    return weights, np.array(found[0]["thresholds"])


def grade_documents(df: DataFrame, model: tuple[np.ndarray, np.ndarray], text: str = "text") -> DataFrame:
    """All columns of ``df`` as ``row``, with ``expected_grade`` and ``tails``: P(grade >= 1), P(grade >= 2), ...

    A NULL text counts as empty; it has the features of an empty text and is graded like any other. Repeated rows are
    graded alike. The model (a few thousand weights) goes to the tasks with the code. An empty table gives an empty one.
    """
    weights, thresholds = model
    used = np.flatnonzero(weights).astype(np.int32)
    values = weights[used]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    place = df.columns.index(text)

    def run(batches):
        table = np.zeros(1 << BITS)
        table[used] = values
        for batch in batches:
            texts = pa.compute.fill_null(pa.compute.struct_field(batch.column(0), [place]), "").cast(pa.binary())
            for a, b in steps(pa.compute.binary_length(texts).to_pylist()):
                p = tails(scores(table, *features(texts.slice(a, b - a).to_pylist())), thresholds)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(p.sum(axis=1)), pa.array(p.tolist(), pa.list_(pa.float64()))],
                                                 ["row", "expected_grade", "tails"])

    return map_batches(rows, run, schema_of(rows.select("row"), "expected_grade double, tails array<double>"))


def ratings(labels: DataFrame) -> DataFrame:
    """Grade 0 to 2 of labelled documents: one point for quality, one for not being toxic."""
    return labels.select("doc_id", (F.col("quality") + 1 - F.col("toxic")).alias("grade"))
