"""Global alignment of many pairs of sequences at once, and pairs of sequences that are alike.

Pairs of one length class stand in one array. The table of scores is filled along anti-diagonals, whose cells depend on the two
diagonals before only, so a step is a handful of array operations for all cells and all pairs, and three diagonals are held. Matches and length of
the chosen path are carried beside the score, so nothing is traced back.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from loomtab.operators.ordered import keyed_join
from loomtab.session import written

MATCH, MISMATCH, GAP = 2, -1, -2
CLASS = 64
"""Lengths are rounded up to a multiple of this one."""
CELLS = 1 << 21
"""Cells of one diagonal over all pairs, at most about."""


def aligned(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Matches and length of the best alignment of each row of ``x`` (its first ``n`` signs) with the row of ``y`` (``m`` signs).

    At equal scores a pair goes before a gap in ``y``, and that before a gap in ``x``, seen from the end.
    """
    pairs, rows, columns = len(x), x.shape[1], y.shape[1]
    shape = (pairs, rows + 1)
    low = np.int32(-(1 << 28))
    before = [np.full(shape, low), np.zeros(shape, np.int32), np.zeros(shape, np.int32)]
    last = [a.copy() for a in before]
    last[0][:, 0] = 0
    hits, width = np.zeros(pairs, np.int32), np.zeros(pairs, np.int32)
    backwards = np.ascontiguousarray(y[:, ::-1])
    total = n + m
    for d in range(1, rows + columns + 1):
        first, stop = max(0, d - columns), min(rows, d) + 1  # rows i of the cells (i, d - i)
        now = [np.full(shape, low), np.zeros(shape, np.int32), np.zeros(shape, np.int32)]
        here = slice(first, stop)
        left = last[0][:, here] + GAP  # a gap in x
        inner = slice(max(first, 1), stop)
        above = slice(inner.start - 1, stop - 1)
        down = last[0][:, above] + GAP
        # Row i meets sign d - i of y; the corner cells have no pair.
        a, b = max(first, 1), min(stop - 1, d - 1) + 1
        same = x[:, a - 1:b - 1] == backwards[:, columns - d + a:columns - d + b]
        paired = np.full((pairs, stop - inner.start), low)
        met = np.zeros(paired.shape, np.int32)
        paired[:, a - inner.start:b - inner.start] = before[0][:, a - 1:b - 1] + np.where(same, np.int32(MATCH), np.int32(MISMATCH))
        met[:, a - inner.start:b - inner.start] = same
        now[0][:, here], now[1][:, here], now[2][:, here] = left, last[1][:, here], last[2][:, here] + 1
        best = np.maximum(np.maximum(paired, down), now[0][:, inner])
        by_pair, by_down = paired == best, down == best
        now[1][:, inner] = np.where(by_pair, before[1][:, above] + met, np.where(by_down, last[1][:, above], now[1][:, inner]))
        now[2][:, inner] = np.where(by_pair, before[2][:, above], np.where(by_down, last[2][:, above], now[2][:, inner] - 1)) + 1
        now[0][:, inner] = best
        ends = np.flatnonzero(total == d)
        hits[ends], width[ends] = now[1][ends, n[ends]], now[2][ends, n[ends]]
        before, last = last, now
    return hits, width


def identities(left: Sequence[str | None], right: Sequence[str | None]) -> np.ndarray:
    """Matches over the length of the best global alignment of each pair; 0 if one is empty or NULL."""
    sides = [[np.frombuffer((s or "").encode("utf-32-le"), np.uint32) for s in side] for side in (left, right)]
    sizes = np.array([[len(s) for s in side] for side in sides]).reshape(2, -1)
    out = np.zeros(sizes.shape[1])
    classes = -(-sizes // CLASS) * CLASS
    use = np.flatnonzero(sizes.min(axis=0) > 0)
    for rows, columns in np.unique(classes[:, use], axis=1).T.tolist():
        own = use[(classes[0, use] == rows) & (classes[1, use] == columns)]
        step = max(1, CELLS // (rows + 1))
        for s in range(0, len(own), step):
            part = own[s:s + step]
            x, y = np.zeros((len(part), rows), np.uint32), np.zeros((len(part), columns), np.uint32)
            for table, side in ((x, sides[0]), (y, sides[1])):
                held = np.concatenate([side[i] for i in part])
                size = np.array([len(side[i]) for i in part])
                table[np.repeat(np.arange(len(part)), size), np.arange(len(held)) - np.repeat(np.cumsum(size) - size, size)] = held
            hits, width = aligned(x, y, sizes[0, part], sizes[1, part])
            out[part] = hits / width
    return out


def may_reach(left: Sequence[str], right: Sequence[str], loss: float, size: int) -> np.ndarray:
    """False for pairs with too few runs of ``size`` signs in common to lose at most ``loss`` times the shorter length."""
    sizes = np.array([[len(s) for s in side] for side in (left, right)]).reshape(2, -1)
    seen = []
    for side, lengths in zip((left, right), sizes):
        signs = np.frombuffer("".join(side).encode("utf-32-le"), np.uint32).astype(np.uint64)
        code = np.zeros(max(0, len(signs) - size + 1), np.uint64)
        for i in range(size):  # two runs that wrap to one number only count as one more in common
            code = code * np.uint64(0x9E3779B97F4A7C15) + signs[i:len(signs) - size + 1 + i]
        ends = np.cumsum(lengths)
        pair = np.repeat(np.arange(len(lengths)), lengths)[:len(code)]
        whole = np.arange(len(code)) + size <= ends[pair]
        pair, code = pair[whole], code[whole]
        order = np.lexsort((code, pair))
        pair, code = pair[order], code[order]
        new = np.append(True, (pair[1:] != pair[:-1]) | (code[1:] != code[:-1]))[:len(pair)]
        place = np.arange(len(pair))
        seen.append(np.rec.fromarrays([pair, code, place - np.maximum.accumulate(np.where(new, place, 0))], names="pair,code,number"))
    both = np.concatenate(seen)
    both = both[np.lexsort((both["number"], both["code"], both["pair"]))]
    shared = np.bincount(both["pair"][1:][both[1:] == both[:-1]], minlength=sizes.shape[1])
    return shared >= sizes.max(axis=0) - size + 1 - np.floor(sizes.min(axis=0) * loss * size + 1e-9)


def pair_identities(sequences: DataFrame, pairs: DataFrame, key: str, seq: str, runs: tuple[float, int] | None = None) -> DataFrame:
    """(a, b, identity) for the listed pairs of keys; pairs are spread evenly over tasks. With ``runs`` (the share that may be lost, length of
    a run) pairs that cannot be that alike have identity 0."""
    left = sequences.select(F.col(key).alias("a"), F.col(seq).alias("_x"))
    right = sequences.select(F.col(key).alias("b"), F.col(seq).alias("_y"))

    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        out = np.zeros(len(x))
        chosen = np.flatnonzero(may_reach(x.tolist(), y.tolist(), *runs)) if runs else np.arange(len(x))
        out[chosen] = identities(x.iloc[chosen].tolist(), y.iloc[chosen].tolist())
        return pd.Series(out)

    return pairs.join(left, "a").join(right, "b").select("a", "b", F.pandas_udf(score, "double")("_x", "_y").alias("identity"))


def block_identities(sequences: DataFrame, key: str, seq: str, by: str) -> DataFrame:
    """(a, b, identity), a < b, for all pairs of rows with equal ``by``: blocks are meant to be small, their pairs are what is asked for."""
    keys = sequences.select(F.col(key).alias("a"), F.col(by).alias("_by"))
    pairs = keys.join(keys.select(F.col("a").alias("b"), F.col("_by").alias("_of")), (F.col("_by") == F.col("_of")) & (F.col("a") < F.col("b"))).select("a", "b")
    return pair_identities(sequences, pairs, key, seq)


def alike(sequences: DataFrame, key: str, seq: str, threshold: float, size: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(a, b, identity), a < b, of all pairs of different sequences at or above ``threshold``, and (key, a) of every row: the smallest key of its equals.

    With identity t or more, at most e = (1 - t) / t times the shorter length of an alignment are no matches, each of which can
    spoil ``size`` runs of ``size`` signs. So of the longer one's L - size + 1 runs all but size * e are shared, lengths differ by at most e,
    and two such sequences share one of the size * e + 1 rarest runs of each: they meet on those only, and are aligned if enough runs
    are shared. Where that bound proves nothing
    (short sequences), a sequence meets all others of a fitting length by its length. ``size`` follows from the threshold: e of a
    sequence may spoil about six tenths of its runs. Empty and NULL sequences are alike to none.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    if size is None:
        size = max(1, min(8, int(0.6 * threshold / max(1 - threshold, 1e-9))))
    rows = sequences.select(F.col(key).alias("key"), F.col(seq).alias("s"))
    folded = written(rows.where("length(s) > 0").groupBy("s").agg(F.min("key").alias("a")).select("a", "s", F.length("s").alias("n")), "sequences")
    loss = (1 - threshold) / threshold
    # Runs are numbered within a sequence, so that repeats count.
    starts = F.sequence(F.lit(1), F.col("n") - size + 1)
    runs = folded.where(F.col("n") >= size).select("a", "n", F.explode(F.transform(starts, lambda i: F.substring("s", i, F.lit(size)))).alias("run")) \
        .groupBy("a", "n", "run").agg(F.count(F.lit(1)).alias("times")).select("a", "n", "run", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("number"))
    runs = written(runs, "runs")
    common = runs.groupBy("run", "number").agg(F.count(F.lit(1)).alias("f"))
    # A sequence may be the longer one, at most 1 + loss times the shorter, or the shorter one itself.
    spoiled = F.floor(F.col("n") * loss * size + 1e-9).cast("int")
    proved = F.col("n") - size + 1 - spoiled > 0
    heads = (keyed_join(runs, common, ["run", "number"]).where(proved & (F.col("f") > 1)).groupBy("a", "n")
             .agg(F.array_sort(F.collect_list(F.struct("f", "run", "number"))).alias("o"), F.count(F.lit(1)).alias("held")))
    alone = runs.groupBy("a").agg(F.count(F.lit(1)).alias("all"))
    # Runs that no other sequence has stand before all others in the order and use up places.
    heads = heads.join(alone, "a").select("a", "n", F.explode(F.slice("o", F.lit(1), F.greatest(F.lit(0), spoiled + 1 - (F.col("all") - F.col("held")).cast("int")))).alias("x"))
    heads = heads.select("a", "n", F.col("x.run").alias("run"), F.col("x.number").alias("number"))
    other = heads.select(F.col("a").alias("b"), F.col("n").alias("m"), F.col("run").alias("_run"), F.col("number").alias("_number"))
    fits = (F.greatest("n", "m") - F.least("n", "m") <= F.least("n", "m") * loss + 1e-9) & (F.col("a") < F.col("b"))
    by_run = heads.join(other, (F.col("run") == F.col("_run")) & (F.col("number") == F.col("_number")) & fits).select("a", "b")
    short = folded.select("a", "n").where(~proved)
    lengths = F.sequence(F.greatest(F.lit(1), F.ceil(F.col("n") / (1 + loss) - 1e-9).cast("int")), F.floor(F.col("n") * (1 + loss) + 1e-9).cast("int"))
    by_length = short.withColumn("m", F.explode(lengths)).join(folded.select(F.col("a").alias("b"), F.col("n").alias("m")), "m").where("a <> b") \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = by_run.unionByName(by_length).distinct()
    found = pair_identities(folded.select("a", "s"), pairs, "a", "s", (loss, size)).where(F.col("identity") >= threshold)
    members = rows.join(folded.select("s", "a"), "s", "left").select(F.col("key").alias(key), F.coalesce("a", "key").alias("a"))
    return found, members
