"""Exact nearest neighbours as a pruned comparison of written blocks.

Rows are put into cells around pivots, whose number grows with the square root of the
rows: the pivots of ten billion rows are 25,000, some MB. Rows of different vectors are written once, sorted by cell, as files of
bounded size. A task takes the rows of one file and reads the files of the shared folder one after the other, its own first and near ones next:
each row's k-th distance so far bounds it, and cells whose nearest possible point is beyond that (triangle inequality) are passed over, so
nothing is dropped. No row is copied for a comparison and only the k best of a row leave a task, so disk grows with the rows alone. A cell holding
a third of the rows is many files. Files are reached through Arrow's file systems, by the scheme of the path.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window, functions as F, types as T

from loomtab.operators.ordered import keyed_join
from loomtab.session import written
from loomtab.sources.lines import located

BLOCK_ROWS = 4096
"""Rows of a file, while there are few, and of a cell at least, about."""
FILE_BYTES = 16 << 20
"""Bytes of the vectors of a file, as doubles, about."""
STEP = 1 << 22
"""Distances held at a time."""
QUERY_BLOCK = 20_000
"""Queries that go to the tasks as one matrix."""
VISITS = 1 << 15
"""Rows of one batch after each of its rows was sent to every cell; a task holds 64 times as many distances to pivots."""


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in col.to_numpy()])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, recomputed from differences where cancellation would hurt."""
    sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T
    near = sq < 1e-6 * ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :])
    out = np.sqrt(np.maximum(sq, 0.0))
    if near.any():
        i, j = np.nonzero(near)
        for s in range(0, len(i), 65536):
            ii, jj = i[s:s + 65536], j[s:s + 65536]
            d = a[ii] - b[jj]
            out[ii, jj] = np.sqrt((d * d).sum(1))
    return out


def _pivots(rows: DataFrame, n_pivots: int) -> pd.DataFrame:
    """A repeatable, bounded handful of rows by hash order; they only steer pruning."""
    top = (rows.select("_v", F.xxhash64("_id", F.lit(17)).alias("_h")).orderBy("_h").limit(n_pivots).select("_v"))
    return top.toPandas()


def _pieces(frames: Iterator[pd.DataFrame], n_pivots: int) -> Iterator[pd.DataFrame]:
    """Frames cut so that a piece sent to every pivot is still a bounded number of rows."""
    step = max(1, VISITS // n_pivots)
    return (f.iloc[s:s + step] for f in frames for s in range(0, len(f), step))


def _with_cell(rows: DataFrame, pivots: np.ndarray, kind: str) -> DataFrame:
    """Adds the nearest pivot ``_cell`` and the distance to it ``_d``."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in _pieces(frames, max(1, len(shared.value) // 64)):
            d = _distances(_matrix(f["_v"]), shared.value)
            d[np.isnan(d)] = np.inf
            cell = d.argmin(1)
            yield f.assign(_cell=cell.astype(np.int32), _d=d[np.arange(len(f)), cell])

    return rows.mapInPandas(run, f"{kind}, _cell int, _d double")


class _Written:
    """Rows of different vectors in files by group and cell: (_g, _k) a group, _h a hash of group and vector, _id the lowest of _n ids, _v, _cell, _d."""

    def __init__(self, rows: DataFrame, by: Sequence[str], total: int, pivots: np.ndarray, seed: int):
        self.rows, self.by, self.seed, self.pivots = rows, by, seed, pivots
        distinct = rows.groupBy(*by, "_v").agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_n"))
        named = distinct.select("_id", "_n", "_v", *_group(rows, by, seed))
        placed = _with_cell(named, pivots, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema.fields))
        files = max(1, -(-total * pivots.shape[1] * 8 // FILE_BYTES), min(-(-total // BLOCK_ROWS), 4 * rows.sparkSession.sparkContext.defaultParallelism))
        self.table = written(placed.repartitionByRange(files, "_g", "_cell", "_h").sortWithinPartitions("_g", "_cell", "_h"), "vectors")
        found = self.table.groupBy(F.input_file_name().alias("path")).agg(*[f(c) for c in ("_g", "_cell") for f in (F.min, F.max)])
        self.files = sorted(map(tuple, found.collect()))

    def single(self) -> bool:
        """No vector and no id comes twice."""
        return self.table.where("_n > 1").isEmpty() and self.table.groupBy("_id").count().where("count > 1").isEmpty()

    def named(self) -> DataFrame:
        """(_id, _h) of all rows, copies too."""
        return self.rows.select("_id", _group(self.rows, self.by, self.seed)[-1])

    def told_by_hash(self) -> bool:
        return self.table.groupBy("_h").count().where("count > 1").isEmpty()


def _group(rows: DataFrame, by: Sequence[str], seed: int) -> list:
    """_g, _k and _h of each row."""
    kinds = {c: isinstance(rows.schema[c].dataType, (T.DoubleType, T.FloatType)) for c in by}
    parts = [x for c in by for x in (F.col(c).isNull(), F.col(c) + F.lit(0.0) if kinds[c] else F.col(c))]
    return [(F.xxhash64(*parts) if by else F.lit(0).cast("long")).alias("_g"), (F.to_json(F.struct(*by)) if by else F.lit("")).alias("_k"),
            F.xxhash64(*parts, F.lit(seed), "_v").alias("_h")]


def _opened(path: str) -> tuple[pa.Table, np.ndarray]:
    """A file and its vectors."""
    system, place = located(path)
    table = pq.read_table(place, filesystem=system, partitioning=None).combine_chunks()
    lists = table.column("_v").combine_chunks()
    lengths = pc.unique(pc.list_value_length(lists))
    if len(lengths) != 1 or not lengths[0].is_valid:
        raise ValueError("vectors must be of one length and not NULL")
    return table, lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(table.num_rows, -1)


def _plain(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_pandas(integer_object_nulls=True).to_numpy()


def _groups(table: pa.Table) -> dict[tuple, np.ndarray]:
    """(_g, _k) -> its rows, in order."""
    g = _plain(table, "_g")
    if not len(g) or (g[0] == g[-1] and len(pc.unique(table.column("_k"))) == 1):
        return {(g[0], table.column("_k")[0].as_py()): np.arange(len(g))} if len(g) else {}
    return pd.DataFrame({"g": g, "k": _plain(table, "_k")}).groupby(["g", "k"], sort=False).indices


class _Best:
    """The ``k`` nearest of each row so far: distance, id and hash, in order."""

    def __init__(self, rows: int, k: int, ids: np.ndarray):
        self.far = np.full((rows, k), np.inf)
        self.id, self.h = np.empty((rows, k), ids.dtype), np.zeros((rows, k), np.int64)

    def add(self, row: np.ndarray, far: np.ndarray, ids: np.ndarray, h: np.ndarray) -> None:
        met = np.unique(row)
        at, place = np.nonzero(np.isfinite(self.far[met]))
        at = met[at]
        row, far = np.concatenate([at, row]), np.concatenate([self.far[at, place], far])
        ids, h = np.concatenate([self.id[at, place], ids]), np.concatenate([self.h[at, place], h])
        order = np.lexsort((ids, far, row)) if ids.dtype != object else pd.DataFrame({"r": row, "f": far, "i": ids}).sort_values(["r", "f", "i"], kind="stable").index.to_numpy()
        row, far, ids, h = row[order], far[order], ids[order], h[order]
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        rank = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        keep = rank < self.far.shape[1]
        row, rank = row[keep], rank[keep]
        self.far[row, rank], self.id[row, rank], self.h[row, rank] = far[keep], ids[keep], h[keep]


def _met(best: _Best, rows: np.ndarray, a: np.ndarray, b: np.ndarray, ids: np.ndarray, h: np.ndarray) -> None:
    """Offers the rows ``b`` to ``rows`` of ``a``: products rule pairs out, what is left is measured from differences."""
    k, b2 = best.far.shape[1], (b * b).sum(1)
    right = np.concatenate([b, b2[:, None], np.ones((len(b), 1))], axis=1).T
    step = max(1, STEP // len(b))
    for at in (rows[s:s + step] for s in range(0, len(rows), step)):
        own = a[at]
        a2 = (own * own).sum(1)
        square = np.concatenate([-2 * own, np.ones((len(own), 1)), a2[:, None]], axis=1) @ right
        slack = 1e-10 * (a2 + b2.max())
        limit = best.far[at, -1] ** 2 + slack
        if (loose := ~np.isfinite(limit)).any():  # not yet k found: the k-th of these
            m = min(k, len(b))
            kth = np.partition(square[loose], m - 1, axis=1)[:, m - 1]
            limit[loose] = np.where(np.isnan(kth), np.inf, kth) + slack[loose]
        i, j = np.nonzero(square <= limit[:, None])
        if not len(i):
            continue
        far = np.concatenate([np.sqrt(((own[i[s:s + 65536]] - b[j[s:s + 65536]]) ** 2).sum(1)) for s in range(0, len(i), 65536)])
        keep = np.isfinite(far) & (far <= best.far[at, -1][i])
        if keep.any():
            best.add(at[i[keep]], far[keep], ids[j[keep]], h[j[keep]])


def _through(best: _Best, table: pa.Table, v: np.ndarray, own: dict, a: np.ndarray, pivots: np.ndarray) -> None:
    """Offers the rows of a file to those rows of its groups that its cells can hold something for."""
    cell, radius, ids, h = (_plain(table, c) for c in ("_cell", "_d", "_id", "_h"))
    for group, there in _groups(table).items():
        if group not in own:
            continue
        rows = own[group]
        cells = np.append(np.flatnonzero(np.append(True, np.diff(cell[there]) != 0)), len(there))
        s = 0
        while s < len(cells) - 1:  # some cells together, where they are small
            e = max(s + 1, int(np.searchsorted(cells, cells[s] + BLOCK_ROWS, side="right")) - 1)
            part = there[cells[s]:cells[e]]
            widest = np.maximum.reduceat(radius[part], cells[s:e] - cells[s])
            reach = rows
            if len(pivots) > 1 and np.isfinite(bound := best.far[rows, -1]).any():
                steps = max(1, STEP // (e - s))
                near = [(_distances(a[rows[x:x + steps]], pivots[cell[there[cells[s:e]]]]) - widest > bound[x:x + steps, None] * (1 + 1e-9) + 1e-9).all(1) for x in range(0, len(rows), steps)]
                reach = rows[~np.concatenate(near)]
            if len(reach):
                _met(best, reach, a, v[part], ids[part], h[part])
            s = e


def _answers(asked: _Written, base: _Written, k: int, id_type: str, leave_out_self: bool, opposite: bool) -> DataFrame:
    """(_id, rank, neighbor, distance, _h): the ``k`` nearest different vectors of each; one more is looked for where the row itself is left out. ``opposite``: nearest to the mirrored vector."""
    spark, shared = base.table.sparkSession, base.table.sparkSession.sparkContext.broadcast(base.pivots)
    theirs, files, found = asked.files, base.files, k + leave_out_self

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for number in (n for batch in batches for n in batch.column(0).to_pylist()):
            path, low, high, *_ = theirs[number]
            table, v = _opened(path)
            a = -v if opposite else v
            own, ids = _groups(table), _plain(table, "_id")
            best, middle = _Best(len(a), found, ids), np.nanmean(a, axis=0)
            away = np.sqrt(((pivots - middle) ** 2).sum(1))
            # The file itself, then by the nearest cell; groups of a file follow one another.
            todo = sorted((f[0] != path or opposite, float(np.nan_to_num(away[f[3]:f[4] + 1].min()) if f[1] == f[2] else 0), f[0]) for f in files if f[1] <= high and f[2] >= low)
            for _, _, other in todo:
                _through(best, *((table, v) if other == path else _opened(other)), own, a, pivots)
            ok = np.isfinite(best.far)
            if leave_out_self:
                ok &= best.id != ids[:, None]
            rank = np.cumsum(ok, axis=1)
            i, j = np.nonzero(ok & (rank <= k))
            kind = table.schema.field("_id").type
            yield pa.RecordBatch.from_arrays([pa.array(ids[i], kind), pa.array(rank[i, j].astype(np.int32)), pa.array(best.id[i, j], kind), pa.array(best.far[i, j]), pa.array(best.h[i, j])],
                                             ["_id", "rank", "neighbor", "distance", "_h"])

    n = len(theirs)
    return spark.range(0, n, 1, max(1, n)).mapInArrow(run, f"_id {id_type}, rank int, neighbor {id_type}, distance double, _h long")


def _shaped(df: DataFrame, key: str, vector: str, by: Sequence[str], kind: str) -> DataFrame:
    # 0.0 is added to make -0.0 and 0.0 one.
    return df.select(*by, F.col(key).alias("_id"), F.transform(F.col(vector).cast(f"array<{kind}>"), lambda x: x + F.lit(0.0).cast(kind)).alias("_v"))


def _kind(*frames: DataFrame, vector: str) -> str:
    return "float" if all(d.schema[vector].dataType == T.ArrayType(T.FloatType()) for d in frames) else "double"


def _laid_out(rows: DataFrame, by: Sequence[str], n_pivots: int | None, asked: DataFrame | None = None) -> tuple[_Written, _Written, bool]:
    """Rows and asked rows, and whether all of them are single."""
    total = rows.count()
    pivots = _matrix(_pivots(rows, n_pivots or max(1, min(int(total ** 0.5) // 4, total // BLOCK_ROWS)))["_v"])
    for seed in count(29):
        there = _Written(rows, by, total, pivots, seed)
        heads = there if asked is None else _Written(asked, by, asked.count(), pivots, seed)
        every = {there, heads}
        if all(x.single() for x in every):
            return there, heads, True
        if all(x.told_by_hash() for x in every):  # else with another hash
            return there, heads, False


def _ranked(there: _Written, heads: _Written, single: bool, key: str, k: int, leave_out_self: bool, opposite: bool = False) -> DataFrame:
    id_type, w = there.rows.schema["_id"].dataType.simpleString(), Window.partitionBy("_id").orderBy("distance", "neighbor")
    if single:
        return _answers(heads, there, k, id_type, leave_out_self, opposite).select(F.col("_id").alias(key), "rank", "neighbor", "distance")
    # Equal vectors have equal distances, so one row looks for all its copies, and of these only the k + 1 lowest ids can be anyone's neighbours.
    found = _answers(heads, there, k + 1, id_type, False, opposite).drop("rank")
    of_copy = there.named().join(there.table.where("_n > 1").select("_h"), "_h")
    of_copy = of_copy.withColumn("_c", F.row_number().over(Window.partitionBy("_h").orderBy("_id"))).where(F.col("_c") <= k + 1)
    found = found.join(of_copy.select("_h", F.col("_id").alias("_copy"), "_c"), "_h", "left")
    found = found.select("_id", F.when(F.col("_c").isNull(), F.col("neighbor")).otherwise(F.col("_copy")).alias("neighbor"), "distance")
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k + 1).select(F.col("_id").alias("_head"), "neighbor", "distance")
    found = heads.named().join(heads.table.select("_h", F.col("_id").alias("_head")), "_h").select("_id", "_head").join(ranked, "_head").drop("_head")
    found = found.where(F.col("_id") != F.col("neighbor")) if leave_out_self else found
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(F.col("_id").alias(key), "rank", "neighbor", "distance")


def _none(base: DataFrame, key: str) -> DataFrame:
    id_type = base.schema[key].dataType.simpleString()
    return base.sparkSession.createDataFrame([], f"`{key}` {id_type}, rank int, neighbor {id_type}, distance double")


def nearest(base: DataFrame, key: str, vector: str, k: int, queries: DataFrame | None = None, by: Sequence[str] = (),
            n_pivots: int | None = None) -> DataFrame:
    """(key, rank, neighbor, distance): the k nearest rows by Euclidean distance, ties by id.

    Without ``queries`` every row looks among the other rows. ``by`` limits the
    search to rows with equal values. Exact.
    """
    kind = _kind(base, *([] if queries is None else [queries]), vector=vector)
    rows = _shaped(base, key, vector, by, kind)
    if rows.isEmpty():
        return _none(base, key)
    return _ranked(*_laid_out(rows, by, n_pivots, None if queries is None else _shaped(queries, key, vector, by, kind)), key, k, queries is None)


def nearest_and_opposite(base: DataFrame, key: str, vector: str, k: int, far: int, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The ``k`` nearest other rows of each row, and the ``far`` rows (itself among them) nearest to its mirrored vector, as ``nearest`` gives them."""
    rows = _shaped(base, key, vector, by, _kind(base, vector=vector))
    if rows.isEmpty():
        return _none(base, key), _none(base, key)
    laid = _laid_out(rows, by, None)
    return _ranked(*laid, key, k, True), _ranked(*laid, key, far, False, opposite=True)


def top_by_scan(base: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str, k: int,
                metric: str = "cosine", query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_key, rank, key, score): k best base rows per query, ties by key.

    A stated query set goes against all rows: queries are sent to every task as a matrix, in blocks of about
    ``query_block``, and each task keeps its k best per query, so the corpus is scanned once per block and never
    shuffled. For as many queries as rows use ``nearest``.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(f"unknown metric {metric}")
    blocks = max(1, -(-queries.count() // query_block))
    asked = queries.select(query_key, F.col(vector).cast("array<double>").alias("_v"), F.pmod(F.xxhash64(query_key), F.lit(blocks)).alias("_blk"))
    parts = [_scan(base, key, vector, asked.where(F.col("_blk") == i).drop("_blk").toPandas(), query_key, asked.schema[query_key].dataType.simpleString(), k, metric)
             for i in range(blocks)]
    return _rank(reduce(DataFrame.unionByName, parts), query_key, key, k, metric)


def _scan(base, key, vector, held, query_key, q_type, k, metric):
    key_type = base.schema[key].dataType.simpleString()
    if held.empty:
        return base.sparkSession.createDataFrame([], f"`{query_key}` {q_type}, `{key}` {key_type}, score double")
    q = _matrix(held["_v"])
    if metric == "cosine":
        q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
    shared = base.sparkSession.sparkContext.broadcast((held[query_key].to_numpy(), q))

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, m = shared.value
        best: pd.DataFrame | None = None
        for f in frames:
            if not len(f):
                continue
            step = max(64, 8_000_000 // len(m))  # keeps the score matrix near 64 MB
            for s in range(0, len(f), step):
                piece = f.iloc[s:s + step]
                v = _matrix(piece["_v"])
                if metric == "cosine":
                    v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
                    bad = -(m @ v.T)
                else:
                    bad = _distances(m, v)
                top = min(k, bad.shape[1])
                kth = np.partition(bad, top - 1, axis=1)[:, top - 1]
                i, j = np.nonzero(bad <= kth[:, None])
                new = pd.DataFrame({"q": i, "b": piece["_id"].to_numpy()[j], "s": bad[i, j]})
                both = new if best is None else pd.concat([best, new])
                best = both.sort_values(["q", "s", "b"], kind="stable").groupby("q", sort=False).head(k)
        if best is not None:
            sign = -1.0 if metric == "cosine" else 1.0
            yield pd.DataFrame({query_key: names[best["q"].to_numpy()], key: best["b"].to_numpy(), "score": sign * best["s"].to_numpy()})

    return (base.select(F.col(key).alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
            .mapInPandas(scan, f"`{query_key}` {q_type}, `{key}` {key_type}, score double"))


def _rank(part, query_key, key, k, metric):
    first = F.desc("score") if metric == "cosine" else F.asc("score")
    w = Window.partitionBy(query_key).orderBy(first, key)
    return (part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(query_key, "rank", key, "score"))
