"""Compression of vectors to codes of codebook entries: Lloyd's rounds over cover trees.

A vector is cut into equal parts, each part position has a codebook. Tasks build cover trees over the parts of
some thousand vectors at a time, once: points of a node lie within a power of two of its centre, centres of sister
nodes are farther apart than half of that, and the points of a node stand side by side, so that their number and sum are
differences of two cumulative sums. In a round a node's centre is compared with all entries. If the nearest is
nearer than the second by more than twice the node's radius, it is nearest to all its points by the triangle inequality, and
the subtree is added whole; else its children follow, and the points of a leaf are compared one by one. Only sums by
entry leave a task. All values are whole numbers, so neither the order nor the number of tasks changes the result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loomtab.llm.common import map_batches, stored
from loomtab.operators.ordered import keyed_join

BLOCK = 4096
"""Vectors in one forest of trees."""
LEAF = 16
STEP = 4 << 20
"""Distances computed at a time."""


def whole(rows: np.ndarray) -> np.ndarray:
    return np.floor(256.0 * rows.astype(np.float64)).astype(np.int64)


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of several runs one after another."""
    total = int(size.sum())
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(total)


class Forest:
    """Cover trees of several sets of points of equal number; ``points`` in tree order, ``order`` is the place each had."""

    FIELDS = ("first", "size", "centre", "child", "children", "root")

    def __init__(self, points, order, radius, **fields):
        self.points, self.order, self.radius = points, order, radius
        for name in self.FIELDS:
            setattr(self, name, fields[name])
        self.sums = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(points, axis=0, out=self.sums[1:])

    @classmethod
    def build(cls, sets: np.ndarray) -> Forest:
        """``sets`` has one row of points per tree."""
        roots, n, _ = sets.shape
        points = sets.reshape(roots * n, -1)
        order = np.arange(roots * n)
        first, size = np.arange(roots) * n, np.full(roots, n)
        centre, root = first.copy(), np.arange(roots)
        nodes, made = [], roots
        while len(first):
            member = ranges(first, size)
            row, owner = order[member], np.repeat(np.arange(len(first)), size)
            far = distances(points[row], points[centre][owner])
            reach = np.maximum.reduceat(far, np.cumsum(size) - size)
            split = (size > LEAF) & (reach > 0)
            # Centres of children are farther apart than the power of two below the radius.
            cover = np.where(split, 4.0 ** (np.ceil(np.log2(np.maximum(reach, 1)) / 2) - 1), 0)
            inside = split[owner]
            member, row, owner = member[inside], row[inside], owner[inside]
            given = np.empty(len(row), np.int64)
            open_, parents, centres, count = np.arange(len(row)), [], [], 0
            pick = centre[np.flatnonzero(split)]  # a node's centre is the centre of its first child
            while len(open_):
                begins = np.append(True, owner[open_[1:]] != owner[open_[:-1]])
                number = np.cumsum(begins) - 1
                if parents:
                    pick = row[open_[begins]]
                near = distances(points[row[open_]], points[pick][number]) <= cover[owner[open_]]
                given[open_[near]] = count + number[near]
                parents.append(owner[open_[begins]])
                centres.append(pick)
                count += len(pick)
                open_ = open_[~near]
            parent, new_centre = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (parents, centres))
            by_parent = np.argsort(parent, kind="stable")
            rank = np.empty(count, np.int64)
            rank[by_parent] = np.arange(count)
            sorted_ = np.argsort(rank[given], kind="stable")
            order[member] = row[sorted_]
            children = np.bincount(parent, minlength=len(first))
            nodes.append((first, size, centre, made + np.cumsum(children) - children, children, root, reach))
            made += count
            parent = parent[by_parent]
            new_size = np.bincount(rank[given], minlength=count)
            first, size, centre, root = first[parent], new_size, new_centre[by_parent], root[parent]
            if count:
                before = np.cumsum(size) - size
                opens = np.append(True, parent[1:] != parent[:-1])
                first = first + before - before[opens][np.cumsum(opens) - 1]
        *fields, reach = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*nodes))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        named = dict(zip(cls.FIELDS, fields))
        named["centre"] = place[named["centre"]]
        return cls(points[order], order, np.sqrt(reach.astype(np.float64)) * (1 + 1e-12), **named)

    def nearest(self, row: np.ndarray, books: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest entry of points (the first of equals), its squared distance and that of the second."""
        trees, entries, _ = books.shape
        best, least, second = (np.empty(len(row), np.int64) for _ in range(3))
        kind = np.float64 if exact_in_double(self.points, books) else np.int64
        ends = np.searchsorted(root, np.arange(trees + 1))  # nodes and points come tree by tree
        for tree in np.flatnonzero(np.diff(ends)):
            book = books[tree]
            turned, norms, step = book.T.astype(kind), (book ** 2).sum(axis=1), STEP // entries
            for a in range(ends[tree], ends[tree + 1], step):
                part = slice(a, min(a + step, ends[tree + 1]))
                points = self.points[row[part]]
                all_ = (points ** 2).sum(axis=1)[:, None] + norms - 2 * (points.astype(kind) @ turned).astype(np.int64)
                at = all_.argmin(axis=1)
                line = np.arange(len(at))
                best[part], least[part] = at, all_[line, at]
                all_[line, at] = np.iinfo(np.int64).max
                second[part] = all_.min(axis=1)
        return best, least, second

    def assign(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Entry of every point in tree order, number and sum of points by (tree, entry), and how many points were compared."""
        trees, entries, width = books.shape
        label = np.empty(len(self.points), np.int64)
        count, sums = np.zeros(trees * entries, np.int64), np.zeros((trees * entries, width), np.int64)
        node, compared = np.arange(min(trees, len(self.first))), 0
        while len(node):
            best, least, second = self.nearest(self.centre[node], books, self.root[node])
            compared += len(node)
            sure = np.sqrt(second) * (1 - 1e-12) - np.sqrt(least) * (1 + 1e-12) > 2 * self.radius[node]
            sure |= (self.radius[node] == 0) | (entries == 1)
            done, to = node[sure], self.root[node[sure]] * entries + best[sure]
            first, size = self.first[done], self.size[done]
            label[ranges(first, size)] = np.repeat(best[sure], size)
            add_to(count, to, size)
            add_to(sums, to, self.sums[first + size] - self.sums[first])
            node = node[~sure]
            leaf = node[self.children[node] == 0]
            row = ranges(self.first[leaf], self.size[leaf])
            tree = np.repeat(self.root[leaf], self.size[leaf])
            label[row] = exact = self.nearest(row, books, tree)[0]
            compared += len(row)
            add_to(count, tree * entries + exact, np.ones(len(row), np.int64))
            add_to(sums, tree * entries + exact, self.points[row])
            node = ranges(self.child[node], self.children[node])
        return label, count, sums, compared

    def codes(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries by vector and part, and the squared distance of each vector, in the order the vectors came in."""
        trees = books.shape[0]
        label = self.assign(books)[0]
        n = len(self.points) // trees
        tree = self.order // n
        far = distances(self.points, books[tree, label])
        codes, error = np.empty((trees, n), np.int64), np.empty((trees, n), np.int64)
        codes.reshape(-1)[self.order], error.reshape(-1)[self.order] = label, far
        return codes.T, error.sum(axis=0)


def add_to(total: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Adds each value to its place; places may repeat."""
    if len(at):
        order = np.argsort(at, kind="stable")
        begins = np.flatnonzero(np.append(True, np.diff(at[order]) != 0))
        total[at[order][begins]] += np.add.reduceat(values[order], begins)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=1)


def exact_in_double(*arrays: np.ndarray) -> bool:
    """True if products of such whole numbers add up without rounding in double precision."""
    top = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    return top ** 2 * arrays[0].shape[-1] < 1 << 53


def finite(vector: str) -> Column:
    """True where no component is NULL, NaN or infinite; false for a NULL vector."""
    fine = F.forall(vector, lambda x: x.isNotNull() & F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False))


def as_rows(lists: pa.ListArray, width: int) -> np.ndarray:
    """Whole numbers of vectors, each filled up with zeros to ``width``."""
    size = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    rows = np.zeros((len(size), width), np.int64)
    rows[np.repeat(np.arange(len(size)), size), ranges(np.zeros(len(size), np.int64), size)] = whole(flat)
    return rows


def forests(df: DataFrame, width: int, parts: int, block: int = BLOCK) -> DataFrame:
    """One row per forest: key and label of its vectors, and the trees of all part positions."""
    def run(batches):
        def made(batch):
            n = batch.num_rows
            rows = as_rows(batch.column(2).combine_chunks(), width).reshape(n, parts, width // parts)
            trees = Forest.build(np.ascontiguousarray(rows.transpose(1, 0, 2)))
            numbers = [trees.order, *(getattr(trees, f) for f in Forest.FIELDS)]
            columns = [*(batch.column(c).combine_chunks() for c in (0, 1)), pa.array(trees.points.ravel()), pa.array(trees.radius), *(pa.array(x.astype(np.int32)) for x in numbers)]
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns], names)

        held, count = [], 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, block - count)
                batch = batch.slice(taken.num_rows)
                held.append(taken)
                count += taken.num_rows
                if count == block:
                    yield made(pa.Table.from_batches(held))
                    held, count = [], 0
        if held:
            yield made(pa.Table.from_batches(held))

    kinds = [df.schema[c].dataType.simpleString() for c in ("key", "label")]
    names = ["keys", "labels", "points", "radius", "places", *Forest.FIELDS]
    ddl = f"keys array<{kinds[0]}>, labels array<{kinds[1]}>, points array<long>, radius array<double>, " + ", ".join(f"{f} array<int>" for f in names[4:])
    return map_batches(df.select("key", "label", "vector"), run, ddl)


def read_forests(batch: pa.RecordBatch, part_width: int):
    """(keys, labels, forest) of each row; keys and labels may be left out."""
    column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    for i in range(batch.num_rows):
        values = {f: column[f].slice(i, 1).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for f in ("points", "places", *Forest.FIELDS)}
        points, order = values.pop("points"), values.pop("places")
        radius = column["radius"].slice(i, 1).flatten().to_numpy(zero_copy_only=False)
        yield [column[c].slice(i, 1).flatten() for c in ("keys", "labels") if c in column], Forest(points.reshape(len(order), part_width), order, radius, **values)


def improved(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: entries become the mean of what is nearest to them, rounded down; those nearest to nothing stay."""
    parts, entries, width = books.shape

    def run(batches):
        count, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        for batch in batches:
            for _, forest in read_forests(batch, width):
                _, c, s, _ = forest.assign(books)
                count += c
                sums += s
        used = np.flatnonzero(count)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * (width + 1), pa.int32()), pa.array(np.column_stack([count[used], sums[used]]).ravel(), pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), lists], ["entry", "numbers"])

    held = trees.select("points", "places", "radius", *Forest.FIELDS)
    total = map_batches(held, run, "entry int, numbers array<long>").select("entry", F.posexplode("numbers").alias("i", "number")) \
        .groupBy("entry", "i").agg(F.sum("number").alias("number")).collect()  # as many rows as the codebooks have components
    numbers = np.zeros((parts * entries, width + 1), np.int64)
    for r in total:
        numbers[r["entry"], r["i"]] = r["number"]
    used = np.flatnonzero(numbers[:, 0])
    out = books.copy().reshape(parts * entries, width)
    out[used] = numbers[used, 1:] // numbers[used, :1]
    return out.reshape(books.shape)


def encode(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 16, entries: int = 64,
           rounds: int = 2, block: int = BLOCK) -> tuple[DataFrame, np.ndarray]:
    """``key``, ``label``, ``codes`` (entry of each part), ``error`` (squared distance) of every vector that can be encoded, and the codebooks.

    Components become ``floor(256 * x)``. A NULL vector and one with a NULL, NaN or infinite component have no code and are
    left out, and so is one with a component so large that squared distances do not fit 64 bits (524,288 for 64 components).
    Vectors shorter than others, or of a length that ``parts`` does not divide, are filled up with zeros. The codebooks start
    with the vectors of the ``entries`` smallest keys (NULL keys last, equal keys by vector); fewer vectors give fewer entries.
    Repeated rows count one by one. An empty table gives an empty one and codebooks without entries. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    own = df.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector")).where(finite("vector"))
    longest = own.agg(F.max(F.size("vector"))).first()[0] or 0
    width = -(-longest // parts) * parts
    limit = (2.0 ** 62 / max(width, 1)) ** 0.5 / 512
    own = own.where(F.forall("vector", lambda x: F.abs(x) < limit))
    seeds = [r["vector"] for r in own.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).select("vector").collect()]
    books = as_rows(pa.array(seeds, pa.list_(pa.float64())), width).reshape(len(seeds), parts, width // parts).transpose(1, 0, 2).copy()
    schema = f"key {own.schema['key'].dataType.simpleString()}, label {own.schema['label'].dataType.simpleString()}, codes array<int>, error long"
    if not seeds:
        return own.sparkSession.createDataFrame([], schema), books
    trees = stored(forests(own, width, parts, block), "forests")
    for _ in range(rounds):
        books = improved(trees, books)

    def run(batches):
        for batch in batches:
            for (keys, labels), forest in read_forests(batch, width // parts):
                codes, error = forest.codes(books)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * parts, pa.int32()), pa.array(codes.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([keys, labels, lists, pa.array(error)], ["key", "label", "codes", "error"])

    return stored(map_batches(trees, run, schema), "codes"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of all vectors of one label; vectors without a label count together."""
    return keyed_join(coded, coded.groupBy("label").agg(F.sum("error").alias("label_error")), ["label"])


def hex_codes(codes: str) -> Column:
    """Two hex digits for each entry."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
