"""Repeated byte windows across documents by a depth-limited radix sort of suffixes.

A suffix is ordered through ``threshold`` bytes only, most significant digits first, and a suffix that is
alone after a digit leaves the sort. The digits are dealt like this:

1. Every window holds an anchor, the piece of ``anchor`` bytes with the smallest hash in it; equal windows
   have equal anchors at equal places. The first pass deals anchors by their hash and keeps those that occur twice.
2. The second pass brings the surroundings of such anchors (all windows that hold it) to one bucket and sorts
   them, to the right and to the left of the anchor, by digits of eight bytes. Neighbours in the
   sorted order and the length they share give the class of every window, and each class its smallest document.
   Anchors of too many surroundings are dealt by whole windows instead, so no bucket depends on one anchor.
3. Each block of documents gets back the windows that a smaller document has.

Texts are dealt to blocks once; the three passes read the same shuffle. What leaves a block is folded
there first, so a passage of any number of documents is one entry per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from loomtab.llm.common import binaries, bound_batches, schema_of, text_or_empty, tidy_groups
from loomtab.llm.hashing import BASE, OTHER_BASE, gram_hashes, mixed, powers, prefix

BLOCK_BYTES = 5 << 20
BUCKET_BYTES = 5 << 20
"""Text per block of documents, and text whose anchors make up a bucket."""
CROWDED = 20_000
"""Occurrences of an anchor above which its windows are dealt one by one."""
SEGMENT = 1 << 18
LAST = np.iinfo(np.int64).max


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum of each run of ``width`` values, by doubling."""
    reach = 1
    while reach * 2 <= width:
        values = pick(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return pick(values[:len(values) - rest], values[rest:]) if rest else values


class Shape:
    """Sizes that follow from the threshold."""

    def __init__(self, threshold: int):
        if threshold < 16:
            raise ValueError("the threshold must be at least 16 bytes")
        self.window = threshold
        self.anchor = max(8, threshold * 2 // 5)
        self.side = threshold - self.anchor  # bytes a window can reach beyond the anchor on either side
        self.around = self.window + self.side


def anchors(data: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of one text; every window of it holds at least one."""
    n, width = len(data), shape.side + 1
    places, hashes = [], []
    if n < shape.window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for a in range(0, n, SEGMENT):
        low, high = max(0, a - shape.around), min(n, a + SEGMENT + shape.around)
        h = gram_hashes(data[low:high], shape.anchor)
        if len(h) < width:
            continue
        least = sliding(h, width, np.minimum)
        edge = np.zeros(width - 1, np.uint64)
        at = np.flatnonzero(sliding(np.concatenate([edge, least, edge]), width, np.maximum) == h)
        at = at[(at + low >= a) & (at + low < a + SEGMENT)]
        places.append(at + low)
        hashes.append(mixed(h[at] + np.uint64(BASE)))  # smallest hashes are small: mixed again they fill all buckets alike
    return np.concatenate(places), np.concatenate(hashes)


class Block:
    """The texts of one block, in an order that depends on nothing but the rows, with their anchors."""

    def __init__(self, texts: list[bytes], keys: np.ndarray, shape: Shape):
        self.shape, self.texts, self.keys = shape, texts, keys
        place, hashes = [], []
        for t in texts:
            p, h = anchors(np.frombuffer(t, np.uint8), shape)
            place.append(p)
            hashes.append(h)
        self.count = np.array([len(p) for p in place], np.int64)
        self.place = np.concatenate(place) if place else np.zeros(0, np.int64)
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.first = np.append(0, np.cumsum(self.count))
        self.text = np.repeat(np.arange(len(texts)), self.count)

    def surrounding(self, text: int) -> np.ndarray:
        """Hash of the surroundings of every anchor of one text, as ``surrounding_hash`` gives it for their bytes."""
        s = self.shape
        a, b = self.first[text], self.first[text + 1]
        data = np.frombuffer(self.texts[text], np.uint8)
        at = self.place[a:b]
        sums = prefix(np.concatenate([np.zeros(s.side, np.uint8), data, np.zeros(s.side, np.uint8)]))
        total = (sums[at + s.around] - sums[at]) * powers(len(sums))[1][at]
        return sided(total, np.minimum(at, s.side), np.minimum(len(data) - at - s.anchor, s.side))

    def around(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes around the chosen anchors, and how many of them lie within the text to the left and to the right."""
        s = self.shape
        out = np.zeros((len(chosen), s.around), np.uint8)
        left, right = np.zeros(len(chosen), np.uint8), np.zeros(len(chosen), np.uint8)
        owner = self.text[chosen]
        for t in np.unique(owner):
            a, b = np.searchsorted(owner, [t, t + 1])
            data = np.frombuffer(self.texts[t], np.uint8)
            padded = np.concatenate([np.zeros(s.side, np.uint8), data, np.zeros(s.side, np.uint8)])
            at = self.place[chosen[a:b]]
            out[a:b] = np.lib.stride_tricks.sliding_window_view(padded, s.around)[at]
            left[a:b] = np.minimum(at, s.side)
            right[a:b] = np.minimum(len(data) - at - s.anchor, s.side)
        return out, left, right


def sided(total: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(total + left.astype(np.uint64) * np.uint64(BASE) + right.astype(np.uint64) * np.uint64(OTHER_BASE))


def surrounding_hash(around: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    weights = powers(around.shape[1])[0][:around.shape[1]]
    total = np.zeros(len(around), np.uint64)
    for j in range(around.shape[1]):
        total += (around[:, j].astype(np.uint64) + np.uint64(1)) * weights[j]
    return sided(total, left, right)


def first_of(labels: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Positions in ``order`` at which a new label starts."""
    found = labels[order]
    return np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(order) else np.zeros(0, np.int64)


def radix_order(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows within their groups by eight-byte digits, most significant first, and the bytes
    that each row shares with the one before it (-1 where a group starts). Rows alone in their class leave early."""
    n, depth = rows.shape
    order = np.argsort(group, kind="stable")
    shared = np.zeros(n, np.int64)
    starts = first_of(group, order)
    shared[starts] = -1
    active = np.arange(n)  # places in the order that are not alone in their class so far
    label = np.zeros(n, np.int64)
    label[starts] = 1
    label = np.cumsum(label)
    for d in range(0, depth, 8):
        alone = np.append(label[1:] != label[:-1], True) & np.append(True, label[1:] != label[:-1])
        active, label = active[~alone], label[~alone]
        if not len(active):
            break
        digit = np.zeros((len(active), 8), np.uint8)
        digit[:, :min(8, depth - d)] = rows[order[active], d:d + 8]
        key = digit.view(">u8").ravel().astype(np.uint64)
        moved = np.lexsort((key, label))
        order[active] = order[active[moved]]
        key = key[moved]
        same = np.append(False, label[1:] == label[:-1])
        differ = same & np.append(False, key[1:] != key[:-1])
        bits = np.bitwise_xor(key[1:], key[:-1])
        equal_bytes = np.zeros(len(key), np.int64)
        for byte in range(1, 8):
            equal_bytes[1:] += (bits >> np.uint64(8 * (8 - byte))) == 0
        shared[active[differ]] = d + equal_bytes[differ]
        shared[active[same & ~differ]] = min(depth, d + 8)
        label = np.cumsum(~same | differ)
    return order, shared


def smallest(label: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each row the smallest value of its label."""
    order = np.argsort(label, kind="stable")
    starts = first_of(label, order)
    least = np.minimum.reduceat(value[order], starts) if len(starts) else value[:0]
    out = np.empty_like(value)
    out[order] = np.repeat(least, np.diff(np.append(starts, len(order))))
    return out


def owners(around: np.ndarray, left: np.ndarray, right: np.ndarray, document: np.ndarray, shape: Shape) -> np.ndarray:
    """For each surrounding and each reach to the left, the smallest document that has that window (LAST where there is none)."""
    side, n = shape.side, len(around)
    out = np.full((n, side + 1), LAST, np.int64)
    if not n:
        return out
    anchor = np.ascontiguousarray(around[:, side:side + shape.anchor])
    order, shared = radix_order(anchor, np.zeros(n, np.int64))
    group = np.empty(n, np.int64)
    group[order] = np.cumsum(shared < shape.anchor)
    order_r, shared_r = radix_order(np.ascontiguousarray(around[:, side + shape.anchor:]), group)
    order_l, shared_l = radix_order(np.ascontiguousarray(around[:, :side][:, ::-1]), group)
    to_right, to_left = np.empty(n, np.int64), np.empty(n, np.int64)
    for reach in range(side + 1):
        ahead = side - reach
        fits = np.flatnonzero((left >= reach) & (right >= ahead))
        if not len(fits):
            continue
        to_right[order_r] = np.cumsum(shared_r < ahead)
        to_left[order_l] = np.cumsum(shared_l < reach)
        if reach == 0 or ahead == 0:
            label = to_right if reach == 0 else to_left
        else:
            label = to_right * (n + 1) + to_left
        out[fits, reach] = smallest(label[fits], document[fits])
    return out


def planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight next to each other, which compresses well where numbers are alike."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""


def unplanes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def pressed(*columns: np.ndarray) -> bytes:
    import zstandard

    parts = [planes(c) if c.ndim == 1 else np.ascontiguousarray(c).tobytes() for c in columns]
    head = np.array([len(columns[0])] + [len(p) for p in parts], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def unpressed(data: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """Columns as written by ``pressed``; a kind such as ``80`` is a matrix of that many bytes a row."""
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    n, *sizes = np.frombuffer(raw, "<i8", len(kinds) + 1).tolist()
    at, out = 8 * (len(kinds) + 1), []
    for kind, size in zip(kinds, sizes):
        part = raw[at:at + size]
        out.append(np.frombuffer(part, np.uint8).reshape(n, int(kind)) if kind.isdigit() else unplanes(part, kind) if n else np.zeros(0, kind))
        at += size
    return out


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending with the hash, so sorted hashes fall into runs."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def runs(bucket: np.ndarray):
    """(bucket, from, to) of a sorted column."""
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(bucket)).tolist()):
        yield int(bucket[a]), a, b


def opened(table: pa.Table, shape: Shape) -> tuple[Block, np.ndarray]:
    """A block, its rows ordered by key and text, and that order."""
    texts, keys = table["text"].to_pylist(), table["key"].to_numpy()
    order = np.array(sorted(range(len(texts)), key=lambda i: (keys[i], texts[i])), np.int64)
    return Block([texts[i] for i in order], keys[order], shape), order


def blobs(block, rows) -> pa.Table:
    bucket, kind, payload = (list(c) for c in zip(*rows)) if rows else ([], [], [])
    return pa.table({"bucket": pa.array(bucket, pa.int64()), "block": pa.array([block] * len(bucket), pa.int64()),
                     "kind": pa.array(kind, pa.int32()), "payload": pa.array(payload, pa.binary())})


BLOBS = "bucket long, block long, kind int, payload binary"


def first_digit(shape: Shape, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        block, _ = opened(table, shape)
        found, count = np.unique(block.hash, return_counts=True)
        rows = [(b, 0, pressed(found[a:c], np.minimum(count[a:c], 255).astype(np.uint8))) for b, a, c in runs(bucket_of(found, buckets))]
        return blobs(table["block"][0].as_py(), rows)
    return run


def repeated(crowded: int):
    """Marks, for every block that sent anchors to a bucket: 0 alone, 1 repeated, 2 crowded."""
    def run(table: pa.Table) -> pa.Table:
        parts = [unpressed(p, ("<u8", "u1")) for p in table["payload"].to_pylist()]
        found, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        times = np.bincount(inverse, np.concatenate([p[1] for p in parts]).astype(np.float64), len(found))
        mark = ((times > 1).astype(np.uint8) + (times > crowded))[inverse].astype(np.uint8)
        ends = np.cumsum([len(p[0]) for p in parts])
        out = [pressed(m) for m in np.split(mark, ends[:-1])]
        return pa.table({"bucket": table["bucket"], "block": table["block"], "kind": pa.array([0] * len(out), pa.int32()), "payload": pa.array(out, pa.binary())})
    return run


def second_digit(shape: Shape, buckets: int):
    def run(table: pa.Table, marks: pa.Table) -> pa.Table:
        if not table.num_rows:
            return blobs(0, [])
        block, _ = opened(table, shape)
        found, inverse = np.unique(block.hash, return_inverse=True)
        sent = sorted(zip(marks["bucket"].to_pylist(), marks["payload"].to_pylist()))
        mark = np.concatenate([unpressed(p, ("u1",))[0] for _, p in sent]) if sent else np.zeros(0, np.uint8)
        mark = mark[inverse]
        rows = []
        chosen = np.flatnonzero(mark == 1)
        around, left, right = block.around(chosen)
        which = surrounding_hash(around, left, right)
        rows += folded(0, bucket_of(block.hash[chosen], buckets), which, block.keys[block.text[chosen]], (around, left, right))
        chosen = np.flatnonzero(mark == 2)
        if len(chosen):
            around, left, right = block.around(chosen)
            reach = np.arange(shape.side + 1)
            row, reach = np.nonzero((left[:, None] >= reach) & (right[:, None] >= shape.side - reach))
            start = block.place[chosen][row] - reach
            # neighbouring anchors share windows: one row for each window start
            _, once = np.unique(block.text[chosen][row] * (max(map(len, block.texts)) + 1) + start, return_index=True)
            row, reach = row[once], reach[once]
            window = np.lib.stride_tricks.sliding_window_view(around, shape.window, axis=1)[row, shape.side - reach]
            which = window_hash(window)
            crowded = np.unique(block.hash[chosen])
            for b, kind, payload in folded(1, bucket_of(which, buckets), which, block.keys[block.text[chosen][row]], (window,)):
                rows.append((b, kind, len(crowded).to_bytes(8, "little") + crowded.tobytes() + payload))
        return blobs(table["block"][0].as_py(), rows)
    return run


def window_hash(window: np.ndarray) -> np.ndarray:
    return surrounding_hash(window, np.zeros(len(window), np.uint8), np.zeros(len(window), np.uint8))


def folded(kind: int, bucket: np.ndarray, which: np.ndarray, keys: np.ndarray, columns: tuple) -> list:
    """Blobs of one row per bucket and content: the content, its smallest key, and whether a larger key has it too."""
    order = np.lexsort((keys, which, bucket))
    bucket, which, keys = bucket[order], which[order], keys[order]
    new = np.append(True, (which[1:] != which[:-1]) | (bucket[1:] != bucket[:-1])) if len(order) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    last = keys[np.append(starts[1:], len(keys)) - 1] if len(starts) else keys[:0]
    more = (last > keys[starts]).astype(np.uint8)
    picked = [c[order[starts]] for c in columns]
    return [(b, kind, pressed(keys[starts[a:c]], more[a:c], *[p[a:c] for p in picked])) for b, a, c in runs(bucket[starts])]


def classes(shape: Shape):
    """Per block: windows that a smaller document has, as surrounding or window hash, reach from and to, smallest document."""
    def run(table: pa.Table) -> pa.Table:
        bucket, block, kind, payload = [], [], [], []
        data, kinds, senders = table["payload"].to_pylist(), table["kind"].to_pylist(), table["block"].to_pylist()
        for wanted in (0, 1):
            mine = [i for i, k in enumerate(kinds) if k == wanted]
            if not mine:
                continue
            if wanted == 0:
                parts = [unpressed(data[i], ("<i8", "u1", str(shape.around), "u1", "u1")) for i in mine]
                key, more, around, left, right = (np.concatenate(c) for c in zip(*parts))
                which = surrounding_hash(around, left, right)
                pick, back = np.unique(which, return_index=True, return_inverse=True)[1:]
                own = owners(around[pick], left[pick], right[pick], smallest(which, key)[pick], shape)[back]
                heads = [b""] * len(mine)
            else:
                cut = [8 + 8 * int.from_bytes(data[i][:8], "little") for i in mine]
                heads = [data[i][:c] for i, c in zip(mine, cut)]
                parts = [unpressed(data[i][c:], ("<i8", "u1", str(shape.window))) for i, c in zip(mine, cut)]
                key, more, window = (np.concatenate(c) for c in zip(*parts))
                which = window_hash(window)
                order, shared = radix_order(np.ascontiguousarray(window), np.zeros(len(window), np.int64))
                label = np.empty(len(window), np.int64)
                label[order] = np.cumsum(shared < shape.window)
                own = smallest(label, key)[:, None]
            useful = (own < key[:, None]) | ((own == key[:, None]) & (more[:, None] == 1))
            ends = np.cumsum([len(p[0]) for p in parts])
            for i, head, a, b in zip(mine, heads, np.append(0, ends[:-1]), ends):
                value = np.where(useful[a:b], own[a:b], LAST)
                begins = value != np.concatenate([np.full((b - a, 1), LAST), value[:, :-1]], axis=1)
                begins &= value != LAST
                row, low = np.nonzero(begins)
                closes = (value != np.concatenate([value[:, 1:], np.full((b - a, 1), LAST)], axis=1)) & (value != LAST)
                high = np.nonzero(closes)[1]
                if len(row):
                    bucket.append(table["bucket"][i].as_py())
                    block.append(senders[i])
                    kind.append(wanted)
                    payload.append(head + pressed(which[a:b][row], low.astype(np.uint8), high.astype(np.uint8), value[row, low]))
        return pa.table({"bucket": pa.array(bucket, pa.int64()), "block": pa.array(block, pa.int64()),
                         "kind": pa.array(kind, pa.int32()), "payload": pa.array(payload, pa.binary())})
    return run


def covered(shape: Shape, schema, as_text: bool):
    """Bytes of every text that a window of a smaller document covers, as runs, and what is left: bytes, or the text that they make up."""
    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        block, order = opened(table, shape)
        size = np.array([len(t) for t in block.texts], np.int64)
        base = np.append(0, np.cumsum(size + 1))  # one place more than bytes, so that every run ends within its text
        change = np.zeros(base[-1], np.int32)
        plain, windows, crowded = [], [], [np.zeros(0, np.uint64)]
        for kind, data in zip(found["kind"].to_pylist(), found["payload"].to_pylist()):
            at = 0
            if kind == 1:
                at = 8 + 8 * int.from_bytes(data[:8], "little")
                crowded.append(np.frombuffer(data[8:at], np.uint64))
            (windows if kind else plain).append(unpressed(data[at:], ("<u8", "u1", "u1", "<i8")))

        def mark(text, start, stop):
            np.add.at(change, base[text] + start, 1)
            np.add.at(change, base[text] + stop, -1)

        if plain:
            which, low, high, owner = (np.concatenate(c) for c in zip(*plain))
            by = np.argsort(which, kind="stable")
            which, low, high, owner = which[by], low[by].astype(np.int64), high[by].astype(np.int64), owner[by]
            own = np.concatenate([block.surrounding(t) for t in range(len(size))])
            for a in range(0, len(own), 1 << 18):
                part = own[a:a + (1 << 18)]
                first, last = np.searchsorted(which, part, "left"), np.searchsorted(which, part, "right")
                row = np.repeat(np.arange(len(part)), last - first)
                hit = np.arange(len(row)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + first[row]
                row += a
                ok = owner[hit] < block.keys[block.text[row]]
                row, hit = row[ok], hit[ok]
                mark(block.text[row], block.place[row] - high[hit], block.place[row] - low[hit] + shape.window)
        if windows:
            which, _, _, owner = (np.concatenate(c) for c in zip(*windows))
            by = np.lexsort((owner, which))
            which, owner = which[by], owner[by]
            for chosen in np.array_split(np.flatnonzero(np.isin(block.hash, np.concatenate(crowded))), 1 + len(block.hash) // (1 << 16)):
                around, left, right = block.around(chosen)
                reach = np.arange(shape.side + 1)
                row, reach = np.nonzero((left[:, None] >= reach) & (right[:, None] >= shape.side - reach))
                own = window_hash(np.lib.stride_tricks.sliding_window_view(around, shape.window, axis=1)[row, shape.side - reach])
                hit = np.minimum(np.searchsorted(which, own), len(which) - 1)
                text = block.text[chosen[row]]
                ok = (which[hit] == own) & (owner[hit] < block.keys[text])
                start = block.place[chosen[row]] - reach
                mark(text[ok], start[ok], start[ok] + shape.window)
        inside = np.cumsum(change) > 0
        edge = np.diff(inside.astype(np.int8), prepend=0)
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        owner = np.searchsorted(base, begins, "right") - 1
        bounds = np.append(0, np.cumsum(np.bincount(owner, minlength=len(size))))
        left = ~inside
        left[base[1:] - 1] = False
        data = np.frombuffer(b"\0".join([*block.texts, b""]), np.uint8)
        kept = np.append(0, np.cumsum(left))[base]
        back = pa.array(np.argsort(order))
        lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(v - base[owner], pa.int64())) for v in (begins, ends)]
        rest = binaries(data[left], kept)
        if as_text:
            rest = pa.array([b.decode("utf-8", "ignore") for b in rest.to_pylist()], pa.string())
        made = [pa.array(size, pa.int64()), *lists, rest]
        out = table.select(["row"]).columns + [c.take(back) for c in made]
        return pa.table(out, schema=schema)
    return run


def marked_rows(df: DataFrame, key: str, text: str, threshold: int, crowded: int, as_text: bool = False) -> DataFrame:
    """``row`` with all columns of ``df``, ``n_bytes``, ``starts``, ``stops`` and ``kept`` of every row."""
    shape = Shape(threshold)
    value = text_or_empty(text).cast("binary")
    total = df.agg(F.sum(F.octet_length(text_or_empty(text)))).first()[0] or 0
    blocks, buckets = (max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // size)) for size in (BLOCK_BYTES, BUCKET_BYTES))
    bound_batches(df.sparkSession)
    number = F.col(key).cast("long")
    texts = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text], F.col(text).isNull().alias("")).alias("row"),
                      F.coalesce(number, F.lit(LAST)).alias("key"), value.alias("text"), F.pmod(F.xxhash64(number, value), F.lit(blocks)).alias("block"))
    sent = texts.groupBy("block").applyInArrow(tidy_groups(first_digit(shape, buckets)), BLOBS)
    marks = sent.groupBy("bucket").applyInArrow(tidy_groups(repeated(crowded)), BLOBS)
    around = texts.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(tidy_groups(second_digit(shape, buckets)), BLOBS)
    found = around.groupBy("bucket").applyInArrow(tidy_groups(classes(shape)), BLOBS)
    schema = schema_of(texts.select("row"), f"n_bytes long, starts array<long>, stops array<long>, kept {'string' if as_text else 'binary'}")
    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(tidy_groups(covered(shape, to_arrow_schema(schema), as_text)), schema)


def repeated_spans(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = 50, crowded: int = CROWDED) -> DataFrame:
    """``key``, ``n_bytes``, ``starts`` and ``stops`` of the removed runs, and the bytes ``kept``, for every row.

    A byte is removed if a string of ``threshold`` bytes over it also starts in a document of a smaller key; strings are those
    of the input, none crosses documents. NULL texts count as empty and lose nothing, as do texts shorter than the threshold.
    Keys must be whole numbers; a NULL key is larger than all others, and rows of one key take nothing
    from each other, so repeated rows stay alike. An empty table gives an empty one. Other columns are not read.
    """
    found = marked_rows(df.select(key, text), key, text, threshold, crowded)
    return found.select(F.col("row")[key].alias(key), "n_bytes", "starts", "stops", "kept")


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = 50, crowded: int = CROWDED) -> DataFrame:
    """All columns of ``df`` with the repeated bytes cut out of ``text``; what is left of a character that was cut goes too. NULL stays NULL."""
    found = marked_rows(df, key, text, threshold, crowded, as_text=True)
    return found.select(*[F.when(~F.col("row")[""], F.col("kept")).alias(c) if c == text else F.col("row")[c].alias(c) for c in df.columns])
