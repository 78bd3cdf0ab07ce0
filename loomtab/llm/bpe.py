"""Byte-level BPE encoding and decoding.

Boundaries are found without a regex engine. Each code point gets a symbol (letter,
number, kind of white space, apostrophe of a contraction, other), the pattern is a
small automaton over symbols, and its transition functions form a finite monoid: a
lookup table composes two of them. The scan composes blocks of code points, then the
block totals, and reads the state before every code point from the composed prefix.
The slices between boundaries go through pair merging once per worker and are
answered from a cache after that. Byte offsets of all tokens are kept.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomtab.llm.common import map_batches, schema_of, steps, text_or_empty, worker_cache
from loomtab.llm.hashing import Known

# The pattern whose boundaries the automaton finds.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

OTHER, LETTER, NUMBER, SPACE, BLANK, LOOSE, SHORT, LONG, END = range(9)
"""Symbols: SPACE is a blank before a non-space, BLANK another white space before one, LOOSE white space
before white space or the end, SHORT and LONG apostrophes of contractions of one and two letters."""
START, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_SPACE, IN_LOOSE, ONE_LEFT, TWO_LEFT = range(8)

WIDTH = 64


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a piece starts here", by symbol and state."""
    to = np.zeros((9, 8), np.uint8)
    starts = np.ones((9, 8), bool)
    for symbol, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHER)):
        to[symbol] = run
        starts[symbol, [run, AFTER_SPACE]] = False
    for state, then in ((TWO_LEFT, ONE_LEFT), (ONE_LEFT, START)):
        to[LETTER, state], starts[LETTER, state] = then, False
    for symbol, then in ((SHORT, ONE_LEFT), (LONG, TWO_LEFT)):
        to[symbol] = then
        to[symbol, [IN_OTHER, AFTER_SPACE]] = IN_OTHER
        starts[symbol, [IN_OTHER, AFTER_SPACE]] = False
    to[SPACE], to[BLANK], to[LOOSE], to[END] = AFTER_SPACE, START, IN_LOOSE, START
    starts[LOOSE, IN_LOOSE] = False
    return to, starts


def monoid(to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of the symbols' functions: table of products, functions as rows, number of each symbol."""
    functions = [tuple(range(to.shape[1]))]
    number = {functions[0]: 0}
    generators = [tuple(row) for row in to.tolist()]
    for f in functions:
        for g in generators:
            h = tuple(g[s] for s in f)
            if h not in number:
                number[h] = len(functions)
                functions.append(h)
    product = np.array([[number[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16)
    return product, np.array(functions, np.uint8), np.array([number[g] for g in generators], np.uint16)


class Splitter:
    """Finds piece boundaries in arrays of code points; ``classes`` maps a code point to a symbol."""

    def __init__(self, classes: np.ndarray):
        self.classes = classes
        to, self.starts = automaton()
        self.product, self.functions, self.number = monoid(to)

    def symbols(self, points: np.ndarray) -> np.ndarray:
        plain = self.classes[points]
        follows = np.append(plain[1:], END)
        white = (plain == SPACE) | (plain == BLANK)
        out = np.where(white & ((follows == SPACE) | (follows == BLANK) | (follows == END)), np.uint8(LOOSE), plain)
        marks = np.flatnonzero(points == ord("'"))
        if len(marks):
            padded = np.append(points, [0, 0])
            one, two = padded[marks + 1], padded[marks + 2]
            out[marks[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
            pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
            out[marks[np.logical_or.reduce([(one == a) & (two == b) for a, b in pairs])]] = LONG
        return out

    def boundaries(self, points: np.ndarray) -> np.ndarray:
        """Positions at which a piece or the end mark of a text starts."""
        n = len(points)
        symbols = self.symbols(points)
        rows = -(-n // WIDTH)
        padded = np.full(rows * WIDTH, END, np.uint8)
        padded[:n] = symbols
        columns = self.number[padded].reshape(rows, WIDTH).T.copy()
        size = len(self.product)
        product = self.product.ravel()
        before = np.empty((WIDTH, rows), np.uint16)
        whole = np.zeros(rows, np.uint16)
        for j in range(WIDTH):
            before[j] = whole
            whole = product.take(whole.astype(np.intp) * size + columns[j])
        shift = 1
        while shift < rows:
            whole[shift:] = product.take(whole[:-shift].astype(np.intp) * size + whole[shift:])
            shift *= 2
        carried = np.append(np.uint8(START), self.functions[whole[:-1], START])
        states = self.functions.ravel().take(before.astype(np.intp) * self.functions.shape[1] + carried)
        return np.flatnonzero(self.starts[symbols, states.T.ravel()[:n]])


def code_classes() -> np.ndarray:
    """Symbol of every code point, as the engine that reads the pattern sees it; one more entry for the end mark.

    ``regex`` may know a newer Unicode than the encoder, so its letters and numbers are asked for one by one.
    """
    import regex
    import tiktoken

    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    ranks = {bytes([b]): b for b in range(256)}
    for lead in range(256):
        for first in b"a1":
            ranks.setdefault(bytes([first, lead]), len(ranks))
    engine = tiktoken.Encoding("classes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = np.zeros(0x110001, np.uint8)
    for symbol, first, kind in ((LETTER, "a", r"\p{L}"), (NUMBER, "1", r"\p{N}")):
        for c in regex.findall(kind, everything):
            if len(engine.encode_ordinary(first + c)) == len(c.encode()):
                out[ord(c)] = symbol
    out[[ord(c) for c in regex.findall(r"\s", everything)]] = BLANK
    out[ord(" ")], out[0x110000] = SPACE, END
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join the pair of lowest rank, the leftmost first, until none is known."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    if len(piece) > 64:
        return _merge_long(piece, ranks)
    parts = [piece[i:i + 1] for i in range(len(piece))]
    pairs = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
    while True:
        best, at = None, -1
        for i, r in enumerate(pairs):
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            return [ranks[p] for p in parts]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at])
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1])


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap and linked neighbours, for pieces of many bytes."""
    import heapq

    n = len(piece)
    end, right, left = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = right[i] if end[i] else n
        if not end[i] or j >= n or end[j] != stop:
            continue  # one of the two has changed since
        end[i], end[j], right[i] = stop, 0, right[j]
        if right[j] < n:
            left[right[j]] = i
        for a in (left[i], i):
            if a >= 0 and (b := right[a]) < n and (r := ranks.get(piece[a:end[b]])) is not None:
                heapq.heappush(heap, (r, a, end[b]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = right[i]
    return out


class Pieces:
    """Answers slices it has seen from a table of known ones and merges the others."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.known = ranks, Known()
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int32)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def encode(self, buffer: bytes, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all slices between cuts, and the count before each slice (and after the last)."""
        starts, ends = cut[:-1], cut[1:]

        def learn(fresh: np.ndarray) -> np.ndarray:
            return self.known.add([merge(buffer[a:b], self.ranks) if a < b else [] for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist())])

        return self.known.expand(self.known.numbers(np.frombuffer(buffer, np.uint8), starts, ends, learn))


def encode_texts(texts: list[str], splitter: Splitter, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token ids, their byte offsets within each text, and the token count before each text (and after the last)."""
    if pieces.known.full():
        pieces.known.drop()
    points = np.concatenate([np.append(np.frombuffer(t.encode("utf-32-le"), np.uint32), np.uint32(0x110000)) for t in texts])
    starts = splitter.boundaries(points)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    width[points == 0x110000] = 0
    cut = np.append(0, np.cumsum(width))[np.append(starts, len(points))]
    ids, before = pieces.encode("".join(texts).encode(), cut)
    closing = points[starts] == 0x110000
    bounds = np.append(0, before[1:][closing])
    size = pieces.lengths[ids].astype(np.int64)
    offsets = np.cumsum(size) - size
    text_start = np.append(0, cut[:-1][closing][:-1])
    return ids, offsets - np.repeat(text_start, np.diff(bounds)), bounds


def encode(df: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``ids`` and ``offsets`` (first byte of each token) of every text.

    NULL counts as the empty text and has no tokens. Rows are independent of each other, so repeated rows and ids
    change nothing; an empty table gives an empty one. Other columns of ``df`` are not read. ``vocabulary`` is a
    rank file; it is read once on the driver and goes to the tasks with the code (some MB, whatever the data).
    """
    ranks, classes = read_ranks(vocabulary), code_classes()
    name = "bpe_" + vocabulary
    schema = schema_of(df.select(*keep), "ids array<int>, offsets array<int>")

    def run(batches):
        splitter, pieces = worker_cache(name, lambda: (Splitter(classes), Pieces(ranks)))
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for a, b in steps(pa.compute.binary_length(column).to_pylist()):
                ids, offsets, bounds = encode_texts(column.slice(a, b - a).to_pylist(), splitter, pieces)
                lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(v, pa.int32())) for v in (ids, offsets)]
                yield pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in batch.columns[:-1]] + lists, [*keep, "ids", "offsets"])

    return map_batches(df.select(*keep, text_or_empty(text).alias("_text")), run, schema, cached=True)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the bytes of every list of ids as ``decoded``; NULL gives no bytes, an unknown id fails."""
    ranks = read_ranks(vocabulary)
    schema = schema_of(df.select(*keep), "decoded binary")

    def run(batches):
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_pylist()
            out = [b"".join(map(tokens.__getitem__, flat[a:b].tolist())) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(out, pa.binary())], [*keep, "decoded"])

    return map_batches(df.select(*keep, F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("_ids")), run, schema)
