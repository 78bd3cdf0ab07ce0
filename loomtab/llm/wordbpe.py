"""BPE of words with word ends: encoding by contiguous rank arrays, decoding by the token table.

A word is a row of parts with the rank of each two neighbours beside it. The row is scanned for its lowest rank, the
boundary at that place is deleted, the ranks on both sides of the new part are looked up again, until no rank is
left. Words of one length class are rows of one array, so that a scan, a deletion and a refresh are each one step for
all of them. Words of more than ``SHORT`` parts keep their boundaries in a linked list and their ranks in a heap: there a
scan of the whole row for every merge would be quadratic.

Texts are cut into chunks at places where the vocabulary's own steps cannot look across (``chunks.py``); chunks known to
the worker are answered from its table. In new ones ASCII letters, digits and marks are told apart here; chunks with other
signs take the normal form and the pattern that the vocabulary file names.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomtab.llm.chunks import TOKEN, ChunkEncoder
from loomtab.llm.common import map_batches, schema_of, steps, text_or_empty, worker_cache

SHORT = 64
NONE = np.int32(1 << 30)
# The pattern of the vocabulary for texts of ASCII signs without upper case.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)


def byte_signs() -> dict[int, str]:
    """The sign that stands for each byte: printable ones for themselves, the others from U+0100 on in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class Merges:
    """Rank of two neighbouring tokens and the token they make, found in sorted keys."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        suffix = model["end_of_word_suffix"]
        if model["type"] != "BPE" or not suffix or model["continuing_subword_prefix"] or model["ignore_merges"] or model["dropout"]:
            raise ValueError(f"no word ends in {path}")
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        key = left * self.size + right
        order = np.argsort(key[::-1], kind="stable")  # of a pair listed twice the last rank counts
        self.keys, first = np.unique(key[::-1][order], return_index=True)
        self.ranks = (len(key) - 1 - order[first]).astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        signs = byte_signs()
        self.inner = np.array([vocab[signs[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[signs[b] + suffix] for b in range(256)], np.int32)
        self.signs = {s: b for b, s in signs.items()}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ``NONE`` for a pair that is never joined. Tokens below 0 are places beyond a word's end."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def parts(self, word: bytes) -> np.ndarray:
        data = np.frombuffer(word, np.uint8)
        out = self.inner[data]
        out[-1] = self.last[data[-1]]
        return out

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of words of at least one byte."""
        out: list = [None] * len(words)
        classes: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            classes.setdefault(len(w).bit_length() if len(w) <= SHORT else 0, []).append(i)
        for size, chosen in classes.items():
            if size == 0:
                for i in chosen:
                    out[i] = self.merge_long(self.parts(words[i]))
                continue
            width = max(len(words[i]) for i in chosen)
            rows = np.full((len(chosen), width), -1, np.int32)
            for row, i in enumerate(chosen):
                rows[row, :len(words[i])] = self.parts(words[i])
            for i, row in zip(chosen, self.merge_rows(rows)):
                out[i] = row
        return out

    def merge_rows(self, parts: np.ndarray) -> list[list[int]]:
        """All rows at once; -1 fills a row behind its last part."""
        done = np.full(parts.shape, -1, np.int32)
        place = np.arange(len(parts))
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        while ranks.shape[1]:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(at)), at]
            joined = best < NONE
            if not joined.all():
                done[place[~joined], :parts.shape[1]] = parts[~joined]
                place, parts, ranks, at, best = place[joined], parts[joined], ranks[joined], at[joined], best[joined]
            if not len(place):
                break
            row, width = np.arange(len(place)), ranks.shape[1]
            parts[row, at] = self.made[best]
            keep = np.arange(width + 1)[None, :] != at[:, None] + 1
            parts = parts[keep].reshape(len(place), width)
            ranks = ranks[np.arange(width)[None, :] != at[:, None]].reshape(len(place), width - 1)
            for then, side in ((at - 1, at > 0), (at, at < width - 1)):
                r, t = row[side], then[side]
                ranks[r, t] = self.rank(parts[r, t], parts[r, t + 1])
        done[place, :parts.shape[1]] = parts
        count = (done >= 0).sum(axis=1)
        return [d[:n] for d, n in zip(done.tolist(), count.tolist())]

    def merge_long(self, parts: np.ndarray) -> list[int]:
        n = len(parts)
        ranks = self.rank(parts[:-1], parts[1:])
        token, after, before = parts.tolist(), [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i, a, b) for i, (r, a, b) in enumerate(zip(ranks.tolist(), token, token[1:])) if r < NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if token[i] != a or j < 0 or token[j] != b:
                continue  # one of the two has changed since
            token[i], token[j], after[i] = int(self.made[r]), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0:
                    pair = token[k], token[after[k]]
                    found = int(self.rank(np.array(pair[:1]), np.array(pair[1:]))[0])
                    if found < NONE:
                        heapq.heappush(heap, (found, k, *pair))
        return [t for t in token if t >= 0]


class WordEncoder(ChunkEncoder):
    """Chunks by the rules of ``chunks.py``, new ones merged here."""

    def __init__(self, path: str):
        super().__init__(path, added=True)
        self.merges = Merges(path)

    def words(self, chunk: str) -> list[bytes]:
        if chunk.isascii():
            return [w.encode() for w in PIECES.findall(chunk.lower())]
        normal = self.tokenizer.normalizer.normalize_str(chunk)
        sign = self.merges.signs
        return [bytes(map(sign.__getitem__, piece)) for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def learn(self, chunks: list[str]) -> np.ndarray:
        lists: list[list[int]] = []
        words, owner = [], []
        for i, c in enumerate(chunks):
            lists.append([int(c[1:])] if c[:1] == TOKEN else [])
            if c[:1] != TOKEN:
                own = self.words(c)
                words += own
                owner += [i] * len(own)
        for i, ids in zip(owner, self.merges.merge(words)):
            lists[i] += ids
        return self.known.add(lists)


def encode(df: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``ids`` of every text, without tokens around it; strings of added tokens in a text are those tokens.

    NULL counts as the empty text and has no ids. Rows are independent of each other, so repeated rows and ids change
    nothing; an empty table gives an empty one. Other columns of ``df`` are not read. The file is read where tasks run.
    """
    schema = schema_of(df.select(*keep), "ids array<int>")

    def run(batches):
        encoder = worker_cache("words_" + vocabulary, lambda: WordEncoder(vocabulary))
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for a, b in steps(pa.compute.binary_length(column).to_pylist()):
                ids, bounds = encoder.encode(column.slice(a, b - a).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32), pa.int32()))
                yield pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in batch.columns[:-1]] + [lists], [*keep, "ids"])

    return map_batches(df.select(*keep, text_or_empty(text).alias("_text")), run, schema, cached=True)


def token_strings(path: str) -> list[str]:
    """String of each id, as the vocabulary file lists them; added tokens go first."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["decoder"] is not None:
        raise ValueError(f"{path} names a decoder of its own")
    strings = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return [strings.get(i, "") for i in range(max(strings) + 1)]


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``decoded``: the strings of the ids with one blank between them, as the library joins the tokens of
    a vocabulary that names no decoder. Special tokens stay; NULL and an empty list give the empty text; an id the vocabulary lacks fails."""
    schema = schema_of(df.select(*keep), "decoded string")

    def run(batches):
        strings = worker_cache("strings_" + vocabulary, lambda: pa.array(token_strings(vocabulary)))
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            for a, b in steps(pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy() * 4):
                part = lists.slice(a, b - a)
                flat = part.flatten()
                bounds = np.append(0, np.cumsum(pa.compute.list_value_length(part).to_numpy()))
                spelled = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), strings.take(flat))
                yield pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in batch.columns[:-1]] + [pa.compute.binary_join(spelled, " ")], [*keep, "decoded"])

    return map_batches(df.select(*keep, F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("_ids")), run, schema, cached=True)
