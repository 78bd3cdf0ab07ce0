"""Token ids of whole texts by the tokenizers library, which sees every new chunk once.

Both kinds of vocabulary cut a text before a white-space run that follows a non-space, and between a
Latin letter and a following punctuation mark, whatever stands around. Such places are found
on the bytes, chunks are told apart by their bytes, and those new to a worker go through the library:
ASCII words through its model, other words together, set apart by a control character, all others one by one. A run is
cut before a blank, tab or line end only, and only if it starts there: runs of other white space stay inside their chunk.
Added tokens are looked up in the text as it is, before all else; what stands between them is encoded by itself, as the library does.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from loomtab.llm.common import worker_cache
from loomtab.llm.hashing import Known

PLAIN = re.compile(r" ?[A-Za-z]+")
WORD = re.compile(r"[ \n]?[A-Za-zÀ-ÖØ-öø-ÿ]+")
SPACE, MARK, LATIN = 1, 2, 4
LONGEST = 1 << 20
TOKEN = "\udcff"  # the byte 0xFF
# White space outside ASCII, as the bytes of its code points.
WIDE_SPACE = np.array([int.from_bytes(chr(c).encode(), "big") for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)], np.uint32)


def byte_kinds() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(b" \t\n\r")] = SPACE
    out[list(b",.!?;:")] = MARK
    out[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = LATIN
    return out


def ends_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """True where white space that is not one of the four bytes above ends at a position."""
    last = data[at]
    out = (last >= 0x0B) & (last <= 0x1F)  # control characters of which some are white space
    wide = np.flatnonzero(last >= 0x80)
    two = data[at[wide] - 1].astype(np.uint32) << 8 | last[wide]
    out[wide] = (two == 0xC285) | (two == 0xC2A0) | np.isin(data[at[wide] - 2].astype(np.uint32) << 16 | two, WIDE_SPACE)
    return out


class ChunkEncoder:
    """``added`` tells whether strings of added tokens in a text are these tokens, as in a plain call of the library, or ordinary text."""

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # a chunk holds none: they are cut out before, or are ordinary text
        self.spaced = keeps_space(path)
        self.apart = "\x01" if self.spaced else " \x01 "
        self.apart_id = self.library(["\x01"])[0][0]
        self.kinds = byte_kinds()
        self.known = Known()
        self.added = added_tokens(path) if added else {}
        self.cut_out = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def cut(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of chunks; texts start at ``first``."""
        kind = self.kinds[data]
        latin = kind == LATIN
        if len(data) > 1:  # two-byte letters up to U+00FF, without the two signs among them
            latin[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        space = kind == SPACE
        start = np.zeros(len(data) + 1, bool)
        start[first] = True
        start[1:-1] |= (kind[1:] == MARK) & latin[:-1]
        run = np.flatnonzero(space[1:] & ~space[:-1])
        start[run[~ends_wide_space(data, run)] + 1] = True
        if not self.spaced:
            start[1:-1] |= space[:-1] & ~space[1:]
        starts = np.flatnonzero(start[:-1])
        ends = np.append(starts[1:], len(data))
        if not self.spaced and len(starts):
            chosen = ~space[starts]
            starts, ends = starts[chosen], ends[chosen]
        return starts, ends

    def learn(self, chunks: list[str]) -> np.ndarray:
        """ASCII words go to the library's model as they are, its other steps would not change them; all else takes every step."""
        merge, others, places = self.tokenizer.model.tokenize, [], []
        lists: list = [None] * len(chunks)
        for i, c in enumerate(chunks):
            if c[:1] == TOKEN:
                lists[i] = [int(c[1:])]
            elif PLAIN.fullmatch(c) and (self.spaced or c.islower()):
                lists[i] = [t.id for t in merge("\u0120" + c[1:] if c[0] == " " else c)]
            else:
                others.append(c)
                places.append(i)
        words = [c for c in others if WORD.fullmatch(c)]
        joined = np.array(self.library([self.apart.join(words)])[0] if words else [], np.int32)
        runs = iter(np.split(joined, np.flatnonzero(joined == self.apart_id)))
        rest = iter(self.library([c for c in others if not WORD.fullmatch(c)]))
        for i, c in zip(places, others):
            lists[i] = [t for t in next(runs).tolist() if t != self.apart_id] if WORD.fullmatch(c) else next(rest)
        return self.known.add(lists)

    def parts(self, text: str):
        """Bytes of the parts of a text that are encoded by themselves; an added token is a byte no text has, and its id."""
        at = 0
        for found in self.cut_out.finditer(text) if self.cut_out else ():
            if found.start() > at:
                yield from map(str.encode, pieces(text[at:found.start()]))
            yield (TOKEN + str(self.added[found[0]])).encode(errors="surrogateescape")
            at = found.end()
        if at < len(text):
            yield from map(str.encode, pieces(text[at:] if at else text))

    def encode(self, texts: list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the count before each text (and after the last); ``end`` closes each text."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            for part in self.parts(text):
                parts.append(part)
                owner.append(i)
        counts, ids = np.zeros(len(texts), np.int64), []
        step, held = [], 0
        for i, part in enumerate(parts):
            step.append(i)
            held += len(part)
            if held > LONGEST or i == len(parts) - 1:
                got, count = self._encode([parts[j] for j in step])
                ids.append(got)
                np.add.at(counts, [owner[j] for j in step], count)
                step, held = [], 0
        ids = np.concatenate(ids).astype(np.uint32) if ids else np.zeros(0, np.uint32)
        bounds = np.append(0, np.cumsum(counts))
        if end is None:
            return ids, bounds
        out = np.full(len(ids) + len(texts), end, np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), counts)] = ids
        return out, bounds + np.arange(len(texts) + 1)

    def _encode(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.known.full():
            self.known.drop()
        whole = b"".join(parts)
        if not self.spaced:
            whole = whole.lower()  # as the library will do with A-Z
        data = np.frombuffer(whole, np.uint8)
        bounds = np.append(0, np.cumsum([len(p) for p in parts], dtype=np.int64))
        starts, ends = self.cut(data, bounds[:-1])

        def learn(fresh: np.ndarray) -> np.ndarray:
            return self.learn([whole[a:b].decode(errors="surrogateescape") for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist())])

        ids, before = self.known.expand(self.known.numbers(data, starts, ends, learn))
        return ids, np.diff(before[np.searchsorted(starts, bounds)])


def pieces(text: str):
    """A long text in runs that end before a blank or line end after what is no white space of any kind; short ones whole."""
    while len(text) > LONGEST:
        at = next((m.start() + 1 for m in re.finditer(r"\S[ \n]", text[LONGEST // 2:])), None)
        if at is None:
            break
        at += LONGEST // 2
        yield text[:at]
        text = text[at:]
    yield text


def keeps_space(path: str) -> bool:
    """True if white space is part of the tokens; other kinds of vocabulary than the two described above are refused."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    before, normal = spec["pre_tokenizer"], spec["normalizer"]
    if before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and normal is None:
        return True
    if normal and any(n.get("pattern") == {"Regex": r"\s+"} for n in normal.get("normalizers", ())) and \
            before["type"] == "Sequence" and before["pretokenizers"][0].get("behavior") == "Removed":
        return False
    raise ValueError(f"no rule to cut texts for {path}")


def added_tokens(path: str) -> dict[str, int]:
    """Ids of the added tokens that are found in a text as it is; those with rules of their own are refused."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in tokens):
        raise ValueError(f"no rule to find the added tokens of {path}")
    return {t["content"]: t["id"] for t in tokens}


def chunk_encoder(path: str) -> ChunkEncoder:
    return worker_cache("chunks_" + path, lambda: ChunkEncoder(path, added=True))
