"""Hashes of byte slices, and a table of known slices.

Slices of up to 15 bytes are told apart by their bytes, held in two words with their length; longer ones are keys
of a dictionary, or hashed by XXH3. No equality of slices rests on the polynomial hash, which is for windows of one length only.
"""

from __future__ import annotations

from array import array

import numpy as np
import xxhash

BASE = 0x9E3779B97F4A7C15
OTHER_BASE = 0xC2B2AE3D27D4EB4F
SHORT = 15
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 16)
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            pair.append(np.multiply.accumulate(p))
        known = _POWERS[base] = tuple(pair)
    return known


def prefix(data: np.ndarray, base: int = BASE) -> np.ndarray:
    """Prefix sums from which the hash of any slice follows."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1, base)[0][:len(data)], out=out[1:])
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def packed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 15 bytes of each slice as two words; the last byte is the length, 255 for slices that do not fit."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[:len(data)] = data
    words = np.ndarray(len(data) + 9, "<u8", padded.data, strides=(1,))
    size = ends - starts
    low = words[starts] & MASKS[np.minimum(size, 8)]
    high = words[starts + 8] & MASKS[np.clip(size - 8, 0, 7)]
    return low, high | np.where(size <= SHORT, size, 255).astype(np.uint64) << np.uint64(56)


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each slice, the same wherever the slice stands."""
    low, high = packed(data, starts, ends)
    out = mixed(low * np.uint64(BASE) ^ mixed(high))
    long = np.flatnonzero(ends - starts > SHORT)
    view = memoryview(data).cast("B")
    out[long] = np.array([xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist())], np.uint64)
    return out


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each position on."""
    sums = prefix(data)
    return mixed((sums[size:] - sums[:-size]) * powers(len(data) + 1)[1][:len(data) - size + 1])


class Known:
    """Number of each slice seen before; the ids of a slice belong to its number.

    Short slices stand in an open table under their own bytes, long ones in a dictionary. The table starts with 2**``bits`` places. It grows within a step that needs more; ``full`` tells to drop it before the next one.
    """

    def __init__(self, bits: int = 21):
        self.least = bits
        self.drop()

    def drop(self) -> None:
        self.empty(self.least)
        self.tokens, self.ends = array("i"), array("q", [0])
        self.long: dict[bytes, int] = {}

    def empty(self, bits: int) -> None:
        self.bits, self.used, size = bits, 0, 1 << bits
        self.low, self.high, self.value = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.full(size, -1, np.int32)

    def __len__(self) -> int:
        return len(self.ends) - 1

    def full(self) -> bool:
        return len(self) > (1 << self.least) * 6 // 10

    def add(self, lists: list[list[int]]) -> np.ndarray:
        """Numbers given to the ids of new slices."""
        first = len(self)
        for ids in lists:
            self.tokens.extend(ids)
            self.ends.append(len(self.tokens))
        return np.arange(first, len(self))

    def add_runs(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The same for runs of one array."""
        first, held = len(self), len(self.tokens)
        self.tokens.frombytes(ids.astype(np.int32).tobytes())
        self.ends.frombytes((held + np.cumsum(counts, dtype=np.int64)).tobytes())
        return np.arange(first, len(self))

    def places(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mixed(low * np.uint64(BASE) ^ mixed(high)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        at = self.places(low, high)
        out = self.value[at]
        open_ = np.flatnonzero((out >= 0) & ((self.low[at] != low) | (self.high[at] != high)))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            place = at[open_]
            out[open_] = value = self.value[place]
            open_ = open_[(value >= 0) & ((self.low[place] != low[open_]) | (self.high[place] != high[open_]))]
        return out

    def put(self, low: np.ndarray, high: np.ndarray, number: np.ndarray) -> None:
        need, bits = self.used + len(low), self.bits
        while need > (1 << bits) * 8 // 10:
            bits += 1
        if bits > self.bits:
            held = np.flatnonzero(self.value >= 0)
            old = self.low[held], self.high[held], self.value[held]
            self.empty(bits)
            self.put(*old)
        self.used += len(low)
        at = self.places(low, high)
        left = np.arange(len(low))
        while len(left):
            free = left[self.value[at[left]] < 0]
            self.value[at[free]] = number[free]  # of several for one place the last one stays
            won = free[self.value[at[free]] == number[free]]
            self.low[at[won]], self.high[at[won]] = low[won], high[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, learn) -> np.ndarray:
        """Numbers of all slices; ``learn(positions)`` adds the ids of new ones and returns their numbers."""
        low, high = packed(data, starts, ends)
        fits = ends - starts <= SHORT
        out = np.where(fits, self.find(low, high), -1)
        missing = np.flatnonzero((out < 0) & fits)
        order = missing[np.lexsort((low[missing], high[missing]))]
        new = np.append(True, (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]]))[:len(order)]
        fresh = order[new]
        view, long = memoryview(data).cast("B"), np.flatnonzero(~fits)
        names = [bytes(view[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist())]
        unseen = {name: i for i, name in zip(long.tolist(), names) if name not in self.long}
        if len(fresh) or unseen:
            given = learn(np.concatenate([fresh, np.fromiter(unseen.values(), np.int64, len(unseen))])).astype(np.int32)
            self.put(low[fresh], high[fresh], given[:len(fresh)])
            out[order] = given[np.cumsum(new) - 1]
            self.long.update(zip(unseen, given[len(fresh):].tolist()))
        out[long] = [self.long[name] for name in names]
        return out.astype(np.int64)

    def expand(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all slices one after another, and the count before each slice (and after the last)."""
        ends = np.frombuffer(self.ends, np.int64)
        first, count = ends[numbers], ends[numbers + 1] - ends[numbers]
        before = np.append(0, np.cumsum(count))
        if not before[-1]:
            return np.zeros(0, np.int32), before
        return np.frombuffer(self.tokens, np.int32)[np.repeat(first - before[:-1], count) + np.arange(before[-1])], before
