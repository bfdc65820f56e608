"""Numpy kernels on the bytes of many texts at once: words, word hashes, windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


#: Ranges longer than this are hashed one by one.
LONG = 64
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words of digits, letters a-z and everything beyond ASCII, after A-Z are lower-cased.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True
#: Bytes of words that white space parts (space and 9 to 13).
SPACED = np.ones(256, bool)
SPACED[[32, *range(9, 14)]] = False
SAME = np.arange(256, dtype=np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def spread(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large_binary array, one text after the other, and the n + 1 offsets in them."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
    size = int(offsets[-1] - offsets[0])
    data = np.frombuffer(texts.buffers()[2], np.uint8, size, int(offsets[0])) if size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each range; hashes by two seeds have nothing to do with each other.

    Each block of eight bytes goes through the mixing of what was before it, so no sum of differences cancels out. All ranges take their first block
    at once, those that have one their second, and so on; the few long ones go to a library's hash.
    """
    size = end - start
    out = mix(size.astype(np.uint64) * _BASE + np.uint64((seed * int(_MIX2) + int(_MIX1)) % (1 << 64)))
    if not len(size):
        return out
    blocks = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    at, done = np.flatnonzero(size <= LONG), 0
    while len(at):
        left = size[at] - done
        block = np.ascontiguousarray(blocks[start[at] + done]).view("<u8").ravel() & _MASKS[np.minimum(left, 8)]
        out[at] = mix((out[at] ^ block) * _BASE + _MIX2)
        at, done = at[left > 8], done + 8
    long = np.flatnonzero(size > LONG)
    if len(long):
        raw = memoryview(np.ascontiguousarray(data))
        out[long] = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b], seed) for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)), np.uint64, len(long))
    return out


class Words:
    """The words of many texts. data: folded bytes; start, end: each word's bytes; first: n + 1 word positions of the texts."""

    def __init__(self, texts: pa.Array, table: np.ndarray = WORD, fold: np.ndarray = LOWER) -> None:
        raw, self.offsets = spread(texts)
        self.raw = raw
        self.data = fold[raw] if fold is not SAME else raw
        self.inside = w = table[self.data]
        begin, stop = w.copy(), w.copy()
        begin[1:] &= ~w[:-1]
        stop[:-1] &= ~w[1:]
        full = self.offsets[1:] > self.offsets[:-1]
        at, to = self.offsets[:-1][full], self.offsets[1:][full] - 1
        begin[at], stop[to] = w[at], w[to]
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.count = np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word."""
        return hash_ranges(self.data, self.start, self.end, seed)

    def windows(self, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k-word windows that lie in one text, and the position of each one's first word."""
        if len(h) < k:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        g = h[: len(h) - k + 1].copy()
        for j in range(1, k):
            g *= _MIX1
            g += h[j : len(h) - k + 1 + j]
        last = np.repeat(self.first[1:], self.count)[: len(g)]
        at = np.arange(len(g))
        ok = at + k <= last
        return mix(g[ok]), at[ok]

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def text(self, i: int, k: int) -> bytes:
        """k folded words from word i on, parted by one space."""
        return b" ".join(self.data[self.start[j] : self.end[j]].tobytes() for j in range(i, i + k))


def sums_by_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set between the offsets of each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n positions lie in any of the ranges."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + lengths, -1)
    return np.cumsum(d[:-1]) > 0
