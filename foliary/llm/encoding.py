"""Token ids of whole texts by a public tokenizer, encoded once for each distinct run of non-blank characters.

Where a tokenizer's pattern never joins characters across white space, parts the punctuation tail of a word from it and doesn't
mind case, a text's ids are those of its lower-cased, blank-separated runs (and tails) one after the other. That is tried on PROBES
when the file is loaded; with a tokenizer that fails them, and in texts that hold the opening of a special token, the
library encodes whole texts as they are. Runs are found, told apart by 128 bits of hash and looked up as arrays in a memory of those
met of late; new ones go to the library many at a time: words of letters alone, each of which has one piece that ends a
word, or any runs with a mark between them. The ids between ends or marks are theirs. One gather puts all in order.

The memory is bounded in bytes, holds no long runs and ends with the encoder, which a task makes for itself.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

from foliary.llm.kernels import SPACED, Words, hash_ranges

#: Bytes of an encoder's memory, after which it starts anew, and of the longest run that it keeps.
MEMO_BYTES, RUN_BYTES = 48 << 20, 64
#: Stands between new runs; a run that holds it is encoded alone. Bytes of the runs of one call to the library.
_MARK, _CALL_BYTES = b"\x01", 1 << 16
#: What a punctuation tail holds, and what stands before it.
_TAIL, _BEFORE = np.zeros(256, bool), np.zeros(256, bool)
_TAIL[list(b".,!?;:#$%&*|")] = True
_BEFORE[48:58] = _BEFORE[97:123] = True
PROBES = ("a b", "Two words", "x  y\n\nz\t1 2 3", "it's DON'T they'll, a.b - c", " . , ! ", "Été 中文  x", "a\x01 b", "12,345.60 $ 7% #8 |9| &c", "foo### bar... (baz) A1!?", "no-one's;:")


@dataclass
class _Library:
    """A loaded tokenizer file and what is known of it. ends: which ids end a word; None if that can't be told."""

    tokenizer: object
    bare: object
    special: re.Pattern
    lowers: bool
    mark: int | None
    ends: np.ndarray | None
    by_runs: bool = False

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Where all characters lie below U+0130, no form has to be normalised and lower case is one for one: that is done here."""
        strings = [t.decode("utf-8", "replace") for t in texts]
        simple = self.lowers and all(s.isascii() or max(s) < "İ" for s in strings)
        tokenizer = self.bare if simple else self.tokenizer
        found = tokenizer.encode_batch_fast([s.lower() for s in strings] if simple else strings, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def runs(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, ids, lengths): the ids of runs[order[0]], runs[order[1]], ... one after the other, and the number of each one's."""
        kinds: tuple[list[int], list[int], list[int]] = ([], [], [])  # words of letters, others, those that go alone
        for i, r in enumerate(runs):
            kinds[2 if self.mark is None or _MARK in r else 0 if self.ends is not None and (r.isalpha() or r.decode("utf-8", "replace").isalpha()) else 1].append(i)
        order, ids, lengths = [], [], []
        for kind in (0, 1):
            for part in _calls(kinds[kind], runs):
                own = starts = ends = None
                if kind == 0:
                    own = self.encode([b" ".join([runs[i] for i in part])])[0]
                    ends = np.flatnonzero(self.ends[own]) + 1
                    starts = np.concatenate([[0], ends[:-1]])
                if own is None or len(ends) != len(part):  # each has one end at least, so with as many ends as runs each has one
                    own = self.encode([b" \x01 ".join([runs[i] for i in part])])[0]
                    cuts = np.flatnonzero(own == self.mark)
                    starts, ends = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(own)]])
                    own, starts, ends = own[own != self.mark], starts - np.arange(len(starts)), ends - np.arange(len(ends))
                order += part
                ids.append(own)
                lengths.append(ends - starts)
        alone = self.encode([runs[i] for i in kinds[2]]) if kinds[2] else []
        ids += alone
        lengths.append(np.array([len(x) for x in alone], np.int64))
        return np.array(order + kinds[2], np.int64), np.concatenate([*ids, np.zeros(0, "<u4")]), np.concatenate(lengths)


def _calls(which: list[int], runs: list[bytes]) -> list[list[int]]:
    """Runs for one call each, of about _CALL_BYTES."""
    out, held = [], _CALL_BYTES
    for i in which:
        if held >= _CALL_BYTES:
            out.append([])
            held = 0
        out[-1].append(i)
        held += len(runs[i]) + 1
    return out


@lru_cache(2)
def _library(path: str) -> _Library:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer, normalizers

    tokenizer, bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
    bare.normalizer = normalizers.Sequence([])
    special = re.compile(b"|".join(re.escape(t.content[:2].encode()) for t in tokenizer.get_added_tokens_decoder().values()) or b"(?!)")
    lowers = tokenizer.normalizer is not None and tokenizer.normalizer.normalize_str("AÉ ß") == "aé ß"
    mark = tokenizer.encode(_MARK.decode(), add_special_tokens=False).ids
    suffix, vocabulary, ends = getattr(tokenizer.model, "end_of_word_suffix", None), tokenizer.get_vocab(), None
    if suffix:
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True
    library = _Library(tokenizer, bare, special, lowers, mark[0] if len(mark) == 1 else None, ends)
    words = Words(pa.array([p.encode() for p in PROBES], pa.large_binary()), SPACED)
    start, end, first = _cut(words)
    runs = library.encode([words.data[a:b].tobytes() for a, b in zip(start, end, strict=True)])
    library.by_runs = all(np.concatenate(runs[a:b]).tolist() == tokenizer.encode(p, add_special_tokens=False).ids for a, b, p in zip(first[:-1], first[1:], PROBES, strict=True))
    return library


def _cut(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs and their tails, and the n + 1 positions in them where the texts begin."""
    place = np.arange(len(words.data), dtype=np.int64)
    place[_TAIL[words.data]] = -1
    np.maximum.accumulate(place, out=place)
    body = place[words.end - 1]  # the last byte of each run that no tail may hold
    tailed = np.flatnonzero((body >= words.start) & (body + 1 < words.end) & _BEFORE[words.data[body]])
    start, end = np.insert(words.start, tailed + 1, body[tailed] + 1), words.end.copy()
    end[tailed] = body[tailed] + 1
    return start, np.insert(end, tailed + 1, words.end[tailed]), words.first + np.searchsorted(tailed, words.first)


class _Memo:
    """Runs by hash: two sorted levels of (hash, second hash, first id, ids), the smaller one for what came last, and all their ids."""

    def __init__(self) -> None:
        self.levels = [np.zeros((4, 0), np.uint64)] * 2
        self.ids, self.used = np.zeros(1 << 16, "<u4"), 0

    def size(self) -> int:
        return sum(x.nbytes for x in self.levels) + 4 * self.used

    def find(self, h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First id and number of ids of each run; -1 where it isn't known. h is sorted."""
        begin, length = np.full(len(h), -1, np.int64), np.zeros(len(h), np.int64)
        for level in self.levels:
            if level.shape[1]:
                at = np.minimum(np.searchsorted(level[0], h), level.shape[1] - 1)
                hit = (level[0][at] == h) & (level[1][at] == g)
                begin[hit], length[hit] = level[2][at[hit]], level[3][at[hit]]
        return begin, length

    def append(self, ids: np.ndarray) -> int:
        """The place of the ids, which stay only if keep() follows."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used // 2 + len(ids), "<u4")])
        self.ids[self.used : self.used + len(ids)] = ids
        return self.used

    def keep(self, h: np.ndarray, g: np.ndarray, begin: np.ndarray, length: np.ndarray) -> None:
        self.used += int(length.sum())
        new = np.concatenate([self.levels[1], np.stack([h, g, begin.astype(np.uint64), length.astype(np.uint64)])], 1)
        self.levels[1] = new[:, np.argsort(new[0], kind="stable")]
        if 4 * self.levels[1].shape[1] > self.levels[0].shape[1]:
            both = np.concatenate(self.levels, 1)
            self.levels = [both[:, np.argsort(both[0], kind="stable")], self.levels[1][:, :0]]


class Encoder:
    """encode(texts, end id) -> ids of all texts, each closed with the end id, and the n + 1 offsets in them."""

    def __init__(self, path: str, memo_bytes: int = MEMO_BYTES) -> None:
        self.library, self.most, self.memo = _library(path), memo_bytes, _Memo()

    def _ids(self, words: Words, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First id, in the memory's, and number of ids of each run."""
        h, g = hash_ranges(words.data, start, end), hash_ranges(words.data, start, end, 1)
        long = end - start > RUN_BYTES
        h[long], g[long] = np.arange(long.sum()), 0  # each for itself
        keys, at, back = np.unique(h, return_index=True, return_inverse=True)
        if (g[at][back] != g).any():  # two runs of one hash: every run for itself
            at = np.argsort(h, kind="stable")
            keys, back = h[at], np.argsort(at, kind="stable")
        if self.memo.size() > self.most:
            self.memo = _Memo()
        begin, length = self.memo.find(keys, g[at])
        new = np.flatnonzero((begin < 0) | long[at])
        if len(new):
            new = new[np.argsort(long[at[new]], kind="stable")]
            raw = words.data.tobytes()
            brief = int((~long[at[new]]).sum())
            for part, keep in ((new[:brief], True), (new[brief:], False)):
                if not len(part):
                    continue
                order, ids, many = self.library.runs([raw[a:b] for a, b in zip(start[at[part]].tolist(), end[at[part]].tolist(), strict=True)])
                part = part[order]
                begin[part], length[part] = self.memo.append(ids) + np.cumsum(many) - many, many
                if keep:
                    self.memo.keep(keys[part], g[at[part]], begin[part], many)
        return begin[back], length[back]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """texts: a large_binary array without nulls."""
        n, library = len(texts), self.library
        end = np.array([end_id], "<u4")
        if not library.by_runs:
            return _joined([x for ids in library.encode(texts.to_pylist()) for x in (ids, end)], 2)
        words = Words(texts, SPACED)
        whole = [i for i, t in enumerate(texts.to_pylist()) if library.special.search(t)] if library.special.search(memoryview(words.raw)) else []
        start, stop, first = _cut(words)
        begin, length = self._ids(words, start, stop)
        total = np.concatenate([[0], np.cumsum(length)])
        taken = self.memo.ids[np.repeat(begin - total[:-1], length) + np.arange(int(total[-1]))]
        offsets = total[first] + np.arange(n + 1)
        out = np.full(len(taken) + n, end_id, "<u4")
        inside = np.ones(len(out), bool)
        inside[offsets[1:] - 1] = False
        out[inside] = taken
        if not whole:
            return out, offsets
        parts = [out[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        for i, own in zip(whole, library.encode([texts[i].as_py() for i in whole]), strict=True):
            parts[i] = np.concatenate([own, end])
        return _joined(parts, 1)


def _joined(parts: list[np.ndarray], each: int) -> tuple[np.ndarray, np.ndarray]:
    """The parts one after the other, and the offsets at every `each` of them."""
    return np.concatenate([*parts, np.zeros(0, "<u4")]), np.cumsum([0, *map(len, parts)])[::each]
