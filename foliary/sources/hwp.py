"""Text of binary HWP documents: streams of a compound file, and the paragraph records in them."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

#: Fixed values of the public formats: ends of chains, the record of a paragraph's text, control codes by the units that they take.
_END, _FREE = 0xFFFFFFFE, 0xFFFFFFFF
_PARA_TEXT = 67
_ONE_UNIT = frozenset([0, 10, 13, *range(24, 32)])
_CODE_TEXT = {9: "\t", 10: "\n", 24: "-", 30: " ", 31: " "}
#: Bound on the bytes of one inflated section.
MOST_BYTES = 256 << 20


class Unreadable(ValueError):
    """A file whose text can't be had."""


class Compound:
    """Streams of a compound file by their path."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1":
            raise Unreadable("no compound file")
        self.data, self.size, self.small = data, 1 << struct.unpack_from("<H", data, 30)[0], 1 << struct.unpack_from("<H", data, 32)[0]
        first_dir, self.cutoff, first_mini, _, difat, n_difat = struct.unpack_from("<I4xIIIII", data, 48)
        where = list(struct.unpack_from("<109I", data, 76))
        for _ in range(min(n_difat, len(data) // self.size)):
            if difat >= _END:
                break
            more = struct.unpack(f"<{self.size // 4}I", self._sector(difat))
            where += more[:-1]
            difat = more[-1]
        self.fat = [x for s in where if s < _END for x in struct.unpack(f"<{self.size // 4}I", self._sector(s))]
        mini = b"".join(self._sector(s) for s in self._chain(self.fat, first_mini))
        self.mini_fat = list(struct.unpack(f"<{len(mini) // 4}I", mini))
        entries = b"".join(self._sector(s) for s in self._chain(self.fat, first_dir))
        self.nodes = [entries[i : i + 128] for i in range(0, len(entries) - 127, 128)]
        root = struct.unpack_from("<IQ", self.nodes[0], 116)
        self.ministream = b"".join(self._sector(s) for s in self._chain(self.fat, root[0]))
        self.streams: dict[str, tuple[int, int]] = {}
        self._walk(struct.unpack_from("<I", self.nodes[0], 76)[0], "")

    def _sector(self, n: int) -> bytes:
        at = (n + 1) * self.size
        return self.data[at : at + self.size].ljust(self.size, b"\0")

    @staticmethod
    def _chain(table: list[int], n: int) -> Iterator[int]:
        for _ in range(len(table)):
            if n >= len(table):
                return
            yield n
            n = table[n]

    def _walk(self, first: int, path: str) -> None:
        todo, seen = [(first, path)], set()
        while todo:
            n, path = todo.pop()
            if n >= len(self.nodes) or n in seen:
                continue
            seen.add(n)
            node = self.nodes[n]
            name = node[: max(struct.unpack_from("<H", node, 64)[0] - 2, 0)].decode("utf-16-le", "replace")
            left, right, child = struct.unpack_from("<3I", node, 68)
            start, size = struct.unpack_from("<IQ", node, 116)
            if node[66] == 2:
                self.streams[path + name] = (start, size)
            todo += [(left, path), (right, path), (child, f"{path}{name}/")]

    def read(self, path: str) -> bytes:
        start, size = self.streams[path]
        if size < self.cutoff:
            parts = [self.ministream[s * self.small : (s + 1) * self.small] for s in self._chain(self.mini_fat, start)]
        else:
            parts = [self._sector(s) for s in self._chain(self.fat, start)]
        return b"".join(parts)[:size]


def _paragraph(body: bytes) -> str:
    out, units, i = [], struct.unpack(f"<{len(body) // 2}H", body[: len(body) // 2 * 2]), 0
    held: list[int] = []
    while i < len(units):
        if units[i] > 31:
            held.append(units[i])
            i += 1
            continue
        out += [struct.pack(f"<{len(held)}H", *held).decode("utf-16-le", "replace"), _CODE_TEXT.get(units[i], "")]
        held, i = [], i + (1 if units[i] in _ONE_UNIT else 8)
    out.append(struct.pack(f"<{len(held)}H", *held).decode("utf-16-le", "replace"))
    return "".join(out)


def paragraphs(body: bytes) -> Iterator[str]:
    """The text of each paragraph of a section, those of tables and boxes in their order."""
    at = 0
    while at + 4 <= len(body):
        (head,) = struct.unpack_from("<I", body, at)
        tag, size, at = head & 1023, head >> 20, at + 4
        if size == 4095:
            size, at = struct.unpack_from("<I", body, at)[0], at + 4
        if tag == _PARA_TEXT:
            yield _paragraph(body[at : at + size])
        at += size


def text(content: bytes) -> str:
    """All sections' paragraphs, a line each."""
    file = Compound(content)
    if "FileHeader" not in file.streams:
        raise Unreadable("no HWP document")
    (flags,) = struct.unpack_from("<I", file.read("FileHeader"), 36)
    if flags & 2:
        raise Unreadable("the document has a password")
    sections = sorted((int(m[1]), name) for name in file.streams if (m := re.fullmatch(r"BodyText/Section(\d+)", name)))
    out = []
    for _, name in sections:
        body = file.read(name)
        out += paragraphs(zlib.decompressobj(-15).decompress(body, MOST_BYTES) if flags & 1 else body)
    return "\n".join(out)
