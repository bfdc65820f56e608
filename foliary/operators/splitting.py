"""The sequential part of chunking: one document's text to its parts, as a small helper of the chunking operator's tasks.

Blocks and parts are (path, text, start, end, law), law being None or (chapter, section, article number, its title, its content).
Every step is one pass over the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from foliary import schema as S

#: The forms of headings, tables of contents and covers. \s and \d are ASCII, as in the expressions.
_CHAPTER = re.compile(r"(제\s*\d+\s*장)\s*(.*)", re.A)
_SECTION = re.compile(r"(제\s*\d+\s*절)\s*(.*)", re.A)
_ARTICLE = re.compile(r"(제\s*\d+\s*조(?:\s*의\s*\d+)?)\s*(?:\(([^)]*)\))?\s*(.*)", re.A)
HEADING_FORM = r"(?:[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]\.|[0-9]+(?:\.[0-9]+)*\.|[가-하]\.|[A-Z]\.)\s+.+"
_HEADING = re.compile(HEADING_FORM, re.A)
_TOC_TITLE = re.compile(r"목\s*차|차\s*례|CONTENTS?", re.A | re.I)
_TOC_LINE = re.compile(r".*(?:\.{2,}|…{2,}|\s{3,})(?:\d+|[ivxlcdm]+)\s*", re.A | re.I)
_PARAGRAPH = re.compile(r"\n\s*\n", re.A)
_SENTENCE = re.compile(r"(?<=[!?])|(?<=[^\W_]\.)|(?<=^\.)")
_GAP, _BLANKS = re.compile(r"\s{2,}", re.A), re.compile(r"\s+", re.A)
_ENDING = re.compile("다\\.|요\\.|함\\.|음\\.")
COVER_WORDS = ("기관명", "부서명", "작성일", "작성자", "문서번호", "등록번호", "보고서", "계획서", "검토서", "용역명", "발주처")
ENDINGS = ("다.", "요.", "함.", "음.")
ATTACHMENTS, ATTACHMENT_PATH = ("붙임", "첨부"), "붙임목록"
#: What ends trimmed text: everything up to U+0020.
_EDGE = "".join(map(chr, range(33)))

Part = tuple[str | None, str, int, int, tuple | None]


def _compact(s: str) -> str:
    return _BLANKS.sub(" ", s).strip(_EDGE)


def _full(text: str) -> list[str]:
    return [t for x in text.split("\n") if (t := x.strip(_EDGE))]


def draft_blocks(text: str) -> list[Part]:
    """The letter, and from the first word for attachments on their list."""
    at = next((i for w in ATTACHMENTS if (i := text.find(w)) >= 0), 0)
    if not at:
        return [(None, text, 0, len(text), None)]
    return [(None, text[:at].strip(_EDGE), 0, at, None), (ATTACHMENT_PATH, text[at:].strip(_EDGE), at, len(text), None)]


def _runs(text: str, opens) -> Iterator[tuple[str, str, int, int]]:
    """(first line, text, start, end) of the runs of lines that lines with opens(line) begin."""
    held, start, at = [], 0, 0
    for line in text.split("\n"):
        if held and opens(line.strip(_EDGE)):
            yield held[0], "\n".join(held), start, at
            held, start = [], at
        held.append(line)
        at += len(line) + 1
    yield held[0], "\n".join(held), start, len(text)


def structured_blocks(text: str) -> list[Part]:
    """A block for each heading, named by it."""
    out = []
    for head, body, start, end in _runs(text, _HEADING.fullmatch):
        head = head.strip(_EDGE)
        out.append((head if _HEADING.fullmatch(head) else "", body.strip(_EDGE), start, end, None))
    return out


def law_blocks(text: str) -> list[Part]:
    """A block for each chapter, section and article. A chapter ends the section before it, either ends the article."""
    out, chapter, section = [], None, None
    for head, body, start, end in _runs(text, lambda x: _CHAPTER.fullmatch(x) or _SECTION.fullmatch(x) or _ARTICLE.fullmatch(x)):
        head, body, number, title, content = head.strip(_EDGE), body.strip(_EDGE), None, None, None
        if m := _CHAPTER.fullmatch(head):
            chapter, section = " ".join(filter(None, map(_compact, m.groups()))), None
        elif m := _SECTION.fullmatch(head):
            section = " ".join(filter(None, map(_compact, m.groups())))
        elif m := _ARTICLE.fullmatch(head):
            number, title, lead = _compact(m[1]), (m[2] or "").strip(_EDGE), m[3].strip(_EDGE)
            bare = re.sub(rf"^{re.escape(number)}\s*(?:\({re.escape(title)}\))?\s*", "", body, count=1, flags=re.A).strip(_EDGE)
            content = bare or lead
        path = " > ".join(filter(None, (chapter, section, number)))
        out.append((path, body, start, end, (chapter, section, number, title or None, content)))
    return out


def paragraph_blocks(text: str, size: int) -> list[Part]:
    """Paragraphs packed in order while they fit."""
    out, held, length, start, at = [], [], 0, 0, 0
    for p in _PARAGRAPH.split(text):
        own = p.strip(_EDGE)
        if own:
            if held and length + len(own) > size:
                out.append(("", "\n\n".join(held), start, at, None))
                held, length = [], 0
            if not held:
                start = at
            held.append(own)
            length += len(own) + 2
        at += len(p) + 2
    if held:
        out.append(("", "\n\n".join(held), start, len(text), None))
    return out


def sentences(text: str, size: int) -> Iterator[str]:
    """Trimmed sentences; longer ones than size are cut. A dot ends a sentence after a letter or digit, and at the start."""
    for s in _SENTENCE.split(text):
        s = s.strip(_EDGE)
        for i in range(0, len(s), size):
            yield s[i : i + size]


def oversized(block: Part, size: int, overlap: int, parity: bool = True) -> Iterator[Part]:
    """The block in parts of whole sentences, each of which starts with the end of the one before; their places are approximate.
    parity: a part's text is its article's content, whatever the kind of document; otherwise only articles have one."""
    path, text, begin, end, law = block
    if len(text) <= size:
        yield block
        return

    def part(text: str, start: int, end: int) -> Part:
        own = (law or (None,) * 5)[:4]
        return path, text, start, end, (*own, text if parity or own[2] else None)

    held, length, start, at = [], 0, 0, 0
    for s in sentences(text, size):
        if held and length + len(s) > size:
            own = "".join(held).strip(_EDGE)
            yield part(own, begin + start, begin + at)
            tail = own[-overlap:] if overlap else ""
            held, length, start = [tail] if tail else [], len(tail), max(0, at - len(tail))
        held += s, " "
        length += len(s) + 1
        at += len(s) + 1
    if held:
        yield part("".join(held).strip(_EDGE), begin + start, end)


def table_like(text: str) -> bool:
    """At least five lines, of which five (and a third) have a bar or four columns parted by wide gaps."""
    rows = text.rstrip("\n").split("\n")
    return len(rows) >= 5 and sum("|" in x or len(_GAP.split(re.sub(r"\s{2,}$", "", x, flags=re.A))) >= 4 for x in rows) >= max(5, len(rows) // 3)


def substantive(text: str) -> bool:
    """Short text that is content all the same: a table, two sentences or two long lines."""
    return len(text) >= S.SHORT_CONTENT and (table_like(text) or sum(map(text.count, ".!?")) >= 2 or sum(len(x.strip(_EDGE)) >= 80 for x in text.split("\n")) >= 2)


def contents_table(text: str) -> bool:
    rows = _full(text)
    titles = [x for x in rows if _TOC_TITLE.fullmatch(x)]
    dotted = sum(bool(_TOC_LINE.fullmatch(x)) for x in rows if not _TOC_TITLE.fullmatch(x))
    return not rows or bool(titles and (len(rows) <= 2 or dotted >= 2)) or (dotted >= 4 and dotted >= len(rows) // 2)


def cover(text: str) -> bool:
    if len(text) > S.COVER_CHARS or substantive(text):
        return False
    rows = _full(text)
    return not rows or (not any(x.endswith(ENDINGS) for x in rows) and (len(rows) <= 4 or sum(any(w in x for w in COVER_WORDS) for x in rows) >= 2))


def falls_back(text: str) -> bool:
    """Whether a text all of whose parts are front matter is split all the same."""
    return len(text) > S.COVER_CHARS or substantive(text) or len(_ENDING.findall(text)) >= 3


def split(text: str, kind: str, size: int, overlap: int, parity: bool = True) -> list[Part]:
    """The parts of a normalised text: blocks of its kind, cut to size, without front matter, short ones joined to the one before."""
    if not text:
        return []
    blocks = draft_blocks(text) if kind == "DRAFT" else law_blocks(text) if kind == "LAW" else structured_blocks(text) if kind == "STRUCTURED" else paragraph_blocks(text, size)
    out: list[Part] = []
    for block in blocks:
        for part in oversized(block, size, overlap, parity):
            own = part[1].strip(_EDGE)
            if not own or contents_table(own) or (not out and cover(own)):
                continue
            if out and len(own) < S.MIN_CHUNK:
                path, before, start, end, law = out[-1]
                out[-1] = (path, f"{before}\n\n{own}", start, end, law)
            else:
                out.append(part)
    if not out and falls_back(text):
        out = [part for block in paragraph_blocks(text, size) for part in oversized(block, size, overlap, parity)]
    return out
