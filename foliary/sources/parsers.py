"""Text of single files: web pages, HWPX, Office XML and plain text (PDF and binary HWP have modules of their own). Small helpers of foliary.sources.files, which runs them in tasks."""

from __future__ import annotations

import contextlib
import io
import re
import signal
import threading
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

from foliary.sources import hwp, pdf

#: Elements whose text goes, and those that stand in lines of their own.
HIDDEN = frozenset(["script", "style", "noscript", "head"])
BLOCKS = frozenset("div p section article header footer h1 h2 h3 h4 h5 h6 ul ol li tr".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_ENDS = {"li": ("li",), "p": ("p",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_SCOPE = frozenset(["table", "ul", "ol", "body"])


class ParseError(Exception):
    """A file that can't be read: code and message."""

    def __init__(self, code: str, message: str) -> None:
        super().__init__(message)
        self.code = code


class _Node:
    __slots__ = ("children", "tag", "tables", "text")

    def __init__(self, tag: str, tables: int = 0) -> None:
        self.tag, self.children, self.tables, self.text = tag, [], tables, ""


class _Tree(HTMLParser):
    """Elements as they nest; the places of open ones are kept by tag, so an end costs what it ends."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("body")
        self.stack = [self.root]
        self.places: dict[str, list[int]] = {"body": [0]}

    def _cut(self, at: int) -> None:
        while len(self.stack) > at:
            self.places[self.stack.pop().tag].pop()

    def _last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("html", "body"):
            return
        ended = self._last(_ENDS.get(tag, ("p",) if tag in BLOCKS or tag == "table" else ()))
        if ended > self._last(_SCOPE):
            self._cut(ended)
        above = self.stack[-1]
        node = _Node(tag, above.tables + (tag == "table"))
        above.children.append(node)
        if tag not in _VOID:
            self.places.setdefault(tag, []).append(len(self.stack))
            self.stack.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.stack[-1].children.append(_Node(tag, self.stack[-1].tables + (tag == "table")))

    def handle_endtag(self, tag: str) -> None:
        if tag not in ("html", "body") and self.places.get(tag):
            self._cut(self.places[tag][-1])

    def handle_data(self, data: str) -> None:
        self.stack[-1].children.append(data)


#: A table within so many tables is text like any other: each of them repeats the rows of those within.
MOST_TABLES = 8


def _tidy(s: str) -> str:
    s = re.sub(r"[ \t\x0b\f\r]+", " ", s)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r" *\n *", "\n", s)).strip()


def _one_line(s: str) -> str:
    return re.sub(r"\s+", " ", s).strip()


def _is_table(node: _Node) -> bool:
    return node.tag == "table" and node.tables <= MOST_TABLES


def _text(node: _Node) -> str:
    """Inline text joined by one blank, blocks in lines of their own, tables as rows; the elements within have their text already."""
    told = [c for c in node.children if not isinstance(c, str) or not c.isspace()]
    if len(told) == 1 and isinstance(told[0], _Node) and told[0].tag not in ("br", "table", *HIDDEN):
        return told[0].text
    out: list[str] = []
    last = ""  # the last character written

    def add(s: str) -> None:
        nonlocal last
        out.append(s)
        last = s[-1]

    for child in told:
        if isinstance(child, str) or (child.tag not in BLOCKS and child.tag not in ("table", "br", *HIDDEN)):
            own = _one_line(child) if isinstance(child, str) else child.text.strip()
            if own:
                add(("" if not last or last in "\n " else " ") + own)
        elif child.tag == "br":
            add("\n")
        elif child.tag not in HIDDEN:
            own = child.text.strip()
            if own:
                add(("" if not last or last == "\n" else "\n") + own + "\n")
    return _tidy("".join(out))


def _find(node: _Node, tags: tuple[str, ...], deep: bool = True) -> list[_Node]:
    found, todo = [], [c for c in reversed(node.children) if isinstance(c, _Node)]
    while todo:
        child = todo.pop()
        if child.tag in tags:
            found.append(child)
        if deep:
            todo += [c for c in reversed(child.children) if isinstance(c, _Node)]
    return found


def _table(node: _Node) -> str:
    """A line for each row, also of tables within: cells with text, parted by a bar."""
    rows = []
    for row in _find(node, ("tr",)):
        cells = _find(row, ("td", "th"), deep=False) or _find(row, ("td", "th"))
        if own := [t for c in cells if (t := _one_line(c.text))]:
            rows.append(" | ".join(own))
    return "\n".join(rows)


def web_page(content: bytes) -> str:
    tree = _Tree()
    tree.feed(content.decode("utf-8", "replace"))
    tree.close()
    order, todo = [], [tree.root]
    while todo:  # however deep elements nest
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if isinstance(c, _Node) and c.tag not in HIDDEN]
    for node in reversed(order):  # what lies within comes first
        node.text = _table(node) if _is_table(node) else _text(node)
    return tree.root.text


def _xml(archive: zipfile.ZipFile, name: str) -> ElementTree.Element:
    data = archive.read(name)
    if b"<!DOCTYPE" in data[:4096] or b"<!ENTITY" in data[:4096]:
        raise ParseError("INVALID_DOCUMENT_FORMAT", f"{name} declares entities")
    return ElementTree.fromstring(data)


def _local(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2]


def _numbered(archive: zipfile.ZipFile, pattern: str) -> list[str]:
    found = [(int(m[1] or 0), n) for n in archive.namelist() if (m := re.fullmatch(pattern, n))]
    return [n for _, n in sorted(found)]


def hwpx(content: bytes) -> str:
    """Paragraphs in lines, cells parted by tabs, rows in lines."""

    def walk(e: ElementTree.Element) -> str:
        kind = _local(e)
        if kind == "t":
            return (e.text or "") + "".join(walk(x) + (x.tail or "") for x in e)
        if kind == "tab":
            return "\t"
        if kind == "lineBreak":
            return "\n"
        if kind == "tr":
            return "\t".join(walk(x).strip("\n") for x in e) + "\n"
        return "".join(map(walk, e)) + ("\n" if kind == "p" else "")

    with zipfile.ZipFile(io.BytesIO(content)) as z:
        return "".join(walk(_xml(z, n)) for n in _numbered(z, r"Contents/section(\d+)\.xml"))


def word(content: bytes) -> str:
    def walk(e: ElementTree.Element) -> str:
        kind = _local(e)
        if kind == "t":
            return e.text or ""
        if kind in ("tab", "br"):
            return "\t" if kind == "tab" else "\n"
        if kind == "tr":
            return "\t".join(walk(x).strip("\n") for x in e if _local(x) == "tc") + "\n"
        return "".join(map(walk, e)) + ("\n" if kind == "p" else "")

    with zipfile.ZipFile(io.BytesIO(content)) as z:
        return walk(_xml(z, "word/document.xml"))


def excel(content: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = ["".join(t.text or "" for t in e.iter() if _local(t) == "t") for e in _xml(z, "xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in z.namelist() else []
        out = []
        for name in _numbered(z, r"xl/worksheets/sheet(\d+)\.xml"):
            for row in (e for e in _xml(z, name).iter() if _local(e) == "row"):
                cells = []
                for c in row:
                    own = "".join(x.text or "" for x in c.iter() if _local(x) in ("v", "t"))
                    cells.append(shared[int(own)] if c.get("t") == "s" and own else own)
                out.append("\t".join(cells))
        return "\n".join(out)


def slides(content: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        found = (("".join(t.text or "" for t in p.iter() if _local(t) == "t")) for n in _numbered(z, r"ppt/slides/slide(\d+)\.xml") for p in _xml(z, n).iter() if _local(p) == "p")
        return "\n".join(x for x in found if x)


def plain(content: bytes) -> str:
    for charset in ("utf-8-sig", "cp949"):
        try:
            return content.decode(charset)
        except UnicodeDecodeError:
            continue
    return content.decode("utf-8", "replace")


Parsers = dict[str, tuple[str, Callable[[bytes], str]]]
#: By extension: media type and parser.
PARSERS: Parsers = {
    "hwp": ("application/x-hwp", hwp.text),
    "pdf": ("application/pdf", pdf.text),
    "hwpx": ("application/hwp+zip", hwpx),
    "html": ("text/html", web_page),
    "htm": ("text/html", web_page),
    "docx": ("application/vnd.openxmlformats-officedocument.wordprocessingml.document", word),
    "xlsx": ("application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", excel),
    "pptx": ("application/vnd.openxmlformats-officedocument.presentationml.presentation", slides),
    "txt": ("text/plain", plain),
    "csv": ("text/csv", plain),
}


def register(extension: str, media_type: str, parser: Callable[[bytes], str]) -> None:
    """Adds a parser for runs that start from here on; they take the parsers to their tasks."""
    PARSERS[extension.lower()] = (media_type, parser)


def _kind(name: str, content: bytes, known: Parsers) -> str:
    """The extension that decides (an HWP document may be of the zipped kind), else what the first bytes say."""
    ext = name.rpartition(".")[2].lower() if "." in name else ""
    if ext == "hwp" and content.startswith(b"PK"):
        return "hwpx"
    if ext in known:
        return ext
    head = content[:512].lstrip().lower()
    if head.startswith((b"<!doctype html", b"<html")):
        return "html"
    if head.startswith(b"%pdf"):
        return "pdf"
    if content[:8] == b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1":
        return "hwp" if "HWP Document File".encode() in content else "ole"
    return "txt" if b"\0" not in content[:4096] else ext or "bin"


@contextlib.contextmanager
def _limit(seconds: float) -> Iterator[None]:
    """Raises ParseError after so many seconds, in the worker's main thread (elsewhere there is no limit)."""
    if threading.current_thread() is not threading.main_thread():
        yield
        return

    def stop(*_) -> None:
        raise ParseError("EXTRACT_TIMEOUT", f"no result after {seconds:g} s")

    before = signal.signal(signal.SIGALRM, stop)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


#: Folders of pictures in zipped formats, and how pictures begin.
_MEDIA = re.compile(r"(?:word/media|xl/media|ppt/media|BinData)/[^/]+")
_PICTURES = (b"\x89PNG\r\n\x1a\n", b"\xff\xd8\xff", b"GIF8", b"BM")


def images(content: bytes | None) -> list[dict]:
    """seq (from 1) and data of the pictures in a zipped document; what isn't a picture takes no number."""
    try:
        with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
            found = [d for n in sorted(z.namelist()) if _MEDIA.fullmatch(n) and (d := z.read(n)).startswith(_PICTURES)]
    except Exception:  # a file without pictures, then
        found = []
    return [{"seq": i, "data": d} for i, d in enumerate(found, 1)]


def extract(name: str, content: bytes | None, seconds: float = 60, known: Parsers = PARSERS) -> dict:
    """status, code, message, media_type, contents of one file by the parsers known; never raises, and gives up after so many seconds."""
    if content is None:
        return {"status": "FAIL", "code": "FILE_NOT_FOUND", "message": f"no such file: {name}", "media_type": None, "contents": None}
    kind = _kind(name or "", content, known)
    media, parser = known.get(kind, (None, None))
    try:
        if parser is None:
            raise ParseError("UNSUPPORTED_FORMAT", f"there is no parser for {kind}")
        with _limit(seconds):
            text = parser(content)
        return {"status": "PASS", "code": None, "message": None, "media_type": media, "contents": text}
    except ParseError as e:
        code, message = e.code, str(e)
    except hwp.Unreadable as e:
        code, message = "UNSUPPORTED_FORMAT", str(e)
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError) as e:
        code, message = "INVALID_DOCUMENT_FORMAT", f"{type(e).__name__}: {e}"
    except Exception as e:  # a row, not the run, fails
        while e.__cause__ is not None:
            e = e.__cause__
        code, message = "PDF_PARSE_FAILED" if kind == "pdf" else "PARSE_FAILED", f"{type(e).__name__}: {e}"
    return {"status": "FAIL", "code": code, "message": message[:2000], "media_type": media, "contents": None}


def opened(content: bytes | None) -> Iterator[dict]:
    """Files of an archive, one at a time: seq from 1, base name, content; or one row with seq 0 and what is wrong. Names are read as CP949."""
    none = {"seq": 0, "name": None, "content": None, "code": None, "message": None}
    if content is None:
        yield none | {"code": "FILE_NOT_FOUND", "message": "no such archive"}
        return
    try:
        with zipfile.ZipFile(io.BytesIO(content), metadata_encoding="cp949") as z:
            n = 0
            for info in z.infolist():
                name = re.split(r"[/\\]", info.filename.rstrip())[-1].strip()
                if info.is_dir() or not name:
                    continue
                n += 1
                row = none | {"seq": n, "name": name}
                try:
                    row["content"] = z.read(info)
                except Exception as e:
                    row |= {"code": "ZIP_ENTRY_FAILED", "message": f"{type(e).__name__}: {e}"[:2000]}
                yield row
            if not n:
                yield none | {"code": "EMPTY_ZIP", "message": "the archive holds no file"}
    except Exception as e:
        yield none | {"code": "ZIP_FAILED", "message": f"{type(e).__name__}: {e}"[:2000]}


def entries(content: bytes | None) -> list[dict]:
    """The files of an archive as a list."""
    return list(opened(content))


def packed(name: str | None, text: str | None) -> bytes:
    """An archive of one text file."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(f"{name}.txt", text or "")
    return out.getvalue()
