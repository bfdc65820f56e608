"""HTML extraction by wrapper induction: the pages of a host are aligned by simple tree matching.

A page becomes a tree of block elements (inline markup is transparent) whose leaves are text blocks. Its *skeleton* is the tree of
labels (tag, id, classes; digits folded), where neighbours of one label and shape are one node. For each host the most
common skeleton is the reference; every other skeleton is aligned with it by simple tree matching, which gives each page's nodes
*slots* of the reference. What a slot says is then counted over the whole host, one page for each content (the marked article,
or without one all blocks that no keyword marks), so copies count once and differing pages each, whatever their headings:

* a block that most of the pages repeat in its slot is constant, hence template: outside marked articles two pages can tell, in
  them (where a sub-heading may recur) LEAST_PAGES;
* a slot outside the article whose blocks nearly all recur on other pages (a rotating advert) is template;
* copies of an article among changing adverts are no evidence: pages that repeat a block must differ in heading or two longest blocks
  (so a host where these are boilerplate on every page gets no wrapper);
* other slots vary and are content.

Where a host has too few pages to tell, and besides, elements that say what they are are template: nav, footer, aside and the like, the
controls of forms, hidden ones, whatever they hold; and forms, roles and telling class names, unless the page's prose lies in them (a wrapper may be
called search-index or be one form around the page, see _standing). Names that begin with has, no, with or without tell of layout and count for
nothing. If the page marks its article (article, main, role, itemprop), content lies there; otherwise it is the deepest
element that holds most of the text that is left, and the title, without link lists.

Corpus-wide work is joins and sums by host, slot and block hash; no host's pages meet in one task. Wrappers (one row a host) are
broadcast if they are few, else joined by shuffle. Null, empty and markup-only pages give an empty text; pages without a
url are one host; repeated rows are extracted each on its own; no rows, no rows. Skeletons stop at MOST_DEPTH levels: deeper elements are
no nodes of their own unless what they say of themselves (template, article) changes what holds there, which counts at any depth
up to MOST_DEPTH such changes on one path. Parsing takes time in proportion to the page, however deep its elements nest.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm.frames import Held, map_text, written

MOST_DEPTH = 48
#: Pages with different contents that a host must have for rotating slots, and for constants in marked articles and elsewhere.
LEAST_PAGES, LEAST_OUTSIDE = 8, 2
#: Share of the host's pages that repeat a constant block, and of a rotating slot's blocks that recur.
CONSTANT, ROTATING = 0.7, 0.8
#: Hosts up to this many are broadcast with their wrappers (a wrapper is a few kB); more are joined by shuffle.
BROADCAST_HOSTS = 10_000

_RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote button canvas caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup label li legend main menu nav noscript object ol optgroup option p pre search section select summary svg table tbody td template tfoot th thead tr ul video audio".split()
)
_CLOSES_P = _BLOCK - frozenset("button canvas label legend noscript object optgroup option select svg template video audio caption tbody td tfoot th thead tr".split())
#: A start tag ends open elements of these tags, up to the nearest of the others.
_ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table", "tbody", "thead", "tfoot"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup"])),
}
_BARRIER = frozenset(["table", "td", "th", "button", "object", "template", "caption"])

#: What elements say of themselves.
DROP_TAGS = frozenset("nav footer aside menu dialog noscript template svg button select label legend object canvas video audio search".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist note status".split())
DROP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner banners sponsor sponsors sponsored promo promos promotion sidebar sidebars widget widgets menu menus nav navbar "
    "navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices notification notifications popup modal overlay newsletter subscribe subscription signup login signin search share sharing "
    "social related recommended recommendations pagination pager skip copyright toolbar paywall outbrain taboola topbar alert disclaimer".split()
)
_TALK_WORDS = frozenset("comment comments commentlist disqus respond replies reply".split())
_HEAD_WORDS = frozenset(["header", "masthead"])
_LAYOUT_WORDS = frozenset(["has", "no", "with", "without"])
#: What an element is by itself. Those from SAYS on hold unless the page's prose lies in the element.
NEUTRAL, DROP, ARTICLE, HEAD, SAYS, TALK, TOP = range(7)
#: Shares of the page's prose that a telling element must hold to be a mere wrapper: with the page's heading or main article in it, and without.
WITH_HEADING, WITHOUT = 3, 1.5

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*+>|<[!?/][^>]*+>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@lru_cache(1 << 14)
def _element(tag: str, attributes: str) -> tuple[str, int]:
    """An element's label, and what it says of itself."""
    if not attributes.strip(" /\t\r\n\f"):
        return tag, ARTICLE if tag in ("article", "main") else HEAD if tag == "header" else DROP if tag in DROP_TAGS else SAYS if tag == "form" else NEUTRAL
    found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
    names = " ".join(found.get(k, "") for k in ("id", "class"))
    marks = ["#" + i for i in found.get("id", "").split()] + ["." + c for c in sorted(found.get("class", "").split())]
    label = re.sub(r"[^a-z0._#-]+", "", (tag + "".join(marks)).lower().translate(_DIGITS))
    words: set[str] = set()
    for name in names.split():
        own = [w.lower() for w in _WORD.findall(name)]
        if own and own[0] not in _LAYOUT_WORDS:
            words.update(own)
    role = found.get("role", "").lower()
    if role in ("main", "article") or found.get("itemprop") == "articleBody" or tag in ("article", "main"):
        kind = TALK if words & _TALK_WORDS else ARTICLE
    elif tag in DROP_TAGS or "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        kind = DROP
    elif tag == "header":
        kind = HEAD
    elif words & _TALK_WORDS:
        kind = TALK
    elif words & _HEAD_WORDS:
        kind = TOP
    else:
        kind = SAYS if tag == "form" or role in DROP_ROLES or words & DROP_WORDS else NEUTRAL
    return label, kind


_DIGITS = str.maketrans("123456789", "000000000")


@dataclass
class Page:
    """Nodes (0 is the root) and blocks: (node, text, characters in links, innermost block element) in page order."""

    labels: list[str] = field(default_factory=lambda: ["root"])
    kinds: list[int] = field(default_factory=lambda: [NEUTRAL])
    parents: list[int] = field(default_factory=lambda: [-1])
    tags: list[str] = field(default_factory=lambda: ["root"])
    blocks: list[tuple[int, str, int, str]] = field(default_factory=list)


class _Open:
    """The open elements of a page, with the places of each tag's: closing one costs what it closes."""

    def __init__(self) -> None:
        self.stack = [("root", 0, NEUTRAL, 0)]  # tag, node, what was last said of what lies there, changes of that beyond MOST_DEPTH
        self.places: dict[str, list[int]] = {}
        self.closers: list[int] = []  # of elements that end a paragraph

    def push(self, tag: str, node: int, said: int, changes: int) -> None:
        at = len(self.stack)
        self.places.setdefault(tag, []).append(at)
        if tag in _CLOSES_P:
            self.closers.append(at)
        self.stack.append((tag, node, said, changes))

    def cut(self, at: int) -> None:
        """Ends all elements from this place on."""
        while len(self.stack) > at:
            self.places[self.stack.pop()[0]].pop()
        while self.closers and self.closers[-1] >= at:
            self.closers.pop()

    def innermost(self, tags: frozenset) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def end(self, tag: str) -> int:
        """The place of what an end tag ends; 0 if nothing."""
        if tag == "p":  # not beyond an element that would have ended it
            at = self.closers[-1] if self.closers else 0
            return at if at and self.stack[at][0] == "p" else 0
        own = self.places.get(tag)
        return own[-1] if own else 0

    def implied(self, tag: str) -> None:
        """Ends what a start tag ends."""
        if tag in _CLOSES_P and (own := self.places.get("p")) and own[-1] > self.innermost(_BARRIER):
            self.cut(own[-1])
        if tag in _ENDS:
            tags, barrier = _ENDS[tag]
            edge = self.innermost(barrier)
            first = [own[bisect_right(own, edge)] for t in tags if (own := self.places.get(t)) and own[-1] > edge]
            if first:
                self.cut(min(first))


def parse(source: str) -> Page:
    page, open_ = Page(), _Open()
    stack, parts, links, in_link, at = open_.stack, [], 0, False, 0
    n, search, last = len(source), _TOKEN.search, source.rfind(">")

    def flush() -> None:
        nonlocal parts, links, in_link
        if parts:
            text = "".join(parts)
            if text and not text.isspace():
                own = " ".join((html.unescape(text) if "&" in text else text).split())
                if own:
                    page.blocks.append((stack[-1][1], own, links, stack[-1][0]))
        parts, links, in_link = [], 0, False

    while at < n:
        m = search(source, at) if at <= last or "<!--" in source[at:] else None
        if m is None:
            parts.append(source[at:])
            break
        if (lo := m.start()) > at:
            parts.append(source[at:lo])
            if in_link:
                links += lo - at
        at, tag = m.end(), m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in _BLOCK:
                if place := open_.end(tag):
                    flush()
                    open_.cut(place)
            elif tag == "a":
                in_link = False
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I).search(source, at)
            at = end.end() if end else n
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "hr":
            flush()
            continue
        if tag == "a":
            in_link = True
            continue
        if tag not in _BLOCK:
            continue
        flush()
        open_.implied(tag)
        label, kind = _element(tag, m[3])
        _, node, above, changes = stack[-1]
        said = above if above == DROP or kind == NEUTRAL else kind
        changed = len(stack) > MOST_DEPTH and said != above
        if len(stack) <= MOST_DEPTH or (changed and changes < MOST_DEPTH):
            page.labels.append(label)
            page.kinds.append(kind)
            page.tags.append(tag)
            page.parents.append(node)
            open_.push(tag, len(page.labels) - 1, said, changes + changed)
        else:
            open_.push(tag, node, above, changes)
    flush()
    return page


def skeleton(page: Page) -> tuple[str, list[int]]:
    """The skeleton, written label(child child), and each node's place in it in preorder."""
    n = len(page.labels)
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        children[page.parents[i]].append(i)
    shape: list[str] = [""] * n
    for i in range(n - 1, -1, -1):
        own, last = [], None
        for c in children[i]:
            if shape[c] != last:
                last = shape[c]
                own.append(last)
        shape[i] = f"{page.labels[i]}({' '.join(own)})" if own else page.labels[i]
    size = [1] * n
    for i in range(n - 1, -1, -1):
        last = None
        for c in children[i]:
            if shape[c] != last:
                last = shape[c]
                size[i] += size[c]
    places = [0] * n
    for i in range(n):
        at, last, own = places[i] + 1, None, 0
        for c in children[i]:
            if last is not None and shape[c] != last:
                at += own
            last, own = shape[c], size[c]
            places[c] = at
    return shape[0], places


def _tree(shape: str) -> tuple[list[str], list[list[int]], list[int]]:
    """Labels, children and subtree sizes of a written skeleton, in preorder."""
    labels, children, stack, last = [], [], [], -1
    for token in re.findall(r"[()]|[^() ]+", shape):
        if token == "(":
            stack.append(last)
        elif token == ")":
            last = stack.pop()
        else:
            last = len(labels)
            labels.append(token)
            children.append([])
            if stack:
                children[stack[-1]].append(last)
    size = [1] * len(labels)
    for i in range(len(labels) - 1, -1, -1):
        size[i] += sum(size[c] for c in children[i])
    return labels, children, size


def match(shape: str, reference: str) -> list[int]:
    """Simple tree matching: the slot (node of the reference) of each node of a skeleton, or -1."""
    la, ca, sa = _tree(shape)
    lb, cb, sb = _tree(reference)
    slots = [-1] * len(la)
    memo: dict[tuple[int, int], int] = {}

    def same(a: int, b: int) -> bool:
        return sa[a] == sb[b] and la[a : a + sa[a]] == lb[b : b + sb[b]] and [len(x) for x in ca[a : a + sa[a]]] == [len(x) for x in cb[b : b + sb[b]]]

    def table(xs: list[int], ys: list[int]) -> list[list[int]]:
        rows = [[0] * (len(ys) + 1)]
        for x in xs:
            row, before = [0], rows[-1]
            for j, y in enumerate(ys):
                row.append(max(before[j + 1], row[j], before[j] + weight(x, y)))
            rows.append(row)
        return rows

    def weight(a: int, b: int) -> int:
        if la[a] != lb[b]:
            return 0
        if (a, b) not in memo:
            memo[a, b] = 1 + table(ca[a], cb[b])[-1][-1]
        return memo[a, b]

    todo = [(0, 0)]
    while todo:
        a, b = todo.pop()
        slots[a] = b
        xs, ys = ca[a], cb[b]
        while xs and ys and same(xs[0], ys[0]):  # equal subtrees at either end always belong together
            todo.append((xs[0], ys[0]))
            xs, ys = xs[1:], ys[1:]
        while xs and ys and same(xs[-1], ys[-1]):
            todo.append((xs[-1], ys[-1]))
            xs, ys = xs[:-1], ys[:-1]
        if not xs or not ys:
            continue
        rows, i, j = table(xs, ys), len(xs), len(ys)
        while i and j:
            w = weight(xs[i - 1], ys[j - 1])
            if w and rows[i][j] == rows[i - 1][j - 1] + w:
                i, j = i - 1, j - 1
                todo.append((xs[i], ys[j]))
            elif rows[i][j] == rows[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return slots


class _Matcher:
    """match() with a bounded memory of what it has met."""

    def __init__(self, most: int = 20_000) -> None:
        self.known: dict[tuple[str, str], list[int]] = {}
        self.most = most

    def __call__(self, shape: str, reference: str) -> list[int]:
        found = self.known.get((shape, reference))
        if found is None:
            if len(self.known) >= self.most:
                self.known.clear()
            found = self.known[shape, reference] = match(shape, reference)
        return found


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _standing(page: Page) -> list[int]:
    """What holds for each node with its ancestors: DROP, ARTICLE or NEUTRAL.

    What an element says by its names, its role or being a form is believed unless it wraps the page's prose (text outside links, not counting what
    is template for certain): it holds the main one of the marked articles, if that is a third of the prose or more; or else the page's heading (an h1
    outside headers) and a third of the prose; or, where no such heading is, two thirds and doesn't speak of comments. Such an element says nothing.
    """
    n, kinds, parents = len(page.labels), page.kinds, page.parents
    if max(kinds, default=NEUTRAL) >= SAYS:
        certain, headed, prose, titled = ([x] * n for x in (False, False, 0, False))
        for i in range(1, n):
            certain[i] = certain[parents[i]] or kinds[i] == DROP
        for node, text, links, _ in page.blocks:
            if not certain[node]:
                prose[node] += max(len(text) - links, 0)
        for i in range(n - 1, 0, -1):
            prose[parents[i]] += prose[i]
        for i in range(1, n):
            headed[i] = headed[parents[i]] or kinds[i] == HEAD or (kinds[i] == TOP and WITH_HEADING * prose[i] < prose[0])
        for node, _, _, tag in page.blocks:
            titled[node] |= tag == "h1" and not certain[node] and not headed[node]
        for i in range(n - 1, 0, -1):
            titled[parents[i]] |= titled[i]
        marked = [i for i in range(1, n) if kinds[i] == ARTICLE and not certain[i]]
        core, wraps = max(marked, key=lambda i: (prose[i], -i), default=0), set()
        if core and WITH_HEADING * prose[core] >= prose[0]:
            at = core
            while at:
                wraps.add(at)
                at = parents[at]
        else:
            core = 0

        def wrapper(i: int) -> bool:
            if core:
                return i in wraps
            if titled[0]:
                return titled[i] and WITH_HEADING * prose[i] >= prose[0]
            return kinds[i] != TALK and WITHOUT * prose[i] >= prose[0] > 0

        kinds = [NEUTRAL if k >= SAYS and wrapper(i) else k for i, k in enumerate(kinds)]
    out = [NEUTRAL]
    for kind, parent in zip(kinds[1:], parents[1:], strict=True):
        above = out[parent]
        if above == DROP or kind in (DROP, SAYS, TALK):
            out.append(DROP)
        elif kind in (HEAD, TOP):
            out.append(above if above == ARTICLE else DROP)
        else:
            out.append(kind if kind == ARTICLE else above)
    return out


_SEEN = "array<struct<node:int,hash:bigint,inside:boolean>>"
_SEEN_ARROW = pa.list_(pa.struct([("node", pa.int32()), ("hash", pa.int64()), ("inside", pa.bool_())]))


def _shapes(pages: DataFrame, source: str) -> DataFrame:
    """host, shape, said (hash of the page's content), gist (hash of its heading and two longest blocks) and seen (the places of its blocks, and whether they lie in a marked article)."""

    def make():
        def kernel(texts):
            shapes, said, gists, seen = [], [], [], []
            for t in texts:
                page = parse(t.as_py().decode("utf-8", "replace"))
                shape, places = skeleton(page)
                standing = _standing(page)
                own = {(places[node], _hash(text), standing[node] == ARTICLE) for node, text, *_ in page.blocks}
                open_ = [(node, text, tag) for node, text, _, tag in page.blocks if standing[node] != DROP]
                marked = [b for b in open_ if standing[b[0]] == ARTICLE]
                if 4 * sum(len(b[1]) for b in marked) >= sum(len(b[1]) for b in open_):  # as content() asks
                    open_ = marked
                told = [b[1] for b in open_] or [b[1] for b in page.blocks]
                lead = next((text for _, text, tag in open_ if tag == "h1"), told[0] if told else "")
                shapes.append(shape)
                said.append(_hash("\n\n".join(told)))
                gists.append(_hash("\n\n".join([lead, *sorted(set(told), key=lambda t: (-len(t), t))[:2]])))
                seen.append([{"node": a, "hash": b, "inside": c} for a, b, c in sorted(own)])
            return [pa.array(shapes, pa.string()), pa.array(said, pa.int64()), pa.array(gists, pa.int64()), pa.array(seen, _SEEN_ARROW)]

        return kernel

    return map_text(pages, make, [("shape", "string"), ("said", "bigint"), ("gist", "bigint"), ("seen", _SEEN)], text=source, keep=("host",))


def _by_host(rows: DataFrame, table: DataFrame) -> DataFrame:
    """rows beside the host's row of a written table (with `rows`, the host's pages): by broadcast if the hosts are few. Otherwise those
    with more than a BROADCAST_HOSTS-th of all pages, which are fewer than that, are broadcast, and their rows spread over the
    shuffle that joins the others."""
    n, total = table.agg(F.count("*"), F.sum("rows")).first()
    if n <= BROADCAST_HOSTS:
        return rows.join(F.broadcast(table), "host", "left")
    names = [c for c in table.columns if c != "host"]
    hot = table.where(F.col("rows") > total // BROADCAST_HOSTS).select("host", *[F.col(c).alias(f"hot_{c}") for c in names])
    first = rows.join(F.broadcast(hot), "host", "left")
    known = F.col("hot_rows").isNotNull()
    key = F.when(known, F.concat(F.lit("#"), F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16)).cast("string"))).otherwise(F.col("host"))
    rest = table.select(F.col("host").alias("own"), *[F.col(c).alias(f"own_{c}") for c in names])
    both = first.withColumn("key", key).join(rest, F.col("key") == F.col("own"), "left")
    return both.select(*rows.columns, *[F.when(known, F.col(f"hot_{c}")).otherwise(F.col(f"own_{c}")).alias(c) for c in names])


def induce(pages: DataFrame, *, url: str = "url", source: str = "html") -> DataFrame:
    """One row for each host: host, reference, rows (its pages), template (slots) and constant (array<struct<slot, hash>>)."""
    held = Held(pages.sparkSession)
    shapes = held(_shapes(_hosted(pages, url, source), source))
    distinct = held(shapes.groupBy("host", "said").agg(F.min(F.struct("shape", "seen", "gist")).alias("p"), F.count("*").alias("copies")).select("host", "copies", "p.*"))
    common = distinct.groupBy("host", "shape").agg(F.count("*").alias("n"), F.sum("copies").alias("copies"))
    reference = held(common.groupBy("host").agg(F.max_by("shape", F.struct("n", "shape")).alias("reference"), F.sum("n").alias("pages"), F.sum("copies").alias("rows")))
    placed = _by_host(distinct, reference).where(F.col("pages") >= LEAST_OUTSIDE).select("host", "shape", "reference", "pages", "gist", "seen")

    def run(batches):
        matcher = _Matcher()
        for batch in batches:
            host, shape, ref, pages, gist, seen = (batch.column(i).to_pylist() for i in range(6))
            out = [(h, p, g, slot, s["hash"], s["inside"]) for h, x, r, p, g, own in zip(host, shape, ref, pages, gist, seen, strict=True) for slots in (matcher(x, r),) for s in own if (slot := slots[s["node"]]) >= 0]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_()))], names=["host", "pages", "gist", "slot", "hash", "inside"])

    blocks = placed.mapInArrow(run, "host string, pages bigint, gist bigint, slot int, hash bigint, inside boolean")
    counts = blocks.groupBy("host", "slot", "hash").agg(F.count("*").alias("n"), F.max("pages").alias("pages"), F.max("inside").alias("inside"), (F.min("gist") < F.max("gist")).alias("varied"))
    constant = F.col("varied") & (F.col("n") >= F.col("pages") * CONSTANT) & (~F.col("inside") | (F.col("pages") >= LEAST_PAGES))
    slots = counts.groupBy("host", "slot").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("varied"), F.col("n")).otherwise(0)).alias("again"), F.max("inside").alias("inside"), F.collect_list(F.when(constant, F.struct("slot", "hash"))).alias("constant"))
    rotating = ~F.col("inside") & (F.col("again") >= F.col("all") * ROTATING) & (F.col("all") >= LEAST_PAGES)
    found = slots.groupBy("host").agg(F.collect_list(F.when(rotating, F.col("slot"))).alias("template"), F.flatten(F.collect_list("constant")).alias("constant"))
    wrappers = written(reference.join(found, "host", "left").select("host", "reference", "rows", F.coalesce("template", F.array().cast("array<int>")).alias("template"), F.coalesce("constant", F.array().cast("array<struct<slot:int,hash:bigint>>")).alias("constant")))
    held.clear()
    return wrappers


def _hosted(pages: DataFrame, url: str, source: str, *more: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(*[F.col(f"`{c}`") for c in more], host.alias("host"), F.col(f"`{source}`").cast("string").alias(source))


def content(page: Page, template: frozenset[int] = frozenset(), constant: frozenset[tuple[int, int]] = frozenset(), slots: Sequence[int] = (), places: Sequence[int] = ()) -> str:
    """The main text of a parsed page, given its host's wrapper and the slot of each place of its skeleton."""
    standing, kept = _standing(page), []
    hidden = [False] * len(page.labels)
    for i in range(len(page.labels)):
        slot = slots[places[i]] if slots else -1
        hidden[i] = (i > 0 and hidden[page.parents[i]]) or slot in template
    for block in page.blocks:
        node, text, *_ = block
        if standing[node] == DROP or hidden[node]:
            continue
        if constant and (slot := slots[places[node]]) >= 0 and (slot, _hash(text)) in constant:
            continue
        kept.append(block)
    marked = [b for b in kept if standing[b[0]] == ARTICLE]
    size = sum(len(b[1]) for b in kept)
    if 4 * sum(len(b[1]) for b in marked) >= size:
        return "\n\n".join(b[1] for b in marked)
    prose = [b for b in kept if 5 * b[2] < 3 * len(b[1]) or b[3] in ("p", "h1", "h2", "h3", "blockquote", "pre")]
    held, size = [0] * len(page.labels), sum(len(b[1]) for b in prose)
    for node, text, *_ in prose:
        held[node] += len(text)
    for i in range(len(held) - 1, 0, -1):
        held[page.parents[i]] += held[i]
    root, above = 0, next((b[0] for b in prose if b[3] == "h1"), 0)  # the title stays inside
    path = {0}
    while above:
        path.add(above)
        above = page.parents[above]
    for i in range(1, len(held)):  # parents come before children, so this walks down the one path that holds most
        if page.parents[i] == root and 5 * held[i] >= 4 * size and page.tags[i] not in ("p", "li", "td") and (len(path) == 1 or i in path):
            root = i
    inside = [False] * len(held)
    for at in range(len(held)):
        inside[at] = at == root or (at > 0 and inside[page.parents[at]])
    return "\n\n".join(text for node, text, *_ in prose if inside[node])


def extract(pages: DataFrame, wrappers: DataFrame, *, url: str = "url", source: str = "html", keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """Columns `keep` and text (never null) of every page."""
    alias = {k: f"__{i}" for i, k in enumerate(keep)}
    given = pages.select(*[F.col(f"`{k}`").alias(a) for k, a in alias.items()], F.col(f"`{url}`").alias("__url"), F.col(f"`{source}`").alias("__html"))
    rows = _by_host(_hosted(given, "__url", "__html", *alias.values()), wrappers)
    wrapper = ("reference", "template", "constant")
    n = len(alias)

    def run(batches):
        matcher, known = _Matcher(), {}
        for batch in batches:
            texts = []
            for host, source, reference, template, constant in zip(*(batch.column(i) for i in range(n, n + 5)), strict=True):
                page = parse(source.as_py() or "")
                if not reference.is_valid:
                    texts.append(content(page))
                    continue
                if (name := host.as_py()) not in known:
                    if len(known) >= 1000:
                        known.clear()
                    known[name] = (reference.as_py(), frozenset(template.as_py()), frozenset((c["slot"], c["hash"]) for c in constant.as_py()))
                ref, fixed, same = known[name]
                if not fixed and not same:
                    texts.append(content(page))
                    continue
                shape, places = skeleton(page)
                texts.append(content(page, fixed, same, matcher(shape, ref), places))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string())], names=[*alias.values(), "__text"])

    ordered = rows.select(*alias.values(), "host", "__html", *wrapper)
    schema = ordered.select(*alias.values(), F.lit("").alias("__text")).schema
    return ordered.mapInArrow(run, schema).select(*[F.col(a).alias(k) for k, a in alias.items()], F.col("__text").alias("text"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, induce(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
