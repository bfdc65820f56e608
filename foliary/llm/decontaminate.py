"""Benchmark decontamination: a broadcast hash set of normalised test n-grams scanned over every training window.

Words are runs of digits, letters and non-ASCII characters after A-Z are lower-cased. Each `n` consecutive words of a
benchmark item are a window; an item of fewer words (not none) is one window of its own length. A worker looks up the
rolling hash of every document window in the set, then compares the words themselves, so a hit is never a hash
collision. The set is broadcast in blocks of at most `block_windows` windows (a proven bound: about 60 MB); a larger
benchmark's blocks are all looked up, one loaded after the other, in a single pass over the documents, so each row has its
hits of the whole benchmark without a join.

Null or empty texts have no words; a null item id counts as no item, though its windows still hit; repeated items and
repeated documents are each taken as they are; empty tables give no hits or no rows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm.frames import aside, map_text
from foliary.llm.kernels import Words, covered

WORDS = 10
BLOCK_WINDOWS = 200_000
_BITS = 20


def _packed(parts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The parts, one after the other, and the n + 1 offsets in them."""
    return b"".join(parts), np.cumsum([0, *(len(p) for p in parts)])


class WindowSet:
    """Windows by length and hash: for each, the words and the items that hold it."""

    def __init__(self) -> None:
        self.by: dict[int, dict[tuple[int, bytes], set[str]]] = defaultdict(lambda: defaultdict(set))

    def add(self, length: int, h: int, words: bytes, item: str | None) -> None:
        found = self.by[length][h, words]
        if item is not None:
            found.add(item)

    def lookup(self) -> dict[int, tuple]:
        """By window length: the windows' hashes in order; their words, packed; their items, packed, the items' offsets and where each window's begin.

        Flat arrays, which a worker loads about as fast as it copies them.
        """
        out = {}
        for length, found in self.by.items():
            windows = sorted(found)
            items = [sorted(found[w]) for w in windows]
            out[length] = (np.array([h for h, _ in windows], np.uint64), *_packed([w for _, w in windows]), *_packed([i.encode("utf-8") for x in items for i in x]), np.cumsum([0, *map(len, items)]))
        return out


def _windows_of(benchmark: DataFrame, n: int, item: str, text: str) -> DataFrame:
    """A row for each window of each item: item, length, hash (as signed long), words."""

    def make():
        def kernel(texts):
            words = Words(texts)
            h = words.hashes()
            out = [[] for _ in range(len(texts))]
            for k in sorted({n, *words.count[(words.count > 0) & (words.count < n)].tolist()}):
                g, at = words.windows(h, k)
                own = np.searchsorted(words.first, at, "right") - 1
                for x, i, d in zip(g.tolist(), at.tolist(), own.tolist(), strict=True):
                    if k == n or words.count[d] == k:
                        out[d].append({"length": k, "hash": np.int64(np.uint64(x)).item() if x < 1 << 63 else x - (1 << 64), "words": words.text(i, k)})
            return [pa.array(out, pa.list_(pa.struct([("length", pa.int32()), ("hash", pa.int64()), ("words", pa.binary())])))]

        return kernel

    rows = map_text(benchmark, make, [("windows", "array<struct<length:int,hash:bigint,words:binary>>")], text=text, keep=(item,))
    return rows.select(F.col(f"`{item}`").cast("string").alias("item"), F.explode("windows").alias("w")).select("item", "w.*")


def _blocks(windows: DataFrame, most: int) -> Iterator[WindowSet]:
    """The windows in sets of at most `most`, streamed to the driver one partition at a time."""
    held, n = WindowSet(), 0
    for r in windows.toLocalIterator():
        held.add(r["length"], r["hash"] % (1 << 64), bytes(r["words"]), r["item"])
        n += 1
        if n >= most:
            yield held
            held, n = WindowSet(), 0
    if n:
        yield held


def _sent(documents: DataFrame, benchmark: DataFrame, n: int, item: str, text: str, most: int) -> list[Broadcast]:
    """The benchmark's windows, broadcast in blocks of at most `most`."""
    context = documents.sparkSession.sparkContext
    return [context.broadcast(block.lookup()) for block in _blocks(_windows_of(benchmark, n, item, text), most)]


def _loaded(blocks: list[Broadcast]) -> Iterator[dict[int, tuple]]:
    """The blocks one after the other; a worker keeps a lone block, and of more it holds two at most."""
    for block in blocks:  # a value that Spark has put there already (it does so where it encrypts) costs no second one
        yield block.value if len(blocks) == 1 or hasattr(block, "_value") else block.load_from_path(block._path)


def _scan(words: Words, blocks: list[Broadcast]) -> tuple[np.ndarray, np.ndarray, list[set]]:
    """Starts and lengths (in words) of verified hits of every block, and each text's items."""
    h = words.hashes()
    windows = lru_cache(None)(lambda k: words.windows(h, k))
    starts, lengths, items = [], [], [set() for _ in words.count]
    for lookup in _loaded(blocks):
        for k, (hashes, held, ends, names, stops, own) in lookup.items():
            g, at = windows(k)
            bits = np.zeros(1 << _BITS, bool)
            bits[hashes >> np.uint64(64 - _BITS)] = True
            maybe = np.flatnonzero(bits[g >> np.uint64(64 - _BITS)])
            lo, hi = (np.searchsorted(hashes, g[maybe], side) for side in ("left", "right"))
            for j in np.flatnonzero(lo < hi).tolist():
                i = int(at[maybe[j]])
                said = words.text(i, k)
                for w in range(int(lo[j]), int(hi[j])):
                    if held[ends[w] : ends[w + 1]] == said:
                        starts.append(i)
                        lengths.append(k)
                        items[int(np.searchsorted(words.first, i, "right")) - 1].update(names[stops[x] : stops[x + 1]].decode("utf-8") for x in range(int(own[w]), int(own[w + 1])))
    return np.array(starts, np.int64), np.array(lengths, np.int64), items


_RANGES = "array<struct<start:bigint,end:bigint>>"
_FIELDS = [("n_words", "bigint"), ("items", "array<string>"), ("hits", _RANGES)]
_RANGES_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _runs(hit: np.ndarray) -> list[dict]:
    """Ranges of set flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]


def find_contamination(documents: DataFrame, benchmark: DataFrame, *, n: int = WORDS, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row for each document: its id, n_words, items (sorted ids of items with occurring windows) and hits (ranges of hit words)."""
    blocks = _sent(documents, benchmark, n, item_id, item_text, block_windows)

    def make():
        def kernel(texts):
            words = Words(texts)
            starts, lengths, items = _scan(words, blocks)
            hit = covered(starts, lengths, len(words.start))
            hits = [[]] * len(items)
            if len(starts):  # items without an id leave no name, but their ranges count
                touched = np.zeros(len(items), bool)
                touched[np.searchsorted(words.first, starts, "right") - 1] = True
                hits = [_runs(hit[a:b]) if t else [] for t, a, b in zip(touched, words.first[:-1], words.first[1:], strict=True)]
            return [pa.array(words.count, pa.int64()), pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(hits, _RANGES_ARROW)]

        return kernel

    return map_text(documents, make, _FIELDS, text=text, keep=(doc_id,))


def decontaminate(documents: DataFrame, benchmark: DataFrame, *, n: int = WORDS, most_share: float = 0.5, item_text: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The columns of documents, without benchmark passages: hit spans are cut out of the text; a document goes whole
    if hit words are more than `most_share` of its words. Hits are those of all blocks in the text as it came.

    A span runs from its first hit word's first character to the next word after it (so what parts the words goes with
    them). n_chars, where it is a column, follows the new text. Untouched documents are returned as they are.
    """
    blocks = _sent(documents, benchmark, n, "item_id", item_text, block_windows)
    if not blocks:  # no window at all
        return documents

    def make():
        def kernel(texts):
            words = Words(texts)
            starts, lengths, _ = _scan(words, blocks)
            clean, drop = [None] * len(words.count), np.zeros(len(words.count), bool)
            if len(starts):
                hit = covered(starts, lengths, len(words.start))
                for d in np.unique(np.searchsorted(words.first, starts, "right") - 1).tolist():
                    a, b = int(words.first[d]), int(words.first[d + 1])
                    runs = _runs(hit[a:b])
                    if sum(r["end"] - r["start"] for r in runs) > most_share * (b - a):
                        drop[d] = True
                        continue
                    at, pieces = int(words.offsets[d]), []
                    for r in runs:
                        pieces.append(words.raw[at : words.start[a + r["start"]]].tobytes())
                        at = int(words.start[a + r["end"]]) if a + r["end"] < b else int(words.offsets[d + 1])
                    pieces.append(words.raw[at : words.offsets[d + 1]].tobytes())
                    clean[d] = b"".join(pieces).decode("utf-8", "replace")
            return [pa.array(clean, pa.string()), pa.array(drop)]

        return kernel

    given, alias = aside(documents)
    found = map_text(given, make, [("__clean", "string"), ("__drop", "boolean")], text=alias["text"], keep=tuple(alias.values()))
    changes = {"text": F.coalesce("__clean", alias["text"])}
    if "n_chars" in alias:
        changes["n_chars"] = F.when(F.col("__clean").isNotNull(), F.length("__clean").cast("long")).otherwise(F.col(alias["n_chars"]))
    return found.where(~F.col("__drop")).select(*[changes.get(c, F.col(a)).alias(c) for c, a in alias.items()])


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of find_contamination over all documents."""
    found = find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bk AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bk)),
ks AS (SELECT DISTINCT k FROM bk),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT DISTINCT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
n AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS h FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""
