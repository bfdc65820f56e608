"""Quality rules: base statistics of every document and a short-circuit cascade of cheap rejections.

A rule reads whole texts and rejects some. On a sample of about SAMPLE_ROWS texts each rule's cost (seconds a byte)
and selectivity (share rejected) are measured; rules then run in order of rejection per cost, each only on the texts that
all rules before it kept. A document is kept if no rule rejects it, so the order changes the cost, never the verdict.

Null and empty texts have no words, so the base rule rejects them. Repeated rows are judged alike, each on its own.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm.frames import aside, map_text
from foliary.llm.kernels import SAME, SPACED, Words, covered, hash_ranges, mix, spread, sums_by_text

#: Size of the sample on which cost and selectivity are estimated.
SAMPLE_ROWS = 2000
MIN_WORDS = 50
#: Fixed by the contract: characters that count as symbols.
SYMBOLS = b"#*$%&|<>"


def _table(chars) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SYMBOL, _UPPER, _LETTER, _BANG = _table(SYMBOLS), _table(range(65, 91)), _table([*range(65, 91), *range(97, 123)]), _table(b"!")
_WORDY = _table([*range(65, 91), *range(97, 123), *range(128, 256)])
_HEAD = ~_table(range(128, 192))  # all bytes but those that continue a code point


@dataclass(frozen=True)
class Rule:
    """A named test: reject(texts, n_words) -> flags of the texts to reject."""

    name: str
    reject: Callable[[pa.Array, np.ndarray], np.ndarray]


def _counts(texts: pa.Array, table: np.ndarray) -> np.ndarray:
    data, offsets = spread(texts)
    return sums_by_text(table[data], offsets)


def _dup_lines(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: its lines with a word that equal an earlier line, and its lines with a word."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    texts_with = np.searchsorted(offsets, breaks, "right") - 1
    start = np.concatenate([offsets[:-1], breaks + 1])
    owner = np.concatenate([np.arange(n), texts_with])
    order = np.lexsort((start, owner))
    start, owner = start[order], owner[order]
    end = np.empty_like(start)
    end[:-1] = np.where(owner[1:] == owner[:-1], start[1:] - 1, offsets[owner[:-1] + 1])
    if len(end):
        end[-1] = offsets[owner[-1] + 1]
    flags = np.zeros(len(data) + 1, np.int64)
    np.cumsum(in_word, out=flags[1:])
    full = flags[end] > flags[start]
    start, end, owner = start[full], end[full], owner[full]
    h = hash_ranges(data, start, end) ^ mix(owner.astype(np.uint64))
    _, first, same = np.unique(h, return_index=True, return_inverse=True)
    lines = np.bincount(owner, minlength=n)
    dup = lines - np.bincount(owner[first], minlength=n)
    again = np.flatnonzero(first[same] != np.arange(len(h)))  # lines of one hash with an earlier one are held against it
    raw = memoryview(np.ascontiguousarray(data))
    spans = zip(start[again].tolist(), end[again].tolist(), start[first[same[again]]].tolist(), end[first[same[again]]].tolist(), strict=True)
    odd = {t for t, f, (a, b, c, d) in zip(owner[again].tolist(), owner[first[same[again]]].tolist(), spans, strict=True) if t != f or raw[a:b] != raw[c:d]}
    odd |= {f for t, f in zip(owner[again].tolist(), owner[first[same[again]]].tolist(), strict=True) if t != f}
    for t in odd:  # different lines of one hash: this text's are told by their bytes
        own = np.flatnonzero(owner == t)
        dup[t] = len(own) - len({raw[a:b].tobytes() for a, b in zip(start[own].tolist(), end[own].tolist(), strict=True)})
    return dup, lines


def repeated_words(words: Words, k: int = 3) -> np.ndarray:
    """Of each text: words that lie in k-word windows which the text holds twice or more."""
    g, at = words.windows(words.hashes(), k)
    owner = np.searchsorted(words.first, at, "right") - 1
    key = mix(g ^ mix(owner.astype(np.uint64)))
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(words.count), np.int64)
    twice = np.unique(twice)
    bits = np.zeros(1 << 18, bool)
    bits[twice >> np.uint64(46)] = True
    maybe = np.flatnonzero(bits[key >> np.uint64(46)])
    found = np.minimum(np.searchsorted(twice, key[maybe]), len(twice) - 1)
    hits = at[maybe[twice[found] == key[maybe]]]
    return sums_by_text(covered(hits, k, len(words.start)), words.first)


def base_statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    words = Words(texts, SPACED, SAME)
    dup, _ = _dup_lines(words.data, words.offsets, words.inside)
    out = {"n_words": words.count, "word_chars": sums_by_text(words.inside & _HEAD[words.data], words.offsets), "n_symbols": sums_by_text(_SYMBOL[words.data], words.offsets), "n_dup_lines": dup, "n_repeat_words": repeated_words(words)}
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
    return out


def _word_length(texts, n):
    data, offsets = spread(texts)
    chars = sums_by_text(SPACED[data] & _HEAD[data], offsets)
    return (chars > 20 * n) | (chars < 2 * n)


def _dup_share(texts, n):
    data, offsets = spread(texts)
    dup, lines = _dup_lines(data, offsets, SPACED[data])
    return 2 * dup > lines


def _few_letters(texts, n):
    words = Words(texts, SPACED, SAME)
    total = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(_WORDY[words.data], out=total[1:])
    return 10 * sums_by_text(total[words.end] > total[words.start], words.first) < 6 * n


RULES: tuple[Rule, ...] = (
    Rule("symbols", lambda texts, n: 10 * _counts(texts, _SYMBOL) > n),
    Rule("capitals", lambda texts, n: 2 * _counts(texts, _UPPER) > _counts(texts, _LETTER)),
    Rule("exclamations", lambda texts, n: 2 * _counts(texts, _BANG) > n),
    Rule("word_length", _word_length),
    Rule("repeated_lines", _dup_share),
    Rule("few_letters", _few_letters),
)


def order_rules(documents: DataFrame, rules: Sequence[Rule] = RULES, *, text: str = "text", rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejection per cost, as measured where the texts are, on about `rows` whole texts of the table."""
    n = documents.count()
    if not n:
        return list(rules)

    def make():
        def kernel(texts):
            n_words, seconds, rejected = Words(texts, SPACED, SAME).count, [], []
            for rule in rules:
                began = time.perf_counter()
                rejected.append(rule.reject(texts, n_words).astype(float))
                seconds.append(np.full(len(texts), (time.perf_counter() - began) / len(texts)))
            flat = lambda x: pa.array(np.stack(x, 1).tolist(), pa.list_(pa.float64()))
            return [flat(seconds), flat(rejected)]

        return kernel

    some = documents.select(F.col(f"`{text}`").cast("string").alias("text")).where(F.length("text") > 0).sample(fraction=min(1.0, rows / n), seed=7)
    measured = map_text(some, make, [("seconds", "array<double>"), ("rejected", "array<double>")], keep=())
    r = measured.agg(*[F.sum(F.col(c)[i]).alias(f"{c}{i}") for c in ("seconds", "rejected") for i in range(len(rules))]).first()
    worth = [(r[f"rejected{i}"] or 0) / max(r[f"seconds{i}"] or 0, 1e-9) for i in range(len(rules))]
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: -worth[i])]


def cascade(texts: pa.Array, n_words: np.ndarray, alive: np.ndarray, rules: Sequence[Rule]) -> np.ndarray:
    """Which of the alive texts every rule keeps; a rule sees only what those before it kept."""
    rows = np.flatnonzero(alive)
    for rule in rules:
        if not len(rows):
            break
        part = texts if len(rows) == len(texts) else texts.take(pa.array(rows))
        rows = rows[~rule.reject(part, n_words[rows])]
    kept = np.zeros(len(texts), bool)
    kept[rows] = True
    return kept


_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality(documents: DataFrame, *, keep: Sequence[str] = ("doc_id",), text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Columns `keep`, the base statistics, base_failed and kept of every document."""
    ordered = order_rules(documents, rules, text=text)

    def make():
        def kernel(texts):
            stats = base_statistics(texts)
            kept = cascade(texts, stats["n_words"], ~stats["base_failed"], ordered)
            return [*(pa.array(stats[k], pa.int64()) for k in _STATS), pa.array(stats["base_failed"]), pa.array(kept)]

        return kernel

    return map_text(documents, make, [*((k, "bigint") for k in _STATS), ("base_failed", "boolean"), ("kept", "boolean")], text=text, keep=keep)


def filter_quality(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that the base rule and the cascade keep, with their own columns."""
    ordered = order_rules(documents, rules)
    given, alias = aside(documents)

    def make():
        def kernel(texts):
            words = Words(texts, SPACED, SAME)
            alive = words.count >= MIN_WORDS
            alive &= 100 * repeated_words(words) <= 50 * words.count
            return [pa.array(cascade(texts, words.count, alive, ordered))]

        return kernel

    judged = map_text(given, make, [("__kept", "boolean")], text=alias["text"], keep=tuple(alias.values()))
    return judged.where("__kept").select(*[F.col(a).alias(c) for c, a in alias.items()])


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Base and verdict in SQL; {docs} is a table with doc_id and text.
QUALITY_SQL = r"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (10 * n_symbols > n_words OR 2 * n_upper > n_letters OR 2 * n_bang > n_words OR word_chars > 20 * n_words OR word_chars < 2 * n_words OR 2 * n_dup_lines > n_lines OR 10 * n_wordy < 6 * n_words) AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper, CAST(len(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS BIGINT) AS n_letters, CAST(len(regexp_replace(t, '[^!]', '', 'g')) AS BIGINT) AS n_bang,
    CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) AS BIGINT) AS n_wordy, coalesce(n_repeat, 0) AS n_repeat_words
  FROM (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM (SELECT doc_id, coalesce(text, '') AS t FROM {docs}))
  LEFT JOIN (
    SELECT doc_id, count(*) AS n_repeat FROM (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS p FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (
        SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (
          SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {docs}))))
      WHERE c > 1) GROUP BY doc_id) USING (doc_id)))
"""
OP10_SQL = QUALITY_SQL.replace("{docs}", "documents")
