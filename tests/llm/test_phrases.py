"""Phrase collocations against a plain model of counts, scores and dropping."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliary.llm import frames, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain_pieces(text):
    return [w for w in (re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER))) if w]


def model(rows, most=3, least=10, best=2000, covered=50):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for w in plain_pieces(text):
            n[lang or "und" if lang is None else lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    counts["und" if lang is None else lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if candidates.get(p[i : i + k]) and 100 * a >= covered * candidates[p[i : i + k]]}
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, s[2].decode(), -s[1], s[3], s[4], n[lang], -s[0]) for i, s in enumerate(sorted(scored)[:best])]
    return sorted(out)


def mined(spark, rows, **k):
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], SCHEMA)
    return sorted(tuple(r[c] for c in COLUMNS) for r in phrases.collocations(docs, **k).collect())


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(5)
    vocabulary = ["Alpha", "beta", "gamma", "délta", "中文", "x", "y", "z", "q\x00q", "😀"]
    text = lambda: "".join(r.choice(vocabulary) + r.choices([" ", "  ", "\t", ". ", ",", "\n", "\r\n", " ; ", "!?"], [20, 2, 1, 2, 1, 1, 1, 1, 1])[0] for _ in range(r.randrange(120)))
    rows = [(text(), r.choice(["en", "fr", None, ""])) for _ in range(150)]
    return rows + [rows[0]] * 40 + [(None, "en"), ("", None), (" \t\n.,", "fr"), (None, None)]


def test_phrases_equal_a_plain_model(spark, corpus):
    assert mined(spark, corpus) == model(corpus)
    assert mined(spark, corpus, most_words=4, least=5, best=7, covered_percent=80) == model(corpus, 4, 5, 7, 80)
    assert mined(spark, corpus, most_words=2, least=1) == model(corpus, 2, 1)


def test_many_buckets_chunks_and_shares_change_nothing(spark, corpus, monkeypatch):
    monkeypatch.setattr(phrases, "RANKED_ROWS", 7)
    monkeypatch.setattr(phrases, "CHUNK_ROWS", 3)
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 40)
    monkeypatch.setattr(phrases, "BLOCK_WORDS_A_BUCKET", 1)
    monkeypatch.setattr(frames, "BROADCAST_ROWS", 3)
    assert mined(spark, corpus, bucket_words=50, best=9) == model(corpus, best=9)


def test_a_long_piece_and_one_that_all_share(spark):
    rows = [("long words " * 60_000, "en")] + [("The same line, again and again", "en")] * 3000
    found = mined(spark, rows)
    assert found == model(rows) and ("en", 3000) in {(x[0], x[3]) for x in found}


def test_scores_beyond_64_bits_are_exact(spark):
    a = 5_000_000_003
    counts = spark.createDataFrame([("en", "u v", a, 7 * a, 3 * a)], "lang string, phrase string, a long, l long, r long")
    exact = counts.select(F.expr("(CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(19,0)) * CAST(a AS DECIMAL(19,0)))) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")).first()[0]
    assert exact == 1_000_000 * a * a // (21 * a * a)


def test_multiplicities_weigh_as_much_as_rows(spark):
    """Pieces with a multiplicity of thousands of millions: sums stay whole."""
    times = 3_000_000_000
    given = spark.createDataFrame([("en", "a b", times), ("en", "b a b", 2)], "lang string, piece string, times long")
    found = {(r["gram"], r["f"]) for r in phrases.count_phrases(given, words=5, least=1).collect()}
    assert found == {("a", times + 2), ("b", times + 4), ("a b", times + 2), ("b a", 2), ("b a b", 2)}


def test_cut_gives_normal_pieces():
    found = phrases.cut(pa.array([b"A  b.\tC\td \r\n", b"", b" .. ", "É x;Y".encode()], pa.large_binary()))
    assert found.to_pylist() == [["a b", "c d"], [], [], ["É x", "y"]]


def test_no_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b. " * 12, None, "x", 3)], SCHEMA + ", phrase string, piece long")
    assert [tuple(r[c] for c in COLUMNS) for r in phrases.collocations(docs).collect()] == [("und", 1, "a b", 12, 12, 12, 24, 1_000_000)]
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_hot_keys_are_looked_up_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(frames, "BROADCAST_ROWS", 4)
    rows = spark.createDataFrame([("hot", i) for i in range(100)] + [(f"k{i}", i) for i in range(20)] + [(None, 1), ("absent", 2)], "key string, i long")
    table = spark.createDataFrame([("hot", 100, "H")] + [(f"k{i}", 1, str(i)) for i in range(20)], "key string, n long, value string")
    found = frames.looked_up(rows, table, "key", "n").collect()
    assert len(found) == 122 and all(r["value"] == (None if r["key"] in (None, "absent") else "H" if r["key"] == "hot" else r["key"][1:]) for r in found)
