"""Phrase collocation mining: how often phrases of up to MOST_WORDS words occur in each language, and how much oftener than their parts would by chance.

1. Texts are cut into pieces at stops and line ends, pieces into words. Identical pieces of a language become one row with a multiplicity, counted
   before the shuffle, so copies and lines that many texts repeat are looked at once.
2. A task writes the phrases of its pieces out and sums their multiplicities in duckdb, a block of words at a time, within a memory limit and out of core beyond
   it. The sums leave it in the order of hash buckets, as one compressed chunk for each bucket; a bucket's chunks meet in one task, where duckdb
   sums them up the same way. There are as many buckets as keep BUCKET_WORDS in one, MOST_BUCKETS at most, and blocks grow with the
   buckets, so that a chunk stays worth its shuffle. Phrases rarer than the least count end here: a part occurs at least as often
   as the phrase, so nothing that a candidate is judged by is lost.
3. A candidate asks for its parts: a request for each part of each cut goes where the part's count lies, the answers go back to the candidate.
   Parts that very many candidates ask for are few, so these are broadcast and their requests stay where they are.
4. Candidates that lie in a longer one of half their count or more go; the others are ranked within their language, first in shares of bounded
   size, then the best of these.

Scores are whole numbers, worked out in decimals of 38 digits: exact for counts below 10**16. Null texts are empty; a null language is `und`; repeated
rows count each; ids aren't looked at. Pieces and texts of any length are taken whole; no rows give no rows.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliary.llm.frames import Held, looked_up, map_text, segments, written
from foliary.llm.kernels import LOWER, Words

#: Fixed by the contract: what parts pieces, and what parts the words of a piece.
STOPS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
UNKNOWN_LANG = "und"
MOST_WORDS, LEAST_COUNT, BEST = 3, 10, 2000
#: A candidate goes if a longer one around it has so many hundredths of its count or more.
COVERED_PERCENT = 50
#: Words of distinct pieces for each hash bucket, and buckets at most; memory that duckdb may take in a task before it goes out of core.
BUCKET_WORDS, MOST_BUCKETS, MEMORY_MB = 1 << 20, 1 << 16, 320
#: Words whose phrases a task sums before it sends them out: so many, or so many for each bucket if that is more.
BLOCK_WORDS, BLOCK_WORDS_A_BUCKET = 1 << 19, 1 << 10
#: Most sums in a chunk on its way to its bucket; candidates of a language that are ranked in one task at first.
CHUNK_ROWS, RANKED_ROWS = 1 << 18, 1 << 20

_STOP = np.zeros(256, bool)
_STOP[list(STOPS)] = True
_WORD = ~_STOP
_WORD[list(BLANKS)] = False


def cut(texts: pa.Array) -> pa.ListArray:
    """The pieces of each text that hold a word: words, A-Z lower-cased, with one space between."""
    words = Words(texts, _WORD, LOWER)
    data, start, end = words.data, words.start, words.end
    stops = np.zeros(len(data) + 1, np.int32)
    np.cumsum(_STOP[data], out=stops[1:])
    first = np.ones(len(start), bool)  # of a piece
    owner = words.owner()
    first[1:] = (owner[1:] != owner[:-1]) | (stops[start[1:]] > stops[end[:-1]])
    joined = end[:-1][~first[1:]]
    data[joined] = 32
    kept = words.inside
    kept[joined] = True
    place = np.zeros(len(data) + 1, np.int32)
    np.cumsum(kept, out=place[1:])
    offsets = np.append(place[start[first]], place[-1]).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data[kept]))
    each = np.bincount(owner[first], minlength=len(words.count))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(each)]), pa.int32()), pieces)


def pieces(documents: DataFrame, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, piece, times: each distinct piece of a language and how often it stands in the texts."""
    given = documents.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), F.col(f"`{text}`").alias("text"))
    each = map_text(given, lambda: lambda texts: [cut(texts)], [("pieces", "array<string>")], keep=("lang",))
    return each.select("lang", F.explode("pieces").alias("piece")).groupBy("lang", "piece").agg(F.count("*").alias("times"))


@contextlib.contextmanager
def _duckdb(memory_mb: int):
    """A duckdb of one thread that spills beside Spark's own spills and leaves nothing there."""
    import duckdb

    where = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
    with tempfile.TemporaryDirectory(dir=where, ignore_cleanup_errors=True) as spill:
        db = duckdb.connect(config={"threads": 1, "memory_limit": f"{memory_mb}MB", "temp_directory": spill, "preserve_insertion_order": False})
        try:
            yield db
        finally:
            db.close()


def grams(lang: pa.Array, piece: pa.Array, times: pa.Array, most_words: int) -> Iterator[pa.RecordBatch]:
    """lang, gram and times of all runs of one to most_words words of the pieces."""
    split = pc.split_pattern(piece, " ")
    words = split.flatten()
    owner = np.repeat(np.arange(len(piece)), np.diff(split.offsets.to_numpy()))
    at = np.arange(len(words))
    for k in range(1, most_words + 1):
        at = at[: max(len(words) - k + 1, 0)] if k == 1 else at[(at + k <= len(words))]
        at = at[owner[at] == owner[at + k - 1]]
        if not len(at):
            return
        made = words if k == 1 else pc.binary_join_element_wise(*[words.take(pa.array(at + j)) for j in range(k)], " ")
        own = pa.array(owner[at])
        yield pa.RecordBatch.from_arrays([lang.take(own), made, times.take(own)], names=["lang", "gram", "times"])


_SUMS = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("times", pa.int64())])


def _packed(rows: pa.Table) -> bytes:
    """The rows as a Parquet file: phrases stand in order, so each is kept as what it has beyond the one before."""
    sink = pa.BufferOutputStream()
    pq.write_table(rows, sink, compression="zstd", compression_level=3, use_dictionary=["lang"], column_encoding={"gram": "DELTA_BYTE_ARRAY", "times": "DELTA_BINARY_PACKED"}, write_statistics=False, store_schema=False)
    return sink.getvalue().to_pybytes()


def _chunks(deduplicated: DataFrame, most_words: int, buckets: int, memory_mb: int) -> DataFrame:
    """bucket, chunk: the sums of each task's pieces, a chunk or more for each bucket."""

    most = max(BLOCK_WORDS, buckets * BLOCK_WORDS_A_BUCKET)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, over = (batch.slice(lo, hi - lo) for batch in batches for lo, hi in segments(pc.binary_length(batch.column(1)).to_pylist())), False

        def block() -> Iterator[pa.RecordBatch]:
            """The phrases of the next pieces, until they have so many words."""
            nonlocal over
            n = 0
            while n < most:
                part = next(parts, None)
                if part is None:
                    over = True
                    return
                for k, rows in enumerate(grams(*part.columns, most_words)):
                    n += 0 if k else len(rows)
                    yield rows

        def row(bucket: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([_packed(pa.Table.from_batches(held, _SUMS))], pa.binary())], names=["bucket", "chunk"])

        with _duckdb(memory_mb) as db:
            while not over:
                source = pa.RecordBatchReader.from_batches(_SUMS, block())  # noqa: F841  named in the query
                sums = db.sql(f"SELECT CAST(hash(lang, gram) % {buckets} AS INTEGER) AS bucket, lang, gram, CAST(sum(times) AS BIGINT) AS times FROM source GROUP BY lang, gram ORDER BY bucket, lang, gram")
                last, held, n = -1, [], 0
                for batch in sums.to_arrow_reader(1 << 16):
                    ids = batch.column(0).to_numpy()
                    rows = batch.select(["lang", "gram", "times"]).cast(_SUMS)
                    edges = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
                    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                        if held and (ids[lo] != last or n >= CHUNK_ROWS):
                            yield row(last, held)
                            held, n = [], 0
                        last = int(ids[lo])
                        held.append(rows.slice(lo, hi - lo))
                        n += hi - lo
                if held:
                    yield row(last, held)

    return deduplicated.select("lang", "piece", "times").mapInArrow(run, "bucket int, chunk binary")


def count_phrases(deduplicated: DataFrame, *, words: int, most_words: int = MOST_WORDS, least: int = LEAST_COUNT, bucket_words: int = BUCKET_WORDS, memory_mb: int = MEMORY_MB) -> DataFrame:
    """lang, gram, n_words, f of every run of one to most_words words that occurs `least` times or more in the pieces, which hold so many words in all."""
    buckets = min(MOST_BUCKETS, max(1, -(-words // bucket_words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def every() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk in batch.column(1):
                    for rows in pq.ParquetFile(pa.BufferReader(chunk.as_buffer())).iter_batches():
                        yield rows.cast(_SUMS)

        with _duckdb(memory_mb) as db:
            source = pa.RecordBatchReader.from_batches(_SUMS, every())  # noqa: F841
            found = db.sql(f"SELECT lang, gram, CAST(length(gram) - length(replace(gram, ' ', '')) + 1 AS INTEGER) AS n_words, CAST(sum(times) AS BIGINT) AS f FROM source GROUP BY lang, gram HAVING sum(times) >= {least}")
            yield from found.to_arrow_reader(1 << 16)

    met = _chunks(deduplicated, most_words, buckets, memory_mb).repartition(buckets, "bucket")
    return met.mapInArrow(run, "lang string, gram string, n_words int, f bigint")


def _parts(candidates: DataFrame, most_words: int) -> DataFrame:
    """lang, phrase, a, cut, left (whether the part lies before the cut), part: a request for each part."""
    w = F.split("phrase", " ")
    sides = [F.when(F.col("n_words") > k, F.struct(F.lit(k).alias("cut"), F.lit(left).alias("left"), F.array_join(F.slice(w, 1, k) if left else F.slice(w, k + 1, most_words), " ").alias("part"))) for k in range(1, most_words) for left in (True, False)]
    return candidates.select("lang", "phrase", "a", F.explode(F.array_compact(F.array(*sides))).alias("p")).select("lang", "phrase", "a", "p.*")


def _inner(candidates: DataFrame, most_words: int) -> DataFrame:
    """lang, phrase, around: the greatest count of the longer candidates that a phrase lies in."""
    w = F.split("phrase", " ")
    inside = [F.when(F.col("n_words") >= i + k - 1, F.when(F.col("n_words") > k, F.array_join(F.slice(w, i, k), " "))) for k in range(2, most_words) for i in range(1, most_words - k + 2)]
    if not inside:
        return candidates.select("lang", "phrase", F.col("a").alias("around")).limit(0)
    return candidates.select("lang", "a", F.explode(F.array_compact(F.array(*inside))).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("around"))


def collocations(documents: DataFrame, *, text: str = "text", lang: str = "lang", most_words: int = MOST_WORDS, least: int = LEAST_COUNT, best: int = BEST, covered_percent: int = COVERED_PERCENT, bucket_words: int = BUCKET_WORDS, memory_mb: int = MEMORY_MB) -> DataFrame:
    """The best phrases of 2 to most_words words of each language: lang, rank (from 1), phrase, a (its occurrences), l and r (those of its parts at the cut of the lowest
    score), n (all words of the language), score."""
    held = Held(documents.sparkSession)
    deduplicated = held(pieces(documents, text=text, lang=lang), compression="zstd")
    n_words = F.length("piece") - F.length(F.translate("piece", " ", "")) + 1
    totals = held(deduplicated.groupBy("lang").agg(F.sum(n_words * F.col("times")).alias("n"), F.sum(n_words).alias("words")))
    words = totals.agg(F.sum("words")).first()[0] or 0
    counts = held(count_phrases(deduplicated, words=words, most_words=most_words, least=least, bucket_words=bucket_words, memory_mb=memory_mb))
    candidates = counts.where("n_words > 1").select("lang", F.col("gram").alias("phrase"), F.col("f").alias("a"), "n_words")
    key = lambda part: F.concat_ws("\t", "lang", part)  # noqa: E731  no word holds a tab
    requests = _parts(candidates, most_words).withColumn("key", key("part")).drop("part")
    asked = requests.groupBy("key").agg(F.count("*").alias("asked"))
    known = held(counts.select(key("gram").alias("key"), "f").join(asked, "key"))
    answers = looked_up(requests, known, "key", "asked").repartition("lang", "phrase")
    cuts = answers.groupBy("lang", "phrase", "cut").agg(F.first("a").alias("a"), F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    exact = {c: F.col(c).cast("decimal(19,0)").alias(f"__{c}") for c in "alr"}
    scored = cuts.select("*", *exact.values()).withColumn("score", F.expr("(CAST(1000000 AS DECIMAL(7,0)) * (__a * __a)) div (__l * __r)"))
    lowest = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("s")).select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    around = _inner(candidates, most_words)
    open_ = held(lowest.join(around, ["lang", "phrase"], "left").where(F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * covered_percent)).drop("around"))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    shares = max(1, -(-open_.count() // RANKED_ROWS))
    first = open_.withColumn("__share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    first = first.withColumn("__n", F.row_number().over(Window.partitionBy("lang", "__share").orderBy(*order))).where(F.col("__n") <= best)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= best)
    found = written(ranked.join(totals.drop("words"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
    held.clear()
    return found


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS v(k))),
f AS MATERIALIZED (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
x AS MATERIALIZED (SELECT lang, g, a, cut, array_to_string(w[1:cut], ' ') AS lp, array_to_string(w[cut + 1:], ' ') AS rp FROM (SELECT lang, g, a, w, unnest(range(1, k)) AS cut FROM c)),
s AS (SELECT x.lang, x.g, x.a, x.cut, l.f AS l, r.f AS r, 1000000 * CAST(x.a AS HUGEINT) * x.a // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM x JOIN f l ON l.lang = x.lang AND l.g = x.lp JOIN f r ON r.lang = x.lang AND r.g = x.rp),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
d AS (SELECT DISTINCT s.lang, s.g FROM c s JOIN (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS g FROM c WHERE k = 3) t ON t.lang = s.lang AND t.g = s.g WHERE s.k = 2 AND 100 * t.a >= 50 * s.a),
o AS (SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM b ANTI JOIN d USING (lang, g))
SELECT lang, rank, g AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""
