"""Best-fit packing of token sequences in bulk-synchronous rounds.

Documents are encoded, closed with an end id and cut only where longer than a sequence. Lengths are whole numbers up to
the capacity, so pieces (and gaps) of one size are interchangeable: a *run* stands for any number of them, and a round
touches at most `capacity` runs of each kind. A round sorts the runs of pieces and of gaps by size, sends every run of the
current size band to its successor gap (the smallest that holds it), settles conflicts by rank (larger pieces first, as many
as there are gaps), updates the gaps and repeats; when no piece of the band fits, the largest size opens new sequences. Bands run
from large to small, as in best-fit decreasing. What follows from a run's rounds is applied to its pieces by their rank
within the size: the number of earlier pieces in its own task plus those of all tasks before, from one count for each
task and length. The text is read once and never shuffled.

Null and empty texts are one piece of the end id; rows that repeat an id are packed each on its own; no rows, no pieces.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliary.llm.encoding import Encoder
from foliary.llm.frames import map_text, written

CAPACITY = 2048
END_ID = 0


def cut(documents: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32 (and ids as little-endian bytes), bucket (the task) and
    nth (its rank among the task's pieces of that length)."""
    fields = {"piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "nth": "bigint"} | ({"ids": "binary"} if with_ids else {})

    def make():
        encoder, seen, bucket = Encoder(tokenizer), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()

        def kernel(texts):
            ids, offsets = encoder.encode(texts, end_id)
            size, raw = np.diff(offsets), memoryview(ids.astype("<u4", copy=False)).cast("B")
            many = -(-size // capacity)
            first = np.concatenate([[0], np.cumsum(many)])
            piece = np.arange(first[-1]) - np.repeat(first[:-1], many)
            start = piece * capacity
            length = np.minimum(np.repeat(size, many) - start, capacity)
            at = (4 * (np.repeat(offsets[:-1], many) + start)).tolist()
            parts = [raw[a : a + 4 * n] for a, n in zip(at, length.tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            nth = np.empty(len(order), np.int64)
            nth[order] = np.arange(len(order)) - np.searchsorted(length[order], length[order])
            nth += seen[length]
            np.add.at(seen, length, 1)
            columns = [pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(nth)]
            if with_ids:
                columns.append(pa.array([bytes(p) for p in parts], pa.binary()))
            return [pa.array(np.full(len(texts), bucket), pa.int32()), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.StructArray.from_arrays(columns, names=list(fields)))]

        return kernel

    ddl = ",".join(f"{name}:{kind}" for name, kind in fields.items())
    rows = map_text(documents, make, [("bucket", "int"), ("pieces", f"array<struct<{ddl}>>")], text=text, keep=(doc_id,))
    return rows.select(F.col(f"`{doc_id}`").alias("doc_id"), "bucket", F.explode("pieces").alias("p")).select("doc_id", "bucket", "p.*")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, pieces, first sequence, offset), by length and rank: the pieces of that length from that rank
    on go to as many sequences from that one on, each at that offset."""
    left, taken = Counter({n: c for n, c in counts.items() if c}), Counter()
    gaps: dict[int, list[tuple[int, int]]] = {}  # size -> runs of (first sequence, sequences)
    rows, opened = [], 0

    def place(length: int, gap: int, first: int, n: int) -> None:
        rows.append((length, taken[length], n, first, capacity - gap))
        taken[length] += n
        left[length] -= n
        if gap > length:
            gaps.setdefault(gap - length, []).append((first, n))

    shares = 1
    while max(left.values(), default=0):
        band = sorted((n for n, c in left.items() if c and n > (capacity // (shares + 1) if shares < 24 else 0)), reverse=True)
        shares += 1
        while band := [n for n in band if left[n]]:
            sizes = np.array(sorted(gaps))
            bids: dict[int, list[int]] = {}
            for n, i in zip(band, np.searchsorted(sizes, band).tolist(), strict=True):  # successors; larger pieces come first
                if i < len(sizes):
                    bids.setdefault(int(sizes[i]), []).append(n)
            for gap, wanting in bids.items():
                runs = gaps.pop(gap)
                for n in wanting:
                    while left[n] and runs:
                        first, many = runs.pop()
                        used = min(many, left[n])
                        if used < many:
                            runs.append((first + used, many - used))
                        place(n, gap, first, used)
                if runs:
                    gaps.setdefault(gap, []).extend(runs)
            if not bids:  # nothing fits: the largest size opens as many sequences as it fills
                n = band[0]
                many = -(-left[n] // (capacity // n))
                place(n, capacity, opened, many)
                opened += many
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """The rows of cut() with sequence_id and offset."""
    spark = pieces.sparkSession
    pieces = written(pieces)
    counts = written(pieces.groupBy("bucket", "length").agg(F.count("*").alias("n")))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    table = plan(totals, capacity)
    sent = spark.sparkContext.broadcast((table[:, 0] << 40 | table[:, 1], table))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("bucket", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["bucket", "length"]).withColumn("rank", F.col("base") + F.col("nth")).drop("base", "nth", "bucket")
    names = ranked.columns

    def run(batches):
        keys, rows = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(names.index(c)).to_numpy() for c in ("length", "rank"))
            row = rows[np.searchsorted(keys, length << 40 | rank, "right") - 1]
            kept = [batch.column(i) for i, c in enumerate(names) if c != "rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])], names=[*(c for c in names if c != "rank"), "sequence_id", "offset"])

    schema = ranked.drop("rank").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    return ranked.mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (little-endian bytes) and n_tokens of whole sequences, from pieces that were cut with their ids."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("n_tokens"))
    return parts.select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"), "n_tokens")


def pack_documents(documents: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    return pack(cut(documents, tokenizer, capacity=capacity, end_id=end_id, with_ids=with_ids), capacity=capacity)


def op1_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
