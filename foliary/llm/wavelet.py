"""Token-id shards as wavelet matrices: succinct bit-planes with rank and select in one compressed file a shard.

A shard holds the ids of consecutive documents. Bit-plane k holds bit k (from the highest) of every id, in an order that is
stably parted by the planes above it, so counting and finding a token takes one rank or select for each plane and never
decodes the shard. Blob layout, little-endian: b"FWM1", u64 ids, u32 planes, u64 documents, i64 document ids with a
null mask byte each, u64 ids of each document; then for each plane u64 zeros, u32 compressed size and the zstd bytes of
the packed bits. Rank directories (one u32 for 2048 bits) are rebuilt when a plane is opened.

Shards are rows of a Parquet table with one record a file, so any file system that Spark writes works and a lost task leaves
nothing behind. Ids are whole numbers of 64 bits (the blob holds them so; a column of others can't be cast and raises). Null and empty texts are documents of the end id alone; documents without an id come first; rows that repeat an
id stand side by side; an empty table gives no shard.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm.encoding import Encoder
from foliary.llm.frames import scratch, segments

#: Ids after which a shard is closed at the next document's end.
SHARD_IDS = 1 << 20
END_ID = 2
_BLOCK = 2048


def build(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """The blob of a shard."""
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    head = [b"FWM1", struct.pack("<QIQ", len(ids), bits, len(doc_ids)), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is None for d in doc_ids), np.array(lengths, "<u8").tobytes()]
    packer = zstandard.ZstdCompressor(level=1)
    a = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    for k in range(bits - 1, -1, -1):
        one = a & a.dtype.type(1 << k) != 0
        low, high = a[np.flatnonzero(~one)], a[np.flatnonzero(one)]
        body = packer.compress(np.packbits(one).tobytes())
        head += [struct.pack("<QI", len(low), len(body)), body]
        a = np.concatenate([low, high])
    return b"".join(head)


class Shard:
    """An opened shard: access, counting and occurrence lookup on its bit-planes."""

    def __init__(self, blob: bytes) -> None:
        if blob[:4] != b"FWM1":
            raise ValueError("not a token shard")
        self.n, self.bits, docs = struct.unpack_from("<QIQ", blob, 4)
        at = 24
        ids = np.frombuffer(blob, "<i8", docs, at)
        at += 8 * docs
        self.doc_ids = [None if gone else int(d) for d, gone in zip(ids, blob[at : at + docs], strict=True)]
        at += docs
        self.lengths = np.frombuffer(blob, "<u8", docs, at).astype(np.int64)
        at += 8 * docs
        unpacker, self.zeros, self.planes = zstandard.ZstdDecompressor(), [], []
        for _ in range(self.bits):
            zeros, size = struct.unpack_from("<QI", blob, at)
            self.zeros.append(zeros)
            self.planes.append(np.frombuffer(unpacker.decompress(blob[at + 12 : at + 12 + size]), np.uint8))
            at += 12 + size
        self._ranks: list[np.ndarray | None] = [None] * self.bits

    def _ones(self, k: int, i: int) -> int:
        """Set bits among the first i of plane k."""
        if self._ranks[k] is None:
            plane = self.planes[k]
            ones = np.bitwise_count(np.pad(plane, (0, -len(plane) % (_BLOCK // 8)))).reshape(-1, _BLOCK // 8).sum(1, dtype=np.int64)
            self._ranks[k] = np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)
        b = i // _BLOCK
        part = self.planes[k][b * _BLOCK // 8 : i // 8]
        rest = int(self.planes[k][i // 8]) >> (8 - i % 8) if i % 8 else 0
        return int(self._ranks[k][b]) + int(np.bitwise_count(part).sum()) + rest.bit_count()

    def access(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for k in range(self.bits):
            one = int(self.planes[k][i // 8]) >> (7 - i % 8) & 1
            value = value << 1 | one
            ones = self._ones(k, i)
            i = self.zeros[k] + ones if one else i - ones
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the token's occurrences among the first i ids lie below the last plane."""
        lo = 0
        if token >> self.bits:
            return 0, 0
        for k in range(self.bits):
            a, b = self._ones(k, lo), self._ones(k, i)
            lo, i = (self.zeros[k] + a, self.zeros[k] + b) if token >> (self.bits - 1 - k) & 1 else (lo - a, i - b)
        return lo, i

    def rank(self, token: int, i: int) -> int:
        """How often the token stands among the first i ids."""
        lo, hi = self._range(token, i)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select(self, k: int, one: int, j: int) -> int:
        """The place in plane k of the j-th bit (from 0) of this kind."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self._ones(k, mid + 1)
            if (ones if one else mid + 1 - ones) > j:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def select(self, token: int, j: int) -> int:
        """The place of the token's j-th occurrence, from 0."""
        lo, hi = self._range(token, self.n)
        if not 0 <= j < hi - lo:
            raise IndexError(j)
        i = lo + j
        for k in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - k) & 1
            i = self._select(k, one, i - self.zeros[k] if one else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, j) for j in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All ids in order: the planes undone from the lowest up."""
        a = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for k in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.planes[k], count=self.n).astype(bool)
            up = np.empty_like(a)
            up[np.flatnonzero(~one)] = a[: self.zeros[k]]
            up[np.flatnonzero(one)] = a[self.zeros[k] :] + a.dtype.type(1 << (self.bits - 1 - k))
            a = up
        return a.astype("<u4")


def write_shards(documents: DataFrame, tokenizer: str, path: str, *, end_id: int = END_ID, shard_ids: int = SHARD_IDS, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encodes whole texts in ascending doc_id order into shards: rows (part, shard, before, n_tokens, blob) of a Parquet table at path.

    before: the ids of the part's earlier shards. Rows of one id (or none) are dealt by their text's hash and their place too, so
    many of them don't meet in one task.
    """
    given = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    order = ("doc_id", "__tie", "__row")
    dealt = given.withColumn("__tie", F.xxhash64("text")).withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches):
        encoder, part, shard, before = Encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        ids, docs, lengths, held = [], [], [], 0

        def row():
            blob = build(np.concatenate(ids), docs, lengths)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([before], pa.int64()), pa.array([held], pa.int64()), pa.array([blob], pa.binary())], names=["part", "shard", "before", "n_tokens", "blob"])

        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for lo, hi in segments(pa.compute.binary_length(texts).to_pylist()):
                own, offsets = encoder.encode(texts.slice(lo, hi - lo), end_id)
                names, ends, at = batch.column(0).slice(lo, hi - lo).to_pylist(), offsets[1:], 0
                while at < len(names):  # up to the document that fills the shard
                    to = min(int(np.searchsorted(ends, offsets[at] + shard_ids - held)) + 1, len(names))
                    ids.append(own[offsets[at] : offsets[to]])
                    docs += names[at:to]
                    lengths += np.diff(offsets[at : to + 1]).tolist()
                    held += len(ids[-1])
                    at = to
                    if held >= shard_ids:
                        yield row()
                        ids, docs, lengths, held, shard, before = [], [], [], 0, shard + 1, before + held
        if docs:
            yield row()

    dealt.mapInArrow(run, _TABLE).write.option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(path)


_TABLE = "part int, shard int, before bigint, n_tokens bigint, blob binary"


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with `before`, the ids of all shards before each one. Only a number for each writing task reaches the driver
    and the executors; blobs stay where they are."""
    shards = spark.read.schema(_TABLE).parquet(path)
    parts, earlier, total = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect(), [], 0
    for p in parts:
        earlier.append((p["part"], total))
        total += p["n"]
    table = F.broadcast(spark.createDataFrame(earlier, "part int, earlier bigint"))
    return shards.join(table, "part").withColumn("before", F.col("before") + F.col("earlier")).drop("earlier")


def documents_of(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the shards."""

    def run(batches):
        for batch in batches:
            for blob, before in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                shard = Shard(blob.as_py())
                raw, ends = shard.decode().tobytes(), np.cumsum(shard.lengths)
                starts = ends - shard.lengths
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, pa.int64()), pa.array(starts + before), pa.array(shard.lengths), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.select("blob", "before").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    write_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"), path)
    return documents_of(read_shards(spark, path))
