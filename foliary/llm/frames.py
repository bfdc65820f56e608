"""What the training-data operators share: scratch tables and Arrow maps over a text column."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a kernel works on at once; a longer text is a segment of its own.
SEGMENT_BYTES = 1 << 20


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share, below spark.checkpoint.dir.

    Where that setting is absent (tests in local mode) a temporary folder is set for the session; a cluster
    without it uses the warehouse folder, which is shared too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master == "local" or master.startswith("local["):
            root = tempfile.mkdtemp(prefix="spark-")
            spark.sparkContext.setCheckpointDir(root)
        else:
            root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/foliary-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str | None = None, **options: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read back: the lineage ends there and survives lost executors."""
    spark, path = df.sparkSession, path or scratch(df.sparkSession)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Held:
    """Scratch tables that a computation needs until its result is written: held(df) writes one, clear() removes all of them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame, **options: str) -> DataFrame:
        self.paths.append(scratch(self.spark))
        return written(df, self.paths[-1], **options)

    def clear(self) -> None:
        for path in self.paths:
            at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        self.paths.clear()


def segments(sizes: Sequence[int], most: int = SEGMENT_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose sizes add up to about `most`; one larger row stands alone."""
    lo, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield lo, len(sizes)


def let_go() -> None:
    """Gives the memory that a task has freed back to the system: the worker waits for its next task beside others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries do so by themselves
        ctypes.CDLL(None).malloc_trim(0)


def map_text(df: DataFrame, make: Callable[[], Callable], fields: Sequence[tuple[str, str]], *, text: str = "text", keep: Sequence[str] = ("doc_id",), sizes: int = SEGMENT_BYTES) -> DataFrame:
    """Columns `keep` of df beside the columns `fields` that a kernel derives from the whole text of each row.

    make() runs once in each task and returns kernel(texts) -> one Arrow array for each field; texts is a large_binary
    array without nulls (a null text is empty). Derived columns replace kept ones of the same name. No rows, no calls.
    """
    new = [name for name, _ in fields]
    kept = [k for k in keep if k not in new]
    given = df.select(*[F.col(f"`{k}`") for k in kept], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = T.StructType([*given.schema.fields[:-1], *T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields)).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = make()
        for batch in batches:
            texts = batch.column(len(kept)).cast(pa.large_binary()).fill_null(b"")
            lengths = pa.compute.binary_length(texts).to_pylist()
            for lo, hi in segments(lengths, sizes):
                part = batch.slice(lo, hi - lo)
                made = kernel(texts.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *made], names=[*kept, *new])
        del kernel
        let_go()

    return given.mapInArrow(run, schema)


def aside(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with its columns under names of no other use (__0, __1, ...), and the new name of each."""
    alias = {c: f"__{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*alias.values()), alias


#: Rows of a looked-up table (of some hundred bytes each) that are broadcast.
BROADCAST_ROWS = 10_000


def looked_up(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """rows beside the columns of a written table with one row for each key (its `weight`: how many of the rows have that key): by broadcast if the
    table has few rows. Otherwise keys with more than a BROADCAST_ROWS-th of all rows, which are fewer than that, are broadcast, and
    their rows spread over the shuffle that joins the others. Rows whose key the table lacks have nulls."""
    n, total = table.agg(F.count("*"), F.sum(weight)).first()
    names = [c for c in table.columns if c not in (key, weight)]
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table.drop(weight)), key, "left")
    hot = table.where(F.col(weight) > total // BROADCAST_ROWS).select(key, F.lit(True).alias("__hot"), *[F.col(c).alias(f"__hot_{c}") for c in names])
    first = rows.join(F.broadcast(hot), key, "left")
    known = F.col("__hot").isNotNull()
    spread_ = F.when(known, F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16)))
    rest = table.select(F.col(key).alias("__key"), F.lit(-1).cast("long").alias("__spread"), *[F.col(c).alias(f"__own_{c}") for c in names])
    both = first.withColumn("__dealt", F.coalesce(spread_, F.lit(-1).cast("long"))).join(rest, (F.col(key) == F.col("__key")) & (F.col("__dealt") == F.col("__spread")), "left")
    return both.select(*rows.columns, *[F.when(known, F.col(f"__hot_{c}")).otherwise(F.col(f"__own_{c}")).alias(c) for c in names])
