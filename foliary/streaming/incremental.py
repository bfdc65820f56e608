"""The same operators on files as they arrive: each micro-batch is extracted, chunked and written by key, so a batch that is run again
after a failure leaves the same rows. What a query must know of earlier rows it keeps as state in RocksDB, by key and for a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from foliary.operators import chunking, merge
from foliary.operators import selection as Q
from foliary.operators.keyed import KeyedTable
from foliary.plans import workflow


def arriving(spark: SparkSession, path: str, schema, *, files_at_once: int = 1000) -> DataFrame:
    """Rows of Parquet files below a path, those that are new at each trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, *, continuous: str | None = None) -> StreamingQuery:
    """write(rows, batch) for each micro-batch: all there is now, or at every interval."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)).start()


def chunk_stream(stream: DataFrame, chunks_path: str, checkpoint: str, *, size: int, overlap: int) -> StreamingQuery:
    """Chunks of arriving documents (extract_idx, file_name, zip_entry_file_name, indexing_contents), one folder for each batch, written over
    if the batch is run again."""

    def write(rows: DataFrame, batch: int) -> None:
        chunking.chunk_documents(rows, size=size, overlap=overlap, marker=True).write.mode("overwrite").parquet(f"{chunks_path}/batch={batch}")

    return each_batch(stream, write, checkpoint)


def progress_by_window(events: DataFrame, *, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Counts of a run's item events by window and status, with late rows up to `late`."""
    return events.withWatermark("at", late).groupBy(F.window("at", window), "status").agg(F.count("*").alias("n"))


class _FirstOnly(StatefulProcessor):
    """Lets the first row of a key through, and no other until the key has been forgotten."""

    def __init__(self, ttl_ms: int | None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.seen.exists():
            return
        self.seen.update((True,))
        yield min(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))  # of those that come at once the least

    def close(self) -> None:
        pass


def once_each(stream: DataFrame, *key: str, ttl_seconds: float | None = None) -> DataFrame:
    """The first row of each key, once a run however often the key arrives; with a time to live a key counts as new again that long after its first row, and its
    state goes; such a query has no last batch, so run it by an interval, not for what is there now. State is by key, so it is spread like any grouping; a key that comes very often costs its rows and one flag."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    first = _FirstOnly(None if ttl_seconds is None else int(ttl_seconds * 1000))
    return stream.groupBy(*key).transformWithState(first, stream.schema, "Append", "None" if ttl_seconds is None else "ProcessingTime")


def extract_stream(stream: DataFrame, extracts: KeyedTable, base: str, checkpoint: str, p: Q.Params, **how) -> StreamingQuery:
    """Files as their catalogue rows arrive: of each micro-batch those that no extract row has settled (an anti-join with the table as it is then) are read, extracted
    and merged into the table's touched buckets. A batch that is run again finds its rows settled."""

    def write(rows: DataFrame, batch: int) -> None:
        _, made = workflow.extract_run(rows, extracts.read(), base, p, **how)
        extracts.merge(made, merge.upsert_extracts)

    return each_batch(stream, write, checkpoint)
