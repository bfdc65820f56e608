"""Data sources over single files in a store: a scan of the files that a catalogue names, and a sink that puts the bytes of each row at its path.

The scan goes over a plan: the catalogue's rows with path and size, dealt into splits of about SPLIT_BYTES, one Parquet file each. Spark makes the plan (sizes
are asked for in tasks; what is shuffled are these rows alone), the source lists its files, and a task opens what its split names. So content is read where it is
used and lies in no exchange, a store is never listed, and files that nobody wants aren't touched.

The sink writes beside the target and renames: a task that is tried again, or twice at once, leaves one file a path, whole or not at all; what attempts that failed have
left lies in one folder, which goes at commit and at abort.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from foliary.sources import shared

SPLIT_BYTES = 1 << 27
#: What opening a file counts for, in bytes (a split has so some thousand small files, and not a task for each hundred); rows with content that leave a task at once; a larger file is an error of its row.
OPEN_BYTES, BATCH_BYTES, MOST_BYTES = 1 << 15, 1 << 26, (1 << 31) - 1024


def _store(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Stores:
    """File systems by the scheme and host of paths, made once a task."""

    def __init__(self) -> None:
        self.known: dict[str, object] = {}

    def __call__(self, path: str):
        """The file system of a path, and the path in it as it stands, whatever characters it has."""
        head, mark, rest = path.partition("://")
        key = f"{head}://{rest.split('/', 1)[0]}/" if mark else "/"
        if key not in self.known:
            self.known[key] = _store(key)[0]
        if not mark:
            return self.known[key], path.removeprefix("file:")
        return self.known[key], f"/{rest.split('/', 1)[-1]}" if head in ("file", "hdfs", "viewfs") else rest


def planned(rows: DataFrame, path: str = "path", *, split_bytes: int = SPLIT_BYTES, plan: str | None = None) -> str:
    """Writes the plan of a scan over rows (with the path of a file in each; null: none) to a folder and returns it."""
    spark, plan = rows.sparkSession, plan or shared.scratch(rows.sparkSession)
    names, at = rows.columns, rows.columns.index(path)

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        stores, before, task = _Stores(), 0, TaskContext.get().partitionId()
        for batch in batches:
            paths, places = batch.column(at).to_pylist(), []
            sizes, asked = [None] * len(paths), {}
            for i, p in enumerate(paths):
                if p is not None:
                    store, own = stores(p)
                    asked.setdefault(id(store), (store, [], []))[1].append(i)
                    asked[id(store)][2].append(own)
            for store, rows_, owns in asked.values():  # a store is asked once a batch
                for i, info in zip(rows_, store.get_file_info(owns), strict=True):
                    sizes[i] = info.size if info.is_file else None
            for size in sizes:
                places.append(before)
                before += (size or 0) + OPEN_BYTES
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array([task] * len(sizes), pa.int32()), pa.array(places, pa.int64())], names=[*names, "__size", "__task", "__before"])

    schema = rows.withColumns({"__size": F.lit(0).cast("long"), "__task": F.lit(0), "__before": F.lit(0).cast("long")}).schema
    schema = StructType([*rows.schema.fields, *schema.fields[-3:]])
    for f in schema.fields[-3:]:
        f.nullable = True
    rows.mapInArrow(sized, schema).write.parquet(f"{plan}/sized")
    known = spark.read.schema(schema).parquet(f"{plan}/sized")
    tasks, offsets, total = known.groupBy("__task").agg(F.max(F.col("__before") + F.coalesce("__size", F.lit(0)) + OPEN_BYTES).alias("n")).orderBy("__task").collect(), [], 0
    for t in tasks:  # a row for each task
        offsets.append((t["__task"], total))
        total += t["n"]
    split_bytes = max(1, min(split_bytes, -(-total // spark.sparkContext.defaultParallelism)))  # a split for each core at least
    splits = max(1, -(-total // split_bytes))
    table = F.broadcast(spark.createDataFrame(offsets, "__task int, __offset bigint"))
    split = F.floor((F.col("__offset") + F.col("__before")) / F.lit(split_bytes)).cast("int")
    dealt = known.join(table, "__task").withColumn("__split", split).repartitionById(splits, F.col("__split")).sortWithinPartitions(path)
    dealt.select(*[F.col(f"`{c}`") for c in rows.columns], "__size").write.parquet(f"{plan}/splits")
    return f"{plan}/splits"


@dataclass
class Split(InputPartition):
    file: str


class _Scan(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.plan, self.path, self.content, self.names = options["plan"], options.get("pathcolumn", "path"), options.get("contentcolumn", "content"), schema.names

    def partitions(self) -> list[Split]:
        from pyarrow import fs

        store, root = _store(self.plan)
        return [Split(f.path) for f in store.get_file_info(fs.FileSelector(root)) if f.path.endswith(".parquet")] or [Split("")]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        stores, held, size = _Stores(), [], 0
        with _store(self.plan)[0].open_input_file(partition.file) as source:
            for batch in pq.ParquetFile(source).iter_batches(batch_size=4096):
                sizes, paths = batch.column("__size").to_pylist(), batch.column(self.path).to_pylist()
                lo = 0
                for i, (n, path) in enumerate(zip(sizes, paths, strict=True)):
                    content = None
                    if n is not None and n <= MOST_BYTES:
                        store, own = stores(path)
                        try:
                            with store.open_input_stream(own, compression=None) as f:
                                content = f.read()
                        except FileNotFoundError:  # gone since it was planned
                            content = None
                    held.append(content)
                    size += len(content or b"")
                    if size >= BATCH_BYTES:
                        yield self._made(batch.slice(lo, i + 1 - lo), held)
                        lo, held, size = i + 1, [], 0
                if held:
                    yield self._made(batch.slice(lo), held)
                    held, size = [], 0

    def _made(self, rows: pa.RecordBatch, content: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(content, pa.binary()) if c == self.content else rows.column(c) for c in self.names], names=self.names)


class CataloguedFiles(DataSource):
    """format("foliary_catalogued").option("plan", planned(...)).schema(the rows' columns and content binary)."""

    @classmethod
    def name(cls) -> str:
        return "foliary_catalogued"

    def reader(self, schema: StructType) -> _Scan:
        return _Scan(schema, self.options)


def scanned(rows: DataFrame, path: str = "path", content: str = "content", **plan) -> DataFrame:
    """rows with the content of the file at each path; null where no file lies there, or one of more than MOST_BYTES. The plan is made at once and stays; content
    is read whenever the result is."""
    spark = rows.sparkSession
    spark.dataSource.register(CataloguedFiles)
    schema = StructType(list(rows.schema.fields)).add(content, "binary")
    return spark.read.format(CataloguedFiles.name()).schema(schema).option("plan", planned(rows, path, **plan)).option("pathcolumn", path).option("contentcolumn", content).load()


@dataclass
class Written(WriterCommitMessage):
    files: int


class _Sink(DataSourceArrowWriter):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.path, self.data = (schema.names.index(options.get(k, d)) for k, d in (("pathcolumn", "path"), ("datacolumn", "data")))
        self.attempts = f"{options['base'].rstrip('/')}/_attempts/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        stores, n, made = _Stores(), 0, set()
        store, attempts = _store(self.attempts)
        store.create_dir(attempts, recursive=True)
        for batch in iterator:
            for path, data in zip(batch.column(self.path), batch.column(self.data), strict=True):
                if not path.is_valid or not data.is_valid:
                    continue
                _, final = stores(path.as_py())
                if (folder := posixpath.dirname(final)) not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                beside = f"{attempts}/{uuid.uuid4().hex}"
                with store.open_output_stream(beside, compression=None) as out:
                    out.write(data.as_buffer())
                store.move(beside, final)
                n += 1
        return Written(n)

    def _over(self) -> None:
        store, attempts = _store(self.attempts)
        from pyarrow import fs

        if store.get_file_info(attempts).type == fs.FileType.Directory:
            store.delete_dir(attempts)

    def commit(self, messages: list) -> None:
        self._over()

    def abort(self, messages: list) -> None:
        self._over()


class FileSink(DataSource):
    """format("foliary_files").option("base", a folder of the same store): the column data of each row at its column path. Rows without either are left out; of
    rows with one path one stays."""

    @classmethod
    def name(cls) -> str:
        return "foliary_files"

    def writer(self, schema: StructType, overwrite: bool) -> _Sink:
        return _Sink(schema, self.options)


def put_files(rows: DataFrame, base: str, path: str = "path", data: str = "data") -> None:
    """Writes the column data of each row to its path; paths lie below base."""
    rows.sparkSession.dataSource.register(FileSink)
    rows.select(F.col(f"`{path}`").alias("path"), F.col(f"`{data}`").alias("data")).write.format(FileSink.name()).option("base", base).mode("append").save()


def register(spark: SparkSession) -> None:
    """Both sources under their names, for readers and writers of the session."""
    for source in (CataloguedFiles, FileSink):
        spark.dataSource.register(source)
