"""Tables and files: Parquet or JDBC scans, binary files by catalogued path, archives, and their extraction to rows."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary import schema as S
from foliary.functions import text as X
from foliary.functions.letters import with_letters
from foliary.sources import parsers, stored


def table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def jdbc_table(spark: SparkSession, url: str, name: str, *, key: str, lower: int, upper: int, partitions: int, **options: str) -> DataFrame:
    """A database table, read in ranges of a numeric key."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, partitionColumn=key, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions))
    return reader.options(**options).load()


def stored_files(spark: SparkSession, *paths: str, pattern: str | None = None) -> DataFrame:
    """path and content of files in any store that Spark reads."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(list(paths)).select("path", "content")


def catalogued(catalog: DataFrame, files: DataFrame, base: str, default_year: str = "2023") -> DataFrame:
    """The catalogue's rows with path and content; content is null where no file lies at the path. Schemes of paths don't matter."""
    bare = lambda c: F.regexp_replace(c, r"^[a-z0-9]+:/+", "/")
    path = X.resolved_path(F.col("org_file_path"), F.col("save_file_name"), F.col("transferyear"), F.col("rc_rfile_no"), F.col("rc_ritem_no"), base, default_year)
    found = files.select(bare(F.col("path")).alias("path"), "content")
    return catalog.withColumn("path", bare(path)).join(found, "path", "left")


def scan_catalogued(catalog: DataFrame, base: str, default_year: str = "2023", **plan) -> DataFrame:
    """The catalogue's rows with path and content, which tasks read by path: nothing else is listed or read, and no content is shuffled. Content is null where no file
    lies at the path."""
    path = X.resolved_path(F.col("org_file_path"), F.col("save_file_name"), F.col("transferyear"), F.col("rc_rfile_no"), F.col("rc_ritem_no"), base, default_year)
    return stored.scanned(catalog.withColumn("path", path), **plan)


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt evenly over the cores where they come in fewer partitions than these (small tables before costly maps)."""
    if rows.isStreaming:
        return rows
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


#: Bytes of rows that a worker turns into Python values and results at a time.
STEP_BYTES = 1 << 20


def stepped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about STEP_BYTES, so that what is made of one leaves the worker before the next: a batch has up to 10,000 rows whatever they hold."""
    for batch in batches:
        n = batch.num_rows
        step = max(1, STEP_BYTES * n // max(1, batch.nbytes))
        for lo in range(0, n, step):
            yield batch.slice(lo, step)


Columns = list[tuple[str, str, pa.DataType]]


def results(batches: Iterator[pa.RecordBatch], keep: tuple[str, ...], columns: Columns, inputs: tuple[str, ...], make) -> Iterator[pa.RecordBatch]:
    """The rows of `columns` (name, kind, Arrow type) that make(*inputs) gives for each row of the batches, beside the row's columns `keep`. What is made is let go of by
    the STEP_BYTES, also within a row."""
    names = [*keep, *(c[0] for c in columns)]

    def table(batch: pa.RecordBatch, source: list[int], out: list[tuple]) -> pa.RecordBatch:
        at = pa.array(source, pa.int32())
        return pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in keep), *(pa.array(v, c[2]) for v, c in zip(zip(*out, strict=True), columns, strict=True))], names=names)

    for batch in stepped(batches):
        source, out, size = [], [], 0
        for i, given in enumerate(zip(*(batch.column(c).to_pylist() for c in inputs), strict=True)):
            for row in make(*given):
                source.append(i)
                out.append(row)
                size += sum(len(v) for v in row if isinstance(v, (str, bytes)))
                if size >= STEP_BYTES:
                    yield table(batch, source, out)
                    source, out, size = [], [], 0
        if out:
            yield table(batch, source, out)


def _made(rows: DataFrame, keep: tuple[str, ...], columns: Columns, inputs: tuple[str, ...], make) -> DataFrame:
    """results() of the rows, by one pass of Python."""
    rows = rows.select(*dict.fromkeys((*keep, *inputs)))
    return rows.mapInArrow(lambda batches: results(batches, keep, columns, inputs, make), rows.select(*keep, *[F.lit(None).cast(kind).alias(name) for name, kind, _ in columns]).schema)


def _is_archive(name: str) -> Column:
    return F.coalesce(X.extension(F.col(name)) == "zip", F.lit(False))


_PLACE: Columns = [("zip_seq", "int", pa.int32()), ("entry_name", "string", pa.string())]
_WRONG: Columns = [("code", "string", pa.string()), ("message", "string", pa.string())]
_BYTES: Columns = [("content", "binary", pa.binary())]
_RESULT: Columns = [(n, "string", pa.string()) for n in ("status", "code", "message", "media_type", "contents")]


def _files(rows: DataFrame, keep: tuple[str, ...], columns: Columns, make, name: str = "save_file_name", inputs: tuple[str, ...] = ("content",), content=None) -> DataFrame:
    """zip_seq, entry_name and the rows of `columns` that make(own name, content, code, message) gives for each file, archives being opened in the same pass: an
    entry is let go of before the next is read. The bytes are the column content, or what content(*inputs) gives."""

    def run(archive: bool, name: str, *given):
        stored = content(*given) if content else given[0]
        for e in parsers.opened(stored) if archive else ({"seq": 0, "name": None, "content": stored, "code": None, "message": None},):
            for row in make(name if e["name"] is None else e["name"], e["content"], e["code"], e["message"]):
                yield e["seq"], e["name"], *row

    return _made(rows.withColumn("__archive", _is_archive(name)), keep, [*_PLACE, *columns], ("__archive", name, *inputs), run)


def expand_archives(rows: DataFrame, name: str = "save_file_name") -> DataFrame:
    """A row for each file: archives by extension give their entries (zip_seq from 1; 0 and a code if none can be had), others
    stay as they are with zip_seq 0. Adds zip_seq, entry_name, code, message; content is the entry's."""
    none = F.lit(None).cast("string")
    outer = rows.where(~_is_archive(name)).select("*", F.lit(0).alias("zip_seq"), none.alias("entry_name"), none.alias("code"), none.alias("message"))
    others = tuple(c for c in rows.columns if c != "content")
    inner = _files(rows.where(_is_archive(name)), others, [*_BYTES, *_WRONG], lambda _, *found: (found,), name)
    return outer.unionByName(inner)


def parse_files(rows: DataFrame, *, keep: tuple[str, ...], name: str = "save_file_name", inputs: tuple[str, ...] = ("content",), content=None, more: parsers.Parsers | None = None, count_images: bool = False) -> DataFrame:
    """Columns `keep` of the rows with zip_seq, entry_name, status, code, message, media_type and contents of each file and each entry of an archive, all in one pass
    of Python. Bytes that aren't the column content are what content(*inputs) gives. n_images counts pictures where that is asked for, else it is 0."""
    known = parsers.PARSERS | (more or {})

    def make(name: str, stored: bytes | None, code: str | None, message: str | None):
        found = parsers.extract(name, stored, known=known) if code is None else {"status": S.FAIL, "code": code, "message": message, "media_type": None, "contents": None}
        return ((*(found[c[0]] for c in _RESULT), len(parsers.images(stored)) if count_images else 0),)

    return _files(rows, keep, [*_RESULT, ("n_images", "int", pa.int32())], make, name, inputs, content)


def extract_files(rows: DataFrame, *, more: parsers.Parsers | None = None, images: str | None = None) -> DataFrame:
    """Extracted documents (foliary.schema.EXTRACTS without idx and summaries) of catalogued rows with content, by the registered parsers and
    `more`, which the tasks get from here. With a base folder for pictures img_datas maps their names to where image_files puts them."""
    own = F.coalesce("entry_name", "save_file_name")
    done = parse_files(rows, keep=("transferyear", "rc_rfile_no", "rc_ritem_no", "prodyear", "save_file_name"), more=more, count_images=images is not None)
    pictures = F.lit("[]")
    if images is not None:
        pictures = F.when(F.col("n_images") > 0, X.image_map(F.transform(F.sequence(F.lit(1), F.greatest("n_images", F.lit(1))), lambda i: _image_path(images, own, i)))).otherwise("[]")
    contents = X.normalize_extracted(F.col("contents"))
    zipped = X.extension(F.col("save_file_name")) == "zip"
    made = done.select(
        F.col("save_file_name").alias("file_name"), "rc_rfile_no", "rc_ritem_no", "zip_seq", F.col("entry_name").alias("zip_entry_file_name"), contents.alias("contents"), pictures.alias("img_datas"),
        X.effective_type(F.col("save_file_name"), F.when(zipped, "ZIP"), F.col("media_type")).alias("file_type"), X.file_group(own).alias("file_gubun"), contents.alias("indexing_contents"),
        X.data_year(F.col("transferyear"), F.col("prodyear")).alias("data_year"), F.when(X.has_text(contents), "Y").otherwise("N").alias("has_contents"), F.col("status").alias("extract_status"),
        F.when(F.col("code").isNotNull(), F.concat_ws(": ", "code", "message")).alias("extract_err_msg"),
    )
    return with_letters(made)


_IMAGE: Columns = [("seq", "int", pa.int32()), ("data", "binary", pa.binary())]


def _image_path(base: str, name: Column, seq: Column) -> Column:
    """base/year/file/item/name without extension/imgN.png; an entry of an archive stands below the archive's name."""
    stem = lambda c: F.regexp_replace(c, r"\.[^.]*$", "")
    below = F.when(F.col("entry_name").isNotNull(), F.concat_ws("/", stem(F.col("save_file_name")), stem(F.col("entry_name")))).otherwise(stem(name))
    return F.concat(F.concat_ws("/", F.lit(base), "transferyear", "rc_rfile_no", "rc_ritem_no", below), F.lit("/img"), seq.cast("string"), F.lit(".png"))


def image_files(rows: DataFrame, base: str, name: str = "save_file_name") -> DataFrame:
    """A row for each picture in the files of catalogued rows and in the entries of their archives: keys, entry_name (null outside archives), seq,
    data and the path that it belongs at. stored.put_files(pictures, base, "image_path") puts them there."""
    rows = rows.withColumn("save_file_name", F.col(name))
    keep = tuple(dict.fromkeys(("transferyear", "rc_rfile_no", "rc_ritem_no", "save_file_name", name)))
    found = _files(rows, keep, _IMAGE, lambda _, content, *__: [(i["seq"], i["data"]) for i in parsers.images(content)], name)
    return found.select("rc_rfile_no", "rc_ritem_no", name, "entry_name", "seq", _image_path(base, F.col(name), F.col("seq")).alias("image_path"), "data")


def page_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] | None = None) -> DataFrame:
    """pages (or their columns `keep`) with text: the whole body's text, tables as rows of cells; null where a page can't be read within the parsers' time. Spark can't
    tell which columns are needed after a pass of Python, so `keep` spares large ones the way there and back."""
    keep = tuple(pages.columns) if keep is None else keep
    rows = spread(pages.select(*keep, F.col(html).cast("binary").alias("__b")))
    made = _made(rows, keep, [("text", "string", pa.string())], ("__b",), lambda b: ((parsers.extract("page.html", b or b"")["contents"],),))
    return made.withColumn("text", X.normalize_extracted(F.col("text")))


def prompts(spark: SparkSession, path: str) -> dict[str, str]:
    """Prompt templates by name: *.txt below a path. A handful of small files, so they come to the driver."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path", F.decode("content", "UTF-8").alias("text")).collect()
    found = {Path(r["path"]).stem: r["text"] for r in rows}
    if not found:
        raise ValueError(f"no prompt template below {path}")
    return found


def prompt(templates: dict[str, str], name: str) -> str:
    if name not in templates:
        raise ValueError(f"unknown prompt {name}; there are {', '.join(sorted(templates))}")
    return templates[name]
