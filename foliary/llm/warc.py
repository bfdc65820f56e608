"""WARC archives of pages, with a globally ordered index of captures.

Writing: equal payloads are told by their SHA-256 and size. The row with the least id of each group is written as a response with its payload, the others
as revisits that name it and hold no more than the HTTP head, so a payload is stored once. Tasks write archives (WARC 1.1, a gzip member a
record, ARCHIVE_BYTES at most but for one larger record) straight to the shared folder, each under a name of its own.

Index, by external merge: a task sorts what it has written by URL key and timestamp, RUN_ROWS captures at a time, and gives these *runs* out as rows of a Parquet
table, which Spark commits with the task: what a lost or repeated attempt has written is in no run, so it is no part of the archives. The runs are
then dealt by ranges of (URL key, timestamp, id), where each range's share of every run arrives in order, and a loser tree merges them: k - 1
comparisons to set up, then one path of the tree for each capture, whatever k is. Ranges follow each other, so the index is ordered as a whole, and since
the timestamp and the id are part of the range, the captures of one URL may fill many ranges.

Reading: the index is dealt by archive and offset, neighbouring records are read at once, and each payload is held against its digest.

Null payloads are empty; those of fewer than `least_bytes` bytes are all responses. Of rows that repeat an id and a payload one is the response. A row
without an id comes after all others in its group; where only such rows are, the revisits refer to none. Null URLs come first in the index. Characters that
a header can't hold are percent-encoded in its URL. Payloads of any length are kept whole (one record in memory at a time); no rows, no archives.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliary.llm.frames import Held, let_go, looked_up, scratch, segments, written

#: Bytes of an archive, of what is read at once, and of the records that one task reads.
ARCHIVE_BYTES, READ_BYTES, TASK_BYTES = 1 << 30, 1 << 22, 1 << 24
#: Captures that a task sorts at once, and that a merging task holds.
RUN_ROWS, MERGE_ROWS = 1 << 17, 1 << 17
#: The time of captures that have none of their own.
CAPTURED = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_KEPT = "!#$%&'()*+,/:;=?@[]~-._"
RESPONSE, REVISIT = "response", "revisit"


def url_key(url: Column) -> Column:
    """The key that captures are ordered by: the host's labels from the last to the first, then port, path and query; lower case, without scheme, user and fragment."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?|^//", ""), r"#.*$", "")
    host = F.regexp_extract(bare, r"^([^/:?]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.substr(bare, F.length(host) + 1))


def digest(sha1_hex: str) -> str:
    """A SHA-1 in upper-case base32."""
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _named(page_id: object) -> str:
    """An id as part of a record's name; ~ is no id."""
    return "~" if page_id is None else quote(str(page_id), safe="").replace("~", "%7E")


def record(page_id: object, url: str | None, date: str, kind: str, refers_to: object, sha1: str, size: int, payload: bytes | None, own: str) -> bytes:
    """A WARC record, not compressed. `own` names records that no other refers to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {kind}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_KEPT)}")
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest(sha1)}", f"Page-ID: {_named(page_id)}"]
    if kind == REVISIT:
        head += [f"WARC-Record-ID: <urn:capture:{own}>", f"WARC-Refers-To: <urn:page:{_named(refers_to)}:{digest(sha1)}>", f"WARC-Profile: {_PROFILE}"]
        body = http
    else:
        head.append(f"WARC-Record-ID: <urn:page:{_named(page_id)}:{digest(sha1)}>" if own == "" else f"WARC-Record-ID: <urn:capture:{own}>")
        body = http + (payload or b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def packed(raw: bytes) -> bytes:
    """A gzip member of its own."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def parse_record(member: bytes) -> dict:
    """What a record says (one gzip member), held against itself: page_id and refers_to as text, url, date, record_type, payload_bytes, payload_digest, payload (null in revisits)."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    if len(body) != int(fields["Content-Length"]) or rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("a record of another length than it says")
    http, _, payload = body.partition(b"\r\n\r\n")
    size, told, kind = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1]), fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == RESPONSE and (len(payload) != size or digest(hashlib.sha1(payload).hexdigest()) != told):
        raise ValueError("a payload that isn't what its digest says")
    name = lambda x: None if x == "~" else unquote(x)
    refers = name(fields["WARC-Refers-To"].strip("<>").split(":")[2]) if kind == REVISIT else None
    return {"page_id": name(fields["Page-ID"]), "url": fields.get("WARC-Target-URI"), "date": fields["WARC-Date"], "record_type": kind, "refers_to": refers, "payload_bytes": size, "payload_digest": told, "payload": payload if kind == RESPONSE else None}


def _captures(pages: DataFrame, page_id: str, url: str, html: str, date: str | None, least_bytes: int, held: Held) -> DataFrame:
    """page_id, url, urlkey, date, kind, refers_to, sha1, size, payload (null in revisits) and alone (whether no record can refer to it)."""
    payload, when = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary"), F.coalesce(F.col(f"`{date}`").cast("string"), F.lit(CAPTURED)) if date else F.lit(CAPTURED)
    given = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), when.alias("date"), payload.alias("payload"))
    given = given.select("page_id", "url", url_key(F.col("url")).alias("urlkey"), "date", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("key"), "payload")
    given = given.withColumn("key", F.when(F.col("size") >= least_bytes, F.concat_ws(":", "key", F.col("size").cast("string"))))
    each = given.where("key IS NOT NULL").groupBy("key", "page_id").agg(F.count("*").alias("ties"))
    groups = each.groupBy("key").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "ties")).alias("f"), F.sum("ties").alias("n")).where("n > 1")
    groups = held(groups.select("key", "n", F.col("f.page_id").alias("first"), F.col("f.ties").alias("ties")))
    rows = looked_up(given, groups, "key", "n")
    head = F.col("ties").isNull() | F.col("page_id").eqNullSafe(F.col("first"))
    columns = lambda kind: ("page_id", "url", "urlkey", "date", kind.alias("kind"), F.when(kind == REVISIT, F.col("first")).alias("refers_to"), "sha1", "size", F.when(kind == RESPONSE, F.col("payload")).alias("payload"), F.col("ties").isNull().alias("alone"))
    out = rows.where(~head | (F.coalesce("ties", F.lit(1)) == 1)).select(*columns(F.when(head, RESPONSE).otherwise(REVISIT)))
    if groups.where("ties > 1").take(1):  # rows that repeat the least id and its payload: one of them is written
        tied = rows.where(head & (F.col("ties") > 1))
        numbered = held(tied.drop("payload").withColumn("row", F.monotonically_increasing_id()))
        chosen = held(numbered.groupBy("key").agg(F.min("row").alias("chosen"), F.count("*").alias("m")))
        numbered = looked_up(numbered, chosen, "key", "m")
        payloads = tied.groupBy("key").agg(F.first("payload").alias("payload"))
        out = out.unionByName(numbered.where("row = chosen").join(payloads, "key").select(*columns(F.lit(RESPONSE)))).unionByName(numbered.where("row <> chosen").withColumn("payload", F.lit(None).cast("binary")).select(*columns(F.lit(REVISIT))))
    return out


_PLACE = [T.StructField("archive", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())]
_ORDER = ("urlkey", "date", "page_id", "archive", "offset")


def _run_schema(captures: DataFrame) -> T.StructType:
    return T.StructType([captures.schema[c] for c in ("urlkey", "date", "page_id", "url", "kind")] + _PLACE)


def _sort_keys(columns: Sequence[list]) -> list[tuple]:
    """Comparable keys of captures: nulls first, as Spark orders them."""
    return [tuple(x for v in row for x in (v is not None, v)) for row in zip(*columns, strict=True)]


def _written_runs(captures: DataFrame, path: str) -> DataFrame:
    """Writes the archives below path; the rows are the captures of each task as sorted runs."""
    schema, names = _run_schema(captures), captures.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as arrow_fs

        fs, root = arrow_fs.FileSystem.from_uri(path)
        arrow, archive, out, at, held = None, "", None, 0, []

        def sorted_run() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            keys = _sort_keys([rows.column(c).to_pylist() for c in _ORDER])
            return rows.take(pa.array(sorted(range(len(keys)), key=keys.__getitem__), pa.int64())).combine_chunks().to_batches()[0]

        try:
            for batch in batches:
                sizes = [n or 0 for n in pa.compute.binary_length(batch.column(names.index("payload"))).to_pylist()]
                for lo, hi in segments(sizes):
                    part, places = batch.slice(lo, hi - lo), []
                    for page_id, url, date, kind, refers_to, sha1, size, payload, alone in zip(*(part.column(names.index(c)).to_pylist() for c in ("page_id", "url", "date", "kind", "refers_to", "sha1", "size", "payload", "alone")), strict=True):
                        own = f"{archive}:{at}" if alone or kind == REVISIT else ""
                        member = packed(record(page_id, url, date, kind, refers_to, sha1, size, payload, own))
                        if out is None or (at and at + len(member) > ARCHIVE_BYTES):
                            if out is not None:
                                out.close()
                            archive, at = f"{uuid.uuid4().hex}.warc.gz", 0
                            fs.create_dir(root, recursive=True)
                            out = fs.open_output_stream(f"{root}/{archive}", compression=None)
                            if own:
                                member = packed(record(page_id, url, date, kind, refers_to, sha1, size, payload, f"{archive}:0"))
                        out.write(member)
                        places.append((archive, at, len(member)))
                        at += len(member)
                    archives, offsets, lengths = zip(*places, strict=True)
                    columns = [part.column(names.index(f.name)) for f in schema.fields[:-3]]
                    arrow = arrow or pa.schema([(f.name, c.type) for f, c in zip(schema.fields, columns, strict=False)] + [("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
                    held.append(pa.RecordBatch.from_arrays([*columns, pa.array(archives, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], schema=arrow))
                    if sum(len(b) for b in held) >= RUN_ROWS:
                        yield sorted_run()
                        held = []
        finally:
            if out is not None:
                out.close()
        if held:
            yield sorted_run()
        del held
        let_go()

    return captures.mapInArrow(run, schema)


class LoserTree:
    """Merges sorted lists: an inner node keeps the loser of its subtree's match, so the next winner takes one path from its leaf up."""

    def __init__(self, runs: Sequence[Sequence]) -> None:
        self.runs, self.at, k = runs, [0] * len(runs), len(runs)
        self.losers, self.winner = [-1] * k, -1
        for leaf in range(k):
            self._play(leaf, first=True)

    def _beats(self, a: int, b: int) -> bool:
        """Whether the run a goes before b: by its next item, then by its number; a run at its end goes last."""
        if self.at[a] == len(self.runs[a]):
            return False
        if self.at[b] == len(self.runs[b]):
            return True
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return x < y or (not y < x and a < b)

    def _play(self, leaf: int, first: bool = False) -> None:
        winner, node = leaf, (leaf + len(self.runs)) // 2
        while node:
            rival = self.losers[node]
            if first and rival < 0:  # waits here for the other side's winner
                self.losers[node] = winner
                return
            if self._beats(rival, winner):
                self.losers[node], winner = winner, rival
            node //= 2
        self.winner = winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, place in it) of every item in order."""
        while self.runs and self.at[self.winner] < len(self.runs[self.winner]):
            run = self.winner
            yield run, self.at[run]
            self.at[run] += 1
            self._play(run)


def ascending_runs(keys: Sequence) -> list[tuple[int, int]]:
    """The longest stretches of keys that don't descend."""
    edges = [0, *(i for i in range(1, len(keys)) if keys[i] < keys[i - 1]), len(keys)]
    return list(zip(edges[:-1], edges[1:], strict=True)) if keys else []


def merge_runs(runs: DataFrame) -> DataFrame:
    """The captures of a written table of runs in one order over all partitions. What a merging task gets of a run comes in order, so stretches that ascend are
    runs again, in whatever order they arrive."""
    ranges = max(1, -(-runs.count() // MERGE_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        keys = _sort_keys([table.column(c).to_pylist() for c in _ORDER])
        stretches = ascending_runs(keys)
        order = [stretches[r][0] + i for r, i in LoserTree([keys[a:b] for a, b in stretches])]
        yield from table.take(pa.array(order, pa.int64())).combine_chunks().to_batches(max_chunksize=1 << 14)
        del rows, table, keys
        let_go()

    return runs.repartitionByRange(ranges, *_ORDER).mapInArrow(run, runs.schema)


def write_archives(pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", html: str = "html", date: str | None = None, least_bytes: int = 0) -> None:
    """Archives, runs and index below path: path/archives/*.warc.gz, path/runs and path/index (Parquet, its files in order). `date` names a column of
    WARC dates (text, yyyy-mm-ddThh:mm:ssZ)."""
    held = Held(pages.sparkSession)
    captures = _captures(pages, page_id, url, html, date, least_bytes, held)
    runs = written(_written_runs(captures, f"{path}/archives"), f"{path}/runs")
    written(merge_runs(runs), f"{path}/index")
    held.clear()


def index(spark: SparkSession, path: str) -> DataFrame:
    """The captures: urlkey, date, page_id, url, kind, archive, offset, length."""
    return spark.read.parquet(f"{path}/index")


def history(spark: SparkSession, path: str, url: str) -> DataFrame:
    """The captures of one URL by time; of the ordered index only the row groups that can hold its key are read."""
    return index(spark, path).where(F.col("urlkey") == url_key(F.lit(url))).orderBy("date", "page_id")


def read_archives(captures: DataFrame, path: str, *, payloads: bool = False) -> DataFrame:
    """What the records of an index (or a part of one) say: page_id, url, date, record_type, refers_to, payload_bytes, payload_digest and, if asked for, payload."""
    kind = captures.schema["page_id"].dataType.simpleString()
    names = ["page_id", "url", "date", "record_type", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * payloads
    types = [pa.string()] * 5 + [pa.int64(), pa.string()] + [pa.binary()] * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as arrow_fs

        fs, root = arrow_fs.FileSystem.from_uri(f"{path}/archives")
        name, source = None, None
        for batch in batches:
            archives, offsets, lengths = (c.to_pylist() for c in batch.columns)
            i = 0
            while i < len(archives):
                j = i + 1  # neighbours, read at once
                while j < len(archives) and archives[j] == archives[i] and offsets[j] == offsets[j - 1] + lengths[j - 1] and offsets[j] + lengths[j] - offsets[i] <= READ_BYTES:
                    j += 1
                if archives[i] != name:
                    if source is not None:
                        source.close()
                    name, source = archives[i], fs.open_input_file(f"{root}/{archives[i]}")
                block = source.read_at(offsets[j - 1] + lengths[j - 1] - offsets[i], offsets[i])
                found = [parse_record(block[offsets[k] - offsets[i] : offsets[k] - offsets[i] + lengths[k]]) for k in range(i, j)]
                yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], t) for n, t in zip(names, types, strict=True)], names=names)
                i = j
        if source is not None:
            source.close()
        let_go()

    schema = ", ".join(f"{n} {'bigint' if n == 'payload_bytes' else 'binary' if n == 'payload' else 'string'}" for n in names)
    tasks = max(1, -(-(captures.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES))
    dealt = captures.select("archive", "offset", "length").repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    read = dealt.mapInArrow(run, schema)
    return read.withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_archives(index(spark, path), path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP11_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, t, CAST(strlen(t) AS BIGINT) AS payload_bytes, sha1(t) AS h, min(page_id) OVER (PARTITION BY t) AS f FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(5 * (3 - i % 4) AS INTEGER)) & 31) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN f = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN f <> page_id THEN f END AS refers_to
FROM h
"""
