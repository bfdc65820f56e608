"""Structure-aware chunks of archive documents, in one pass without a shuffle.

What can be told of a text as a whole (its normal form, role, kind, token estimates) are Column expressions. Splitting carries state
from line to line and from sentence to sentence, where nested array functions cost the square of a document's length, so it runs in
Arrow batches (foliary.operators.splitting), a document at a time. Offsets are code points; those of oversized parts are
approximate, since sentences are trimmed.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary import schema as S
from foliary.functions.text import has_text, let, lines, normalize_for_chunks, role_mark, token_estimate
from foliary.operators.splitting import HEADING_FORM, split
from foliary.sources.files import spread, stepped

#: The words and forms by which kinds of documents are told apart (a heading's own form is splitting's), and roles by the mark in the file name.
DRAFT_WORDS = ("수신", "경유", "제목", "시행", "접수", "결재", "붙임")
LAW_MARKS = (r"제\s*\d+\s*(장|절|관|조(?:\s*의\s*\d+)?)", "[①②③④⑤⑥⑦⑧⑨⑩]")
HEADING = f"(?m)^{HEADING_FORM}$"
ROLES = {"N": "DRAFT_BODY", "S": "ATTACHMENT"}


def doc_role(file_name: Column, entry_name: Column) -> Column:
    mark = role_mark(F.when(has_text(entry_name), entry_name).otherwise(file_name))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv]), mark), F.lit(S.UNKNOWN))


def table_like(text: Column) -> Column:
    """At least five lines, of which five (and a third) have a bar or four columns parted by wide gaps."""
    wide = lambda x: x.contains("|") | (F.size(F.split(F.regexp_replace(x, r"\s{2,}$", ""), r"\s{2,}")) >= 4)
    return let(lines(text), lambda rows: (F.size(rows) >= 5) & (F.size(F.filter(rows, wide)) >= F.greatest(F.lit(5), F.floor(F.size(rows) / 3))))


def law_score(text: Column) -> Column:
    return sum((F.regexp_count(text, F.lit(p)) for p in LAW_MARKS), F.lit(0))


def draft_score(text: Column) -> Column:
    return sum((F.contains(text, F.lit(w)).cast("int") for w in DRAFT_WORDS), F.lit(0))


def heading_score(text: Column) -> Column:
    return F.regexp_count(text, F.lit(HEADING))


def doc_type(text: Column, role: Column) -> Column:
    """By the first TYPE_SAMPLE characters, which is where a kind shows itself by definition: DRAFT, LAW, STRUCTURED, TABLE or GENERAL."""

    def kinds(sample: Column) -> Column:
        found = F.when((role == "DRAFT_BODY") & (draft_score(sample) >= 2), "DRAFT").when(law_score(sample) >= 5, "LAW").when(heading_score(sample) >= 4, "STRUCTURED")
        return found.when(table_like(sample), "TABLE").otherwise("GENERAL")

    return let(F.substring(text, 1, S.TYPE_SAMPLE), kinds)


def resolved_overlap(size: int, overlap: int) -> int:
    return size // 10 if overlap >= size else overlap


_LAW = ("law_chapter", "law_section", "law_article_no", "law_article_title", "law_article_content")


def chunk_documents(sources: DataFrame, *, size: int = S.CHUNK_SIZE, overlap: int = S.OVERLAP, parity: bool = True, keep: tuple[str, ...] = (), marker: bool = False) -> DataFrame:
    """Chunks (foliary.schema.CHUNKS, and columns `keep` of the sources) of documents: extract_idx, file_name, zip_entry_file_name,
    indexing_contents. Null and blank texts have none; with `marker` a document without chunks has a row that says so (chunk_seq 0, kind and status SKIP)."""
    overlap = resolved_overlap(size, overlap)
    fixed = ("extract_idx", *keep, "doc_role", "doc_type")
    n = len(fixed)
    rows = spread(sources if marker else sources.where(has_text(F.col("indexing_contents"))))  # what is blank only when normalised splits into nothing
    rows = rows.select("extract_idx", *keep, normalize_for_chunks(F.col("indexing_contents")).alias("t"), doc_role(F.col("file_name"), F.col("zip_entry_file_name")).alias("doc_role"))
    rows = rows.withColumn("doc_type", doc_type(F.col("t"), F.col("doc_role"))).select(*fixed, "t")
    made = [("chunk_seq", "int", pa.int32()), ("section_path", "string", pa.string()), *((c, "string", pa.string()) for c in _LAW), ("chunk_text", "string", pa.string()), ("start_offset", "int", pa.int32()), ("end_offset", "int", pa.int32())]

    def run(batches):
        for batch in stepped(batches):
            source, out = [], []
            for i, (text, kind) in enumerate(zip(batch.column(n).to_pylist(), batch.column(n - 1).to_pylist(), strict=True)):
                n_before = len(out)
                for seq, (path, part, start, end, law) in enumerate(split(text, kind, size, overlap, parity) if text else (), 1):
                    source.append(i)
                    out.append((seq, path, *(law or (None,) * 5), part, start, end))
                if marker and len(out) == n_before:
                    source.append(i)
                    out.append((0, None, *(None,) * 5, S.NO_CONTENT, None, None))
            given = [batch.column(k).take(pa.array(source, pa.int32())) for k in range(n)]
            yield pa.RecordBatch.from_arrays([*given, *(pa.array([o[k] for o in out], kind) for k, (_, _, kind) in enumerate(made))], names=[*fixed, *(m[0] for m in made)])

    schema = rows.select(*fixed, *[F.lit(None).cast(kind).alias(name) for name, kind, _ in made]).schema
    text = F.col("chunk_text")
    out = rows.mapInArrow(run, schema)
    real = F.col("chunk_seq") > 0
    told = lambda c, none: F.when(real, c).otherwise(none) if marker else c
    return out.select("extract_idx", *keep, "chunk_seq", told(F.col("doc_role"), S.UNKNOWN).alias("doc_role"), told(F.col("doc_type"), S.SKIP).alias("doc_type"), "section_path", *_LAW, "chunk_text", "start_offset", "end_offset", told(F.length(text), 0).alias("char_count"), told(token_estimate(text), 0).alias("token_count"), told(F.lit(S.READY), S.SKIP).alias("chunk_status"))
