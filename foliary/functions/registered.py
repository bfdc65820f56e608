"""The library in SQL: scalar functions as SQL text (so they are part of the plan like any expression) and table functions for what gives several rows.

    registered.register(spark)
    SELECT s.extract_idx, c.* FROM sources s, LATERAL foliary_chunks(s.t, s.doc_type, 3500, 350) c

Table functions work in Arrow batches; a null or blank argument gives no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from foliary.functions.text import AGENCIES, FILE_TYPES, normalize_for_chunks
from foliary.operators.chunking import doc_role, doc_type, resolved_overlap
from foliary.operators.splitting import split

_TEXT = r"coalesce(regexp_like(c, '\\S'), false)"
_DIGITS = "regexp_replace(c, '[^0-9]', '')"
_EXTENSION = r"lower(regexp_extract(coalesce(c, ''), '\\.([^.]+)$', 1))"
_KNOWN = "map(" + ", ".join(f"'{k}', '{v}'" for k, v in FILE_TYPES.items()) + ")"
_EDGE = r"^[\\x00-\\x20]+|[\\x00-\\x20]+$"

#: SQL text of each scalar function of one string `c`; every one equals the Column form of the same name in foliary.functions.text.
SCALARS = {
    "foliary_extension": ("STRING", _EXTENSION),
    "foliary_file_type": ("STRING", f"coalesce(try_element_at({_KNOWN}, {_EXTENSION}), CASE WHEN regexp_like({_EXTENSION}, '\\\\S') THEN upper({_EXTENSION}) END, 'UNKNOWN')"),
    "foliary_production_date": ("STRING", f"CASE WHEN NOT {_TEXT} THEN '' WHEN length({_DIGITS}) >= 8 THEN substring({_DIGITS}, 1, 8) WHEN length({_DIGITS}) = 4 THEN {_DIGITS} || '0101' ELSE c END"),
    "foliary_production_year": ("STRING", f"CASE WHEN NOT {_TEXT} THEN '' WHEN length({_DIGITS}) >= 4 THEN substring({_DIGITS}, 1, 4) ELSE c END"),
    "foliary_term_date": ("STRING", "substring(translate(c, '-./ ', ''), 1, 8)"),
    "foliary_first_token": ("STRING", f"substring_index(regexp_replace(coalesce(c, ''), '{_EDGE}', ''), ' ', 1)"),
    "foliary_lead_agency": ("STRING", "CASE " + " ".join(f"WHEN startswith(c, '{a}') THEN '{b}'" for a, b in AGENCIES) + " END"),
    "foliary_token_estimate": ("INT", f"CASE WHEN {_TEXT} THEN CAST(greatest(1, regexp_count(c, '[A-Za-z0-9_]+') + CAST(ceil(regexp_count(c, '[가-힣]') / 2.5) AS INT)) AS INT) ELSE 0 END"),
}


class Chunks:
    """Chunks of a text in the chunker's form (foliary_prepared), by the kind of its document."""

    def eval(self, text: str, kind: str, size: int, overlap: int):
        if text and kind:
            for seq, (path, part, start, end, law) in enumerate(split(text, kind, size, resolved_overlap(size, overlap), True), 1):
                yield (seq, path, *(law or (None,) * 5), part, start, end)


class Entries:
    """The entries of an answer: of an array of objects each field of each object, of one object its fields. Numbers and booleans as text, containers as JSON, null as null;
    broken JSON has none."""

    def eval(self, answer: str):
        try:
            found = json.loads(answer) if answer else []
        except ValueError:
            return
        for i, entry in enumerate(found if isinstance(found, list) else [found], 1):
            if isinstance(entry, dict):
                for name, value in entry.items():
                    yield i, name, value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


_LAW = "law_chapter string, law_section string, law_article_no string, law_article_title string, law_article_content string"
TABLES = {
    "foliary_chunks": (Chunks, f"chunk_seq int, section_path string, {_LAW}, chunk_text string, start_offset int, end_offset int"),
    "foliary_entries": (Entries, "entry int, name string, value string"),
}


def register(spark: SparkSession) -> None:
    """All functions, for the session."""
    for name, (kind, text) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(c STRING) RETURNS {kind} RETURN {text}")
    for name, (maker, returns) in TABLES.items():
        spark.udtf.register(name, udtf(maker, returnType=returns, useArrow=True))


def prepared(sources: DataFrame, view: str = "foliary_prepared", keep: tuple[str, ...] = ("extract_idx",)) -> DataFrame:
    """The sources (file_name, zip_entry_file_name, indexing_contents) as a view for foliary_chunks: `keep`, doc_role, doc_type and t, the text in the chunker's form."""
    rows = sources.select(*keep, normalize_for_chunks(F.col("indexing_contents")).alias("t"), doc_role(F.col("file_name"), F.col("zip_entry_file_name")).alias("doc_role"))
    rows = rows.select(*keep, "doc_role", doc_type(F.col("t"), F.col("doc_role")).alias("doc_type"), "t")
    rows.createOrReplaceTempView(view)
    return rows
