"""Prompts as Column expressions: templates with variables, and the messages of a chat request."""

from __future__ import annotations

from collections.abc import Sequence
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary import schema as S
from foliary.functions.text import cut, null_to_blank

#: Variables of the templates.
ITEM_VARIABLES = ("RC_CODE", "RC_RFILE_NO", "RC_RITEM_NO", "BND_TTL", "JEMOK", "ALL_ORG_NM", "PRODREGDATE", "PRODYEAR")

POLICY_VARIABLES = ("RC_CODE", "RC_RFILE_NO", "RC_RITEM_NO", "CLSS_ID", "BND_TTL", "JEMOK", "ALL_ORG_NM", "DEPT_NM", "PRODREGDATE", "PRODYEAR", "candidate_policy_list_json")
DEPARTMENT_VARIABLES = (*POLICY_VARIABLES[:-1], "Mapping_Dictionary")
SUBJECT_VARIABLES = (*ITEM_VARIABLES, "candidate_event_list_json")
SUMMARY_VARIABLES = (
    "BND_TTL", "JEMOK", "RC_CODE", "ALL_ORG_NM", "PRODREGDATE", "PRODYEAR", "RC_RFILE_NO", "RC_RITEM_NO", "ORG_FILE_PATH", "ORG_FILE_NAME", "SAVE_FILE_NAME", "FILE_NAME",
    "CONTENTS", "INDEXING_CONTENTS", "ZIP_SEQ", "ZIP_ENTRY_FILE_NAME", "FILE_TYPE", "FILE_GUBUN", "maxContentLength", "maxSummaryLength",
)
#: Templates of this package, by the work that they are for.
TEMPLATES = ("summary", "policy_extract", "policy_extract_sample", "policy_extract_dept", "event_extract", "activity_extract")


def template(name: str) -> str:
    if name not in TEMPLATES:
        raise ValueError(f"unknown prompt {name}; there are {', '.join(TEMPLATES)}")
    return resources.files("foliary").joinpath(f"prompts/{name}.txt").read_text(encoding="utf-8")


def variables(rows: DataFrame, names: Sequence[str], more: dict[str, Column] | None = None) -> dict[str, Column]:
    """The variables of a template in their order: those of `more`, else columns of rows by their names in lower case; others are left out."""
    own = {v: (more or {}).get(v, F.col(v.lower()) if v.lower() in rows.columns else None) for v in names}
    return {v: c for v, c in own.items() if c is not None}


def escaped(value: Column) -> Column:
    """As the inside of a JSON string."""
    return F.regexp_extract(F.to_json(F.struct(null_to_blank(value).alias("v"))), r'(?s)^\{"v":"(.*)"\}$', 1)


def render(template: Column | str, variables: dict[str, Column]) -> Column:
    """The template with ${k} and {k} replaced by the value and {{k}} by its JSON form, in the order of the variables; so what an earlier
    value brings in is open to the later ones. Null is empty; unknown names stay."""
    out = F.lit(template) if isinstance(template, str) else null_to_blank(template)
    for name, value in variables.items():
        own = null_to_blank(value.cast("string"))
        for form, text in ((f"${{{name}}}", own), (f"{{{{{name}}}}}", escaped(own)), (f"{{{name}}}", own)):
            out = F.replace(out, F.lit(form), text)
    return out


def mentions(template: str, name: str) -> bool:
    """Whether a template needs a variable, so that costly ones are only built then."""
    return f"{{{name}}}" in template


def file_level(columns: dict[str, Column]) -> dict[str, Column]:
    """The variables for a whole file: without the item's number and title."""
    return columns | {k: F.lit("") for k in ("RC_RITEM_NO", "JEMOK") if k in columns}


def summary_message(file_title: Column, item_title: Column, contents: Column, output_format: str, most: int = S.CONTENT_CHARS) -> Column:
    return F.concat(F.lit("File: "), null_to_blank(file_title), F.lit("\nItem: "), null_to_blank(item_title), F.lit("\n\n"), cut(contents, most), F.lit("\n\n"), F.lit(output_format))


def chat_request(model: str, system: Column, user: Column, temperature: float = 0.2) -> Column:
    """The body of a chat-completion call."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), null_to_blank(c).alias("content"))
    return F.to_json(F.struct(F.lit(model).alias("model"), F.array(message("system", system), message("user", user)).alias("messages"), F.lit(temperature).alias("temperature"), F.lit(False).alias("stream")))
