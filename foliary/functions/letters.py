"""What an official letter says of itself: title, numbers and dates of dispatch and receipt, and its body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.functions.text import blank_to_null, has_text

#: Names of files that are letters, and the forms in which letters give their parts.
LETTER_FILE = r"^.*_[Nn]\d{2}\..*$"
_TITLE, _SENT, _RECEIVED = r"제\s*목", r"시\s*행", r"접\s*수"
_DAY = r"\((\d{4})\s*[.\-/]\s*(\d{1,2})\s*[.\-/]\s*(\d{1,2})"
TITLE_CELL = rf"(?:^|\|)\s*{_TITLE}\s*\|\s*(.+?)(?=\s*(?:\||\n)\s*(?:1\s*[.]|{_SENT}|{_RECEIVED}|우\s*\||전화|팩스|$))"
TITLE_LINE = rf"(?m)^\s*{_TITLE}\s*[|:]?\s*(.+)$"
TITLE_MARK = rf"{_TITLE}\s*\|\s*.+?(?=\n|$)"
FIRST_ITEM = r"(?m)^\s*1\s*[.]\s+.*$"
END_MARK = r"끝\s*\."
NOT_A_NUMBER = r"^(?:우$|우 |전화|전송|팩스)"
CLEANING = (
    (r"(?m)^\s*[|]+\s*", ""),
    (r"(?m)^\s*(수신자|경유|제목)\s*[|:].*$", ""),
    (r"(?m)^\s*(행정안전부장관|교육과학기술부장관|.*장관)\s*$", ""),
    (r"(?m)^\s*(주무관|행정사무관|.*과장|협조자|시행|접수|우|전화|전송|팩스|비공개)\b.*$", ""),
    (r"\s*<img\d+/>\s*", " "),
)


def _forms(mark: str, stops: str) -> tuple[str, str, str]:
    """A number in a cell with its date, after a blank with its date, and in a cell without a date."""
    return rf"{mark}\s*\|\s*([^|()]+?)\s*\|\s*{_DAY}\s*[.]?\s*\)", rf"{mark}\s+([^\s()|]+)\s*(?:\|\s*)?{_DAY}", rf"{mark}\s*\|\s*([^|()]+?)(?=\s*\|\s*(?:{stops}|/|$))"


SENT = _forms(_SENT, rf"{_RECEIVED}|우|전화|전송|팩스")
RECEIVED = _forms(_RECEIVED, "우|전화|전송|팩스")


def is_letter(file_name: Column, contents: Column) -> Column:
    return F.coalesce(file_name.rlike(LETTER_FILE), F.lit(False)) & has_text(contents)


def clean(c: Column) -> Column:
    return blank_to_null(F.regexp_replace(F.replace(c, F.lit("|"), F.lit(" ")), r"\s+", " "))


def prepared(contents: Column) -> Column:
    text = F.replace(F.replace(contents, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.regexp_replace(text, r"\s*\|\s*", " | ")


def title(text: Column) -> Column:
    """From the title's cell if there is one (even if nothing is left of it), else from its line."""
    return F.when(text.rlike(TITLE_CELL), clean(F.regexp_extract(text, TITLE_CELL, 1))).when(text.rlike(TITLE_LINE), clean(F.regexp_extract(text, TITLE_LINE, 1)))


def number_and_date(text: Column, forms: tuple[str, str, str]) -> Column:
    """struct<number, date>: date as yyyy-MM-dd without a check of the calendar; a number without date must look like one."""
    cell, blank, undated = forms

    def dated(p: str) -> Column:
        part = lambda i: F.regexp_extract(text, p, i)
        return F.struct(clean(part(1)).alias("number"), F.concat_ws("-", F.lpad(part(2), 4, "0"), F.lpad(part(3), 2, "0"), F.lpad(part(4), 2, "0")).alias("date"))

    alone = clean(F.regexp_extract(text, undated, 1))
    valid = has_text(alone) & ~alone.rlike(NOT_A_NUMBER) & alone.rlike(r"-\d")
    none = F.lit(None).cast("string")
    return F.when(text.rlike(cell), dated(cell)).when(text.rlike(blank), dated(blank)).otherwise(F.struct(F.when(valid, alone).alias("number"), none.alias("date")))


def clean_body(c: Column, *, strict: bool = False) -> Column:
    """strict writes nn for three line ends or more, as a replacement text with escaped letters does."""
    for pattern, by in (*CLEANING, (r"\n{3,}", "nn" if strict else "\n\n")):
        c = F.regexp_replace(c, pattern, by)
    return blank_to_null(c)


def _until_end(c: Column) -> Column:
    head = F.regexp_extract(c, rf"(?s)^(.*?{END_MARK})", 1)
    return F.when(head != "", head).otherwise(c)


def body(text: Column, *, strict: bool = False) -> Column:
    """What follows the title up to the end mark; without it, what starts with item 1; null if nothing is left."""
    after = F.when(text.rlike(TITLE_MARK), clean_body(_until_end(F.regexp_replace(text, rf"(?s)^.*?{_TITLE}\s*\|\s*[^\n]+", "")), strict=strict))
    at = F.regexp_instr(text, F.lit(FIRST_ITEM))
    listed = F.when(text.rlike(FIRST_ITEM), clean_body(_until_end(F.substr(text, at)), strict=strict))
    return F.coalesce(after, listed)


def with_letters(rows: DataFrame, *, file_name: str = "file_name", contents: str = "contents", indexing: str = "indexing_contents", strict: bool = False) -> DataFrame:
    """rows with hwp_sub_title, implement_org, implement_date, receipt_org, receipt_date (null where the file is no letter or doesn't say) and the
    indexing column replaced by the letter's body if it has one."""
    text = F.col("__p")
    rows = rows.withColumn("__p", F.when(is_letter(F.col(file_name), F.col(contents)), prepared(F.col(contents))))
    rows = rows.withColumns({"__s": number_and_date(text, SENT), "__r": number_and_date(text, RECEIVED), "__b": body(text, strict=strict), "hwp_sub_title": title(text)})
    found = {"implement_org": "__s.number", "implement_date": "__s.date", "receipt_org": "__r.number", "receipt_date": "__r.date"}
    return rows.withColumns({k: F.col(c) for k, c in found.items()} | {indexing: F.coalesce("__b", indexing)}).drop("__p", "__s", "__r", "__b")
