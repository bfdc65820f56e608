"""Text, name and date functions as Column expressions. Lengths are code points."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliary import schema as S

_EDGE = r"^[\x00-\x20]+|[\x00-\x20]+$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once, wherever and however often body (a lambda's too) uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def trimmed(c: Column) -> Column:
    """Without characters up to U+0020 at either end (Spark's trim takes spaces alone)."""
    return F.regexp_replace(c, _EDGE, "")


def has_text(c: Column) -> Column:
    """True if c holds a character that isn't white space; false for null."""
    return F.coalesce(c.rlike(r"\S"), F.lit(False))


def blank_to_null(c: Column) -> Column:
    return F.when(has_text(c), trimmed(c))


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def cut(c: Column, n: int, *, keep_null: bool = False) -> Column:
    """At most n characters; null is empty unless it is to stay."""
    out = F.substring(c, 1, n)
    return out if keep_null else null_to_blank(out)


def compact(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(null_to_blank(c), r"\s+", " "), _EDGE, "")


def lines(c: Column) -> Column:
    """The \\n-parted lines without empty ones at the end."""
    return F.split(F.regexp_replace(c, r"\n+\z", ""), "\n", -1)


def normalize_extracted(c: Column) -> Column:
    """Text as a parser gives it: no NUL, form feeds break lines, runs of blanks are one, lines of a page number alone go."""
    c = F.translate(c, "\x0c\x00", "\n")
    for pattern, by in ((r"[ \t\x0B\f\r]+", " "), (r"(?m)^\s*[-–—]?\s*\d+\s*[-–—]?\s*$", ""), (r"\n{3,}", "\n\n"), (_EDGE, "")):
        c = F.regexp_replace(c, pattern, by)
    return c


def normalize_for_chunks(c: Column) -> Column:
    """Text as the chunker takes it: \\n line ends, tabs are blanks, at most one empty line; null is empty."""
    c = F.replace(F.replace(null_to_blank(c), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    for pattern, by in ((r"[\t\x0B\f]+", " "), (r"(?m)[ ]{2,}$", ""), (r"\n{3,}", "\n\n"), (_EDGE, "")):
        c = F.regexp_replace(c, pattern, by)
    return c


def token_estimate(c: Column) -> Column:
    """0 for blank text, else ASCII words and 2 for 5 Hangul syllables (rounded up), 1 at least."""
    words, hangul = F.regexp_count(c, F.lit("[A-Za-z0-9_]+")), F.regexp_count(c, F.lit("[가-힣]"))
    return F.when(has_text(c), F.greatest(F.lit(1), words + F.ceil(hangul / 2.5).cast("int"))).otherwise(0).cast("int")


# File names and paths


def extension(name: Column) -> Column:
    """What follows the last dot, in lower case; empty if there is none, or it ends the name."""
    return F.lower(F.regexp_extract(null_to_blank(name), r"\.([^.]+)$", 1))


def base_name(path: Column) -> Column:
    return F.regexp_extract(F.replace(path, F.lit("\\"), F.lit("/")), r"([^/]*)$", 1)


def role_mark(name: Column) -> Column:
    """N or S by the rightmost part of the base name that starts with either and a digit; else UNKNOWN."""
    stem = F.regexp_replace(base_name(null_to_blank(name)), r"(?<=.)\.[^.]*$", "")
    marks = F.filter(F.split(F.upper(stem), "_"), lambda t: t.rlike(r"^[NS]\d"))
    return F.coalesce(F.substring(F.try_element_at(marks, F.lit(-1)), 1, 1), F.lit(S.UNKNOWN))


#: File types and groups by extension.
FILE_TYPES = {"hwp": "HWP", "hwpx": "HWP", "pdf": "PDF", "doc": "WORD", "docx": "WORD", "xls": "EXCEL", "xlsx": "EXCEL", "ppt": "POWERPOINT", "pptx": "POWERPOINT", "txt": "TEXT"}
FILE_GROUPS = {"HWP": "HWP", "PDF": "PDF", "WORD": "OFFICE", "EXCEL": "OFFICE", "POWERPOINT": "OFFICE", "TEXT": "TEXT"}


def file_type(name: Column) -> Column:
    ext = extension(name)
    known = F.create_map(*[F.lit(x) for kv in FILE_TYPES.items() for x in kv])
    return F.coalesce(F.try_element_at(known, ext), F.when(has_text(ext), F.upper(ext)), F.lit(S.UNKNOWN))


def file_group(name: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in FILE_GROUPS.items() for x in kv])
    return F.when(extension(name).isin(*FILE_TYPES), F.try_element_at(known, file_type(name))).otherwise("ETC")


def effective_type(name: Column, forced: Column, detected: Column) -> Column:
    """The type that is stored: the role mark if the name has one, else the forced, the name's or the detected type."""
    role, own = role_mark(name), F.when(extension(name) != "", file_type(name))
    return F.coalesce(F.when(role != S.UNKNOWN, role), blank_to_null(forced), own, detected)


def resolved_path(folder: Column, name: Column, year: Column, file_no: Column, item_no: Column, base: str, default_year: str) -> Column:
    """Where a catalogued file lies: its own path (a folder or the file itself) if it has one, else base/year/file/item/name."""
    own = F.replace(folder, F.lit("\\"), F.lit("/"))
    given = F.when(F.endswith(own, F.lit("/")), F.concat(own, name)).when(F.endswith(own, name), own).otherwise(F.concat(own, F.lit("/"), name))
    return F.when(has_text(folder), given).otherwise(F.concat_ws("/", F.lit(base), F.coalesce(blank_to_null(year), F.lit(default_year)), file_no, item_no, name))


# Dates held as text


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def production_date(c: Column) -> Column:
    """Eight digits, a year's first of January, or the text itself; blank is empty."""
    d = _digits(c)
    return F.when(~has_text(c), "").when(F.length(d) >= 8, F.substring(d, 1, 8)).when(F.length(d) == 4, F.concat(d, F.lit("0101"))).otherwise(c)


def production_year(c: Column) -> Column:
    """The first four digits, or the text itself; blank is empty."""
    d = _digits(c)
    return F.when(~has_text(c), "").when(F.length(d) >= 4, F.substring(d, 1, 4)).otherwise(c)


def term_date(c: Column) -> Column:
    """A bound of validity as eight characters to compare: separators taken out."""
    return F.substring(F.translate(c, "-./ ", ""), 1, 8)


def data_year(transfer: Column, production: Column) -> Column:
    return F.coalesce(blank_to_null(transfer), blank_to_null(production)).try_cast("int")


def department(names: Column) -> Column:
    """What stands before the first blank, as SQL has it (a leading blank gives an empty name)."""
    return F.substring_index(names, " ", 1)


def first_token(names: Column) -> Column:
    return F.substring_index(trimmed(null_to_blank(names)), " ", 1)


#: Agencies by the start of a department's name; the last one only outside strict mode.
AGENCIES = (("환경부", "환경부"), ("복지부", "복지부"), ("보건복지부", "복지부"))


def lead_agency(name: Column, *, strict: bool = False) -> Column:
    """The agency prefix of the mapping dictionary; null where there is none. strict leaves out the third entry."""
    known = AGENCIES[:2] if strict else AGENCIES
    return reduce(lambda e, a: e.when(F.startswith(name, F.lit(a[0])), a[1]), known[1:], F.when(F.startswith(name, F.lit(known[0][0])), known[0][1]))


def image_map(paths: Column) -> Column:
    """JSON of img1, img2, ... to the paths; [] without any."""
    keys = F.transform(paths, lambda p, i: F.concat(F.lit("img"), (i + 1).cast("string")))
    return F.when(F.size(paths) > 0, F.to_json(F.map_from_arrays(keys, paths))).otherwise("[]")
