"""License scans: ordered signature rules behind a keyword prefilter, with containment suppression.

Rules are signatures of what licences and notices say (license_wording), and the names of license families in a few phrase forms:
each is a regex with a label, a priority and a keyword. A text that holds none of the gate words is not looked at again. Otherwise
a rule's regex runs only if its keyword stands in the text; of the detections, one whose span lies within that of another with a
higher priority (or the same priority and a longer span, or an earlier label) is suppressed: by start and length, a detection is void if
a surer or equal one before it ends no sooner. All of it is Column expressions on the executors, n log n in the matches.

The contract's base phrases are found apart from the rules and always stay. Null and empty texts have no words and no
labels; repeated rows are scanned each on its own; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm.license_wording import WORDING, WORDING_GATES
from foliary.llm.spans import bound, gated, running, spans

#: Fixed by the contract: phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
_IN = r"0-9A-Za-z\x{80}-\x{10FFFF}"
WORD = f"[{_IN}]+"

#: License families: label, regexes of the name, keywords (lower case) of which every match of the name holds one, versions.
FAMILIES: tuple[tuple[str, str, str, str], ...] = (
    ("gpl", "(?:gnu )?general public license|gnu gpl|gpl", "general public license|gpl", "1 2 3"),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public license|lgpl", "general public license|lgpl", "2 2.1 3"),
    ("agpl", "(?:gnu )?affero general public license|agpl", "affero|agpl", "1 3"),
    ("gfdl", "(?:gnu )?free documentation license|gfdl", "documentation license|gfdl", "1.1 1.2 1.3"),
    ("apache", "apache(?: software)? license|apache", "apache", "1.0 1.1 2.0"),
    ("mit", "mit license|mit/x11 license|mit|expat license", "mit|expat", ""),
    ("bsd", "(?:(?:new|simplified|modified|revised) )?bsd(?: license)?|berkeley software distribution", "bsd|berkeley", "2-clause 3-clause 4-clause"),
    ("isc", "isc license|internet (?:systems|software) consortium license", "isc license|consortium", ""),
    ("mpl", "mozilla public license|mpl", "mozilla|mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse public license|epl", "eclipse|epl", "1.0 2.0"),
    ("cddl", "common development and distribution license|cddl", "common development|cddl", "1.0 1.1"),
    ("cpl", "common public license|cpl", "common public|cpl", "1.0"),
    ("eupl", "european union public licen[cs]e|eupl", "european union|eupl", "1.0 1.1 1.2"),
    ("cecill", "cecill(?:-[bc])?", "cecill", "1.0 2.0 2.1"),
    ("artistic", "artistic license", "artistic", "1.0 2.0"),
    ("bsl", "boost software license|bsl", "boost|bsl", "1.0"),
    ("zlib", "zlib(?:/libpng)? license|zlib", "zlib", ""),
    ("unlicense", "unlicense", "unlicense", ""),
    ("wtfpl", "do what the fuck you want to public license|wtfpl", "do what the|wtfpl", "1 2"),
    ("cc0", "cc0|creative commons zero", "cc0|commons", "1.0"),
    ("cc-by", "cc[ -]by|creative commons attribution(?: license)?", "cc by|cc-by|commons", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-sa", "cc[ -]by[ -]sa|creative commons attribution[ -]share[ -]?alike", "cc by|cc-by|commons", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc", "cc[ -]by[ -]nc|creative commons attribution[ -]non[ -]?commercial", "cc by|cc-by|commons", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nd", "cc[ -]by[ -]nd|creative commons attribution[ -]no[ -]?deriv(?:ative)?s", "cc by|cc-by|commons", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc-sa", "cc[ -]by[ -]nc[ -]sa", "cc by|cc-by", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc-nd", "cc[ -]by[ -]nc[ -]nd", "cc by|cc-by", "1.0 2.0 2.5 3.0 4.0"),
    ("odbl", "open database license|odbl", "open database|odbl", "1.0"),
    ("ofl", "(?:sil )?open font license|ofl", "open font|ofl", "1.0 1.1"),
    ("postgresql", "postgresql license", "postgresql", ""),
    ("python", "python software foundation license|psf license", "python software|psf", "2 2.0"),
    ("php", "php license", "php license", "3.0 3.01"),
    ("ruby", "ruby license", "ruby license", ""),
    ("openssl", "openssl license", "openssl", ""),
    ("w3c", "w3c (?:software )?(?:notice and )?license", "w3c", ""),
    ("ncsa", "ncsa (?:open source )?license", "ncsa", ""),
    ("upl", "universal permissive license", "universal permissive", "1.0"),
    ("ms-pl", "microsoft public license|ms-pl", "microsoft|ms-pl", ""),
    ("ms-rl", "microsoft reciprocal license|ms-rl", "microsoft|ms-rl", ""),
    ("osl", "open software license", "open software license", "1.0 2.0 2.1 3.0"),
    ("afl", "academic free license", "academic free", "1.1 1.2 2.0 2.1 3.0"),
    ("sspl", "server side public license|sspl", "server side|sspl", "1"),
    ("busl", "business source license", "business source", "1.1"),
    ("elastic", "elastic license", "elastic license", "2.0"),
    ("vim", "vim license", "vim license", ""),
    ("x11", "x11 license", "x11 license", ""),
    ("public-domain", "public domain", "public domain", ""),
)
_GRANT = "(?:licensed|released|distributed|available|published) under "
_VERSION = r"(?:,? (?:version |v\.?\x20?)?|-)"
#: Phrase forms of every family, then those of its versions: regex, a keyword that it needs besides (or none), priority.
PLAIN = (
    (r"\b(?:{name})(?:(?<=licen[cs]e)| licen[cs]e)\b", "licen", 40),
    (rf"\b{_GRANT}(?:the )?(?:terms of )?(?:the )?(?:{{name}})\b", "under", 60),
    (r"\bspdx-license-identifier:\x20*{label}\b", "spdx", 90),
)
VERSIONED = (
    (rf"\b(?:{{name}}){_VERSION}{{version}}\b", "", 70),
    (r"\bspdx-license-identifier:\x20*{label}-{version}\b", "spdx", 95),
)


def _wide(pattern: str) -> str:
    """The pattern with any number of blanks wherever it has one."""
    return re.sub(r"(?<!\[) ", " +", pattern)


#: What may stand between words of a notice: blanks and the leaders of comments.
_GAP = "[ *#/;]"


def _loose(pattern: str) -> str:
    """The pattern of a signature with any blanks and comment leaders wherever it has a blank."""
    return re.sub(r"(?<!\[) (\??)", lambda m: _GAP + ("*" if m[1] else "+"), pattern)


def _gate() -> str:
    """Matches in every text in which any rule of a family does."""
    names = "|".join(name for _, name, _, _ in FAMILIES)
    return _wide(rf"(?i)licen[cs]|\b{_GRANT}|\b(?:{names}){_VERSION}[0-9]")


def rules() -> list[tuple[str, int, tuple[str, ...], str, str]]:
    """(label, priority, keywords, another keyword or none, regex) of every rule, by priority, then label."""
    out = []
    for label, name, keywords, versions in FAMILIES:
        fill = {"name": name, "label": label}
        for form, need, priority in PLAIN:
            out.append((label, priority, tuple(keywords.split("|")) if need != "spdx" else (label,), need, _wide(form.format(**fill))))
        for v in versions.split():
            exact = v.removesuffix(".0").replace(".", r"\.") + (r"(?:\.0)?" if "clause" not in v and (v.endswith(".0") or "." not in v) else "")
            for form, need, priority in VERSIONED:
                out.append((f"{label}-{v}", priority, tuple(keywords.split("|")) if need != "spdx" else (label,), need, _wide(form.format(**fill, version=exact))))
    out += [(label, priority, (keyword,), "", _loose(pattern)) for label, priority, keyword, pattern in WORDING]
    return sorted(out, key=lambda r: (-r[1], r[0], r[4]))


def _base_pattern() -> str:
    return rf"(?i)(?<![{_IN}])(?:{'|'.join(p.replace(' ', f'[^{_IN}]+') for p in PHRASES)})(?![{_IN}])"


def scan(documents: DataFrame, *, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, n_words, n_base, first_word, last_word, base_labels and labels (sorted arrays), detections
    (array<struct<label, priority, start, end>> that no other suppresses) and score (the surest detection's share of 100;
    a half for base phrases alone; 0 without any)."""
    kept = [F.col(f"`{k}`") for k in keep]
    t, base = F.col("__t"), _base_pattern()
    rows = documents.select(*kept, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__t"))
    rows = rows.withColumn("__l", F.lower("__t"))
    lower = F.col("__l")
    hit = (lower.contains("license") | lower.contains("cc")) & t.rlike(base)  # every phrase holds one of the two
    gaps, hits = F.split(t, base, -1), F.regexp_extract_all(t, F.lit(base), F.lit(0))
    count = lambda c: F.regexp_count(c, F.lit(WORD)).cast("long")
    first = F.when(F.col("__hit"), count(F.element_at(gaps, 1)))
    back = F.when(F.col("__hit"), count(F.element_at(gaps, -1)) + count(F.element_at(hits, -1)))
    label = lambda h: reduce(lambda e, p: e.when(F.lower(F.substring(h, 1, 2)) == p[0][:2], p[1]), PHRASES.items(), F.when(F.lit(False), ""))
    blank = F.translate(t, "\t\n\x0b\x0c\r", " " * 5)  # a line may end within a name
    able = lower.contains("licen") | lower.contains("under") | t.rlike("[0-9]")  # as every rule needs a name's licence, a grant or a version
    worded = reduce(lambda e, g: e | lower.contains(g), WORDING_GATES[1:], lower.contains(WORDING_GATES[0]))
    signatures = F.when(worded | (able & blank.rlike(_gate())), _detections(blank)).otherwise(F.array().cast(_FOUND))
    rows = rows.withColumn("__hit", hit).select(*kept, "__t", "__hit", count(t).alias("n_words"), F.when(F.col("__hit"), F.regexp_count(t, F.lit(base)).cast("long")).otherwise(0).alias("n_base"), first.alias("first_word"), back.alias("__back"), F.when(F.col("__hit"), F.array_sort(F.array_distinct(F.transform(hits, label)))).otherwise(F.array().cast("array<string>")).alias("base_labels"), signatures.alias("__found"))
    rows = rows.select("*", bound(_ordered(F.col("__found")), _unsuppressed).alias("detections"))
    labels = F.array_sort(F.array_union("base_labels", F.transform("detections", lambda x: x["label"])))
    score = F.greatest(F.coalesce(F.array_max(F.transform("detections", lambda x: x["priority"])), F.lit(0)), F.when(F.col("n_base") > 0, 50).otherwise(0)) / 100
    return rows.select(*kept, "n_words", "n_base", "first_word", (F.col("n_words") - F.col("__back")).alias("last_word"), "base_labels", labels.alias("labels"), "detections", score.cast("double").alias("score"))


_FOUND = "array<struct<label:string,priority:int,start:bigint,end:bigint>>"


def _detections(t: Column) -> Column:
    """All matches of the rules whose keywords the text holds."""
    rows = [{"label": a, "priority": b, "keywords": list(c), "need": d, "pattern": f"(?i){e}"} for a, b, c, d, e in rules()]
    table = F.from_json(F.lit(json.dumps(rows)), "array<struct<label:string,priority:int,keywords:array<string>,need:string,pattern:string>>")

    words = F.from_json(F.lit(json.dumps(sorted({k for r in rows for k in (*r["keywords"], r["need"])}))), "array<string>")
    there = lambda own: F.filter(words, lambda k: own.contains(k))
    tried = lambda held: F.filter(table, lambda r: F.array_contains(held, r["need"]) & F.arrays_overlap(held, r["keywords"]))
    kept = bound(bound(F.regexp_replace(F.lower(t), f"{_GAP}+", " "), there), tried)  # no keyword holds a character of gaps but single blanks
    each = F.transform(kept, lambda r: F.transform(gated(F.regexp_like(t, r["pattern"]), spans(t, r["pattern"])), lambda s: F.struct(r["label"].alias("label"), r["priority"].alias("priority"), s["start"].alias("start"), s["end"].alias("end"))))
    return F.flatten(each)


def _ordered(found: Column) -> Column:
    """By start, then the longer, the surer and the label: whatever may suppress a detection stands before it."""
    return F.array_sort(F.transform(found, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), (-x["priority"]).alias("low"), x["label"].alias("label"))))


def _unsuppressed(found: Column) -> Column:
    """Of ordered detections those that lie in no surer (or as sure and longer, or earlier by label) one before them."""
    levels = sorted({r[1] for r in rules()})
    furthest = F.struct(*[running(F.transform(found, lambda x, p=p: F.when(-x["low"] >= p, -x["back"]).otherwise(F.lit(-1).cast("long"))), F.greatest).alias(f"p{p}") for p in levels])

    def kept(ends: Column) -> Column:
        before = lambda x, i: reduce(lambda e, p: e.when(-x["low"] == p, F.get(ends[f"p{p}"], i - 1)), levels, F.when(F.lit(False), F.lit(-1).cast("long")))
        return F.filter(found, lambda x, i: F.coalesce(before(x, i), F.lit(-1).cast("long")) < -x["back"])

    return F.transform(bound(furthest, kept), lambda x: F.struct(x["label"].alias("label"), (-x["low"]).alias("priority"), x["start"].alias("start"), (-x["back"]).alias("end")))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")
