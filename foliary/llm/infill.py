"""Fill-in-middle transformation: texts are cut into units, two cuts are drawn from a hash of the id, and the three parts are put in another order.

Lookaround splitting: a unit grammar is a set of character classes, and where a unit ends is told by the two characters around that place. So each
grammar becomes one regex of zero width, `(?<=class)(?=neighbour)` for every way in which a unit can end; Spark's split at it cuts nothing away, and
the pieces put together are the text. Every alternative looks behind, so no place inside a surrogate pair and no text start ever matches, and
none matches at the text's end.

The empty text has no place to split but one empty piece, so it's taken apart: it has no units and stays plain. Null texts are empty. Rows without an
id are dealt by the hash of the bare prefix; rows that repeat an id with one text are transformed alike. An empty table gives an empty result. Everything
is Column expressions row by row: no shuffle, whatever the skew.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grammar:
    """Units of a text. runs: bodies of character classes (as between brackets of a regex, apart from each other) whose longest runs are units; single:
    whether each character of no class is a unit of its own, or runs of them are units too; ends: the body of a class after each of whose
    characters a unit ends, whatever follows."""

    runs: tuple[str, ...] = ()
    single: bool = True
    ends: str = ""

    def boundary(self) -> str:
        """The regex of zero width that matches between two units and nowhere else."""
        known = "".join(self.runs)
        ways = [f"(?<=[{r}])(?=[^{r}])" for r in self.runs]
        if self.single:
            ways.append(f"(?<=[^{known}])(?=.)" if known else "(?<=.)(?=.)")
        elif known:
            ways.append(f"(?<=[^{known}])(?=[{known}])")
        if self.ends:
            ways.append(f"(?<=[{self.ends}])(?=.)")
        if not ways:
            raise ValueError("a grammar of no classes has no boundaries")
        return "(?s)" + "|".join(ways)


#: Letters in runs and all else alone; characters; words and what parts them; words with digits and signs alone; lines with their ends.
LETTERS = Grammar(("A-Za-z",))
CHARACTERS = Grammar()
WORDS = Grammar((r"\s",), single=False)
NAMES = Grammar((r"\p{L}\p{N}_", r"\s"))
LINES = Grammar(single=False, ends=r"\n")


@dataclass(frozen=True)
class Marks:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        """Marks must be told apart wherever they meet a text: none begins with what another ends with, and none lies in another."""
        own = (self.prefix, self.suffix, self.middle)
        for i, a in enumerate(own):
            for j, b in enumerate(own):
                if not a or (i != j and a in b) or any(a.endswith(b[:k]) for k in range(1, len(b))):
                    raise ValueError(f"marks {own} can't be told apart")


def units(text: Column, grammar: Grammar = LETTERS) -> Column:
    """The units of a text in order; none of an empty or null one."""
    return F.when(F.length(text) > 0, F.split(text, grammar.boundary(), -1)).otherwise(F.array().cast("array<string>"))


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four numbers of 32 bits drawn for an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that an output and its form were made of: at the marks, which no transformed text holds, the parts are cut out and put in order."""

    def between(after: str, before: str | None) -> Column:
        rest = F.substring_index(output, after, -1)
        return rest if before is None else F.substring_index(rest, before, 1)

    p, s, m = marks.prefix, marks.suffix, marks.middle
    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(documents: DataFrame, *, grammar: Grammar = LETTERS, marks: Marks = Marks(), plain_percent: int = 10, spm_percent: int = 20, seed: int = 1, doc_id: str = "doc_id", text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, n (units), form (plain, psm or spm), prefix_chars and middle_chars (code points; null if plain) and output of every document.

    The prefix ends after the smaller of two cuts of 0 to n units, the middle after the larger. Texts that are empty or hold a mark, and plain_percent of
    the others, stay plain; of the rest spm_percent put the suffix first.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    h = draws(F.col(f"`{doc_id}`"), seed)
    given = documents.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keep)], body.alias("__text"), *[x.alias(f"__h{i}") for i, x in enumerate(h)])
    cut = given.withColumn("__units", units(F.col("__text"), grammar)).withColumn("n", F.size("__units").cast("long"))
    place = lambda i: F.col(f"__h{i}") % (F.col("n") + 1)
    cut = cut.withColumns({"__a": F.least(place(0), place(1)).cast("int"), "__b": F.greatest(place(0), place(1)).cast("int")})
    held = F.contains("__text", F.lit(marks.prefix)) | F.contains("__text", F.lit(marks.suffix)) | F.contains("__text", F.lit(marks.middle))
    plain = (F.col("n") == 0) | held | (F.col("__h2") % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(F.col("__h3") % 100 < spm_percent, "spm").otherwise("psm")
    part = lambda start, size: F.array_join(F.slice("__units", start, size), "")
    parts = cut.select("*", form.alias("form"), part(F.lit(1), F.col("__a")).alias("__p"), part(F.col("__a") + 1, F.col("__b") - F.col("__a")).alias("__m"), part(F.col("__b") + 1, F.size("__units") - F.col("__b")).alias("__s"))
    p, s, m = (F.lit(x) for x in (marks.prefix, marks.suffix, marks.middle))
    psm, spm = F.concat(p, "__p", s, "__s", m, "__m"), F.concat(s, "__s", p, "__p", m, "__m")
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("__text"))
    chars = lambda c: F.when(F.col("form") != "plain", F.length(c)).cast("long")
    return parts.select(*[F.col(f"__k{i}").alias(k) for i, k in enumerate(keep)], "n", "form", chars("__p").alias("prefix_chars"), chars("__m").alias("middle_chars"), output.alias("output"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP13_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS h FROM documents),
c AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS y,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain' WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT doc_id, t, n, form, array_to_string(u[1:least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(u[greatest(x, y) + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
