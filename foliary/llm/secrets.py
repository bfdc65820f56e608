"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Both models are first-order chains over one alphabet, trained on labelled samples with add-one smoothing; their difference is
a table of log-likelihood ratios in thousandths (whole numbers, so sums are exact). A token of TOKEN_CHARS or more key
characters is a secret if the ratios along it add up to MARGIN or more a character. Everything on the executors is Column
expressions: gates by regex, spans by running sums of lengths, the chain by one fold over the token's characters.

Found tokens that overlap a span of the fixed patterns are left to it. Null and empty texts have no spans; repeated rows
are scanned each on its own; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm.frames import aside
from foliary.llm.spans import bound, gated, running, spans

#: Fixed by the contract: the base patterns and the least lengths of what they find.
KEY_VALUE = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS_ID = r"AKIA[A-Z0-9]+"
HEX_RUN = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN_CHARS = 16
#: Thousandths of a nat for each character: none of 20,000 ordinary training identifiers is a secret then. Of names that never
#: train (those of the standard library of Python; see the tests) about 1 in 250 is, and fewer than 1 in 20 random strings is missed.
MARGIN = 800
_STATES = len(ALPHABET) + 1  # 0: the start

#: Words that programs and prose build identifiers from.
_WORDS = """account action address agent allow amount answer apply array assign async attribute author average background balance
batch before begin between binary block border bottom bound branch bucket buffer build button bytes cache calendar callback cancel
catalog category center change channel character check child choice class clean clear client close cluster code collect color column
command comment commit compare compile component config connect constant contain content context control convert count create current
cursor customer data database date debug decode default define delete depth detail device direct display document domain double
download draft driver edge editor element email empty enable encode engine entry error event example execute expand export express
extract factory failure feature field file filter final first float folder force format frame from function gather general generate
global group handle handler header height hidden history host image import index info initial inner input insert install instance
integer internal invalid item iterator join kernel label language large last layer layout left length level library limit line link
list listener load local location lock logger loop main manager mapping margin match matrix maximum memory merge message metadata method
middle minimum mode model module monitor mouse name native network node normal notify null number object offset open operator option
order origin output owner package page panel parameter parent parse partition password path pattern payload pending percent period
plugin point policy pool port position prefix previous print priority private process product profile program project property protocol
provider public query queue random range read record refresh region register release remove render replace report request reset
resource response result return right root route sample save schedule schema scope score screen scroll search second section select
sequence server service session shape signal single size source split stack start state static status stop storage store stream string
style submit suffix summary support switch symbol system table target task temp template test text thread time title toggle token
total trace track transform tree trigger type unique update upload user valid value variable version video view visible watch weight
width window word worker wrapper write and are the that with this for was not ing tion ent ers able ness ment""".split()


def ordinary(n: int, seed: int = 1) -> list[str]:
    """Labelled sample of identifiers: snake, camel and kebab case, some with versions, paths, counters and placeholders (xxxxxx)."""
    r, out = random.Random(seed), []
    for _ in range(n):
        words = [r.choice(_WORDS) for _ in range(r.randint(2, 6))]
        style = r.randrange(6)
        name = "_".join(words) if style == 0 else "-".join(words) if style == 1 else "".join(w.title() for w in words) if style == 2 else words[0] + "".join(w.title() for w in words[1:]) if style == 3 else "/".join(words) if style == 4 else "_".join(words).upper()
        if r.random() < 0.5:
            name += r.choice(["", "_", "-", "v"]) + str(r.choice([r.randint(0, 9), r.randint(10, 99), r.randint(1990, 2030), f"{r.randint(1990, 2030)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}"]))
        if r.random() < 0.1:
            name += r.choice(["", "_", "-", "="]) + r.choice(ALPHABET) * r.randint(4, 12)
        out.append(name)
    return out


def randoms(n: int, seed: int = 2) -> list[str]:
    """Labelled sample of random strings: base64, URL-safe base64, letters with digits, and hexadecimal in either case."""
    r, out = random.Random(seed), []
    kinds = (ALPHABET[:64], ALPHABET[:62] + "_-", ALPHABET[:62], ALPHABET[:26] + ALPHABET[52:62], ALPHABET[26:62], "0123456789abcdef", "0123456789ABCDEF")
    for _ in range(n):
        letters = r.choice(kinds)
        out.append("".join(r.choices(letters, k=r.randint(20, 48))))
    return out


def _chain(samples: Sequence[str]) -> list[list[float]]:
    seen = [[1.0] * _STATES for _ in range(_STATES)]
    for s in samples:
        last = 0
        for c in s:
            last, now = ALPHABET.index(c) + 1, last
            seen[now][last] += 1
    return [[math.log(x / sum(row)) for x in row] for row in seen]


@cache
def ratios(n: int = 20_000) -> tuple[int, ...]:
    """Thousandths of the log-likelihood ratio of each step (state before times states, plus state after): random over ordinary."""
    a, b = _chain(randoms(n)), _chain(ordinary(n))
    return tuple(round(1000 * (x - y)) for p, q in zip(a, b, strict=True) for x, y in zip(p, q, strict=True))


def _ratio(token: Column) -> Column:
    table = F.split(F.lit(",".join(map(str, ratios()))), ",").cast("array<bigint>")
    states = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    step = lambda acc, s: F.struct(s.alias("last"), (acc["sum"] + F.get(table, acc["last"] * _STATES + s)).alias("sum"))
    return F.aggregate(states, F.struct(F.lit(0).alias("last"), F.lit(0).cast("long").alias("sum")), step)["sum"]


_TOKEN = f"[A-Za-z0-9+/_=-]{{{TOKEN_CHARS},}}"


def _kept(found: Column, kind: str, order: int, test) -> Column:
    return F.transform(F.filter(found, test), lambda x: F.struct(x["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["hit"].alias("hit")))


def scan(documents: DataFrame, *, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns `keep` and `secrets`: array<struct<start, order, kind, end, hit>> by start, then kind (assign, access, hex, random)."""
    rows = documents.select(*[F.col(f"`{k}`") for k in keep], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__t"))
    t = F.col("__t")
    assign = gated(t.rlike(r"(?i)password|passwd|secret|token|api_?key"), spans(t, F.lit(KEY_VALUE)))
    access = gated(t.contains("AKIA"), spans(t, F.lit(ACCESS_ID)))
    long_hex = gated(t.rlike(f"[0-9a-f]{{{LEAST['hex']}}}"), spans(t, F.lit(HEX_RUN[:-1] + f"{{{LEAST['hex']},}}")))
    token = gated(t.rlike(_TOKEN), spans(t, F.lit(_TOKEN)))
    base = F.concat(
        _kept(assign, "assign", 0, lambda x: F.length(F.regexp_extract(x["hit"], KEY_VALUE, 2)) >= LEAST["assign"]),
        _kept(access, "access", 1, lambda x: F.length(x["hit"]) >= LEAST["access"]),
        _kept(long_hex, "hex", 2, lambda x: F.lit(True)),
    )
    rows = rows.select(*[F.col(f"`{k}`") for k in keep], base.alias("__base"), token.alias("__token"))
    mixed = F.array_sort(F.concat("__base", _kept(F.col("__token"), "random", 3, lambda x: F.lit(True))))
    more = F.filter(bound(mixed, _free), lambda x: _ratio(x["hit"]) >= F.length(x["hit"]) * MARGIN)
    return rows.select(*[F.col(f"`{k}`") for k in keep], F.array_sort(F.concat("__base", more)).alias("secrets"))


def _free(mixed: Column) -> Column:
    """Of spans by start those of found tokens that no fixed pattern's overlaps: none before ends in one, and none after starts in it."""
    fixed = lambda x: x["order"] < 3
    before = running(F.transform(mixed, lambda x: F.when(fixed(x), x["end"]).otherwise(F.lit(-1).cast("long"))), F.greatest)
    after = F.reverse(running(F.reverse(F.transform(mixed, lambda x: F.when(fixed(x), x["start"]).otherwise(F.lit(1 << 62)))), F.least))
    return bound(F.struct(before.alias("before"), after.alias("after")), lambda m: F.filter(mixed, lambda x, i: ~fixed(x) & (F.get(m["before"], i) <= x["start"]) & (F.get(m["after"], i) >= x["end"])))


def redact(documents: DataFrame) -> DataFrame:
    """The documents with every secret's characters replaced by [SECRET]; n_chars, where it is a column, follows.

    Overlapping spans become one gap. Texts without secrets (null ones too) stay as they are.
    """
    given, alias = aside(documents)
    text = alias["text"]
    found = scan(given, text=text, keep=tuple(alias.values())).withColumn("__clean", F.when(F.size("secrets") > 0, _cut(F.col(text).cast("string"), F.col("secrets"))))
    values = {"text": F.coalesce("__clean", text)}
    if "n_chars" in alias:
        values["n_chars"] = F.when(F.col("__clean").isNotNull(), F.length("__clean").cast("long")).otherwise(F.col(alias["n_chars"]))
    return found.select(*[values.get(c, F.col(a)).alias(c) for c, a in alias.items()])


def _cut(text: Column, found: Column) -> Column:
    """The text with [SECRET] in place of the spans, which lie by start."""
    def pieces(ends: Column) -> Column:
        before = lambda i: F.coalesce(F.get(ends, i - 1), F.lit(0).cast("long"))
        kept = F.filter(F.transform(found, lambda x, i: F.when(x["start"] >= before(i), F.substring(text, (before(i) + 1).cast("int"), (x["start"] - before(i)).cast("int")))), lambda piece: piece.isNotNull())
        last = F.substring(text, (F.element_at(ends, -1) + 1).cast("int"), F.lit(2**31 - 1))
        return F.array_join(F.concat(kept, F.array(last)), "[SECRET]")

    return bound(running(F.transform(found, lambda x: x["end"]), F.greatest), pieces)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return found.select("doc_id", *map(count, LEAST), F.sha2(joined(F.filter("secrets", lambda x: x["order"] < 3)), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


def sql() -> str:
    """The same result in SQL."""
    found = "SELECT doc_id, {kind} AS kind, {order} AS o, s, s + len(h) AS e, h FROM (SELECT doc_id, m[i] AS h, CAST(list_sum(list_transform(g[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS s FROM (SELECT doc_id, m, g, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS m, regexp_split_to_array(t, '{p}') AS g FROM d)))"
    kinds = [found.format(kind=f"'{k}'", order=i, p=p.replace("'", "''")) for i, (k, p) in enumerate((("assign", KEY_VALUE), ("access", ACCESS_ID), ("hex", HEX_RUN[:-1] + f"{{{LEAST['hex']},}}"), ("random", f"[A-Za-z0-9+/_=-]{{{TOKEN_CHARS},}}")))]
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k0 AS ({kinds[0]}), k1 AS ({kinds[1]}), k2 AS ({kinds[2]}), k3 AS ({kinds[3]}),
b AS (SELECT * FROM k0 WHERE len(regexp_extract(h, '{KEY_VALUE.replace("'", "''")}', 2)) >= {LEAST['assign']} UNION ALL SELECT * FROM k1 WHERE len(h) >= {LEAST['access']} UNION ALL SELECT * FROM k2),
r AS (SELECT [{",".join(map(str, ratios()))}] AS ratio),
c AS (SELECT k3.* FROM k3 WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.doc_id = k3.doc_id AND b.s < k3.e AND k3.s < b.e)),
v AS (SELECT doc_id, kind, o, s, e, h FROM c, r WHERE list_sum(list_transform(range(1, len(h) + 1), lambda i: ratio[(CASE WHEN i = 1 THEN 0 ELSE strpos('{ALPHABET}', h[i - 1:i - 1]) END) * {_STATES} + strpos('{ALPHABET}', h[i:i]) + 1])) >= len(h) * {MARGIN}),
a AS (SELECT * FROM b UNION ALL SELECT * FROM v),
x AS (SELECT doc_id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex, sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (o < 3), '')) AS base_sha256, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans FROM a GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN x USING (doc_id)
"""


OP8_SQL = sql()
