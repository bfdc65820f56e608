"""Fill-in-middle transformation against a plain model, and its grammars against regexes that match units."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from foliary.llm import infill

PLAIN_UNITS = {
    infill.LETTERS: r"[A-Za-z]+|[^A-Za-z]",
    infill.CHARACTERS: r"(?s:.)",
    infill.WORDS: r"\s+|\S+",
    infill.NAMES: r"\w+|\s+|[^\w\s]",
    infill.LINES: r"[^\n]*\n|[^\n]+",
}
ODD = [None, "", "a", "1", "\n", "ab1cd", "x<P>y", "<S>", "a <M> b", "<<P", "P><S", "é😀😀a😀", "😀", "日本語 text 😀\n\nend", "<" * 7, "a b\tc\n" * 50, "tail ", "  ", "\r\n\x00x", "word " * 60_000]


def model(doc_id, text, plain=10, spm=20):
    text = text or ""
    own = re.findall(PLAIN_UNITS[infill.LETTERS], text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(own)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(own[:a]), "".join(own[a:b]), "".join(own[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_transformation_equals_a_plain_model_and_is_undone(spark):
    r = random.Random(1)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(i + 100, "".join(r.choices("ab1<>PSM é😀\n", k=r.randrange(60)))) for i in range(400)] + [(None, "no id"), (3, "same id"), (3, "same id"), (-5, "below zero")]
    made = infill.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), keep=("doc_id", "text"))
    found = made.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(((x["doc_id"], x["n"], x["form"], x["prefix_chars"], x["middle_chars"], x["output"]) for x in found), key=str) == sorted(((i, *model(i, t)) for i, t in rows), key=str)
    assert all(x["back"] == (x["text"] or "") for x in found)
    assert {x["form"] for x in found} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("grammar", list(PLAIN_UNITS))
def test_boundaries_cut_into_units(spark, grammar):
    r = random.Random(2)
    texts = [t for t in ODD if t is not None and len(t) < 1000] + ["".join(r.choices("aZ1_ .\n\té😀", k=r.randrange(40))) for _ in range(300)]
    found = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select("text", infill.units(F.col("text"), grammar).alias("u")).collect()
    for row in found:
        assert row["u"] == re.findall(PLAIN_UNITS[grammar], row["text"]), row["text"]


def test_rates_marks_and_seeds(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))
    forms = lambda **k: {x["form"] for x in infill.fill_in_middle(docs, **k).select("form").distinct().collect()}
    assert forms(plain_percent=100) == {"plain"} and forms(plain_percent=0, spm_percent=100) == {"spm"} and forms(plain_percent=0, spm_percent=0) == {"psm"}
    cuts = lambda seed: [tuple(x) for x in infill.fill_in_middle(docs, seed=seed).orderBy("doc_id").select("prefix_chars", "middle_chars").collect()]
    assert cuts(1) != cuts(2)
    with pytest.raises(ValueError):
        infill.Marks("<P>", "<P>", "<M>")
    with pytest.raises(ValueError):
        infill.Marks("ab", "bc", "<M>")
    marks = infill.Marks("[[p]]", "[[s]]", "[[m]]")
    made = infill.fill_in_middle(docs, marks=marks, plain_percent=0)
    assert made.where(infill.restored(F.col("output"), F.col("form"), marks) != "one two three").count() == 0


def test_clashing_columns_nulls_and_no_rows(spark):
    docs = spark.createDataFrame([(None, None, None, "x", 1), (1, "some text here", "plain", None, 2), (1, "some text here", "plain", None, 2)], "doc_id long, text string, form string, output string, n long")
    found = infill.fill_in_middle(docs).collect()
    assert sorted(((x["doc_id"], x["n"], x["form"], x["output"]) for x in found), key=str) == sorted(((i, *(model(i, t)[k] for k in (0, 1, 4))) for i, t in [(None, None), (1, "some text here"), (1, "some text here")]), key=str)
    assert infill.fill_in_middle(docs.limit(0)).count() == 0


def test_no_shuffle_and_no_python(spark, tmp_path):
    spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    plan = infill.op13_fill_in_middle(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan and "lang" not in plan
