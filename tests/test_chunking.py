"""Chunks against golden cases and a plain sequential model of the rules."""

import os
import re

import pytest
from pyspark.sql import functions as F

from foliary.functions.text import normalize_for_chunks, token_estimate
from foliary.operators import chunking, splitting

COLUMNS = "extract_idx long, file_name string, zip_entry_file_name string, indexing_contents string"


def chunks(spark, rows, **options):
    made = chunking.chunk_documents(spark.createDataFrame(rows, COLUMNS), **options)
    return [r.asDict() for r in made.orderBy("extract_idx", "chunk_seq").collect()]


def test_review_form_is_one_chunk(spark):
    text = "검토의견서\n기관명 | 환경과\n의견 | 이 사업은 계획대로 추진하는 것이 타당하다고 판단됩니다. 세부 일정은 별도로 정합니다.\n" + "\n".join(f"항목 {i} | 내용 {i} | 비고 {i} | 확인 {i}" for i in range(20)) + "\n위와 같이 알려드립니다."
    found = chunks(spark, [(723, "1_2_S01.zip", "review.hwp", text)])
    assert len(found) == 1 and found[0]["doc_role"] == "UNKNOWN" and found[0]["chunk_status"] == "READY"
    assert "타당하다고 판단됩니다" in found[0]["chunk_text"] and found[0]["chunk_text"].endswith("위와 같이 알려드립니다.")


def test_cover_alone_and_blank_texts_have_no_chunks(spark):
    assert chunks(spark, [(1, "cover.hwp", None, "2023년 업무 계획\n환경부\n대기과"), (2, "a.hwp", None, None), (3, "a.hwp", None, " \n\t "), (4, None, None, "")]) == []


def test_law_blocks_reset_and_carry(spark):
    text = "전문\n제1장 총칙\n제1절 목적\n제1조(목적) 이 법은 대기를 지킨다.\n① 하나\n제2조 정의는 이렇다.\n제2장 보칙\n제3조의 2 (벌칙) 벌한다.\n② 둘"
    rows = splitting.law_blocks(text)
    assert [r[0] for r in rows] == ["", "제1장 총칙", "제1장 총칙 > 제1절 목적", "제1장 총칙 > 제1절 목적 > 제1조", "제1장 총칙 > 제1절 목적 > 제2조", "제2장 보칙", "제2장 보칙 > 제3조의 2"]
    assert [r[4][3] for r in rows] == [None, None, None, "목적", None, None, "벌칙"]
    assert rows[3][4][4] == "이 법은 대기를 지킨다.\n① 하나" and rows[4][4][4] == "정의는 이렇다."
    assert rows[0][2] == 0 and all(a[3] == b[2] for a, b in zip(rows, rows[1:])) and rows[-1][3] == len(text)
    kind = spark.createDataFrame([(text,)], "t string").select(chunking.doc_type(F.col("t"), F.lit("UNKNOWN"))).first()[0]
    assert kind == "LAW"


def test_structured_and_draft():
    text = "머리말\n1. 개요\n내용 하나\n1.2. 세부\n내용 둘\n가. 대상\n내용 셋\nⅠ. 결론\n끝"
    rows = splitting.structured_blocks(text)
    assert [r[0] for r in rows] == ["", "1. 개요", "1.2. 세부", "가. 대상", "Ⅰ. 결론"] and rows[1][1] == "1. 개요\n내용 하나"
    draft = "수신 가\n제목 나\n본문\n붙임 1. 계획서"
    assert [(r[0], r[2], r[3]) for r in splitting.draft_blocks(draft)] == [(None, 0, draft.index("붙임")), ("붙임목록", draft.index("붙임"), len(draft))]
    assert [r[:2] for r in splitting.draft_blocks("붙임 처음")] == [(None, "붙임 처음")]


def test_draft_by_name_and_words(spark):
    text = "수신 환경부\n제목 계획 알림\n" + "알려드립니다. " * 30 + "\n붙임 1. 계획서 1부. 끝."
    found = chunks(spark, [(1, "1_2_N01.hwp", None, text), (2, "1_2_S01.hwp", None, text)])
    assert [(c["extract_idx"], c["doc_role"], c["doc_type"]) for c in found] == [(1, "DRAFT_BODY", "DRAFT"), (2, "ATTACHMENT", "GENERAL")]


def plain_parts(text, size, overlap):
    """Sentences and overlap, one after the other."""
    if len(text) <= size:
        return [text]
    found, start = [], 0
    for i, c in enumerate(text):
        if c in "!?" or (c == "." and (i == 0 or text[i - 1].isalnum())):
            found.append(text[start : i + 1])
            start = i + 1
    found.append(text[start:])
    slices = [s[i : i + size] for s in (x.strip() for x in found) if s for i in range(0, len(s), size)]
    parts, cur = [], ""
    for s in slices:
        if cur and len(cur) + len(s) > size:
            parts.append(cur.strip())
            cur = cur.strip()[-overlap:] if overlap else ""
        cur += s + " "
    return parts + ([cur.strip()] if cur else [])


@pytest.mark.parametrize(("size", "overlap"), [(200, 20), (350, 35), (90, 89), (100, 0)])
def test_oversized_texts_match_the_plain_fold(size, overlap):
    import random

    r = random.Random(size)
    words = ["alpha", "beta", "3.14", "x.", "gamma!", "delta?", "한글은", "끝났다.", "a" * 130]
    for _ in range(50):
        t = " ".join(r.choices(words, k=r.randint(80, 400)))
        found = list(splitting.oversized(("", t, 0, len(t), None), size, overlap))
        assert [p[1] for p in found] == plain_parts(t, size, overlap)
        assert all(p[4][4] == p[1] for p in found) and found[0][2] == 0 and found[-1][3] == len(t)


def test_paragraphs_pack_while_they_fit(spark):
    one = ("문장은 이렇게 이어진다. " * 10).strip()
    text = "\n\n".join([one] * 5)
    found = chunks(spark, [(1, "a.txt", None, text)], size=300, overlap=30)
    assert [c["chunk_text"] for c in found] == ["\n\n".join([one] * 2)] * 2 + [one]
    assert [c["start_offset"] for c in found] == [0, 2 * len(one) + 4, 4 * len(one) + 8] and found[-1]["end_offset"] == len(text)


def plain_chunks(text, kind, size, overlap):
    """The whole chunker, one line and character after the other: texts of the chunks, with their paths."""
    edge = "".join(map(chr, range(33)))
    lines = text.split("\n")

    def starts(line):
        line = line.strip(edge)
        if kind == "STRUCTURED":
            return line if re.match(r"([ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]|\d+(\.\d+)*|[가-하]|[A-Z])\.\s+\S", line, re.A) else None
        return line if re.match(r"제\s*\d+\s*(장|절|조)", line, re.A) else None

    blocks = []
    if kind == "DRAFT":
        at = text.find("붙임") if "붙임" in text else text.find("첨부")
        blocks = [text] if at <= 0 else [text[:at].strip(edge), text[at:].strip(edge)]
    elif kind in ("STRUCTURED", "LAW"):
        held = []
        for line in lines:
            if starts(line) and held:
                blocks.append("\n".join(held).strip(edge))
                held = []
            held.append(line)
        blocks.append("\n".join(held).strip(edge))
    else:
        paragraphs, held = [], []
        for line in [*lines, ""]:
            if line.strip() or (not held and line):
                held.append(line)
            elif held:
                paragraphs.append("\n".join(held).strip(edge))
                held = []
        current = ""
        for x in filter(None, paragraphs):
            if current and len(current) + 2 + len(x) > size:
                blocks.append(current)
                current = ""
            current = f"{current}\n\n{x}" if current else x
        blocks += [current] if current else []

    def substantive(t):
        return len(t) >= 300 and (splitting.table_like(t) or sum(c in ".!?" for c in t) >= 2 or sum(len(x.strip(edge)) >= 80 for x in t.split("\n")) >= 2)

    def front(t, first):
        rows = [x.strip(edge) for x in t.split("\n") if x.strip(edge)]
        title = [x for x in rows if re.fullmatch(r"목\s*차|차\s*례|contents?", x, re.I | re.A)]
        dotted = [x for x in rows if x not in title and re.search(r"(\.\.|……|\s\s\s)(\d+|[ivxlcdm]+)\s*$", x, re.I | re.A)]
        if (title and (len(rows) <= 2 or len(dotted) >= 2)) or (len(dotted) >= 4 and 2 * len(dotted) >= len(rows) - 1):
            return True
        if not first or len(t) > 1500 or substantive(t) or any(x[-2:] in ("다.", "요.", "함.", "음.") for x in rows):
            return False
        return len(rows) <= 4 or sum(any(w in x for w in splitting.COVER_WORDS) for x in rows) >= 2

    out = []
    for block in blocks:
        for part in plain_parts(block, size, overlap):
            if not part.strip(edge) or front(part.strip(edge), not out):
                continue
            if out and len(part.strip(edge)) < 120:
                out[-1] += "\n\n" + part.strip(edge)
            else:
                out.append(part)
    if not out and (len(text) > 1500 or substantive(text) or sum(text.count(e) for e in ("다.", "요.", "함.", "음.")) >= 3):
        return None if kind not in ("GENERAL", "TABLE") else [p for b in blocks for p in plain_parts(b, size, overlap)]
    return out


def test_whole_chunker_equals_a_plain_model(spark):
    """Texts of every kind, short and long, with covers, tables of contents, laws, letters and forms; and the driver's documents."""
    import random

    r = random.Random(21)
    pieces = ["제1장 총칙", "제2조(목적) 이 법은 대기를 지킨다.", "① 하나", "② 둘", "1. 개요", "1.2. 세부 사항", "가. 대상", "Ⅰ. 결론", "목차", "개요 .....1", "본론 .....2", "결론 .....9", "부록   iv", "기관명 환경부", "보고서", "a | b | c", "x  y  z  w", "", "", "붙임 1. 계획서", "수신 환경부", "제목 계획", "문장은 이렇게 이어진다. 그리고 끝난다.", "긴 문장이 이어지고 또 이어져서 " * 6 + "끝난다.", "words of 3.14 in English! Is it? yes.", "a" * 90]
    texts = ["\n".join(r.choices(pieces, k=r.choice([1, 3, 8, 20, 60, 150]))) for _ in range(400)]
    rows = [(i, r.choice(["1_2_N01.hwp", "x.txt"]), None, t) for i, t in enumerate(texts)]
    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    rows += [(1000 + x.doc_id, "d.txt", None, x.text) for x in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    sources = spark.createDataFrame(rows, COLUMNS)
    text = normalize_for_chunks(F.col("indexing_contents"))
    kinds = sources.select("extract_idx", text.alias("t"), chunking.doc_type(text, chunking.doc_role(F.col("file_name"), F.lit(None).cast("string"))).alias("kind")).collect()
    assert {k.kind for k in kinds} == {"DRAFT", "LAW", "STRUCTURED", "TABLE", "GENERAL"}
    for size, overlap in ((3500, 350), (300, 30)):
        found = {}
        for c in chunking.chunk_documents(sources, size=size, overlap=overlap).orderBy("extract_idx", "chunk_seq").collect():
            found.setdefault(c.extract_idx, []).append(c.chunk_text)
        for k in kinds:
            want = plain_chunks(k.t, k.kind, size, overlap) if k.t.strip() else []
            if want is not None:
                assert found.get(k.extract_idx, []) == want, (k.kind, k.t)


def test_front_matter():
    assert [splitting.contents_table(t) for t in ("목차\n개요 .....1\n본론 .....2\n결론 .....9", "개요 ...1\n가 ...2\n나 ...3\n다    iv", "가\n나", "차 례")] == [True, True, False, True]
    assert splitting.cover("가\n나") and not splitting.cover("알립니다.\n문장이 끝난다.")


def test_table_like_is_one_rule(spark):
    texts = ["a | b\n" * 5, "a | b\n" * 4, "a  b  c  d\n" * 6, "a  b  c   \n" * 6, "  a  b  c\n" * 6, "x\n" * 20 + "a | b\n" * 6, "", "\n\n\n\n\n\n"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", chunking.table_like(F.col("t"))).collect()
    assert [r[1] for r in sorted(rows)] == [splitting.table_like(t) for t in texts]


def test_tokens(spark):
    rows = spark.createDataFrame([("한국어 문장",), ("two words",), ("mixed 한글 3",), ("...",), (" ",), (None,)], "t string").select(token_estimate(F.col("t"))).collect()
    assert [r[0] for r in rows] == [2, 2, 3, 1, 0, 0]
    assert re.fullmatch("[가-힣]+", "한국어")
