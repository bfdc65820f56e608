"""Parsers, archives, catalogued files and letters on small fixtures."""

import io
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from foliary.functions import letters
from foliary.functions import text as X
from foliary.operators import merge
from foliary.operators import selection as Q
from foliary.plans import workflow
from foliary.sources import files, hwp, parsers, pdf


def archive(entries, encoding=None):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in entries:
            z.writestr(name, data)
    return out.getvalue()


def test_web_page_text():
    page = b"<html><head><title>t</title></head><body><div>a <b>b</b><br>c</div><script>x</script><table><tr><th>h</th><td> </td><td>v\n w</td></tr><tr><td>n<table><tr><td>i</td></tr></table></td></tr></table><p>end</body></html>"
    assert parsers.web_page(page) == "a b\nc\nh | v w\nn i\ni\nend"
    assert parsers.web_page(b"") == "" and parsers.web_page(b"<noscript>x</noscript>") == ""


def test_archives_give_entries_or_one_failure():
    found = parsers.entries(archive([("d/", ""), ("d/a.txt", "x"), ("b\\c.txt", "y")]))
    assert [(r["seq"], r["name"], r["content"]) for r in found] == [(1, "a.txt", b"x"), (2, "c.txt", b"y")]
    assert [r["code"] for c in (None, b"no zip", archive([])) for r in parsers.entries(c)] == ["FILE_NOT_FOUND", "ZIP_FAILED", "EMPTY_ZIP"]


def test_formats_and_failures_are_rows():
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    ns = w[1:-1]
    docx = archive([("word/document.xml", f'<d xmlns="{ns}"><p><t>one</t></p><tr><tc><p><t>a</t></p></tc><tc><p><t>b</t></p></tc></tr></d>')])
    hwpx = archive([("Contents/section0.xml", "<s><p><t>가</t><tab/><t>나</t></p><tr><tc><p><t>x</t></p></tc><tc><p><t>y</t></p></tc></tr></s>")])
    xlsx = archive([("xl/sharedStrings.xml", "<s><si><t>s0</t></si></s>"), ("xl/worksheets/sheet1.xml", '<w><row><c t="s"><v>0</v></c><c><v>7</v></c></row></w>')])
    pptx = archive([("ppt/slides/slide1.xml", "<s><p><t>slide</t></p></s>")])
    assert parsers.extract("a.docx", docx)["contents"] == "one\na\tb\n"
    assert parsers.extract("a.hwpx", hwpx)["contents"] == "가\t나\nx\ty\n"
    assert parsers.extract("a.xlsx", xlsx)["contents"] == "s0\t7" and parsers.extract("a.pptx", pptx)["contents"] == "slide"
    assert parsers.extract("a.txt", "한글".encode("cp949"))["contents"] == "한글"
    codes = {n: parsers.extract(n, c)["code"] for n, c in (("a.txt", None), ("a.pdf", b"%PDF-1.4"), ("a.hwp", b"x"), ("a.docx", b"broken"), ("noname", b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"))}
    assert codes == {"a.txt": "FILE_NOT_FOUND", "a.pdf": "PDF_PARSE_FAILED", "a.hwp": "UNSUPPORTED_FORMAT", "a.docx": "INVALID_DOCUMENT_FORMAT", "noname": "UNSUPPORTED_FORMAT"}
    assert parsers.extract("page", b"<!DOCTYPE html><p>x")["media_type"] == "text/html"


def test_extract_run_from_stored_files(spark, tmp_path):
    base = tmp_path / "files" / "2023" / "F1" / "R1"
    base.mkdir(parents=True)
    (base / "1_2_N01.txt").write_text("제목 | 계획 알림 | 1. 본문\n시행 | 과-12 | (2023. 4. 5.) | 접수 | 담당-7\n본문이다. 끝.\n꼬리", encoding="utf-8")
    (base / "x_S01.zip").write_bytes(archive([("in.txt", "하나"), ("bad.pdf", "%PDF")]))
    rows = [("2023", "F1", "R1", "M", 1, "K", "2020", None, n) for n in ("1_2_N01.txt", "x_S01.zip", "gone.txt", None)]
    catalog = spark.createDataFrame(rows, "transferyear string, rc_rfile_no string, rc_ritem_no string, mngno string, detno int, kikwancode string, prodyear string, org_file_path string, save_file_name string")
    from foliary import schema as S

    empty = spark.createDataFrame([], S.EXTRACTS)
    stored = files.stored_files(spark, str(tmp_path / "files"))
    after, _ = workflow.extract_run(catalog, empty, str(tmp_path / "files"), Q.Params(), stored=stored)
    found = {(r.file_name, r.zip_seq): r for r in after.collect()}
    assert set(found) == {("1_2_N01.txt", 0), ("x_S01.zip", 1), ("x_S01.zip", 2), ("gone.txt", 0)}
    letter = found["1_2_N01.txt", 0]
    assert (letter.hwp_sub_title, letter.implement_org, letter.implement_date, letter.receipt_org, letter.receipt_date) == ("계획 알림", "과-12", "2023-04-05", None, None)
    assert letter.indexing_contents == "본문이다. 끝." and letter.file_type == "N" and letter.extract_status == "PASS" and letter.data_year == 2023
    assert found["x_S01.zip", 1].contents == "하나" and found["x_S01.zip", 2].extract_err_msg.startswith("PDF_PARSE_FAILED") and found["gone.txt", 0].extract_status == "FAIL"
    assert Q.extract_targets(catalog, after, Q.Params()).count() == 0
    assert [r.save_file_name for r in Q.extract_targets(catalog, after, Q.Params(retry=True)).collect()] == ["gone.txt"]
    path = str(tmp_path / "table")
    merge.swap(spark, after, path)
    merge.swap(spark, spark.read.parquet(path).where("zip_seq = 0"), path)
    assert spark.read.parquet(path).count() == 2


def test_letters(spark):
    rows = [
        ("a_N01.hwp", "제목 : 줄 제목\n1. 첫 항목\n시행 총무과-3 (2020-1-2 )\n끝 ."),
        ("a_n02.hwp", "시행 | 전화-12 | 우 | 접수 | 과-9 | 우 \n1. 본문"),
        ("a_S01.hwp", "제목 | 아님"),
        ("a_N03.hwp", None),
    ]
    d = spark.createDataFrame(rows, "f string, c string").withColumn("i", F.lit("given"))
    found = {r.f: r for r in letters.with_letters(d, file_name="f", contents="c", indexing="i").collect()}
    assert found["a_N01.hwp"].hwp_sub_title == "줄 제목" and (found["a_N01.hwp"].implement_org, found["a_N01.hwp"].implement_date) == ("총무과-3", "2020-01-02")
    assert found["a_N01.hwp"].i.startswith("1. 첫 항목") and found["a_N01.hwp"].i.endswith("끝 .")
    assert found["a_n02.hwp"].implement_org is None and found["a_n02.hwp"].receipt_org == "과-9"
    assert found["a_S01.hwp"].i == "given" and found["a_N03.hwp"].i == "given"
    body = spark.createDataFrame([("a\n\n\n\nb",)], "t string")
    assert body.select(letters.clean_body(F.col("t"))).first()[0] == "a\n\nb" and body.select(letters.clean_body(F.col("t"), strict=True)).first()[0] == "annb"


@pytest.mark.parametrize(("name", "ext", "mark", "kind", "group"), [("a_N01.hwp", "hwp", "N", "HWP", "HWP"), ("d\\b_s02.PDF", "pdf", "S", "PDF", "PDF"), ("noext", "", "UNKNOWN", "UNKNOWN", "ETC"), ("dot.", "", "UNKNOWN", "UNKNOWN", "ETC"), ("a_N01_S02.x", "x", "S", "X", "ETC"), ("_Nx.docx", "docx", "UNKNOWN", "WORD", "OFFICE"), (None, "", "UNKNOWN", "UNKNOWN", "ETC")])
def test_names(spark, name, ext, mark, kind, group):
    c = F.col("n")
    row = spark.createDataFrame([(name,)], "n string").select(X.extension(c), X.role_mark(c), X.file_type(c), X.file_group(c)).first()
    assert tuple(row) == (ext, mark, kind, group)


def test_slow_files_time_out_and_pictures_are_found(spark):
    import time

    parsers.register("slow", "x/slow", lambda content: time.sleep(5))
    assert parsers.extract("a.slow", b"x", seconds=0.05)["code"] == "EXTRACT_TIMEOUT"
    docx = archive([("word/media/image1.png", b"\x89PNG\r\n\x1a\nxx"), ("word/media/image2.emf", b"??"), ("word/media/image3.jpg", b"\xff\xd8\xffyy"), ("word/document.xml", "<d/>")])
    assert [(i["seq"], i["data"][-2:]) for i in parsers.images(docx)] == [(1, b"xx"), (2, b"yy")] and parsers.images(None) == []
    rows = spark.createDataFrame([("2023", "F", "R", "a.docx", docx)], "transferyear string, rc_rfile_no string, rc_ritem_no string, save_file_name string, content binary")
    assert [r.image_path for r in files.image_files(rows, "/img").orderBy("seq").collect()] == ["/img/2023/F/R/a/img1.png", "/img/2023/F/R/a/img2.png"]


def pdf_file(pages, more=(), box="0 0 600 800"):
    """A file of pages given by their content streams, with a font F1 and further objects from number 90 on."""
    kids = " ".join(f"{10 + 2 * i} 0 R" for i in range(len(pages)))
    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: f"<< /Type /Pages /Kids [{kids}] /MediaBox [{box}] /Resources << /Font << /F1 3 0 R /F2 90 0 R >> /XObject << /X 91 0 R >> >> >>".encode(), 3: b"<< /Type /Font /Subtype /Type1 /Encoding << /Differences [1 /uni00E9 /A] >> >>"}
    for i, body in enumerate(pages):
        data = zlib.compress(body)
        objects[10 + 2 * i] = f"<< /Type /Page /Parent 2 0 R /Contents [{11 + 2 * i} 0 R] >>".encode()
        objects[11 + 2 * i] = b"<< /Length %d /Filter /FlateDecode >> stream\r\n%s\nendstream" % (len(data), data)
    objects |= {90 + i: o for i, o in enumerate(more)}
    return b"%PDF-1.7\n" + b"".join(b"%d 0 obj %s endobj\n" % kv for kv in objects.items()) + b"trailer << /Root 1 0 R >>"


def test_pdf_text():
    show = lambda x, y, t: f"BT /F1 10 Tf {x} {y} Td ({t}) Tj ET ".encode()
    left, right = [show(40, 600 - 20 * i, f"left {i}") for i in range(3)], [show(400, 600 - 20 * i, f"right {i}") for i in range(3)]
    columns = show(200, 700, "Full title of it") + b"".join(a + b for a, b in zip(left, right, strict=True)) + show(250, 100, "foot of the page")
    joined = b"BT /F1 10 Tf 50 700 Td [(Wo) -50 (rld) -500 (of)] TJ 0 -14 Td (\\(a\\051 \\\\) Tj T* 14 TL T* <0102> Tj ET q 1 0 0 1 0 -300 cm BT /F1 10 Tf 1 0 0 1 50 700 Tm (low) Tj ET Q /X Do"
    cmap = b"begincmap 1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfchar <0005> <D55C> endbfchar 2 beginbfrange <0010> <0012> <AC00> <0020> <0021> [<0041> <00420043>] endbfrange endcmap"
    form = b"BT /F2 10 Tf 50 50 Td <000500100012002000210777> Tj ET"
    more = [b"<< /Type /Font /Subtype /Type0 /ToUnicode 92 0 R /DescendantFonts [93 0 R] >>", b"<< /Type /XObject /Subtype /Form /Length %d >> stream\n%s\nendstream" % (len(form), form), b"<< /Length %d >> stream\n%s\nendstream" % (len(cmap), cmap), b"<< /DW 1000 /W [5 [500] 16 18 700] >>"]
    found = pdf.text(pdf_file([columns, joined, b""], more)).split("\n\n")
    assert found[0] == "Full title of it\nleft 0\nleft 1\nleft 2\nright 0\nright 1\nright 2\nfoot of the page"
    assert found[1].split("\n") == ["World of", "(a) \\", "éA", "low", "한가갂ABC\ufffd"]
    packed = zlib.compress(b"1 0 2 34 " + b"<< /Type /Catalog /Pages 2 0 R >> " + b"<< /Type /Pages /Kids [10 0 R] /MediaBox [0 0 600 800] /Resources << /Font << /F1 3 0 R >> >> >>")
    body = pdf_file([show(40, 700, "in an object stream")]).replace(b"1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n", b"")
    body = body[: body.index(b"2 0 obj")] + body[body.index(b"3 0 obj") :] + b"\n80 0 obj << /Type /ObjStm /N 2 /First 9 /Length %d /Filter /FlateDecode >> stream\n%s\nendstream endobj" % (len(packed), packed)
    assert pdf.text(body) == "in an object stream\n"
    assert parsers.extract("a.pdf", pdf_file([b"BT"]).replace(b"trailer <<", b"trailer << /Encrypt 5 0 R"))["code"] == "PDF_PARSE_FAILED"
    assert parsers.extract("x", pdf.written(["one", "(two)"]))["contents"] == "one\n(two)\n"


def hwp_file(sections, flags=1):
    """A compound file of an HWP document, all of whose streams lie in whole sectors."""
    head = b"HWP Document File".ljust(32, b"\0") + struct.pack("<II", 0x05000300, flags) + bytes(4056)
    deflated = []
    for body in sections:
        c = zlib.compressobj(wbits=-15)
        deflated.append(c.compress(body) + c.flush() if flags & 1 else body)
    streams = [("FileHeader", head), *((f"Section{i}", d.ljust(4096, b"\0")) for i, d in enumerate(deflated))]
    fat, data, at = [0xFFFFFFFD], b"", 1
    n_dir = -(-(len(streams) + 2) // 4)
    fat += [*range(2, 1 + n_dir), 0xFFFFFFFE]
    at += n_dir
    places = []
    for _, body in streams:
        n = -(-len(body) // 512)
        places.append((at, len(body)))
        fat += [*range(at + 1, at + n), 0xFFFFFFFE]
        data += body.ljust(512 * n, b"\0")
        at += n

    def node(name, kind, right, child, start=0, size=0):
        raw = name.encode("utf-16-le") + b"\0\0"
        return raw.ljust(64, b"\0") + struct.pack("<HBBIII", len(raw), kind, 1, 0xFFFFFFFF, right, child) + bytes(36) + struct.pack("<IQ", start, size)

    none = 0xFFFFFFFF
    nodes = [node("Root Entry", 5, none, 1, 0xFFFFFFFE), node("FileHeader", 2, 2, none, *places[0]), node("BodyText", 1, none, 3 if sections else none)]
    nodes += [node(streams[i][0], 2, i + 3 if i < len(sections) else none, none, *places[i]) for i in range(1, len(streams))]
    assert len(fat) <= 128
    header = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + bytes(16) + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + bytes(10) + struct.pack("<IIIIIIII", 1, 1, 0, 4096, 0xFFFFFFFE, 0, 0xFFFFFFFE, 0) + struct.pack("<109I", 0, *[none] * 108)
    return header + struct.pack("<128I", *fat, *[none] * (128 - len(fat))) + b"".join(nodes).ljust(512 * n_dir, b"\0") + data


def hwp_record(text, tag=67):
    body = text.encode("utf-16-le")
    head = (tag | min(len(body), 4095) << 20)
    return struct.pack("<I", head) + (struct.pack("<I", len(body)) if len(body) >= 4095 else b"") + body


def test_hwp_text():
    long = "가나다" * 1000
    section = hwp_record("x", 66) + hwp_record("\x02abcdefg제목\x09tttttttabc\x0d") + hwp_record(long) + hwp_record("\x0bggggggg\x18끝")
    for flags in (0, 1):
        assert hwp.text(hwp_file([section, hwp_record("둘")], flags)) == f"제목\tabc\n{long}\n-끝\n둘"
    assert parsers.extract("a.hwp", hwp_file([section]))["media_type"] == "application/x-hwp" and parsers.extract("noname", hwp_file([hwp_record("이름 없이")]))["contents"] == "이름 없이"
    assert parsers.extract("a.hwp", hwp_file([section], 3))["code"] == "UNSUPPORTED_FORMAT"
    assert parsers.extract("a.hwp", archive([("Contents/section0.xml", "<s><p><t>zip</t></p></s>")]))["contents"] == "zip\n"


def test_parsers_and_pictures_of_a_run_reach_its_tasks(spark):
    picture = b"\x89PNG\r\n\x1a\n"
    docx = archive([("word/media/image1.png", picture), ("word/media/image2.png", picture), ("word/document.xml", "<d/>")])
    rows = spark.createDataFrame([("2023", "F", "R", "2020", "a.own", b"abc"), ("2023", "F", "R", "2020", "b.zip", archive([("d.docx", docx)])), ("2023", "F", "R", "2020", "c.docx", docx)], "transferyear string, rc_rfile_no string, rc_ritem_no string, prodyear string, save_file_name string, content binary")
    made = {r.file_name: r for r in files.extract_files(rows, more={"own": ("x/own", lambda content: content.decode().upper())}, images="/img").collect()}
    assert made["a.own"].contents == "ABC" and made["a.own"].img_datas == "[]"
    assert made["b.zip"].img_datas == '{"img1":"/img/2023/F/R/b/d/img1.png","img2":"/img/2023/F/R/b/d/img2.png"}'
    assert made["c.docx"].img_datas == '{"img1":"/img/2023/F/R/c/img1.png","img2":"/img/2023/F/R/c/img2.png"}'
    assert sorted(r.image_path for r in files.image_files(rows, "/img").collect()) == [f"/img/2023/F/R/{n}/img{i}.png" for n in ("b/d", "c") for i in (1, 2)]


def test_files_are_read_by_the_catalogue_and_shuffled_by_nothing(spark, tmp_path, monkeypatch):
    from foliary import schema as S
    from foliary.sources import files, stored

    monkeypatch.setattr(stored, "OPEN_BYTES", 10)
    base = f"file://{tmp_path}/store"
    rows = [("2023", "F", f"R{i}", None, f"{i}_N01.txt", f"text {i} " * i) for i in range(40)]
    catalog = spark.createDataFrame(rows, "transferyear string, rc_rfile_no string, rc_ritem_no string, org_file_path string, save_file_name string, text string")
    path = files.X.resolved_path(F.col("org_file_path"), F.col("save_file_name"), F.col("transferyear"), F.col("rc_rfile_no"), F.col("rc_ritem_no"), base, "2023")
    stored.put_files(catalog.where("rc_ritem_no <> 'R7'").select(path.alias("path"), F.encode("text", "UTF-8").alias("data")), base)
    (tmp_path / "store" / "2023" / "F" / "R7" / "7_N01.txt").mkdir(parents=True)  # a folder is no file
    wanted = catalog.where("rc_ritem_no NOT IN ('R1', 'R2')").drop("text").withColumn("prodyear", F.lit("2020"))
    found = files.scan_catalogued(wanted, base, split_bytes=300)
    assert found.rdd.getNumPartitions() > 5
    assert {r.rc_ritem_no: None if r.content is None else bytes(r.content).decode() for r in found.collect()} == {r[2]: None if r[2] == "R7" else r[5] for r in rows if r[2] not in ("R1", "R2")}
    done = files.extract_files(found)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    by = {r.rc_ritem_no: r for r in done.collect()}
    assert by["R7"].extract_err_msg.startswith("FILE_NOT_FOUND") and by["R3"].extract_status == S.PASS and by["R0"].has_contents == "N"
    assert not (tmp_path / "store" / "_attempts").exists() or not list((tmp_path / "store" / "_attempts").iterdir())
    assert files.scan_catalogued(wanted.limit(0), base).count() == 0


def test_an_extraction_run_reads_only_what_is_wanted(spark, tmp_path):
    from foliary import schema as S
    from foliary.operators import selection as Q
    from foliary.plans import workflow
    from foliary.plans.standins import TABLES

    folder = tmp_path / "store" / "2023" / "F" / "R1"
    folder.mkdir(parents=True)
    (folder / "a_N01.txt").write_text("hello")
    catalog = spark.createDataFrame([("2023", "F", "R1", "m", 1, "2020", None, "a_N01.txt"), ("2023", "F", "R2", "m", 1, "2020", None, "b.txt"), ("2022", "F", "R3", "m", 1, "2020", None, "c.txt")], "transferyear string, rc_rfile_no string, rc_ritem_no string, mngno string, detno int, prodyear string, org_file_path string, save_file_name string")
    extracts = spark.sql(TABLES["extracts"].replace("{lineitem}", "(SELECT 1L AS l_orderkey, 1 AS l_linenumber, 'N' AS l_returnflag, 1L AS l_suppkey, 1L AS l_partkey, 1.0D AS l_extendedprice, 1.0D AS l_quantity, 0.0D AS l_tax, current_timestamp() AS l_shipdate)"))
    extra = {c: F.lit(None).cast("string") for c in ("contents", "img_datas", "extract_err_msg", "implement_org", "implement_date", "receipt_org", "receipt_date", "summary", "llm_summary_err_msg", "create_date")}
    after, made = workflow.extract_run(catalog, extracts.withColumns(extra), f"file://{tmp_path}/store", Q.Params())
    assert {(r.rc_ritem_no, r.extract_status, r.contents) for r in after.collect()} == {("R1", S.PASS, "hello"), ("R2", S.FAIL, None)} or {(r.rc_ritem_no, r.extract_status) for r in after.collect()} == {("R1", S.PASS), ("R2", S.FAIL)}
    assert made.count() == 2


def test_a_sink_leaves_one_file_a_path(spark, tmp_path):
    from foliary.sources import stored

    base = f"file://{tmp_path}/pictures"
    rows = spark.createDataFrame([(f"{base}/2023/a b/img{i % 5}.png", f"picture {i % 5}".encode(), i) for i in range(50)] + [(None, b"x", 1), (f"{base}/none.png", None, 1)], "path string, data binary, other int").repartition(8)
    for _ in range(2):  # again, as after a failure
        stored.put_files(rows, base)
    names = sorted(str(p.relative_to(tmp_path / "pictures")) for p in (tmp_path / "pictures").rglob("*") if p.is_file())
    assert names == [f"2023/a b/img{i}.png" for i in range(5)]
    assert (tmp_path / "pictures/2023/a b/img3.png").read_bytes() == b"picture 3"


@pytest.mark.parametrize("source", ["<div>" * 200_000 + "x", "<span>" * 200_000 + "x", "<p>" * 100_000 + "x" + "</li>" * 100_000, "<ul><li>" * 100_000 + "x"])
def test_pages_of_any_depth_give_rows(spark, source):
    from foliary.sources import files

    pages = spark.createDataFrame([(1, source), (2, "<p>a</p><p>b</p>"), (3, None)], "page_id int, html string")
    found = {r.page_id: r.text for r in files.page_text(pages).collect()}
    assert found[2] == "a\nb" and found[1].endswith("x") and found[3] == ""


def test_tables_within_tables_do_not_explode():
    from foliary.sources import parsers

    assert parsers.web_page(b"<table><tr><td>a</td><td><table><tr><td>b</td><td>c</td></tr></table></td></tr></table>").splitlines() == ["a | b | c", "b | c"]
    assert parsers.web_page(b"<table><tr><td>" * 60 + b"x").count("x") <= 60 * 2**parsers.MOST_TABLES


def test_a_page_that_cannot_be_read_is_a_row(spark, monkeypatch):
    from foliary.sources import parsers

    def broken(content):
        raise RecursionError("deep")

    assert parsers.extract("page.html", b"<p>x", known={"html": ("text/html", broken)})["code"] == "PARSE_FAILED"


def test_results_leave_a_worker_step_by_step(spark, monkeypatch):
    from foliary.operators import chunking
    from foliary.sources import files

    pages = spark.range(300).select(F.col("id").alias("page_id"), F.concat(F.lit("<p>Text "), "id", F.repeat(F.lit(" and more of it."), 600)).alias("html")).coalesce(1)
    whole = pages.selectExpr("page_id AS extract_idx", "'a.html' AS file_name", "CAST(NULL AS STRING) AS zip_entry_file_name", "html AS indexing_contents")
    batches = [b for b in pages.toArrow().combine_chunks().to_batches()]
    assert [b.num_rows for b in batches] == [300]
    steps = list(files.stepped(batches))
    assert len(steps) > 2 and max(b.get_total_buffer_size() if b.num_rows == 300 else b.nbytes for b in steps) <= 2 * files.STEP_BYTES
    assert [x for b in steps for x in b.column(0).to_pylist()] == list(range(300)) and list(files.stepped([batches[0].slice(0, 0)])) == []
    made = lambda: (sorted(files.page_text(pages).select("page_id", "text").collect()), sorted(chunking.chunk_documents(whole).collect(), key=str))
    stepwise = made()
    monkeypatch.setattr(files, "STEP_BYTES", 1 << 40)
    assert stepwise == made() and len(stepwise[0]) == 300


def test_thousands_of_small_files_share_a_split(spark, tmp_path):
    from foliary.sources import stored

    rows = spark.range(3000).select(F.concat(F.lit(f"{tmp_path}/none/"), "id").alias("path"), "id")
    found = stored.scanned(rows)
    assert found.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism and found.where("content IS NULL").count() == 3000


def passes(df):
    return df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")


def test_files_are_opened_and_parsed_in_one_pass_of_python(spark, tmp_path):
    from foliary.plans import catalog
    from foliary.sources import files

    talks = [(1, 1, "user", "hello \n"), (1, 2, None, None), (2, 1, "bot", " ")]
    spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    zipped = catalog.QUERIES["zip_expand"](spark, str(tmp_path))
    assert passes(zipped) == 1
    assert sorted(map(tuple, zipped.collect())) == [(1, 1, 1, "user.txt", "PASS", True), (1, 2, 1, "None.txt", "PASS", False), (2, 1, 1, "bot.txt", "PASS", False)]
    rows = spark.createDataFrame([("2023", "F", "R", "2020", n, c) for n, c in (("a.zip", archive([("x.txt", "x"), ("y.pdf", "no pdf")])), ("b.zip", b"no zip"), ("c.zip", archive([])), ("d.txt", b"d"), ("e.txt", None), ("f.zip", None))], "transferyear string, rc_rfile_no string, rc_ritem_no string, prodyear string, save_file_name string, content binary")
    done = files.extract_files(rows, images="/img")
    assert passes(done) == 1
    found = sorted((r.file_name, r.zip_seq, r.zip_entry_file_name, r.contents, r.extract_status, (r.extract_err_msg or "").partition(":")[0]) for r in done.collect())
    assert [f[:2] for f in found] == [("a.zip", 1), ("a.zip", 2), ("b.zip", 0), ("c.zip", 0), ("d.txt", 0), ("e.txt", 0), ("f.zip", 0)]
    assert [f[2:] for f in found[::4]] == [("x.txt", "x", "PASS", ""), (None, "d", "PASS", "")] and [f[5] for f in found[1:4] + found[5:]] == ["PDF_PARSE_FAILED", "ZIP_FAILED", "EMPTY_ZIP", "FILE_NOT_FOUND", "FILE_NOT_FOUND"]
    both = {(r.save_file_name, r.zip_seq): (r.entry_name, r.content, r.code) for r in files.expand_archives(rows).collect()}
    assert both["a.zip", 1] == ("x.txt", b"x", None) and both["d.txt", 0] == (None, b"d", None) and both["c.zip", 0] == (None, None, "EMPTY_ZIP") and len(both) == 7


def test_entries_of_one_archive_leave_the_worker_step_by_step():
    from foliary.sources import files

    size = files.STEP_BYTES // 2
    large = archive([(f"{i}.txt", "x" * size) for i in range(9)])
    batch = files.pa.RecordBatch.from_pydict({"id": [7, 8], "content": [large, None]})
    columns = [("n", "int", files.pa.int32()), ("content", "binary", files.pa.binary())]
    given = list(files.results(iter([batch]), ("id",), columns, ("content",), lambda c: ((e["seq"], e["content"]) for e in files.parsers.opened(c))))
    assert len(given) == 6 and max(b.nbytes for b in given) < files.STEP_BYTES * 1.1
    assert [(r["id"], r["n"], len(r["content"] or b"")) for b in given for r in b.to_pylist()] == [*((7, i, size) for i in range(1, 10)), (8, 0, 0)]


def test_pdf_files_are_written_and_read_in_one_pass_of_python(spark, tmp_path):
    from foliary.plans import catalog

    spark.createDataFrame([(1, 1, "user", "x"), (2, 1, "bot", None)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    done = catalog.QUERIES["pdf_text"](spark, str(tmp_path))
    assert passes(done) == 1
    assert sorted(map(tuple, done.collect())) == [(1, 1, "PASS", "Conversation 1\nTurn (1)\nby user"), (2, 1, "PASS", "Conversation 2\nTurn (1)\nby bot")]


def test_pdf_files_of_a_small_table_are_dealt_over_all_cores(spark, tmp_path):
    from foliary.plans import catalog

    spark.range(40).selectExpr("id AS conv_id", "id % 3 AS turn", "'user' AS role", "'x' AS text").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    found = catalog.QUERIES["pdf_text"](spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    assert len({r["task"] for r in found}) == spark.sparkContext.defaultParallelism
    assert sorted((r["conv_id"], r["turn"], r["status"], r["text"]) for r in found) == [(i, i % 3, "PASS", f"Conversation {i}\nTurn ({i % 3})\nby user") for i in range(40)]


def test_pages_take_only_what_is_kept_through_python(spark):
    from foliary.sources import files

    pages = spark.createDataFrame([(1, "u", "<p>a</p>"), (2, None, None)], "page_id long, url string, html string")
    assert sorted(map(tuple, files.page_text(pages).collect())) == [(1, "u", "<p>a</p>", "a"), (2, None, None, "")]
    kept = files.page_text(pages, keep=("page_id",))
    assert kept.columns == ["page_id", "text"] and sorted(map(tuple, kept.collect())) == [(1, "a"), (2, "")]
