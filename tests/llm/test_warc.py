"""WARC archives: round trips against a plain model, the order of the index, the loser tree, and what broken records give."""

import base64
import gzip
import hashlib
import random
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from foliary.llm import frames, warc

SCHEMA = "page_id long, url string, html string"


def model(rows, least=0):
    """(page_id, bytes, digest, type, refers_to) of each row; of rows that repeat the least id and a payload one is the response."""
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[html or ""].append(page_id)
    out = []
    for html, ids in groups.items():
        raw = html.encode()
        told = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        for k, i in enumerate(ids):
            out.append((i, *told, "response", None) if not k or len(raw) < least else (i, *told, "revisit", ids[0]))
    return sorted(out, key=str)


def found(spark, path, captures=None):
    rows = warc.read_archives(captures if captures is not None else warc.index(spark, path), path).collect()
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    hosts = ["a.example.org", "B.example.org:8080", "example.org", "zz.net"]
    out = [(i, f"https://{r.choice(hosts)}/p/{r.randrange(40)}?q={r.randrange(3)}#x", r.choice(["<p>same</p>", "", None, f"<p>own {i} é中😀</p>", "x" * r.randrange(5)])) for i in range(300)]
    return out + [(400, None, "<p>no url</p>"), (401, "", "a\r\n\r\nb"), (402, "not a url \r\nWARC-Type: x é", "WARC/1.1\r\n\r\n"), (403, "http://h/", "long " * 400_000), (404, "http://h/", "long " * 400_000)]


def test_round_trip_equals_a_plain_model(spark, rows, tmp_path):
    pages = spark.createDataFrame(rows, SCHEMA).repartition(5)
    warc.write_archives(pages, f"file://{tmp_path}/w")
    assert found(spark, f"file://{tmp_path}/w") == model(rows)
    texts = {r["page_id"]: r["payload"] for r in warc.read_archives(warc.index(spark, f"file://{tmp_path}/w"), f"file://{tmp_path}/w", payloads=True).collect()}
    kinds = {m[0]: m[3] for m in model(rows)}
    assert all(texts[i] == ((html or "").encode() if kinds[i] == "response" else None) for i, _, html in rows)


def test_archives_are_gzip_members_that_any_reader_takes(spark, rows, tmp_path):
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(3), f"file://{tmp_path}/w")
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(tmp_path, "w", "archives").glob("*.warc.gz")))
    heads = raw.count(b"WARC/1.1\r\nWARC-Type: ")
    assert heads == len(rows) and raw.count(b"WARC-Type: revisit\r\n") == sum(m[3] == "revisit" for m in model(rows))
    names = [line for line in raw.split(b"\r\n") if line.startswith(b"WARC-Record-ID: ")]
    assert len(names) == len(set(names)) == len(rows)


def test_small_payloads_are_all_responses_and_dates_order_captures(spark, tmp_path):
    rows = [(i, "http://h/a", "tiny" if i % 2 else "long enough", f"20{20 - i:02d}-01-01T00:00:00Z") for i in range(10)]
    pages = spark.createDataFrame(rows, SCHEMA + ", at string")
    warc.write_archives(pages, f"file://{tmp_path}/w", date="at", least_bytes=5)
    assert found(spark, f"file://{tmp_path}/w") == model([r[:3] for r in rows], 5)
    assert [r["page_id"] for r in warc.history(spark, f"file://{tmp_path}/w", "HTTPS://H/a#frag").collect()] == list(range(9, -1, -1))


@pytest.mark.parametrize("merge_rows,run_rows", [(1 << 17, 1 << 17), (20, 7)])
def test_index_is_ordered_as_a_whole(spark, rows, tmp_path, monkeypatch, merge_rows, run_rows):
    monkeypatch.setattr(warc, "MERGE_ROWS", merge_rows)
    monkeypatch.setattr(warc, "RUN_ROWS", run_rows)
    pages = spark.createDataFrame(rows, SCHEMA).repartition(7)
    path = f"file://{tmp_path}/w"
    warc.write_archives(pages, path)
    parts = sorted(Path(tmp_path, "w", "index").glob("part-*.parquet"))
    order = [(r["urlkey"] is not None, r["urlkey"] or "", r["date"], r["page_id"]) for p in parts for r in spark.read.parquet(str(p)).collect()]
    assert len(order) == len(rows) and order == sorted(order)
    assert merge_rows > 20 or len(parts) > 5
    keys = {r["page_id"]: r["k"] for r in spark.createDataFrame(rows, SCHEMA).select("page_id", warc.url_key(F.col("url")).alias("k")).collect()}
    assert sorted(o[1:] for o in order) == sorted((keys[i] or "", warc.CAPTURED, i) for i, *_ in rows)
    assert keys[403] == "h)/" and any(k and k.startswith("org,example,b):8080/p/") for k in keys.values())


@pytest.mark.parametrize("k", [1, 2, 3, 5, 8, 13])
def test_loser_tree_equals_a_stable_sort(k):
    r = random.Random(k)
    runs = [sorted(r.choices(range(20), k=r.randrange(12))) for _ in range(k)]
    merged = list(warc.LoserTree(runs))
    assert merged == sorted(((i, j) for i, run in enumerate(runs) for j in range(len(run))), key=lambda x: (runs[x[0]][x[1]], *x))
    assert list(warc.LoserTree([])) == []


def test_a_tree_compares_once_a_level():
    calls = 0

    class Key(int):
        def __lt__(self, other):
            nonlocal calls
            calls += 1
            return int(self) < int(other)

    runs = [[Key(j * 64 + i) for j in range(50)] for i in range(64)]
    assert len(list(warc.LoserTree(runs))) == 3200 and calls <= 2 * 3200 * 6 + 200
    assert warc.ascending_runs([3, 4, 4, 1, 2, 0]) == [(0, 3), (3, 5), (5, 6)] and warc.ascending_runs([]) == []


def test_repeated_rows_null_ids_and_clashing_columns(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(frames, "BROADCAST_ROWS", 2)
    rows = [(1, "u", "same")] * 5 + [(1, None, "same"), (2, "u", "same"), (None, "u", "same"), (None, "u", "none"), (None, "v", "none"), (7, "u", "alone"), (7, "u", "other")] + [(i, "u", f"pair {i // 2}") for i in range(10, 40)]
    pages = spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA + ", key string, size long, payload string")
    warc.write_archives(pages, f"file://{tmp_path}/w")
    got = found(spark, f"file://{tmp_path}/w")
    assert got == model(rows)
    assert sum(r[3] == "response" for r in got if r[1] == 4 and r[0] in (1, 2)) == 1


def test_no_rows(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}/w")
    assert found(spark, f"file://{tmp_path}/w") == []


def test_string_ids_and_odd_ones(spark, tmp_path):
    rows = [("b~:>\r\n", "u", "same"), ("a", "u", "same"), ("", "u", "x"), ("~", "u", "y")]
    warc.write_archives(spark.createDataFrame(rows, "page_id string, url string, html string"), f"file://{tmp_path}/w")
    got = {r[0]: r[3:] for r in found(spark, f"file://{tmp_path}/w")}
    assert got == {"a": ("response", None), "b~:>\r\n": ("revisit", "a"), "": ("response", None), "~": ("response", None)}


def test_what_attempts_that_failed_have_left_is_in_no_index(spark, rows, tmp_path):
    path = f"file://{tmp_path}/w"
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), path)
    Path(tmp_path, "w", "archives", "orphan.warc.gz").write_bytes(b"half a rec")
    assert found(spark, path) == model(rows)


def test_damaged_records_are_told():
    raw = warc.record(1, "http://h/", warc.CAPTURED, "response", None, hashlib.sha1(b"abc").hexdigest(), 3, b"abc", "")
    assert warc.parse_record(warc.packed(raw))["payload"] == b"abc"
    for broken in (raw.replace(b"abc", b"abd"), raw.replace(b"WARC/1.1", b"HTTP/1.1"), raw[:-5]):
        with pytest.raises(ValueError):
            warc.parse_record(warc.packed(broken))
