"""Tables in buckets, validity intervals, dictionaries of agencies and chunk markers against plain models."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from foliary import schema as S
from foliary.operators import chunking, keyed, merge
from foliary.operators import selection as Q

KINDS = ", ".join(f"{c} string" for c in ("rc_code", "rc_rfile_no", "rc_ritem_no", *(c for s in S.SUBJECTS for c in merge.RESULT_COLUMNS[s])))


def items(spark, n=200):
    return spark.createDataFrame([("C", f"F{i // 4}", f"R{i}", *[None] * 12) for i in range(n)], KINDS)


def files_of(path):
    return {str(p.relative_to(path)): p.read_bytes() for p in Path(path).rglob("*.parquet")}


def test_a_merge_reads_and_writes_touched_buckets_alone(spark, tmp_path):
    path, table = str(tmp_path / "items"), items(spark)
    kept = keyed.KeyedTable(spark, path, table.schema, "rc_rfile_no", 16).create(table)
    before = files_of(path)
    results = spark.createDataFrame([("C", "F3", "R13", None, "P", "name", None), ("C", "F3", "R14", "failed", None, None, None), ("C", "F99", "R0", None, "P", "no such item", None)], "rc_code string, rc_rfile_no string, rc_ritem_no string, error string, code string, name string, reason string")
    how = lambda old, new, flag: merge.item_results(old, new, S.POLICY, flag=flag)
    written = kept.merge(results, how)
    assert len(written) == 1
    after = files_of(path)
    own = f"__bucket={written[0]}/"
    assert {k: v for k, v in before.items() if not k.startswith(own)} == {k: v for k, v in after.items() if not k.startswith(own)} and len(before) > 8
    assert {k for k in before if k.startswith(own)} != {k for k in after if k.startswith(own)}
    assert sorted(kept.read().collect(), key=str) == sorted(merge.item_results(table, results, S.POLICY).collect(), key=str)
    assert kept.merge(results, how) == [] and files_of(path) == after  # again, as after a crash: nothing is another row
    assert kept.merge(results.limit(0), how) == [] and files_of(path) == after


def test_a_merge_prunes_the_scan(spark, tmp_path):
    table = items(spark)
    kept = keyed.KeyedTable(spark, str(tmp_path / "t"), table.schema, "rc_rfile_no", 8).create(table)
    plans = []

    def how(old, new, flag):
        plans.append(old._jdf.queryExecution().executedPlan().toString())
        return merge.item_results(old, new, S.POLICY, flag=flag)

    kept.merge(spark.createDataFrame([("C", "F1", "R4", None, "P", "n", None)], "rc_code string, rc_rfile_no string, rc_ritem_no string, error string, code string, name string, reason string"), how)
    assert "PartitionFilters: [isnotnull(__bucket" in plans[0] or "PartitionFilters: [(__bucket" in plans[0]


def test_inserts_nulls_and_whole_files_go_to_their_buckets(spark, tmp_path):
    table = items(spark, 40)
    kept = keyed.KeyedTable(spark, str(tmp_path / "t"), table.schema, "rc_rfile_no", 8).create(table)
    decided = spark.createDataFrame([("F2", "P", "whole"), ("F7", "P", "whole")], "rc_rfile_no string, code string, name string")
    assert 1 <= len(kept.merge(decided, merge.propagate_files)) <= 2
    assert kept.read().where("policy_nm = 'whole'").count() == 8
    new = spark.createDataFrame([("C", None, "RX", *["v"] * 12), ("C", "F2", "R8", *["w"] * 12)], KINDS)
    upsert = lambda old, changes, flag: merge.merged(old, changes, S.ITEM_KEY, flag=flag)
    assert len(kept.merge(new, upsert)) == 2 and kept.merge(new, upsert) == []
    assert kept.read().count() == 41 and kept.read().where("rc_rfile_no IS NULL AND policy_cd = 'v'").count() == 1


def test_flags_tell_rows_that_differ(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(1, "a", None), (2, "B", "x"), (4, "d", None)], "k int, v string, w string")
    found = {r.k: r.f for r in merge.merged(old, new, ("k",), flag="f").collect()}
    assert found == {1: False, 2: True, 3: False, 4: True}
    assert {r.k: r.f for r in merge.merged(old, new, ("k",), keep=("v",), flag="f").collect()} == {1: False, 2: False, 3: False, 4: True}


def norm(s):
    return s.replace("-", "").replace(".", "").replace("/", "").replace(" ", "")[:8]


def test_codes_in_force_equal_a_plain_filter(spark):
    r = random.Random(9)
    day = lambda: r.choice([f"{r.randint(1990, 2005)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}", f"{r.randint(1990, 2005)}.{r.randint(1, 12):02d}.01", "", "x", "1999", None])
    codes = [(r.choice(["POLICY", "EVENT", None]), f"I{i}", day(), day(), r.choice([None, "1990", str(r.randint(1990, 2005))]), r.choice([None, str(r.randint(1990, 2010)), "z"])) for i in range(120)]
    keys = list({(r.choice(["POLICY", "EVENT", "OTHER", None]), r.choice(["", None, f"{r.randint(1989, 2006)}{r.randint(1, 12):02d}{r.randint(1, 28):02d}", "199", "x y"]), r.choice(["", None, str(r.randint(1989, 2006)), "zz"])) for _ in range(300)})
    table = spark.createDataFrame(codes, "cls_cd string, item_cd string, tern_start string, tern_end string, start_year string, end_year string")
    found = Q.candidates(table, spark.createDataFrame(keys + keys[:9], "cls_cd string, production_date string, production_year string"))

    def holds(key, code):
        if key[0] is None or key[0] != code[0]:
            return False
        if key[1]:
            return code[2] is not None and code[3] is not None and norm(code[2]) <= norm(key[1]) <= norm(code[3])
        return bool(key[2]) and code[4] is not None and code[5] is not None and code[4] <= key[2] <= code[5]

    want = sorted(((*k, c[1]) for k in keys for c in codes if holds(k, c)), key=str)
    assert sorted(((x.cls_cd, x.production_date, x.production_year, x.item_cd) for x in found.collect()), key=str) == want and want
    assert found.count() == sum(holds(k, c) for k in keys for c in codes)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_each_agency_has_its_own_dictionary(spark):
    names = ["환경부", "환경부 자연보전국", "복지부", "환", None, ""]
    codes = spark.createDataFrame([("POLICY", "LMB", f"T{i}", n) for i, n in enumerate(names)] + [("EVENT", "LMB", "E", "환경부"), ("POLICY", "NMH", "N", "환경부")], "cls_cd string, prev_gov_cd string, detail_task_cd string, lead_agency string")
    codes = codes.withColumns({c: F.lit(None).cast("string") for c in Q.DICTIONARY_COLUMNS if c not in codes.columns})
    agencies = ["환경부", "복지부", "환", "없음", None, ""]
    found = Q.dictionaries(codes, spark.createDataFrame([(a,) for a in agencies * 2], "agency string")).collect()
    want = sorted((a, f"T{i}") for a in agencies if a is not None for i, n in enumerate(names) if n is not None and n.startswith(a))
    assert sorted((x.agency, x.detail_task_cd) for x in found) == want
    assert Q.dictionaries(codes, spark.createDataFrame([], "agency string")).count() == 0


def test_the_chunker_marks_what_has_no_chunks(spark):
    texts = [None, "", " \n ", "목차", "Some text that is long enough to stand for itself. " * 20]
    docs = spark.createDataFrame([(i, "a.hwp", None, t) for i, t in enumerate(texts)], "extract_idx int, file_name string, zip_entry_file_name string, indexing_contents string")
    plain, marked = chunking.chunk_documents(docs), chunking.chunk_documents(docs, marker=True)
    assert plain.columns == marked.columns
    real = lambda rows: sorted((x for x in rows.collect() if x.chunk_seq > 0), key=str)
    assert real(plain) == real(marked)
    without = {x.extract_idx for x in docs.collect()} - {x.extract_idx for x in plain.collect()}
    assert {(x.extract_idx, x.chunk_text, x.chunk_status, x.doc_role, x.doc_type, x.char_count, x.token_count) for x in marked.where("chunk_seq = 0").collect()} == {(i, "No content to split", "SKIP", "UNKNOWN", "SKIP", 0, 0) for i in without} and without
    old = spark.createDataFrame([(i, 1, "old", "READY") for i in range(9)], "extract_idx int, chunk_seq int, chunk_text string, chunk_status string")
    one, two = merge.replace_chunks(old, marked, docs, marked=True), merge.replace_chunks(old, plain, docs)
    assert sorted(one.collect()) == sorted(two.collect())
    assert one._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


@pytest.mark.parametrize("n", [1, 2, 7])
def test_stretches_cover_each_pair_once(spark, n):
    codes = spark.createDataFrame([("E", f"{a}-{z}", None, None, str(2000 + a), str(2000 + z)) for a in range(n) for z in range(a, n)], "cls_cd string, item_cd string, tern_start string, tern_end string, start_year string, end_year string")
    keys = spark.createDataFrame([("E", "", str(2000 + i)) for i in range(n)], "cls_cd string, production_date string, production_year string")
    found = sorted((x.production_year, x.item_cd) for x in Q.candidates(codes, keys).collect())
    assert found == sorted((str(2000 + i), f"{a}-{z}") for a in range(n) for z in range(a, n) for i in range(a, z + 1))


@pytest.mark.parametrize("most", [1, 1 << 26])
def test_a_list_is_made_once_for_all_keys_between_two_bounds(spark, monkeypatch, most):
    import json

    text = lambda i: {"prev_gov_cd": f"g{i % 2}", "sub_cls_cd": "s", "topic_cd": None if i == 1 else "t", "sub_cls_nm": None, "topic_nm": f'"{i}"', "prev_gov_nm": "n", "description": "d"}
    bounds = [("19950101", "1995-06-30", "1995", "1996"), ("19950301", "1995-06-30", "1996", "1996"), ("-", "19950101", None, None), ("19950301", "19950101", "1997", "1996")]
    codes = [{"cls_cd": "EVENT", "item_cd": f"I{i}", "tern_start": b[0], "tern_end": b[1], "start_year": b[2], "end_year": b[3]} | text(i) for i, b in enumerate(bounds)]
    table = spark.createDataFrame([tuple(c.values()) for c in codes], ", ".join(f"{c} string" for c in codes[0]))
    keys = [("EVENT", f"1995{m:02d}{d:02d}", y) for m in range(1, 8) for d in range(1, 29) for y in ("1995", None)] + [("EVENT", x, y) for x in ("", None) for y in ("1995", "1996", "1999")] + [("EVENT", "-", "1995"), ("POLICY", "19950301", "")]
    asked, plain = [], Q.candidates
    monkeypatch.setattr(Q, "candidates", lambda c, k: asked.append(k) or plain(c, k))
    monkeypatch.setattr(Q, "LIST_BYTES", most)
    listed = Q.candidate_lists(table, spark.createDataFrame(keys, "cls_cd string, production_date string, production_year string"))
    found = {(x.cls_cd, x.production_date, x.production_year): [o["ITEM_CD"] for o in json.loads(x.candidates)] for x in listed.collect()}
    want = {}
    order = {c["item_cd"]: (c["prev_gov_cd"], c["topic_cd"] or "", c["item_cd"]) for c in codes}
    for x in plain(table, spark.createDataFrame(keys, "cls_cd string, production_date string, production_year string")).collect():
        want.setdefault((x.cls_cd, x.production_date, x.production_year), []).append(x.item_cd)
    assert found == {k: sorted(v, key=order.get) for k, v in want.items()} and listed.count() == len(want) > 300
    assert asked[0].distinct().count() <= 2 * len(codes) * 2
