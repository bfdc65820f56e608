"""Prompts, answers, rules, ledger, writes and reading order on small fixtures."""

import json
from pathlib import Path


import pytest
from pyspark.sql import functions as F

from foliary import schema as S
from foliary.operators import columns, ledger, merge, prompting, responses, rules
from foliary.plans import workflow


def values(spark, column, *rows, kind="string"):
    d = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r[1] for r in d.select("i", column(F.col("v"))).orderBy("i").collect()]


def test_render_in_order(spark):
    made = values(spark, lambda c: prompting.render('{{A}} ${A} {A} {B} {C}', {"A": c, "B": F.lit("b")}), 'x"\\\n', None, "{B}", "\x01")
    assert made == ['x\\"\\\\\\n x"\\\n x"\\\n b {C}', "   b {C}", "b b b b {C}", "\\u0001 \x01 \x01 b {C}"]
    assert prompting.mentions("a ${L}", "L") and not prompting.mentions("L", "L")


def answer(text):
    return json.dumps({"choices": [{"message": {"content": text}}]})


def test_envelopes(spark):
    wrapped = json.dumps({"response_data": {"choices": [{"text": " t "}]}})
    twice = "response_data: " + json.dumps({"response_data": json.dumps({"choices": [{"message": {"content": "deep"}}]})})
    found = values(spark, responses.message, answer(" a "), wrapped, twice, json.dumps({"choices": []}), "", None, '{"POLICY": "x"}')
    assert found == ["a", "t", "deep", None, None, None, '{"POLICY": "x"}']


def test_json_text(spark):
    texts = ['```json\n{"a": 1}\n```', 'so: [{"a": 1}] ok', 'x {"a": [1]} y', "none", '[1] {"a": 2}']
    assert values(spark, lambda c: responses.json_text(c, arrays=True), *texts) == ['{"a": 1}', '[{"a": 1}]', '{"a": [1]}', None, "[1]"]
    assert values(spark, responses.json_text, *texts)[1] == '{"a": 1}'


def test_department_answers(spark):
    row = {"후보 국정과제번호": 7, "DETAIL_TASK_NM": " ", "세부실천과제명": "과제", "매칭어": ["a", "b"], "판정값": {"no": 1}, "decisionValue": "직접"}
    d = spark.createDataFrame([(1, answer("prose [3, " + json.dumps(row, ensure_ascii=False) + "]"), None), (2, answer("{broken"), None), (3, None, "TimeoutError: 120")], "i int, response string, call_error string")
    a, b, c = responses.parse_departments(d).orderBy("i").collect()
    assert (a.error, a.gov_task_no, a.name, a.matching_terms, a.decision_value, a.code) == (None, "7", "과제", '["a","b"]', "직접", "")
    assert b.error.startswith("POLICY_DEPT") and b.name is None and c.error == "TimeoutError: 120"


def test_subject_run_isolates_failures(spark):
    items = spark.createDataFrame([("C", "F", f"R{i}", t) for i, t in enumerate(["ok", "fail", "제외"])], "rc_code string, rc_rfile_no string, rc_ritem_no string, jemok string").withColumns({c: F.lit(None).cast("string") for c in merge.RESULT_COLUMNS[S.POLICY]})

    def client():
        def send(body):
            title = json.loads(body)["messages"][1]["content"]
            if title == "fail":
                raise TimeoutError("t" * 300)
            return answer(json.dumps({"POLICY": title, "ITEM_CD": "I", "REASON": "why"}))

        return send

    after, _ = workflow.subject_run(items, items.union(items), "{JEMOK}", client, S.POLICY)
    a, b, c = after.orderBy("rc_ritem_no").collect()
    assert (a.policy_nm, a.llm_policy_status, a.llm_policy_err_msg) == ("ok", "PASS", None)
    assert (b.policy_nm, b.llm_policy_status, len(b.llm_policy_err_msg)) == (None, "FAIL", 100)
    assert (c.policy_nm, c.llm_policy_err_msg) == ("제외", "why")


def test_rules(spark):
    codes = spark.createDataFrame([("T1", "one", "대기오염측정망", "환경보건", "수질", "법", "임대"), ("T2", "two", "상수도", None, None, None, None)], "detail_task_cd string, detail_task_nm string, direct_mapping_terms string, conditional_mapping_terms string, expand_candidate_terms string, required_combine_terms string, block_terms string")
    titles = ["대기오염측정망 설치", "대기오염측정망 임대 계약", "환경보건 법 개정", "환경보건 회의", "수질 임대", "인사발령", "상수도 수질", None]
    items = spark.createDataFrame([("C", "F", str(i), "철", t) for i, t in enumerate(titles)], "rc_code string, rc_rfile_no string, rc_ritem_no string, bnd_ttl string, jemok string")
    found = [(r.decision, r.detail_task_cd) for r in rules.map_by_rules(items, codes).orderBy("rc_ritem_no").collect()]
    assert found == [("직접", "T1"), ("검토", "T1"), ("직접", "T1"), ("검토", "T1"), ("제외", "T1"), ("후보없음", None), ("직접", "T2"), ("후보없음", None)]


def test_ledger(spark):
    rows = [("a", 1, "RUNNING", 0), ("a", 2, "SUCCESS", 2), ("a", 3, "RUNNING", 9), ("b", 1, "RUNNING", 0), ("b", 4, "RUNNING", 5)]
    events = spark.createDataFrame(rows, "run_id string, at int, status string, loop_count int").withColumns({c: F.lit(0) for c in ("total_target_count", "total_success_count", "total_fail_count")}).withColumn("error_msg", F.lit(None).cast("string"))
    assert [(r.run_id, r.started_at, r.ended_at, r.status, r.loop_count) for r in ledger.run_states(events).orderBy("run_id").collect()] == [("a", 1, 2, "SUCCESS", 2), ("b", 1, None, "RUNNING", 5)]
    assert [ledger.final_status(*x) for x in ((True, 0), (True, 1), (False, 0), (True, 0, "e"))] == ["SUCCESS", "PARTIAL", "PARTIAL", "FAIL"]
    registry = ledger.Registry()
    key = registry.acquire(ledger.RunKey("POLICY_ALL", "POLICY", "2023", "2012"))
    registry.acquire(ledger.RunKey("EVENT_ALL", "EVENT", "2023"))
    with pytest.raises(ledger.RunConflict):
        registry.acquire(ledger.RunKey("SUBJECT_ALL", "ALL", "2023", "2012"))
    registry.release(key)
    registry.acquire(ledger.RunKey("POLICY_ALL", "POLICY", "2023"))


def test_upsert_keeps_summaries_and_letters(spark):
    old = spark.createDataFrame([(1, "f", "F", "R", 0, "old", "s", "org", "2020-01-01")], "idx long, file_name string, rc_rfile_no string, rc_ritem_no string, zip_seq int, contents string, summary string, implement_org string, implement_date string").withColumns({c: F.lit(None).cast("string") for c in ("receipt_org", "receipt_date")})
    new = spark.createDataFrame([(9, "f", "F", "R", 0, "new", " "), (8, "g", "F", "R", 0, "more", None)], "idx long, file_name string, rc_rfile_no string, rc_ritem_no string, zip_seq int, contents string, implement_org string")
    a, b = merge.upsert_extracts(old, new).orderBy("file_name").collect()
    assert (a.idx, a.contents, a.summary, a.implement_org, a.implement_date) == (1, "new", "s", "org", "2020-01-01")
    assert (b.idx, b.contents, b.summary) == (8, "more", None)


def test_reading_order(spark):
    runs = [("title", 100, 500, 0), ("l1", 0, 200, 20), ("r1", 320, 500, 21), ("l2", 0, 100, 30), ("more", 105, 200, 32), ("r2", 320, 500, 30), ("l3", 0, 200, 40), ("r3", 320, 500, 41), ("foot", 100, 500, 90), (" ", 0, 1, 5)]
    d = spark.createDataFrame([(1, 1, t, float(a), float(b), float(y), float(y + 8), 600.0) for t, a, b, y in runs], "doc_id int, page int, text string, min_x double, max_x double, min_y double, max_y double, page_width double")
    lines = columns.reading_order(d)
    assert [r.text for r in lines.orderBy("line").collect()] == ["title", "l1", "l2 more", "l3", "r1", "r2", "r3", "foot"]
    assert columns.page_text(lines).first().text == "title\nl1\nl2 more\nl3\nr1\nr2\nr3\nfoot\n"
    single = columns.reading_order(d.where("text <> 'r3'"))
    assert [r.text for r in single.orderBy("line").collect()] == ["title", "l1", "r1", "l2 more", "r2", "l3", "foot"]


def test_department_run(spark):
    items = spark.createDataFrame([("C", "F1", "R1", "환경부 과", None), ("C", "F1", "R2", "환경부 과", None), ("C", "F2", "R3", "환경부 과", None)], "rc_code string, rc_rfile_no string, rc_ritem_no string, all_org_nm string, policy_cd string").withColumns({c: F.lit(None).cast("string") for c in ("bnd_ttl", "jemok", "prodregdate", "prodyear", "policy_nm", "llm_policy_status", "llm_policy_err_msg")})
    catalog = spark.createDataFrame([("2023", f, r, "2012") for f, r in (("F1", "R1"), ("F1", "R2"), ("F2", "R3"))], "transferyear string, rc_rfile_no string, rc_ritem_no string, prodyear string")
    none = F.lit(None).cast("string")
    by_file = lambda t: t.select("rc_rfile_no", none.alias("error"), F.when(F.col("rc_rfile_no") == "F1", "P").alias("code"), F.lit("name").alias("name"))
    by_item = lambda t: t.select("rc_code", "rc_rfile_no", "rc_ritem_no", none.alias("error"), F.lit("").alias("code"), F.lit("").alias("name"), none.alias("reason"))
    from foliary.operators.selection import Params

    after, tally = workflow.department_run(items, catalog, ("환경부",), by_file, by_item, Params(prod_year="2012"))
    assert [(r.policy_cd, r.llm_policy_status) for r in after.orderBy("rc_ritem_no").collect()] == [("P", "PASS"), ("P", "PASS"), ("", "PASS")]
    assert {r.phase: r.total_target_count for r in tally.collect()} == {"file": 2, "item": 1}


def test_templates_name_only_their_variables(spark):
    import re

    from foliary.operators import prompting

    sets = {"summary": prompting.SUMMARY_VARIABLES, "policy_extract": prompting.POLICY_VARIABLES, "policy_extract_sample": prompting.POLICY_VARIABLES, "policy_extract_dept": prompting.DEPARTMENT_VARIABLES, "event_extract": prompting.SUBJECT_VARIABLES, "activity_extract": prompting.SUBJECT_VARIABLES}
    assert set(sets) == set(prompting.TEMPLATES) and [len(sets[n]) for n in ("summary", "policy_extract", "policy_extract_dept", "event_extract")] == [20, 11, 11, 9]
    for name, variables in sets.items():
        text = prompting.template(name)
        assert set(re.findall(r"\{(\w+)\}", text)) <= set(variables), name
        row = spark.range(1).select(prompting.render(text, {v: F.lit(f"<{v}>") for v in variables}).alias("t")).first()
        assert not re.search(r"\{\w+\}", row.t) and row.t.count("<RC_CODE>") == 1
    with pytest.raises(ValueError):
        prompting.template("other")


RESULTS = "rc_code string, rc_rfile_no string, rc_ritem_no string, status string, error_msg string"


def test_accounted_run_leaves_its_record(spark, tmp_path):
    from foliary import schema as S
    from foliary.operators import ledger
    from foliary.plans import workflow

    registry, key, path = ledger.Registry(), ledger.RunKey("POLICY_ALL", S.POLICY, "2023"), str(tmp_path / "ledger")
    results = spark.createDataFrame([("c", "f", "r1", "PASS", None), ("c", "f", "r2", "FAIL", "bad")], RESULTS)

    def work(run):
        with pytest.raises(ledger.RunConflict):
            registry.acquire(key)
        return results

    log = lambda r, run_id: ledger.item_log(r, run_id, S.POLICY)
    after = workflow.accounted(spark, registry, key, path, work, lambda r: r.where("status = 'PASS'"), log)
    assert [r.rc_ritem_no for r in after.collect()] == ["r1"]
    with pytest.raises(ZeroDivisionError):
        workflow.accounted(spark, registry, key, path, lambda run: 1 / 0, lambda r: r, log)
    states = {r.status: r for r in ledger.run_states(spark.read.parquet(f"{path}/runs")).collect()}
    assert set(states) == {S.PARTIAL, S.FAIL} and tuple(states[S.PARTIAL][c] for c in ("total_target_count", "total_success_count", "total_fail_count")) == (2, 1, 1)
    assert states[S.FAIL].error_msg.startswith("ZeroDivisionError") and spark.read.parquet(f"{path}/items").where("status = 'FAIL'").count() == 1
    registry.release(registry.acquire(key))


def test_a_log_that_cannot_be_written_only_warns(spark, tmp_path):
    from foliary import schema as S
    from foliary.operators import ledger
    from foliary.plans import workflow

    results = spark.createDataFrame([("c", "f", "r1", "PASS", None)], RESULTS)
    with pytest.warns(UserWarning, match="aren't recorded"):
        after = workflow.accounted(spark, ledger.Registry(), ledger.RunKey("POLICY_ALL", S.POLICY, "2023"), str(tmp_path), lambda run: results, lambda r: r, lambda r, run_id: 1 / 0)
    assert after.count() == 1


def counting(folder):
    """A client that leaves a line in a file of its own for each call."""

    def client():
        import os
        import uuid

        own = os.path.join(folder, uuid.uuid4().hex)

        def send(body):
            with open(own, "a") as f:
                f.write(body.replace("\n", " ") + "\n")
            if "bad" in body:
                raise TimeoutError("late")
            return json.dumps({"choices": [{"text": json.dumps({"ITEM_CD": "X", "POLICY": "ok"})}]})

        return send

    return client


def calls_in(folder):
    return [line for p in Path(folder).iterdir() for line in p.read_text().splitlines()]


def asked(spark, n=60):
    rows = [("C", "F", str(i), "ttl", ("bad " if i % 7 == 0 else "good ") + str(i), None, None, None, None) for i in range(n)]
    return spark.createDataFrame(rows, "rc_code string, rc_rfile_no string, rc_ritem_no string, bnd_ttl string, jemok string, policy_cd string, policy_nm string, llm_policy_status string, llm_policy_err_msg string")


def test_each_target_is_called_once_however_often_the_run_is_read_or_resumed(spark, tmp_path):
    from foliary import schema as S
    from foliary.operators import ledger, merge
    from foliary.plans import workflow

    folder, path, items, registry, key = tmp_path / "calls", str(tmp_path / "ledger"), asked(spark), ledger.Registry(), ledger.RunKey("POLICY_ALL", S.POLICY, "2023")
    folder.mkdir()
    work = lambda run: workflow.subject_answers(items.union(items), "{JEMOK}", counting(str(folder)), S.POLICY, journal=run.journal, after_slice=run.progress)
    log = lambda r, run_id: ledger.item_log(r.withColumnRenamed("error", "error_msg"), run_id, S.POLICY)
    runs = []

    def broken(results):
        runs.append(results)
        raise OSError("the driver is gone")

    with pytest.raises(OSError):
        workflow.accounted(spark, registry, key, path, work, broken, log)
    assert len(calls_in(folder)) == 60
    run_id = spark.read.parquet(f"{path}/runs").first()["run_id"]
    after = workflow.accounted(spark, registry, key, path, work, lambda r: merge.item_results(items, r, S.POLICY), log, run_id=run_id)
    assert {(r.llm_policy_status, r.n) for r in after.groupBy("llm_policy_status").agg(F.count("*").alias("n")).collect()} == {("PASS", 51), ("FAIL", 9)}
    after.write.format("noop").mode("overwrite").save()
    assert len(calls_in(folder)) == 60 and spark.read.parquet(f"{path}/items").count() == 60
    assert {(r.status, r.total_target_count, r.total_fail_count) for r in spark.read.parquet(f"{path}/runs").where("status = 'PARTIAL'").collect()} == {("PARTIAL", 60, 9)}


def test_a_journal_is_taken_up_after_the_slices_that_it_has(spark, tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    requests = spark.range(200).select(F.col("id").cast("string").alias("k"), F.concat(F.lit("call "), "id").alias("request"))

    def dies(done, every):
        if done == 3:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        responses.call_once(requests, ("k",), counting(str(folder)), str(tmp_path / "j"), calls_a_slice=25, after_slice=dies)
    before = len(calls_in(folder))
    assert 0 < before < 200
    found = responses.call_once(requests, ("k",), counting(str(folder)), str(tmp_path / "j"), calls_a_slice=25)
    assert found.count() == 200 and found.where("response IS NULL").count() == 0
    found.count()
    assert sorted(calls_in(folder)) == sorted(f"call {i}" for i in range(200))
    assert responses.call_once(requests.limit(0), ("k",), counting(str(folder)), str(tmp_path / "none")).count() == 0


def test_results_of_all_subjects_go_in_by_one_merge(spark):
    from foliary import schema as S
    from foliary.operators import merge

    columns = [c for s in S.SUBJECTS for c in merge.RESULT_COLUMNS[s]]
    items = spark.createDataFrame([("C", "F", str(i), *(f"old {c}" for c in columns)) for i in range(4)], "rc_code string, rc_rfile_no string, rc_ritem_no string, " + ", ".join(f"{c} string" for c in columns))
    rows = [(S.POLICY, "0", None, "P", "제외", "why"), (S.EVENT, "0", "x" * 600, None, None, None), (S.ACTIVITY, "1", None, "A", "name", "r"), (S.POLICY, "2", "failed", None, None, None), (S.EVENT, "9", None, "E", "n", "r")]
    results = spark.createDataFrame([(s, "C", "F", i, e, c, n, r) for s, i, e, c, n, r in rows], "subject string, rc_code string, rc_rfile_no string, rc_ritem_no string, error string, code string, name string, reason string")
    one = merge.subjects_results(items, results)
    each = items
    for s in S.SUBJECTS:
        each = merge.item_results(each, results.where(F.col("subject") == s), s)
    assert sorted(one.collect()) == sorted(each.collect()) and one._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_terms_are_met_inside_compound_words_as_contains_does(spark, monkeypatch):
    import random

    r = random.Random(7)
    words = ["환경", "보전", "계획", "대기", "수질", "a", "ab", "b c", "법"]
    dictionary = spark.createDataFrame([(f"T{i}", f"n{i}", ",".join({"".join(r.choices(words, k=r.randint(1, 3))) for _ in range(2)}), r.choice(words), r.choice(words), r.choice(words), r.choice(words)) for i in range(30)], "detail_task_cd string, detail_task_nm string, direct_mapping_terms string, conditional_mapping_terms string, expand_candidate_terms string, required_combine_terms string, block_terms string")
    items = spark.createDataFrame([("C", "F", str(i), None, "".join(r.choice(words) + r.choice(["", "", " "]) for _ in range(r.randrange(7)))) for i in range(150)], "rc_code string, rc_rfile_no string, rc_ritem_no string, bnd_ttl string, jemok string")
    each = dictionary.select(F.explode(rules.terms(F.col("direct_mapping_terms"))).alias("t")).distinct().select(F.xxhash64("t").alias("term_id"), F.col("t").alias("term"))
    pairs = {(i.rc_ritem_no, t.term_id) for i in items.collect() for t in each.collect() if t.term in i.jemok}
    for most in (200_000, 4):
        monkeypatch.setattr(rules, "MOST_TERMS", most)
        found = rules.met_terms(items, "jemok", each)
        assert {(x.rc_ritem_no, t) for x in found.collect() for t in x.met} == pairs
        decided = rules.map_by_rules(items, dictionary)
        best = {x.rc_ritem_no: x.decision for x in decided.collect()}
        assert len(best) == 150
        for i in items.collect():
            told = []
            for d in dictionary.collect():
                has = lambda c: any(t in i.jemok for t in c.split(","))
                if has(d.direct_mapping_terms):
                    told.append(1 if has(d.block_terms) else 0)
                if has(d.conditional_mapping_terms):
                    told.append(2 if has(d.block_terms) else 0 if has(d.required_combine_terms) else 1)
                if has(d.expand_candidate_terms):
                    told.append(2 if has(d.block_terms) else 1)
            assert best[i.rc_ritem_no] == (["직접", "검토", "제외"][min(told)] if told else "후보없음")
    assert "word" not in decided._jdf.queryExecution().optimizedPlan().toString()
    empty = dictionary.limit(0)
    assert {x.decision for x in rules.map_by_rules(items, empty).collect()} == {"후보없음"}


def test_published_tables_keep_a_version_for_their_readers(spark, tmp_path):
    from foliary.operators import merge

    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        merge.published(spark, path)
    merge.publish(spark, spark.range(3), path)
    first = merge.published(spark, path)
    merge.publish(spark, first.where("id > 0"), path)
    assert first.count() == 3 and merge.published(spark, path).count() == 2
    merge.publish(spark, spark.range(7), path)
    assert merge.published(spark, path).count() == 7


def test_a_journal_keeps_the_parts_of_a_slice_that_broke_off_and_has_few_slices(spark, tmp_path):
    folder, slices = tmp_path / "calls", []
    folder.mkdir()
    requests = spark.range(400).select(F.col("id").cast("string").alias("k"), F.concat(F.lit("call "), "id").alias("request"))
    plain, last = counting(str(folder)), tmp_path / "last"

    def dying():
        send = plain()

        def one(body):
            if body == "call 7" and not last.exists():
                import time

                time.sleep(3)
                raise KeyboardInterrupt  # the task, not the row
            return send(body)

        return one

    with pytest.raises(Exception):  # noqa: B017
        responses.call_once(requests, ("k",), dying, str(tmp_path / "j"), calls_a_slice=400)
    written = spark.read.schema("k string").parquet(str(tmp_path / "j/answers/slice=0")).count()
    assert 0 < written < 400
    kept = {line for line in calls_in(folder)}
    last.touch()
    found = responses.call_once(requests, ("k",), dying, str(tmp_path / "j"), calls_a_slice=400)
    assert sorted(r.request for r in found.collect()) == sorted(f"call {i}" for i in range(400)) and len(kept) < 400
    assert len(calls_in(folder)) <= 800 - written  # none of the parts that were there is called for again
    responses.call_once(requests, ("k",), plain, str(tmp_path / "many"), calls_a_slice=2, after_slice=lambda done, every: slices.append((done, every)))
    assert slices == [(i, responses.MOST_SLICES) for i in range(1, responses.MOST_SLICES + 1)]


def test_requests_are_made_for_the_rows_that_are_asked_about(spark):
    from foliary.plans import workflow

    rows = spark.createDataFrame([("a", "2", "x"), ("a", "1", "y"), ("b", None, "z"), ("b", "0", "w")], "k string, v string, w string")
    made = workflow.ask(rows, ("k",), F.lit("s"), F.concat_ws("/", "v", "w"), lambda: lambda body: json.loads(body)["messages"][1]["content"])
    assert sorted((r.k, r.response) for r in made.collect()) == [("a", "1/y"), ("b", "z")]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "temperature" in plan[: plan.index("Aggregate")]
