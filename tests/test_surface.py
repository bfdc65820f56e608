"""Endpoints, shared runs, logs of departments and the functions of the SQL surface."""

import http.server
import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from foliary import schema as S
from foliary.functions import registered
from foliary.functions import text as X
from foliary.operators import chunking, endpoints, ledger, responses
from foliary.plans import workflow
from foliary.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


class _Server(http.server.BaseHTTPRequestHandler):
    def do_POST(self):
        body = self.rfile.read(int(self.headers["Content-Length"])).decode()
        kind = self.path.strip("/")
        if kind == "slow":
            time.sleep(3)
        self.send_response(500 if kind == "dead" else 200)
        self.end_headers()
        self.wfile.write(json.dumps({"from": kind, "asked": body}).encode())

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def server():
    own = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Server)
    threading.Thread(target=own.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{own.server_port}"
    own.shutdown()


def test_calls_pass_from_slow_and_dead_endpoints_to_a_live_one(spark, server):
    makers = [endpoints.http_client(f"{server}/{k}", timeout=20) for k in ("dead", "live", "slow")]
    requests = spark.range(40).select("id", F.concat(F.lit("call "), "id").alias("request")).coalesce(2)
    began = time.time()
    found = responses.call(requests, endpoints.pooled(makers, in_flight=8, timeout=0.5, dead_after=2), in_flight=8).collect()
    assert time.time() - began < 30 and [r.id for r in found[:20]] == sorted(r.id for r in found[:20])
    assert all(r.call_error is None and json.loads(r.response) == {"from": "live", "asked": f"call {r.id}"} for r in found) and len(found) == 40


def test_a_call_fails_where_all_endpoints_have(spark, server):
    makers = [endpoints.http_client(f"{server}/dead"), endpoints.http_client("http://127.0.0.1:1/")]
    row = responses.call(spark.range(1).select(F.lit("x").alias("request")), endpoints.pooled(makers, timeout=5)).first()
    assert row.response is None and "HTTPError" in row.call_error and "URLError" in row.call_error
    with pytest.raises(ValueError):
        endpoints.pooled([])


def test_a_late_answer_counts_while_others_are_asked():
    def after(seconds, answer):
        def send(body):
            time.sleep(seconds)
            if answer is None:
                raise OSError("down")
            return answer

        return lambda: send

    pool = endpoints.pooled([after(0.6, "late"), after(5, "slow"), after(0, None)], in_flight=1, timeout=0.4)()
    assert pool("x") == "late" and pool.failures[0] == 1
    began = time.time()
    with pytest.raises(ConnectionError, match="no answer in 0.2 s; OSError: down"):
        endpoints.pooled([after(3, "slow"), after(0, None)], in_flight=1, timeout=0.2)()("x")
    assert time.time() - began < 2


def test_calls_go_round():
    asked = []
    pool = endpoints.pooled([lambda i=i: lambda body: asked.append(i) or body for i in range(3)], in_flight=1)()
    assert [pool(str(i)) for i in range(6)] == [str(i) for i in range(6)] and asked == [0, 1, 2, 0, 1, 2]
    assert endpoints.policy_pool(["a", " ", "b", "a"], every=True) == ["a", "b"] and endpoints.policy_pool(["", "b"], " own ") == ["own"] and endpoints.policy_pool([None, "b"]) == ["b"]


def test_runs_of_several_drivers_exclude_each_other(spark, tmp_path):
    one, two = (ledger.SharedRegistry(spark, str(tmp_path)) for _ in range(2))
    key = ledger.RunKey("POLICY_ALL", S.POLICY, "2023")
    one.acquire(key)
    for other in (key, ledger.RunKey("SUBJECT_ALL", S.ALL, "2023", "2012"), ledger.RunKey("POLICY_ALL", S.POLICY, "2023", "2011")):
        with pytest.raises(ledger.RunConflict):
            two.acquire(other)
    free = ledger.RunKey("EVENT_ALL", S.EVENT, "2023")
    two.acquire(free)
    one.renew(key)
    one.release(key)
    two.acquire(key)
    two.release(key)
    two.release(free)
    lost = ledger.SharedRegistry(spark, str(tmp_path))
    lost.acquire(key)  # its driver is gone
    time.sleep(2)
    assert ledger.SharedRegistry(spark, str(tmp_path), stale=1).acquire(key) == key
    results = spark.createDataFrame([("PASS",)], "status string")
    run = ledger.SharedRegistry(spark, str(tmp_path / "other"))
    assert workflow.accounted(spark, run, key, str(tmp_path / "other"), lambda _: results, lambda r: r).count() == 1 and not run.own


def test_logs_of_a_department_run(spark):
    items = spark.createDataFrame([("C", f, i, "t", "j", "환경부 x", "2012", "2012", None, None, None, None) for f, i in (("F1", "1"), ("F1", "2"), ("F2", "3"), ("F3", "4"))], "rc_code string, rc_rfile_no string, rc_ritem_no string, bnd_ttl string, jemok string, all_org_nm string, prodregdate string, prodyear string, policy_cd string, policy_nm string, llm_policy_status string, llm_policy_err_msg string")
    catalog = spark.createDataFrame([("2023", f, i, "2012") for f, i in (("F1", "1"), ("F1", "2"), ("F2", "3"), ("F3", "4"))], "transferyear string, rc_rfile_no string, rc_ritem_no string, prodyear string")
    kind = F.col("rc_rfile_no")
    files = lambda rows: rows.select("rc_rfile_no", F.when(kind == "F3", "broken").alias("error"), F.when(kind == "F1", "P").alias("code"), F.when(kind == "F1", "whole").alias("name"), F.lit("terms").alias("matching_terms"))
    own = lambda rows: rows.select(*S.ITEM_KEY, F.lit(None).cast("string").alias("error"), F.lit("").alias("code"), F.lit("").alias("name"), F.lit("").alias("reason"))
    from foliary.operators.selection import Params

    after, tally, log = workflow.department_steps(items, catalog, ("환경부",), files, own, Params(prod_year="2012"), "r")
    found = {(r.subject_type, r.rc_rfile_no, r.rc_ritem_no, r.status, r.matching_terms, r.error_msg) for r in log.collect()}
    file, item = "POLICY_DEPT_FILE", "POLICY_DEPT"
    assert found == {(file, "F1", "1", "PASS", "terms", None), (file, "F1", "2", "PASS", "terms", None), (file, "F2", None, "PASS", "terms", None), (file, "F3", None, "FAIL", "terms", "broken"), (item, "F2", "3", "PASS", None, None), (item, "F3", "4", "PASS", None, None)}
    assert {(r.rc_ritem_no, r.policy_cd, r.llm_policy_status) for r in after.collect()} == {("1", "P", "PASS"), ("2", "P", "PASS"), ("3", "", "PASS"), ("4", "", "PASS")}


def test_functions_in_sql_equal_the_column_forms(spark):
    registered.register(spark)
    odd = [None, "", " ", "a_N01.hwp", "x.PDF", "trailing.", "2012-03-04", "2012.", "2012", "y1999", "환경부 자연", " 복지부", "보건복지부", "가나 다 abc_1 9", "\x00\x1f a b", "a.b.TXT", "12/34", "한글만", "…"]
    table = spark.createDataFrame([(t,) for t in odd], "c string")
    forms = {"extension": X.extension, "file_type": X.file_type, "production_date": X.production_date, "production_year": X.production_year, "term_date": X.term_date, "first_token": X.first_token, "lead_agency": X.lead_agency, "token_estimate": X.token_estimate}
    assert {f"foliary_{k}" for k in forms} == set(registered.SCALARS)
    found = table.select("c", *[F.expr(f"foliary_{k}(c)").alias(k) for k in forms], *[f(F.col("c")).alias(f"{k}_own") for k, f in forms.items()])
    for r in found.collect():
        for k in forms:
            assert r[k] == r[f"{k}_own"], (k, r["c"])
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_chunks_in_sql_equal_the_data_frame_form(spark):
    sql = QUERIES["sql_chunks"](spark, SF)
    from foliary.plans.standins import frame

    docs = frame(spark, SF, "doc_extracts").withColumnRenamed("idx", "extract_idx")
    own = chunking.chunk_documents(docs).select(*sql.columns)
    assert sorted(sql.collect()) == sorted(own.collect()) and sql.count() > 100


def test_entries_of_answers(spark):
    registered.register(spark)
    answers = [None, "", "no json", "[1, {\"a\": 1, \"b\": null, \"c\": [true, \"é\"]}, {\"a\": \"x\"}]", "{\"k\": 2.5}"]
    spark.createDataFrame(list(enumerate(answers)), "i int, answer string").createOrReplaceTempView("answers_of_a_test")
    found = {tuple(r) for r in spark.sql("SELECT i, e.* FROM answers_of_a_test, LATERAL foliary_entries(answer) e").collect()}
    assert found == {(3, 2, "a", "1"), (3, 2, "b", None), (3, 2, "c", '[true, "é"]'), (3, 3, "a", "x"), (4, 1, "k", "2.5")}


def test_keys_compare_under_a_collation(spark):
    from foliary.operators import merge
    from foliary.operators import selection as Q

    one = spark.createDataFrame([("A.hwp ", 1), ("b", 2), (None, 3)], "k string, v int")
    two = spark.createDataFrame([("a.HWP", 9), ("B  ", 8), ("c", 7)], "k string, v int")
    met = lambda x, y: {(r[0], r[1]) for r in x.join(y.withColumnRenamed("v", "w"), "k").select("v", "w").collect()}
    assert met(one, two) == set() and met(Q.collated(one), Q.collated(two)) == {(1, 9), (2, 8)}
    after = Q.plain(merge.merged(Q.collated(one), Q.collated(two), ("k",)))
    assert sorted((r.v for r in after.collect())) == [3, 7, 8, 9] and after.schema["k"].dataType.simpleString() == "string"
    assert Q.collated(one.union(two), "k").groupBy("k").count().count() == 4
