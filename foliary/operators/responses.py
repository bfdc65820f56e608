"""Answers of language models: calls through a pluggable client, and their reading as Column expressions. Nothing here fails a run: what
can't be read is a row with an error."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliary import schema as S
from foliary.functions.text import blank_to_null, cut, let, null_to_blank, trimmed
from foliary.sources import shared

#: Names under which a department answer gives its fields.
DEPARTMENT_FIELDS = {
    "name": ("DETAIL_TASK_NM", "detailTaskNm", "후보세부실천과제", "후보 세부실천과제", "후보 이행실천과제", "세부실천과제명", "이행실천과제명"),
    "code": ("DETAIL_TASK_CD", "detailTaskCd", "세부실천과제코드", "이행실천과제코드"),
    "reason": ("REASON", "reason", "판단근거", "판정근거", "매칭사유", "검토·제외 사유"),
    "gov_task_no": ("후보 국정과제번호", "국정과제번호", "GOV_TASK_NO", "govTaskNo"),
    "gov_task_nm": ("후보국정과제", "후보 국정과제", "GOV_TASK_NM", "govTaskNm"),
    "detail_task_nm": ("후보세부실천과제", "후보 세부실천과제", "후보 이행실천과제", "DETAIL_TASK_NM", "detailTaskNm"),
    "detail_task_cd": ("세부실천과제코드", "이행실천과제코드", "DETAIL_TASK_CD", "detailTaskCd"),
    "matching_terms": ("매칭어",),
    "matching_source": ("매칭어출처", "매칭어 출처", "matchingSource"),
    "criteria_type": ("기준어유형", "기준어 유형", "criteriaType"),
    "decision_value": ("판정값", "decisionValue"),
    "decision_reason": ("판단근거", "판정근거", "reason"),
    "review_exclude_reason": ("검토·제외사유", "검토·제외 사유", "reviewExcludeReason"),
}
SUBJECT_FIELDS = {
    S.POLICY: {"code": ("ITEM_CD",), "name": ("POLICY",), "reason": ("REASON",)},
    S.EVENT: {"code": ("item_cd", "ITEM_CD"), "name": ("event_name", "EVENT_NAME"), "reason": ("reason", "REASON")},
    S.ACTIVITY: {"code": ("item_cd", "ITEM_CD"), "name": ("activity_name", "ACTIVITY_NAME"), "reason": ("reason", "REASON")},
}

Client = Callable[[str], str]


def call(requests: DataFrame, client: Callable[[], Client], *, request: str = "request", workers: int | None = None, in_flight: int = 1) -> DataFrame:
    """requests with response and call_error. client() makes, once a task, what sends a request's body and returns the answer's;
    an exception is that row's error. Rows are dealt evenly to the workers, each of which has up to in_flight calls open at a time and keeps the rows' order. Write
    the result before using it twice, or use call_once(): a call isn't repeatable."""
    rows = requests.repartition(workers) if workers else requests
    names, at = rows.columns, rows.columns.index(request)

    def run(batches):
        send = client()

        def one(body: str) -> tuple[str | None, str | None]:
            try:
                return send(body), None
            except Exception as e:
                return None, f"{type(e).__name__}: {e}"

        with ThreadPoolExecutor(in_flight) as threads:
            for batch in batches:
                bodies = batch.column(at).to_pylist()
                done = list(threads.map(one, bodies) if in_flight > 1 else map(one, bodies))
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([d[k] for d in done], pa.string()) for k in (0, 1))], names=[*names, "response", "call_error"])

    none = F.lit(None).cast("string")
    return rows.mapInArrow(run, rows.withColumns({"response": none, "call_error": none}).schema)


#: Calls whose answers are not written yet, of all tasks together: what a crash of the driver can lose. A run on all cores has so many slices at most, and longer ones then.
CALLS_A_SLICE, MOST_SLICES = 5000, 32
#: A task's answers are there as soon as the task is done, not only once its job is.
_TASKS_COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def call_once(requests: DataFrame, key: Sequence[str], client: Callable[[], Client], path: str, *, request: str = "request", workers: int | None = None, in_flight: int = 1, calls_a_slice: int = CALLS_A_SLICE, after_slice: Callable[[int, int], None] | None = None) -> DataFrame:
    """call() under a journal at path: the answers are there before anything reads them, and whoever reads them makes no call.

    First the requests are written as a queue, dealt into slices and these into parts by the key's hash, then the answers of one slice after the other: a part is a task
    and a file. A run that is taken up again at the same path reads its queue and calls for the parts that have no answers yet; what has been answered stays as it was
    answered. after_slice(slices done, slices in all) follows each slice. The result is the journal: the requests' columns, response and call_error.
    """
    spark, asked, queue, answers = requests.sparkSession, f"{path}/asked", f"{path}/requests", f"{path}/answers"
    if not shared.complete(spark, queue):
        if not shared.complete(spark, asked):
            requests.write.mode("overwrite").parquet(asked)
        told, cores = spark.read.schema(requests.schema).parquet(asked), spark.sparkContext.defaultParallelism
        n = told.count()
        slices = max(1, -(-n // calls_a_slice) if workers else min(-(-n // calls_a_slice), MOST_SLICES))
        parts = workers or max(cores, -(-n // (slices * max(1, calls_a_slice // cores))))
        told.withColumns({"part": F.pmod(F.hash(*key), F.lit(parts)), "slice": F.pmod(F.xxhash64(*key), F.lit(slices)).cast("int")}).write.mode("overwrite").partitionBy("slice").parquet(queue)
    slice_, part, answer = T.StructField("slice", T.IntegerType()), T.StructField("part", T.IntegerType()), [T.StructField(c, T.StringType()) for c in ("response", "call_error")]
    queued = spark.read.schema(T.StructType([*requests.schema.fields, part, slice_])).parquet(queue)
    numbers = sorted((r["slice"], r["parts"]) for r in queued.groupBy("slice").agg((F.max("part") + 1).alias("parts")).collect())
    for done, (number, parts) in enumerate(numbers, 1):
        at = f"{answers}/slice={number}"
        if not shared.complete(spark, at):
            rows = spark.read.schema(T.StructType([*requests.schema.fields, part])).parquet(f"{queue}/slice={number}")
            if shared.exists(spark, at):  # broken off
                rows = rows.join(F.broadcast(spark.read.schema(T.StructType([part])).parquet(at).distinct()), "part", "left_anti")
            call(rows.repartitionById(parts, F.col("part")), client, request=request, in_flight=in_flight).write.mode("append").options(**_TASKS_COMMIT).parquet(at)
            if after_slice:
                after_slice(done, len(numbers))
    if not numbers:
        return spark.createDataFrame([], T.StructType([*requests.schema.fields, *answer]))
    return spark.read.schema(T.StructType([*requests.schema.fields, *answer, slice_])).parquet(answers).drop("slice")


def endpoint(urls: Sequence[str], own: str | None, place: int) -> str:
    """The URL set for a subject, else the one at its place in the list, else the first that isn't blank."""
    found = [u for u in urls if u and u.strip()]
    if own and own.strip():
        return own
    if not found:
        raise ValueError("no endpoint is configured")
    return urls[place] if place < len(urls) and urls[place] and urls[place].strip() else found[0]


def _get(json: Column, path: str) -> Column:
    return let(F.get_json_object(json, path), blank_to_null)


def _choice(body: Column) -> Column:
    return F.coalesce(_get(body, "$.choices[0].message.content"), _get(body, "$.choices[0].text"))


def message(body: Column, *, envelopes: int = 3) -> Column:
    """The answer's text in a response body: of the first choice; else what response_data holds, as an object, a string, or after a
    prefix, some envelopes deep; else the text itself if it is no response. Null if there is none."""

    def bare(c: Column) -> Column:
        """Without a prefix; a text that names none is only trimmed."""
        return let(trimmed(null_to_blank(c)), lambda x: F.when(x.contains("response_data:"), F.regexp_replace(x, r"(?s)^.*?response_data:\s*", "")).otherwise(x))

    def read(b: Column, left: int) -> Column:
        def inner(held: Column) -> Column:
            again = let(bare(held), lambda x: read(x, left - 1)) if left else blank_to_null(held)
            alone = F.when(F.get_json_object(b, "$.choices").isNull(), b)
            return F.coalesce(F.when(held.isNotNull(), again), let(alone, blank_to_null))

        return F.coalesce(F.when(b.contains("choices"), _choice(b)), let(F.when(b.contains("response_data"), F.get_json_object(b, "$.response_data")), inner))

    return let(bare(body), lambda b: read(b, envelopes))


def json_text(content: Column, *, arrays: bool = False) -> Column:
    """The JSON in a text: without a code fence, from the first opening brace (or bracket, whichever comes first) to the last closing
    one; null if there is none."""

    def found(own: Column) -> Column:
        thing = let(F.regexp_extract(own, r"(?s)(\{.*\})", 1), blank_to_null)
        if not arrays:
            return thing
        rows = let(F.regexp_extract(own, r"(?s)^[^{\[]*(\[.*\])", 1), blank_to_null)
        return F.when(own.rlike(r"(?s)^[^{\[]*\["), rows).otherwise(thing)

    return let(trimmed(F.regexp_replace(F.regexp_replace(trimmed(null_to_blank(content)), r"^```[a-zA-Z]*", ""), r"```$", "")), found)


def first_object(json: Column) -> Column:
    """The object itself, or the first object of an array, as a variant; null where the JSON is broken."""

    def found(v: Column) -> Column:
        rows = F.try_variant_get(v, "$", "array<variant>")
        return F.coalesce(F.when(F.schema_of_variant(v).startswith("OBJECT"), v), F.get(F.filter(rows, lambda x: F.schema_of_variant(x).startswith("OBJECT")), 0))

    return let(F.try_parse_json(json), found)


def field(v: Column, *names: str, containers: bool = False) -> Column:
    """The first of these fields with text, trimmed; numbers and booleans as text. Containers count only if asked for, as JSON."""

    def one(name: str) -> Column:
        def found(x: Column) -> Column:
            kind = F.schema_of_variant(x)
            inside = kind.startswith("OBJECT") | kind.startswith("ARRAY")
            scalar = let(F.try_variant_get(x, "$", "string"), blank_to_null)
            return F.when(inside, F.to_json(x)).otherwise(scalar) if containers else F.when(~inside, scalar)

        return let(F.try_variant_get(v, f'$["{name}"]', "variant"), found)

    return F.coalesce(*map(one, names))


def parse_error(subject: str, response: Column, width: int = 4000) -> Column:
    return F.concat(F.lit(f"{subject} response can't be read: "), cut(response, width))


def parse_summaries(answers: DataFrame, *, most: int = S.SUMMARY_CHARS) -> DataFrame:
    """answers (response, call_error) with error, flag (Y or N) and summary (empty unless Y)."""
    rows = answers.withColumn("__v", first_object(json_text(message(F.col("response")))))
    flag = F.when(F.upper(null_to_blank(field(F.col("__v"), "flag"))) == "Y", "Y").otherwise("N")
    error = F.coalesce("call_error", F.when(F.col("__v").isNull(), parse_error("SUMMARY", F.col("response"))))
    return rows.select(*answers.columns, error.alias("error"), F.when(error.isNull(), flag).alias("flag"), F.when(error.isNull(), F.when(flag == "Y", cut(field(F.col("__v"), "summary"), most)).otherwise("")).alias("summary")).drop("call_error")


def parse_subjects(answers: DataFrame, subject: str = S.POLICY) -> DataFrame:
    """answers (response, call_error) with error, code, name and reason (empty where the answer gives none)."""
    rows = answers.withColumn("__v", first_object(json_text(message(F.col("response")), arrays=subject == S.POLICY)))
    error = F.coalesce("call_error", F.when(F.col("__v").isNull(), parse_error(subject, F.col("response"))))
    return rows.select(*answers.columns, error.alias("error"), *[F.when(error.isNull(), null_to_blank(field(F.col("__v"), *names))).alias(k) for k, names in SUBJECT_FIELDS[subject].items()]).drop("call_error")


def parse_departments(answers: DataFrame) -> DataFrame:
    """answers (response, call_error) with error, the mapping's fields and result_json."""
    rows = answers.withColumn("__v", first_object(json_text(message(F.col("response")), arrays=True)))
    v = F.col("__v")
    error = F.coalesce("call_error", F.when(v.isNull(), parse_error("POLICY_DEPT", F.col("response"))))
    return rows.select(*answers.columns, error.alias("error"), *[F.when(error.isNull(), null_to_blank(field(v, *names, containers=k == "matching_terms"))).alias(k) for k, names in DEPARTMENT_FIELDS.items()], F.to_json(v).alias("result_json")).drop("call_error")
