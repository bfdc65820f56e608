"""Runs: select, work, write, account for it. Each is one pass over all that is to be done, so nothing is tried twice in a run."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from foliary import schema as S
from foliary.functions.text import cut
from foliary.operators import chunking, ledger, merge, prompting, responses
from foliary.operators import selection as Q
from foliary.sources import files, shared


def extract_run(catalog: DataFrame, extracts: DataFrame, base: str, p: Q.Params, *, stored: DataFrame | None = None, **how) -> tuple[DataFrame, DataFrame]:
    """The extract table after the run, and what the run made (`how`: extract_files()). Content is read by the catalogue's paths, or taken from a table of stored
    files (path, content) if one is given."""
    targets = Q.extract_targets(catalog, extracts, p)
    found = files.scan_catalogued(targets, base, p.transfer_year) if stored is None else files.catalogued(targets, stored, base, p.transfer_year)
    made = files.extract_files(found, **how)
    key = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in S.EXTRACT_KEY])
    made = made.withColumn("idx", key)
    rest = [c for c in made.columns if c not in S.EXTRACT_KEY]
    made = made.groupBy(*S.EXTRACT_KEY).agg(F.min(F.struct(*rest)).alias("__m")).select(*S.EXTRACT_KEY, "__m.*")  # of files catalogued twice the first
    return merge.upsert_extracts(extracts, made), made


def chunk_run(extracts: DataFrame, catalog: DataFrame, chunks: DataFrame, *, transfer_year: str | None = None, recreate: bool = False, size: int = S.CHUNK_SIZE, overlap: int = S.OVERLAP) -> DataFrame:
    """The chunk table after the run: targets' chunks replaced, markers for targets without any."""
    targets = Q.chunk_targets(extracts, catalog, chunks, transfer_year=transfer_year, recreate=recreate)
    return merge.replace_chunks(chunks, chunking.chunk_documents(targets, size=size, overlap=overlap, marker=True), targets, marked=True)


def ask(targets: DataFrame, key: tuple[str, ...], system: Column, user: Column, client: Callable[[], responses.Client], *, model: str = "model", workers: int | None = None, in_flight: int = 1, journal: str | None = None, after_slice: Callable[[int, int], None] | None = None) -> DataFrame:
    """The key, request, response and call_error of a call for each target. Of rows that repeat a key the first by all their columns is asked about. With a
    journal each is called once, whatever reads the result and however often the run is taken up; without one each reading calls again."""
    rest = [c for c in targets.columns if c not in key]
    first = targets.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__first")).select(*key, "__first.*") if rest else targets.select(*key).distinct()
    first = first.select(*key, prompting.chat_request(model, system, user).alias("request"))
    if journal is None:
        return responses.call(first, client, workers=workers, in_flight=in_flight)
    return responses.call_once(first, key, client, journal, workers=workers, in_flight=in_flight, after_slice=after_slice)


def subject_answers(targets: DataFrame, template: str, client: Callable[[], responses.Client], subject: str, *, model: str = "model", **call) -> DataFrame:
    """The results of one subject over its targets: the item's key, error, code, name, reason. An item that stands among the targets more than once is asked
    about once."""
    user = prompting.render(template, prompting.variables(targets, prompting.ITEM_VARIABLES))
    return responses.parse_subjects(ask(targets, S.ITEM_KEY, F.lit(f"Answer in JSON for {subject}."), user, client, model=model, **call), subject)


def subject_run(items: DataFrame, targets: DataFrame, template: str, client: Callable[[], responses.Client], subject: str, **call) -> tuple[DataFrame, DataFrame]:
    """The item table after a run of one subject over its targets, and the results."""
    results = subject_answers(targets, template, client, subject, **call)
    return merge.item_results(items, results, subject), results


def subjects_answers(items: DataFrame, catalog: DataFrame, templates: dict[str, str], clients: dict[str, Callable[[], responses.Client]], p: Q.Params, *, journal: str | None = None, **call) -> DataFrame:
    """The results (subject, item key, error, code, name, reason) of all subjects over the items that lack any, each subject only where its own status is open."""
    work = Q.subject_work(Q.subject_targets(items, catalog, p), retry=p.retry)
    every = None
    for subject, template in templates.items():
        own = work.where(F.col("subject") == subject).drop("subject", "status")
        results = subject_answers(own, template, clients[subject], subject, journal=journal and f"{journal}/{subject}", **call)
        named = results.select(F.lit(subject).alias("subject"), *S.ITEM_KEY, "error", "code", "name", "reason")
        every = named if every is None else every.unionByName(named)
    return every


def subjects_run(items: DataFrame, catalog: DataFrame, templates: dict[str, str], clients: dict[str, Callable[[], responses.Client]], p: Q.Params, **call) -> tuple[DataFrame, DataFrame]:
    """A run of all subjects: the item table after it, in one merge, and the results of all. Without a journal, write the results before using them twice."""
    results = subjects_answers(items, catalog, templates, clients, p, **call)
    return merge.subjects_results(items, results), results


def summary_answers(extracts: DataFrame, catalog: DataFrame, items: DataFrame, system: str, output_format: str, client: Callable[[], responses.Client], p: Q.Params, *, model: str = "model", **call) -> DataFrame:
    """The results (extract key, error, flag, summary) of summaries over the texts that have none."""
    targets = Q.summary_targets(extracts, catalog, items, p)
    user = prompting.summary_message(F.col("bnd_ttl"), F.col("jemok"), F.col("indexing_contents"), output_format)
    more = {"SAVE_FILE_NAME": F.col("file_name"), "ORG_FILE_NAME": F.lit(None).cast("string"), "CONTENTS": cut(F.col("indexing_contents"), S.CONTENT_CHARS), "maxContentLength": F.lit(S.CONTENT_CHARS), "maxSummaryLength": F.lit(S.SUMMARY_CHARS)}
    system_text = prompting.render(system, prompting.variables(targets, [v for v in prompting.SUMMARY_VARIABLES if prompting.mentions(system, v)], more))
    return responses.parse_summaries(ask(targets, S.EXTRACT_KEY, system_text, user, client, model=model, **call))


def summary_run(extracts: DataFrame, catalog: DataFrame, items: DataFrame, system: str, output_format: str, client: Callable[[], responses.Client], p: Q.Params, **call) -> tuple[DataFrame, DataFrame]:
    """The extract table after a run of summaries, and the results."""
    results = summary_answers(extracts, catalog, items, system, output_format, client, p, **call)
    return merge.summary_results(extracts, results), results


@dataclass(frozen=True)
class Run:
    """What the work of an accounted run gets: its id, the folder of its journal, and progress(done, all) to tell how far it is."""

    run_id: str
    journal: str
    progress: Callable[[int, int], None]


def accounted(spark: SparkSession, registry: ledger.Registry, key: ledger.RunKey, path: str, work: Callable[[Run], DataFrame], apply: Callable[[DataFrame], DataFrame], log: Callable[[DataFrame, str], DataFrame] | None = None, *, run_id: str | None = None) -> DataFrame:
    """A run under the ledger at path, each step of which reads what the one before has written, so that nothing is asked for or worked out twice:

    1. the run is refused if it overlaps another; its start is a row of path/runs;
    2. work(run) gives the results (an `error` that is null or a `status`), lazily or by a journal below path/journal; they're written to path/results, and
       counted while they are written;
    3. log(results, run id) gives rows of path/items, apply(results) the table after the run;
    4. its tally and its end are a row of path/runs.

    An error of the work ends the run as failed and goes on to the caller; an error of writing the ledger only warns. With the id of a run that broke off the run is
    taken up where it was: results that are there aren't made again, nor are calls that its journal has, and its items are logged once."""
    registry.acquire(key)
    run_id, counts, resumed = run_id or ledger.new_run_id(), (0, 0, 0), run_id is not None

    def event(status: str, loops: int = 1, error: str | None = None) -> None:
        row = [(run_id, key.process, key.transfer_year, key.prod_year, status, loops, *counts, error)]
        names = "run_id string, process_type string, transfer_year string, prod_year string, status string, loop_count bigint, total_target_count bigint, total_success_count bigint, total_fail_count bigint, error_msg string"
        try:
            spark.createDataFrame(row, names).withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/runs")
        except Exception as e:  # the work counts, not its record
            warnings.warn(f"run {run_id} isn't recorded as {status}: {e}", stacklevel=2)

    try:
        if not resumed:
            event(S.RUNNING)
        at = f"{path}/results/run_id={run_id}"
        if not shared.complete(spark, at):
            results = work(Run(run_id, f"{path}/journal/{run_id}", lambda done, _: event(S.RUNNING, done)))
            seen = Observation()
            results.observe(seen, *_counts(results)).write.mode("overwrite").parquet(at)
            counts = tuple(seen.get[c] or 0 for c in _COUNTED)
            results = spark.read.schema(results.schema).parquet(at)
        else:
            results = spark.read.parquet(at)
            counts = tuple(x or 0 for x in results.agg(*_counts(results)).first())
        if log is not None:
            try:
                log(results, run_id).write.mode("overwrite").parquet(f"{path}/items/run={run_id}")
            except Exception as e:
                warnings.warn(f"items of run {run_id} aren't recorded: {e}", stacklevel=2)
        after = apply(results)
        event(ledger.final_status(True, counts[2]))
        return after
    except Exception as e:
        event(S.FAIL, error=f"{type(e).__name__}: {e}"[:4000])
        raise
    finally:
        registry.release(key)


_COUNTED = ("total_target_count", "total_success_count", "total_fail_count")


def _counts(results: DataFrame) -> list[Column]:
    """Targets, successes and failures, as aggregates that can be observed while the results are written."""
    passed = F.col("status") == S.PASS if "status" in results.columns else F.col("error").isNull()
    return [F.count(F.lit(1)).alias(_COUNTED[0]), F.sum(F.when(passed, 1).otherwise(0)).alias(_COUNTED[1]), F.sum(F.when(passed, 0).otherwise(1)).alias(_COUNTED[2])]


def department_run(items: DataFrame, catalog: DataFrame, departments: tuple[str, ...], decide_files: Callable[[DataFrame], DataFrame], decide_items: Callable[[DataFrame], DataFrame], p: Q.Params) -> tuple[DataFrame, DataFrame]:
    """Files first: a decision (rc_rfile_no, error, code, name) goes to all items of its file. Then the items that are still open, each by its own
    decision (item key, error, code, name, reason); one that stays undecided has passed without a code. Returns the items and the tally by phase."""
    after, tally, _ = department_steps(items, catalog, departments, decide_files, decide_items, p, "")
    return after, tally


def department_steps(items: DataFrame, catalog: DataFrame, departments: tuple[str, ...], decide_files: Callable[[DataFrame], DataFrame], decide_items: Callable[[DataFrame], DataFrame], p: Q.Params, run_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """department_run() with the log of both phases: a file that was decided is logged for each of its items, one that wasn't or that failed as a file (without
    an item), and leaves its items as they are; items are logged each. Decisions may have any of the log's columns. Write what decides before using it twice."""
    of_files = decide_files(Q.department_files(items, catalog, departments, p))
    decided = of_files.where(F.col("error").isNull() & Q.determined(F.col("code"), F.col("name")))
    after = merge.propagate_files(items, decided.select("rc_rfile_no", "code", "name"))
    of_items = decide_items(Q.department_compare(after, catalog, departments, p))
    status = F.when(F.col("error").isNull(), S.PASS).otherwise(S.FAIL).alias("status")
    tallied = of_files.select(F.lit("file").alias("phase"), status).unionByName(of_items.select(F.lit("item").alias("phase"), status))
    more = [c for c in of_files.columns if c in S.LOG_WIDTHS]
    own = Q.item_targets_of_files(items, catalog, p)
    by_item = decided.select("rc_rfile_no", *more).join(own, "rc_rfile_no").withColumn("error_msg", F.lit(None).cast("string"))
    none = F.lit(None).cast("string")
    by_file = of_files.where(F.col("error").isNotNull() | ~F.coalesce(Q.determined(F.col("code"), F.col("name")), F.lit(False))).select(none.alias("rc_code"), "rc_rfile_no", none.alias("rc_ritem_no"), *more, F.col("error").alias("error_msg"))
    log = ledger.item_log(by_item, run_id, "POLICY_DEPT_FILE").unionByName(ledger.item_log(by_file, run_id, "POLICY_DEPT_FILE"), allowMissingColumns=True)
    log = log.unionByName(ledger.item_log(of_items.withColumnRenamed("error", "error_msg"), run_id, "POLICY_DEPT"), allowMissingColumns=True)
    return merge.item_results(after, of_items), ledger.tally(tallied, "phase"), log
