"""Runs and items in an append-only ledger. A run is rows of events (start, progress, finish); its state is the last that counts."""

from __future__ import annotations

import json
import threading
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary import schema as S
from foliary.functions.text import cut

_COUNTS = ("loop_count", "total_target_count", "total_success_count", "total_fail_count")

#: Kinds of runs.
PROCESS_TYPES = tuple(
    "TEXT_BATCH TEXT_ALL SUMMARY_BATCH SUMMARY_ALL POLICY_BATCH POLICY_ALL POLICY_SAMPLE POLICY_DEPT_FILE_BATCH POLICY_DEPT_FILE_ALL POLICY_DEPT_ITEM_COMPARE_BATCH POLICY_DEPT_ITEM_COMPARE_ALL "
    "POLICY_DEPT_BATCH POLICY_DEPT_ALL EVENT_BATCH EVENT_ALL ACTIVITY_BATCH ACTIVITY_ALL SUBJECT_BATCH SUBJECT_ALL".split()
)


def new_run_id() -> str:
    return uuid.uuid4().hex


def final_status(completed: bool, failed: int, error: str | None = None) -> str:
    """FAIL with an error; SUCCESS if the run came to its end without a failure; else PARTIAL."""
    return S.FAIL if error is not None else S.SUCCESS if completed and not failed else S.PARTIAL


def run_states(events: DataFrame) -> DataFrame:
    """events: run_id, at (their order), status, counts, error_msg. One row a run: its first finish (what comes after a finish doesn't
    count), else its last progress; started_at and, if finished, ended_at."""
    done = F.col("status") != S.RUNNING
    state = F.struct("status", *_COUNTS, "error_msg", "at")
    found = events.groupBy("run_id").agg(F.min("at").alias("started_at"), F.min_by(F.when(done, state), F.when(done, F.col("at"))).alias("end"), F.max_by(state, "at").alias("last"))
    return found.select("run_id", "started_at", F.col("end.at").alias("ended_at"), F.coalesce("end", "last").alias("s")).select("run_id", "started_at", "ended_at", "s.status", *[f"s.{c}" for c in _COUNTS], "s.error_msg")


def item_log(results: DataFrame, run_id: str, subject: str) -> DataFrame:
    """Log rows of an item run, cut to the log's widths; columns that results lack are null."""
    given = results.columns
    text = {c: cut(F.col(c), n, keep_null=True) if c in given else F.lit(None).cast("string") for c, n in S.LOG_WIDTHS.items()}
    status = F.when(F.col("error_msg").isNotNull(), S.FAIL).otherwise(S.PASS) if "error_msg" in given else F.lit(S.PASS)
    return results.select(F.lit(run_id).alias("run_id"), F.lit(subject).alias("subject_type"), *S.ITEM_KEY, status.alias("status"), *[c.alias(k) for k, c in text.items()], *(["result_json"] if "result_json" in given else []))


def text_log(extracts: DataFrame, run_id: str) -> DataFrame:
    """Log rows of a text run: the group of the file stands as the task's code, file and entry as its name."""
    name = F.concat_ws(" / ", "file_name", "zip_entry_file_name")
    rows = extracts.select(F.lit(None).cast("string").alias("rc_code"), "rc_rfile_no", "rc_ritem_no", F.col("extract_err_msg").alias("error_msg"), F.col("file_gubun").alias("detail_task_cd"), name.alias("detail_task_nm"))
    return item_log(rows, run_id, "TEXT")


def tally(results: DataFrame, *by: str) -> DataFrame:
    """Targets, successes and failures of results (status), in all or by columns."""
    passed = F.sum(F.when(F.col("status") == S.PASS, 1).otherwise(0))
    return results.groupBy(*by).agg(F.count("*").alias("total_target_count"), F.coalesce(passed, F.lit(0)).alias("total_success_count"), (F.count("*") - F.coalesce(passed, F.lit(0))).alias("total_fail_count"))


class RunConflict(RuntimeError):
    """Another run works on the same records."""


@dataclass(frozen=True)
class RunKey:
    process: str
    subject: str
    transfer_year: str
    prod_year: str | None = None

    def overlaps(self, other: RunKey) -> bool:
        """The same transfer, subjects in common, and a production year in common (none: all)."""
        subjects = S.ALL in (self.subject, other.subject) or self.subject == other.subject
        mine, theirs = (self.prod_year or "").strip(), (other.prod_year or "").strip()
        return self.transfer_year == other.transfer_year and subjects and (not mine or not theirs or mine == theirs)


class Registry:
    """The runs of this driver; hold() refuses one that overlaps another."""

    def __init__(self) -> None:
        self._lock, self._active = threading.Lock(), []

    def acquire(self, key: RunKey) -> RunKey:
        with self._lock:
            for other in self._active:
                if other.overlaps(key):
                    raise RunConflict(f"{other.process} already runs for {other.transfer_year}, {other.prod_year or S.ALL}")
            self._active.append(key)
        return key

    def release(self, key: RunKey) -> None:
        with self._lock:
            if key in self._active:
                self._active.remove(key)


class SharedRegistry:
    """The runs of all drivers that see the same folder. A run claims its records by a file of its own and then looks at the others: of two overlapping claims the
    one that stands later in the order of (time, name) gives way, and where both come at once both may. A claim that is older than `stale` seconds has
    lost its driver and holds nothing; a long run calls renew()."""

    def __init__(self, spark: SparkSession, path: str, *, stale: float = 24 * 3600) -> None:
        self.jvm, self.conf, self.path, self.stale = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), f"{path}/claims", stale
        self.own: dict[RunKey, str] = {}

    def _fs(self):
        at = self.jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.conf), at

    def _claims(self) -> list[tuple[float, str, RunKey]]:
        fs, at = self._fs()
        if not fs.exists(at):
            return []
        found = []
        for s in fs.listStatus(at):
            name = s.getPath().getName()
            try:
                found.append((s.getModificationTime() / 1000, name, RunKey(**json.loads(bytes.fromhex(name.split("-")[1])))))
            except (IndexError, ValueError, TypeError):  # no claim
                continue
        return found

    def acquire(self, key: RunKey) -> RunKey:
        fs, _ = self._fs()
        name = f"{uuid.uuid4().hex}-{json.dumps(asdict(key)).encode().hex()}"
        fs.create(self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), False).close()
        claims = self._claims()
        mine = next(c for c in claims if c[1] == name)
        for at, other, held in claims:
            if other != name and held.overlaps(key) and mine[0] - at < self.stale and (at, other) < (mine[0], name):
                self._drop(name)
                raise RunConflict(f"{held.process} already runs for {held.transfer_year}, {held.prod_year or S.ALL}")
        self.own[key] = name
        return key

    def renew(self, key: RunKey) -> None:
        """Says that the run goes on."""
        fs, _ = self._fs()
        fs.setTimes(self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{self.own[key]}"), int(time.time() * 1000), -1)

    def release(self, key: RunKey) -> None:
        if key in self.own:
            self._drop(self.own.pop(key))

    def _drop(self, name: str) -> None:
        fs, _ = self._fs()
        fs.delete(self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), False)
