"""Keyed writes as whole-table transformations: before + changes = after. Tables are Parquet, so a write is a join and a new version."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary import schema as S
from foliary.functions.text import cut, has_text

_LETTER = ("implement_org", "implement_date", "receipt_org", "receipt_date")


def _latest(changes: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One change for each key: the last by `order`; without an order, keys must be unique."""
    if not order:
        return changes
    cols = [c for c in changes.columns if c not in key]
    best = changes.groupBy(*key).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("__c"))
    return best.select(*key, "__c.*")


def merged(table: DataFrame, changes: DataFrame, key: Sequence[str], *, keep: Sequence[str] = (), update: dict[str, Callable[[Column, Column], Column]] | None = None, insert: bool = True, order: Sequence[str] = (), flag: str | None = None) -> DataFrame:
    """The table after an upsert of changes by key. Columns of `keep`, and those that changes lack, stay; update gives a
    column's new value from (old, new). Without `insert`, unknown keys are left out. A null in a key matches a null. A column `flag` tells which rows are new or
    other than before."""
    update = update or {}
    new = _latest(changes, key, order).select(*[F.col(k).alias(f"__k_{k}") for k in key], *[F.col(c).alias(f"__n_{c}") for c in changes.columns if c not in key], F.lit(True).alias("__new"))
    old = table.withColumn("__old", F.lit(True))
    on = [old[k].eqNullSafe(new[f"__k_{k}"]) for k in key]
    both = old.join(new, on, "full" if insert else "left")

    def value(c: str) -> Column:
        if c in key:
            return F.when(F.col("__old").isNull(), F.col(f"__k_{c}")).otherwise(F.col(c))
        if f"__n_{c}" not in both.columns:
            return F.col(c)
        fresh, was = F.col(f"__n_{c}"), F.col(c)
        changed = update[c](was, fresh) if c in update else was if c in keep else fresh
        return F.when(F.col("__new").isNull(), was).when(F.col("__old").isNull(), fresh).otherwise(changed)

    values = [value(c).cast(table.schema[c].dataType).alias(c) for c in table.columns]
    if flag is None:
        return both.select(*values)
    same = F.lit(True)
    for c in table.columns:
        if c not in key and f"__n_{c}" in both.columns:
            same = same & F.col(c).eqNullSafe(value(c).cast(table.schema[c].dataType))
    return both.select(*values, F.when(F.col("__new").isNull(), False).when(F.col("__old").isNull(), True).otherwise(~same).alias(flag))


def upsert_extracts(extracts: DataFrame, changes: DataFrame, *, key: Sequence[str] = S.EXTRACT_KEY, order: Sequence[str] = (), flag: str | None = None) -> DataFrame:
    """Extracted documents by key. Summary columns stay as they are; letter columns change only if any of the four has text."""
    given = changes.select("*", *[F.lit(None).cast("string").alias(c) for c in _LETTER if c not in changes.columns])
    any_text = F.lit(False)
    for c in _LETTER:
        any_text = any_text | has_text(F.col(f"__n_{c}"))
    return merged(extracts, given, key, keep=("idx", "summary", "summary_flag", "llm_summary_status", "llm_summary_err_msg", "create_date"), update={c: lambda old, new: F.when(any_text, new).otherwise(old) for c in _LETTER}, order=order, flag=flag)


def replace_chunks(chunks: DataFrame, made: DataFrame, sources: DataFrame, *, marked: bool = False) -> DataFrame:
    """The chunk table with all chunks of the sources (extract_idx) replaced; a source without chunks gets a marker, so that it isn't
    selected again. marked: `made` has the markers already (chunk_documents(marker=True)), so it stands in the plan once."""
    done = sources.select("extract_idx").distinct()
    if marked:
        return chunks.join(done, "extract_idx", "left_anti").unionByName(made.select(*[c for c in chunks.columns if c in made.columns]), allowMissingColumns=True).select(*chunks.columns)
    marker = {"chunk_seq": F.lit(0), "doc_role": F.lit(S.UNKNOWN), "doc_type": F.lit(S.SKIP), "chunk_text": F.lit(S.NO_CONTENT), "char_count": F.lit(0), "token_count": F.lit(0), "chunk_status": F.lit(S.SKIP)}
    none = done.join(made.select("extract_idx"), "extract_idx", "left_anti").withColumns(marker)
    return chunks.join(done, "extract_idx", "left_anti").unionByName(made.select(*[c for c in chunks.columns if c in made.columns]), allowMissingColumns=True).unionByName(none, allowMissingColumns=True).select(*chunks.columns)


def summary_results(extracts: DataFrame, results: DataFrame, *, flag: str | None = None) -> DataFrame:
    """results: the key, error (null: passed), flag, summary. A failure sets the flag to N and leaves the summary."""
    failed = F.col("error").isNotNull()
    width = S.ERROR_WIDTHS["SUMMARY"]
    new = results.select(*S.EXTRACT_KEY, F.when(failed, "N").otherwise(F.col("flag")).alias("summary_flag"), F.when(failed, S.FAIL).otherwise(S.PASS).alias("llm_summary_status"), F.when(failed, cut(F.col("error"), width)).alias("llm_summary_err_msg"), "summary")
    return merged(extracts, new, S.EXTRACT_KEY, insert=False, update={"summary": lambda old, fresh: F.when(F.col("__n_llm_summary_status") == S.PASS, fresh).otherwise(old)}, flag=flag)


#: Columns of the items that a subject's result goes to: code, name, status, error message.
RESULT_COLUMNS = {
    S.POLICY: ("policy_cd", "policy_nm", "llm_policy_status", "llm_policy_err_msg"),
    S.EVENT: ("ex_event_cd", "ex_event_nm", "llm_event_status", "llm_event_err_msg"),
    S.ACTIVITY: ("activity_cd", "activity_nm", "llm_activity_status", "llm_activity_err_msg"),
}


def item_results(items: DataFrame, results: DataFrame, subject: str = S.POLICY, *, order: Sequence[str] = (), flag: str | None = None) -> DataFrame:
    """results: the item's key, error (null: passed), code, name, reason. A failure leaves code and name; a policy
    that was found to be excluded, doubtful or indirect keeps its reason as the message."""
    code, name, status, message = RESULT_COLUMNS[subject]
    failed = F.col("error").isNotNull()
    reasoned = F.when(F.col("name").isin(*S.REASONED), F.col("reason")) if subject == S.POLICY else F.lit(None).cast("string")
    new = results.select(*S.ITEM_KEY, F.col("code").alias(code), F.col("name").alias(name), F.when(failed, S.FAIL).otherwise(S.PASS).alias(status), F.when(failed, cut(F.col("error"), S.ERROR_WIDTHS[subject])).otherwise(reasoned).alias(message), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)])
    passed = lambda old, fresh: F.when(F.col(f"__n_{status}") == S.PASS, fresh).otherwise(old)
    return merged(items, new, S.ITEM_KEY, insert=False, update={code: passed, name: passed}, order=[f"__o{i}" for i in range(len(order))], flag=flag)


def subjects_results(items: DataFrame, results: DataFrame, *, flag: str | None = None) -> DataFrame:
    """results: subject beside what item_results() takes. Each item takes the results of all its subjects in one merge; a subject without a result keeps its
    columns."""
    fields = F.struct("error", "code", "name", "reason")
    subjects = list(RESULT_COLUMNS)
    each = results.groupBy(*S.ITEM_KEY).agg(*[F.max_by(F.when(F.col("subject") == s, fields), F.when(F.col("subject") == s, 1)).alias(f"__{s}") for s in subjects])
    made, update = {}, {}
    for s in subjects:
        code, name, status, message = RESULT_COLUMNS[s]
        r = F.col(f"__{s}")
        failed = r["error"].isNotNull()
        reasoned = F.when(r["name"].isin(*S.REASONED), r["reason"]) if s == S.POLICY else F.lit(None).cast("string")
        made |= {code: r["code"], name: r["name"], status: F.when(r.isNotNull(), F.when(failed, S.FAIL).otherwise(S.PASS)), message: F.when(failed, cut(r["error"], S.ERROR_WIDTHS[s])).otherwise(reasoned)}
        told, passed = F.col(f"__n_{status}").isNotNull(), F.col(f"__n_{status}") == S.PASS
        update |= dict.fromkeys((code, name), lambda old, new, yes=passed: F.when(yes, new).otherwise(old)) | dict.fromkeys((status, message), lambda old, new, yes=told: F.when(yes, new).otherwise(old))
    new = each.select(*S.ITEM_KEY, *[c.alias(k) for k, c in made.items()])
    return merged(items, new, S.ITEM_KEY, insert=False, update=update, flag=flag)


def propagate_files(items: DataFrame, decided: DataFrame, *, flag: str | None = None) -> DataFrame:
    """decided: rc_rfile_no, code, name (one row a file): every item of the file takes the decision."""
    new = decided.select("rc_rfile_no", F.col("code").alias("policy_cd"), F.col("name").alias("policy_nm"), F.lit(S.PASS).alias("llm_policy_status"), F.lit(None).cast("string").alias("llm_policy_err_msg"))
    return merged(items, new, ("rc_rfile_no",), insert=False, flag=flag)


def publish(spark: SparkSession, table: DataFrame, path: str) -> None:
    """Writes the table as a new version below path and then names it the current one by an empty file, whose creation is one step in any store:
    readers by published() see the old or the new version, a crash leaves the old one. The version before stays for readers that still have it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(conf)
    named = _versions(spark, path)
    version = f"{(int(named[-1][:12]) + 1) if named else 1:012d}-{uuid.uuid4().hex}"
    table.write.parquet(f"{path}/{version}")
    fs.mkdirs(hadoop(f"{path}/_current"))
    fs.create(hadoop(f"{path}/_current/{version}"), False).close()
    for old in named[:-1]:
        fs.delete(hadoop(f"{path}/_current/{old}"), False)
        fs.delete(hadoop(f"{path}/{old}"), True)


def published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published table."""
    named = _versions(spark, path)
    if not named:
        raise FileNotFoundError(f"no table has been published at {path}")
    return spark.read.parquet(f"{path}/{named[-1]}")


def _versions(spark: SparkSession, path: str) -> list[str]:
    """The names of published versions, the current one last."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_current")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def swap(spark: SparkSession, table: DataFrame, path: str) -> None:
    """Writes the table beside the old one and renames it to its place. Between two renames there is no table at the path, so this is for
    tables without readers meanwhile; publish() is for others."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    new, old = (jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.{x}") for x in ("new", "old"))
    fs.delete(new, True)
    table.write.parquet(new.toString())
    fs.delete(old, True)
    if fs.exists(at):
        fs.rename(at, old)
    if not fs.rename(new, at):
        raise OSError(f"{path} can't be replaced")
    fs.delete(old, True)
