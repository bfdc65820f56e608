"""Registered queries of the archive engine and the SQL that checks them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary import schema as S
from foliary.functions import letters, registered
from foliary.functions import text as X
from foliary.operators import chunking, columns, keyed, ledger, merge, prompting, responses, rules
from foliary.operators import selection as Q
from foliary.plans import workflow
from foliary.plans.standins import ctes, frame
from foliary.sources import files, shared, stored

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None, tables: tuple[str, ...] = ()):
    """Registers a query under its function's name, with the SQL that gives the same rows over the tables' stand-ins."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"WITH {ctes(*tables)} {sql}" if tables else sql
        return f

    return add


_DEPARTMENTS = ("1", "3", "5")
_IN = "('1', '3', '5')"
_FIRST = "split_part(all_org_nm, ' ', 1)"


# Selections

_TARGET = "SELECT transferyear, rc_rfile_no, rc_ritem_no, mngno, detno, prodyear, org_file_path, save_file_name FROM catalog c WHERE transferyear = '2023' AND save_file_name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM extracts e WHERE e.rc_rfile_no = c.rc_rfile_no AND e.rc_ritem_no = c.rc_ritem_no AND e.file_name = c.save_file_name AND e.extract_status IN ({}))"


@query(_TARGET.format("'PASS', 'FAIL'"), ("catalog", "extracts"))
def select_extract_targets(spark: SparkSession, sf: str) -> DataFrame:
    return Q.extract_targets(frame(spark, sf, "catalog"), frame(spark, sf, "extracts"), Q.Params())


@query(_TARGET.format("'PASS'"), ("catalog", "extracts"))
def select_extract_targets_retry(spark: SparkSession, sf: str) -> DataFrame:
    return Q.extract_targets(frame(spark, sf, "catalog"), frame(spark, sf, "extracts"), Q.Params(retry=True))


@query(_TARGET.format("'PASS', 'FAIL'") + " ORDER BY rc_rfile_no, rc_ritem_no, save_file_name, transferyear, mngno, detno, prodyear, org_file_path NULLS FIRST LIMIT 100 OFFSET 200", ("catalog", "extracts"))
def select_extract_targets_page(spark: SparkSession, sf: str) -> DataFrame:
    """The page is the feature: targets 201 to 300."""
    p = Q.Params(limit=100, offset=200).resolved()
    return Q.page(select_extract_targets(spark, sf), ("rc_rfile_no", "rc_ritem_no", "save_file_name"), p.limit, p.offset)


_CHUNKABLE = "SELECT idx AS extract_idx, file_name, zip_entry_file_name, rc_rfile_no, rc_ritem_no, zip_seq, file_type, file_gubun, indexing_contents, hwp_sub_title, data_year FROM doc_extracts e WHERE extract_status = 'PASS' AND trim(indexing_contents) <> ''"


@query(_CHUNKABLE + " AND NOT EXISTS (SELECT 1 FROM doc_chunks c WHERE c.extract_idx = e.idx)", ("doc_extracts", "doc_chunks"))
def select_chunk_targets(spark: SparkSession, sf: str) -> DataFrame:
    return Q.chunk_targets(frame(spark, sf, "doc_extracts"), frame(spark, sf, "catalog"), frame(spark, sf, "doc_chunks"))


_LINES = _CHUNKABLE.replace("doc_extracts", "extracts")


@query(_LINES + " AND data_year >= 0 AND EXISTS (SELECT 1 FROM catalog c WHERE c.transferyear = '2023' AND c.rc_rfile_no = e.rc_rfile_no AND c.rc_ritem_no = e.rc_ritem_no)", ("extracts", "catalog"))
def select_chunk_targets_recreate(spark: SparkSession, sf: str) -> DataFrame:
    return Q.chunk_targets(frame(spark, sf, "extracts"), frame(spark, sf, "catalog"), frame(spark, sf, "doc_chunks"), transfer_year="2023", recreate=True)


_SUMMARY = "SELECT z.rc_rfile_no, z.rc_ritem_no, z.file_name, z.indexing_contents, z.zip_seq, z.zip_entry_file_name, z.file_type, z.file_gubun, b.prodyear, b.org_file_path, a.rc_code, a.bnd_ttl, a.jemok, a.all_org_nm, a.prodregdate FROM extracts z JOIN catalog b ON b.rc_rfile_no = z.rc_rfile_no AND b.rc_ritem_no = z.rc_ritem_no AND b.save_file_name = z.file_name AND b.transferyear = '2023' JOIN items a ON a.rc_rfile_no = z.rc_rfile_no AND a.rc_ritem_no = z.rc_ritem_no WHERE z.extract_status = 'PASS' AND z.has_contents = 'Y' AND z.indexing_contents IS NOT NULL AND z.indexing_contents <> '' AND {}"


@query(_SUMMARY.format("z.summary_flag IS NULL AND z.llm_summary_status IS NULL"), ("extracts", "catalog", "items"))
def select_summary_targets(spark: SparkSession, sf: str) -> DataFrame:
    return Q.summary_targets(frame(spark, sf, "extracts"), frame(spark, sf, "catalog"), frame(spark, sf, "items"), Q.Params())


@query(_SUMMARY.format("(z.llm_summary_status IS NULL OR z.llm_summary_status <> 'PASS')"), ("extracts", "catalog", "items"))
def select_summary_targets_retry(spark: SparkSession, sf: str) -> DataFrame:
    return Q.summary_targets(frame(spark, sf, "extracts"), frame(spark, sf, "catalog"), frame(spark, sf, "items"), Q.Params(retry=True))


_COLUMNS = "a.rc_code, a.rc_rfile_no, a.rc_ritem_no, a.bnd_ttl, a.jemok, a.all_org_nm, a.prodregdate"
_FANOUT = "FROM items a JOIN (SELECT rc_rfile_no, rc_ritem_no, mngno, kikwancode, prodyear FROM catalog WHERE transferyear = '2023' {} GROUP BY ALL) b ON a.rc_rfile_no = b.rc_rfile_no AND a.rc_ritem_no = b.rc_ritem_no WHERE "


@query(f"SELECT {_COLUMNS}, b.prodyear {_FANOUT.format('')} a.llm_policy_status IS NULL", ("items", "catalog"))
def select_policy_targets(spark: SparkSession, sf: str) -> DataFrame:
    return Q.item_targets(frame(spark, sf, "items"), frame(spark, sf, "catalog"), Q.Params())


@query(f"SELECT {_COLUMNS}, b.prodyear {_FANOUT.format("AND prodyear = '1998'")} (a.llm_event_status IS NULL OR a.llm_event_status <> 'PASS')", ("items", "catalog"))
def select_event_targets_retry(spark: SparkSession, sf: str) -> DataFrame:
    return Q.item_targets(frame(spark, sf, "items"), frame(spark, sf, "catalog"), Q.Params(prod_year="1998", retry=True), S.EVENT)


@query(f"SELECT {_COLUMNS}, b.prodyear {_FANOUT.format('')} a.llm_activity_status IS NULL", ("items", "catalog"))
def select_activity_targets(spark: SparkSession, sf: str) -> DataFrame:
    return Q.item_targets(frame(spark, sf, "items"), frame(spark, sf, "catalog"), Q.Params(), S.ACTIVITY)


_STATUSES = "a.llm_policy_status, a.llm_event_status, a.llm_activity_status"


@query(f"SELECT {_COLUMNS}, {_STATUSES}, b.prodyear {_FANOUT.format('')} (a.llm_policy_status IS NULL OR a.llm_event_status IS NULL OR a.llm_activity_status IS NULL)", ("items", "catalog"))
def select_subject_targets(spark: SparkSession, sf: str) -> DataFrame:
    return Q.subject_targets(frame(spark, sf, "items"), frame(spark, sf, "catalog"), Q.Params())


@query(f"SELECT t.*, subject, status FROM (SELECT {_COLUMNS}, {_STATUSES}, b.prodyear {_FANOUT.format('')} (a.llm_policy_status IS NULL OR a.llm_event_status IS NULL OR a.llm_activity_status IS NULL)) t, LATERAL (SELECT 'POLICY' AS subject, t.llm_policy_status AS status UNION ALL SELECT 'EVENT', t.llm_event_status UNION ALL SELECT 'ACTIVITY', t.llm_activity_status) s WHERE status IS NULL OR trim(status) = ''", ("items", "catalog"))
def subject_work(spark: SparkSession, sf: str) -> DataFrame:
    return Q.subject_work(select_subject_targets(spark, sf))


_YEAR = Q.Params(prod_year="1998")
_DEPT = f"SELECT {_COLUMNS}, {_FIRST} AS dept_nm, '1998' AS prodyear FROM items a JOIN (SELECT rc_rfile_no, rc_ritem_no FROM catalog WHERE transferyear = '2023' AND prodyear = '1998' GROUP BY ALL) b ON a.rc_rfile_no = b.rc_rfile_no AND a.rc_ritem_no = b.rc_ritem_no WHERE {_FIRST} IN {_IN}"


@query(_DEPT, ("items", "catalog"))
def select_department_items(spark: SparkSession, sf: str) -> DataFrame:
    return Q.department_items(frame(spark, sf, "items"), frame(spark, sf, "catalog"), _DEPARTMENTS, _YEAR)


@query(_DEPT.replace("'1998' AS prodyear", "a.prodyear").replace("rc_ritem_no FROM catalog", "rc_ritem_no, mngno FROM catalog"), ("items", "catalog"))
def select_department_sample(spark: SparkSession, sf: str) -> DataFrame:
    return Q.department_sample(frame(spark, sf, "items"), frame(spark, sf, "catalog"), _DEPARTMENTS, _YEAR)


@query(_DEPT + " AND (policy_cd IS NULL OR policy_cd = '' OR policy_nm IS NULL OR policy_nm = '해당없음')", ("items", "catalog"))
def select_department_unmapped(spark: SparkSession, sf: str) -> DataFrame:
    return Q.department_unmapped(frame(spark, sf, "items"), frame(spark, sf, "catalog"), _DEPARTMENTS, _YEAR)


@query(_DEPT.replace("'1998' AS prodyear", "a.prodyear, policy_cd, llm_policy_status, llm_policy_err_msg") + " AND policy_cd IS NULL AND (llm_policy_status IS NULL OR llm_policy_status <> 'PASS')", ("items", "catalog"))
def select_department_compare(spark: SparkSession, sf: str) -> DataFrame:
    return Q.department_compare(frame(spark, sf, "items"), frame(spark, sf, "catalog"), _DEPARTMENTS, _YEAR)


@query(f"SELECT min(rc_code) AS rc_code, rc_rfile_no, min(bnd_ttl) AS bnd_ttl, min(all_org_nm) AS all_org_nm, split_part(min(all_org_nm), ' ', 1) AS dept_nm, '1998' AS prodyear FROM items WHERE {_FIRST} IN {_IN} AND rc_rfile_no IN (SELECT rc_rfile_no FROM catalog WHERE transferyear = '2023' AND prodyear = '1998') GROUP BY rc_rfile_no", ("items", "catalog"))
def file_rollup_min(spark: SparkSession, sf: str) -> DataFrame:
    return Q.department_files(frame(spark, sf, "items"), frame(spark, sf, "catalog"), _DEPARTMENTS, _YEAR)


@query(f"SELECT {_COLUMNS}, {_FIRST} AS dept_nm, b.prodyear FROM items a JOIN (SELECT DISTINCT rc_rfile_no, prodyear FROM catalog WHERE transferyear = '2023' AND prodyear = '1998') b USING (rc_rfile_no) WHERE rc_rfile_no IN (SELECT rc_rfile_no FROM items WHERE {_FIRST} IN {_IN})", ("items", "catalog"))
def select_file_items(spark: SparkSession, sf: str) -> DataFrame:
    return Q.file_items(frame(spark, sf, "items"), frame(spark, sf, "catalog"), file_rollup_min(spark, sf), _YEAR)


_OTHER_CASE = "CASE detno % 3 WHEN 0 THEN upper(save_file_name) WHEN 1 THEN save_file_name || '  ' ELSE save_file_name END"
_LOOSE = "lower(rtrim({}, ' '))"


@query(f"SELECT transferyear, rc_rfile_no, rc_ritem_no, mngno, detno, prodyear, org_file_path, save_file_name FROM (SELECT * REPLACE ({_OTHER_CASE} AS save_file_name) FROM catalog) c WHERE transferyear = '2023' AND save_file_name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM extracts e WHERE {_LOOSE.format('e.rc_rfile_no')} = {_LOOSE.format('c.rc_rfile_no')} AND {_LOOSE.format('e.rc_ritem_no')} = {_LOOSE.format('c.rc_ritem_no')} AND {_LOOSE.format('e.file_name')} = {_LOOSE.format('c.save_file_name')} AND e.extract_status IN ('PASS', 'FAIL'))", ("catalog", "extracts"))
def select_extract_targets_collated(spark: SparkSession, sf: str) -> DataFrame:
    """The selection under the database's collation, over names in other cases and with blanks at the end."""
    catalog = frame(spark, sf, "catalog").withColumn("save_file_name", F.expr(_OTHER_CASE))
    return Q.plain(Q.extract_targets(Q.collated(catalog), Q.collated(frame(spark, sf, "extracts")), Q.Params()))


# Candidates

_NORM = "substr(replace(replace(replace(replace({}, '-', ''), '.', ''), '/', ''), ' ', ''), 1, 8)"
_DATE = "CASE WHEN coalesce(trim(prodregdate), '') = '' THEN '' WHEN length(regexp_replace(prodregdate, '[^0-9]', '', 'g')) >= 8 THEN substr(regexp_replace(prodregdate, '[^0-9]', '', 'g'), 1, 8) WHEN length(regexp_replace(prodregdate, '[^0-9]', '', 'g')) = 4 THEN regexp_replace(prodregdate, '[^0-9]', '', 'g') || '0101' ELSE prodregdate END"
_PRODYEAR = "CASE WHEN coalesce(trim(prodyear), '') = '' THEN '' WHEN length(regexp_replace(prodyear, '[^0-9]', '', 'g')) >= 4 THEN substr(regexp_replace(prodyear, '[^0-9]', '', 'g'), 1, 4) ELSE prodyear END"
_KEYS = f"keyed AS (SELECT DISTINCT cls_cd, {_DATE} AS production_date, {_PRODYEAR} AS production_year FROM items, (VALUES ('POLICY'), ('EVENT'), ('ACTIVITY')) v(cls_cd))"
_FOUND = f"found AS (SELECT k.production_date, k.production_year, c.* FROM keyed k JOIN codes c ON c.cls_cd = k.cls_cd AND CASE WHEN k.production_date <> '' THEN c.tern_start IS NOT NULL AND c.tern_end IS NOT NULL AND {_NORM.format('c.tern_start')} <= {_NORM.format('k.production_date')} AND {_NORM.format('c.tern_end')} >= {_NORM.format('k.production_date')} ELSE k.production_year <> '' AND c.start_year <= k.production_year AND c.end_year >= k.production_year END)"


def _keys(spark: SparkSession, sf: str) -> DataFrame:
    dates = frame(spark, sf, "items").select(X.production_date(F.col("prodregdate")).alias("production_date"), X.production_year(F.col("prodyear")).alias("production_year")).distinct()
    return dates.select(F.explode(F.array(*map(F.lit, S.SUBJECTS))).alias("cls_cd"), "production_date", "production_year")


@query()
def candidates_in_force(spark: SparkSession, sf: str) -> DataFrame:
    return Q.candidates(frame(spark, sf, "codes"), _keys(spark, sf)).select("cls_cd", "production_date", "production_year", *Q.CANDIDATE_COLUMNS)


ORACLES["candidates_in_force"] = f"WITH {ctes('items', 'codes')}, {_KEYS}, {_FOUND} SELECT cls_cd, production_date, production_year, item_cd, sub_cls_nm, topic_nm, prev_gov_nm, tern_start, tern_end, description FROM found"


@query()
def candidate_json(spark: SparkSession, sf: str) -> DataFrame:
    return Q.candidate_lists(frame(spark, sf, "codes"), _keys(spark, sf))


_OBJECT = "'{' || " + " || ',' || ".join(f"""'"{c.upper()}":' || coalesce('"' || replace(replace({c}, chr(92), chr(92) || chr(92)), '"', chr(92) || '"') || '"', 'null')""" for c in Q.CANDIDATE_COLUMNS) + " || '}'"
ORACLES["candidate_json"] = f"WITH {ctes('items', 'codes')}, {_KEYS}, {_FOUND} SELECT cls_cd, production_date, production_year, '[' || string_agg({_OBJECT}, ',' ORDER BY prev_gov_cd, sub_cls_cd, topic_cd, item_cd) || ']' AS candidates FROM found GROUP BY ALL"


@query("SELECT gov_task_no, gov_task_nm, detail_task_cd, detail_task_nm, direct_mapping_terms, conditional_mapping_terms, expand_candidate_terms, required_combine_terms, block_terms, note, lead_agency FROM codes WHERE cls_cd = 'POLICY' AND prev_gov_cd = 'LMB' AND lead_agency LIKE 'Brand#1%'", ("codes",))
def dictionary_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return Q.mapping_dictionary(frame(spark, sf, "codes"), "Brand#1")


@query("SELECT rc_code, rc_rfile_no, rc_ritem_no, 'Brand#' || substr(all_org_nm, 1, 1) AS agency, count(detail_task_cd) AS n_tasks, min(detail_task_cd) AS first_task FROM items LEFT JOIN (SELECT * FROM codes WHERE cls_cd = 'POLICY' AND prev_gov_cd = 'LMB') c ON starts_with(c.lead_agency, 'Brand#' || substr(all_org_nm, 1, 1)) GROUP BY ALL", ("items", "codes"))
def agency_dictionaries(spark: SparkSession, sf: str) -> DataFrame:
    """Each item with the dictionary of its own agency: how many tasks it has, and the first."""
    items = frame(spark, sf, "items").select(*S.ITEM_KEY, F.concat(F.lit("Brand#"), F.substring("all_org_nm", 1, 1)).alias("agency"))
    own = Q.dictionaries(frame(spark, sf, "codes"), items).groupBy("agency").agg(F.count("*").alias("n_tasks"), F.min("detail_task_cd").alias("first_task"))
    return items.join(own, "agency", "left").select(*S.ITEM_KEY, "agency", F.coalesce("n_tasks", F.lit(0).cast("long")).alias("n_tasks"), "first_task")


# Names, dates and text

_STEM = "regexp_replace(save_file_name, '(.)\\.[^.]*$', '\\1')"
_MARK = f"CASE WHEN regexp_matches(upper(list_filter(string_split({_STEM}, '_'), lambda t: regexp_matches(upper(t), '^[NS][0-9]'))[-1]), '^[NS]') THEN upper(list_filter(string_split({_STEM}, '_'), lambda t: regexp_matches(upper(t), '^[NS][0-9]'))[-1])[1] ELSE 'UNKNOWN' END"
_EXT = "lower(regexp_extract(coalesce(save_file_name, ''), '\\.([^.]+)$', 1))"
_TYPE = f"CASE {_EXT} WHEN 'hwp' THEN 'HWP' WHEN 'pdf' THEN 'PDF' WHEN 'docx' THEN 'WORD' WHEN '' THEN 'UNKNOWN' ELSE upper({_EXT}) END"


@query(f"SELECT rc_ritem_no, detno, save_file_name, {_EXT} AS extension, {_MARK} AS role_mark, {_TYPE} AS file_type, CASE {_EXT} WHEN 'hwp' THEN 'HWP' WHEN 'pdf' THEN 'PDF' WHEN 'docx' THEN 'OFFICE' ELSE 'ETC' END AS file_group, CASE WHEN {_MARK} <> 'UNKNOWN' THEN {_MARK} WHEN {_EXT} = 'zip' THEN 'ZIP' WHEN {_EXT} <> '' THEN {_TYPE} ELSE 'text/plain' END AS effective_type FROM catalog", ("catalog",))
def file_role_type(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("save_file_name")
    forced = F.when(X.extension(name) == "zip", "ZIP")
    return frame(spark, sf, "catalog").select("rc_ritem_no", "detno", name, X.extension(name).alias("extension"), X.role_mark(name).alias("role_mark"), X.file_type(name).alias("file_type"), X.file_group(name).alias("file_group"), X.effective_type(name, forced, F.lit("text/plain")).alias("effective_type"))


@query("SELECT rc_ritem_no, detno, save_file_name, CASE WHEN coalesce(trim(org_file_path), '') <> '' THEN CASE WHEN replace(org_file_path, chr(92), '/') LIKE '%/' THEN replace(org_file_path, chr(92), '/') || save_file_name ELSE replace(org_file_path, chr(92), '/') || '/' || save_file_name END ELSE '/base/' || transferyear || '/' || rc_rfile_no || '/' || rc_ritem_no || coalesce('/' || save_file_name, '') END AS path FROM catalog", ("catalog",))
def path_resolve(spark: SparkSession, sf: str) -> DataFrame:
    path = X.resolved_path(F.col("org_file_path"), F.col("save_file_name"), F.col("transferyear"), F.col("rc_rfile_no"), F.col("rc_ritem_no"), "/base", "2023")
    return frame(spark, sf, "catalog").select("rc_ritem_no", "detno", "save_file_name", path.alias("path"))


@query(f"SELECT rc_ritem_no, {_DATE} AS production_date, {_PRODYEAR} AS production_year, {_NORM.format('prodregdate')} AS term_date, TRY_CAST(nullif(trim(prodyear), '') AS INTEGER) AS data_year, {_FIRST} AS department, split_part(trim(jemok), ' ', 1) AS first_token FROM items", ("items",))
def normalize_dates(spark: SparkSession, sf: str) -> DataFrame:
    date, year = F.col("prodregdate"), F.col("prodyear")
    return frame(spark, sf, "items").select("rc_ritem_no", X.production_date(date).alias("production_date"), X.production_year(year).alias("production_year"), X.term_date(date).alias("term_date"), X.data_year(year, F.lit(None).cast("string")).alias("data_year"), X.department(F.col("all_org_nm")).alias("department"), X.first_token(F.col("jemok")).alias("first_token"))


_EDGE = "regexp_replace({}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
_CHUNK_TEXT = _EDGE.format("regexp_replace(regexp_replace(regexp_replace(replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[\\t\\x0B\\f]+', ' ', 'g'), '(?m)[ ]{2,}$', '', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")
_PLAIN_TEXT = _EDGE.format("regexp_replace(regexp_replace(regexp_replace(replace(text, chr(12), chr(10)), '[ \\t\\x0B\\f\\r]+', ' ', 'g'), '(?m)^\\s*[-–—]?\\s*\\d+\\s*[-–—]?\\s*$', '', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")


@query(f"SELECT doc_id, {_CHUNK_TEXT} AS for_chunks, {_PLAIN_TEXT} AS extracted FROM documents")
def text_normalize(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", X.normalize_for_chunks(text).alias("for_chunks"), X.normalize_extracted(text).alias("extracted"))


@query("SELECT doc_id, CAST(CASE WHEN regexp_matches(coalesce(text, ''), '\\S') THEN greatest(1, len(regexp_extract_all(text, '[A-Za-z0-9_]+')) + ceil(len(regexp_extract_all(text, '[가-힣]')) / 2.5)) ELSE 0 END AS INTEGER) AS tokens FROM documents")
def token_estimate(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", X.token_estimate(F.col("text")).alias("tokens"))


_SAMPLE = "substr(coalesce(text, ''), 1, 20000)"
_ROWS = f"string_split(regexp_replace({_SAMPLE}, '\\n+$', ''), chr(10))"


@query(f"SELECT doc_id, CAST(len(regexp_extract_all({_SAMPLE}, '제\\s*\\d+\\s*(장|절|관|조(?:\\s*의\\s*\\d+)?)')) + len(regexp_extract_all({_SAMPLE}, '[①②③④⑤⑥⑦⑧⑨⑩]')) AS INTEGER) AS law, CAST(len(regexp_extract_all({_SAMPLE}, '(?m)^((Ⅰ|Ⅱ|Ⅲ|Ⅳ|Ⅴ|Ⅵ|Ⅶ|Ⅷ|Ⅸ|Ⅹ)\\.|[0-9]+(\\.[0-9]+)*\\.|[가-하]\\.|[A-Z]\\.)\\s+.+$')) AS INTEGER) AS headings, len({_ROWS}) >= 5 AND len(list_filter({_ROWS}, lambda x: contains(x, '|') OR len(regexp_split_to_array(regexp_replace(x, '\\s{{2,}}$', ''), '\\s{{2,}}')) >= 4)) >= greatest(5, floor(len({_ROWS}) / 3)) AS table_like FROM documents")
def doc_type_scores(spark: SparkSession, sf: str) -> DataFrame:
    sample = F.substring(X.null_to_blank(F.col("text")), 1, S.TYPE_SAMPLE)
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", chunking.law_score(sample).cast("int").alias("law"), chunking.heading_score(sample).alias("headings"), chunking.table_like(sample).alias("table_like"))


# Chunks


@query()
def chunk_documents(spark: SparkSession, sf: str) -> DataFrame:
    sources = frame(spark, sf, "doc_extracts").where(F.col("extract_status") == S.PASS).withColumnRenamed("idx", "extract_idx")
    return chunking.chunk_documents(sources)


@query()
def chunk_statistics(spark: SparkSession, sf: str) -> DataFrame:
    found = chunk_documents(spark, sf).groupBy("doc_type")
    return found.agg(F.count("*").alias("n_chunks"), F.countDistinct("extract_idx").alias("n_documents"), F.sum("char_count").alias("chars"), F.max("char_count").alias("longest"), F.sum("token_count").alias("tokens"))


_KEPT = "SELECT extract_idx, 1 AS chunk_seq, 'old' AS chunk_text, 'READY' AS chunk_status FROM doc_chunks"
_DONE = "(SELECT idx, indexing_contents AS t FROM doc_extracts WHERE extract_status = 'FAIL' OR data_year = 2023)"


@query(f"SELECT * FROM ({_KEPT}) WHERE extract_idx NOT IN (SELECT idx FROM {_DONE}) UNION ALL SELECT idx, 0, 'No content to split', 'SKIP' FROM {_DONE} WHERE length(coalesce(t, '')) = 0 UNION ALL SELECT idx, CAST(seq AS INTEGER), substr(t, seq * 1000 - 999, 1000), 'READY' FROM (SELECT idx, t, unnest(range(1, CAST(ceil(length(t) / 1000) AS BIGINT) + 1)) AS seq FROM {_DONE})", ("doc_extracts", "doc_chunks"))
def chunk_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of failed and of recent documents give way to their whole texts in pieces of a thousand characters, or to a marker where there is no text."""
    old = frame(spark, sf, "doc_chunks").select("extract_idx", F.lit(1).alias("chunk_seq"), F.lit("old").alias("chunk_text"), F.lit(S.READY).alias("chunk_status"))
    done = frame(spark, sf, "doc_extracts").where((F.col("extract_status") == S.FAIL) | (F.col("data_year") == 2023)).select(F.col("idx").alias("extract_idx"), "indexing_contents")
    pieces = F.ceil(F.length("indexing_contents") / 1000).cast("int")
    seq = done.where(F.length("indexing_contents") > 0).select("extract_idx", "indexing_contents", F.explode(F.sequence(F.lit(1), pieces)).alias("chunk_seq"))
    made = seq.select("extract_idx", "chunk_seq", F.expr("substring(indexing_contents, chunk_seq * 1000 - 999, 1000)").alias("chunk_text"), F.lit(S.READY).alias("chunk_status"))
    return merge.replace_chunks(old, made, done)


@query(f"SELECT extract_idx, 'old' AS kind FROM ({_KEPT}) WHERE extract_idx NOT IN (SELECT idx FROM {_DONE}) UNION ALL SELECT idx, CASE WHEN regexp_matches(coalesce(t, ''), '\\S') THEN 'text' ELSE 'marker' END FROM {_DONE}", ("doc_extracts", "doc_chunks"))
def chunk_run(spark: SparkSession, sf: str) -> DataFrame:
    """The chunker's own chunks in place of the old ones, as what each document is left with: old chunks, chunks of its text or no more than a marker. Texts that the
    chunker finds nothing in (title pages) count by whether they have any."""
    old = frame(spark, sf, "doc_chunks").select("extract_idx", F.lit(1).alias("chunk_seq"), F.lit("old").alias("doc_type"), F.lit("old").alias("chunk_text"), F.lit(S.READY).alias("chunk_status"))
    done = frame(spark, sf, "doc_extracts").where((F.col("extract_status") == S.FAIL) | (F.col("data_year") == 2023)).select(F.col("idx").alias("extract_idx"), "file_name", "zip_entry_file_name", "indexing_contents")
    after = merge.replace_chunks(old, chunking.chunk_documents(done, marker=True), done, marked=True)
    left = after.groupBy("extract_idx").agg(F.min("chunk_seq").alias("least"), F.min("doc_type").alias("doc_type"), F.count("*").alias("n"))
    told = left.join(done.select("extract_idx", F.when(X.has_text(F.col("indexing_contents")), "text").otherwise("marker").alias("has")).distinct(), "extract_idx", "left")
    kind = F.when(F.col("has").isNull(), F.col("doc_type")).when(F.col("least") > 0, "text").otherwise(F.col("has"))
    return told.select("extract_idx", kind.alias("kind"))


# In SQL


@query("SELECT conv_id, CAST(n AS INTEGER) AS entry, name, value FROM (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM conversations), LATERAL (VALUES ('turn', CAST(turn AS VARCHAR)), ('role', role), ('text', text)) v(name, value)")
def sql_entries(spark: SparkSession, sf: str) -> DataFrame:
    """A conversation as one answer in JSON, and its entries by a table function, in SQL."""
    registered.register(spark)
    text = """SELECT c.conv_id, e.entry, e.name, e.value
      FROM (SELECT conv_id, to_json(array_sort(collect_list(named_struct('turn', turn, 'role', role, 'text', text))), map('ignoreNullFields', 'false')) AS answer FROM {turns} GROUP BY conv_id) c, LATERAL foliary_entries(c.answer) e"""
    return spark.sql(text, turns=spark.read.parquet(f"{sf}/conversations.parquet"))


@query(f"SELECT rc_ritem_no, {_DATE} AS production_date, {_PRODYEAR} AS production_year, split_part(all_org_nm, ' ', 1) AS department FROM items", ("items",))
def sql_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Forms of the items' columns by functions in SQL."""
    registered.register(spark)
    return spark.sql("SELECT rc_ritem_no, foliary_production_date(prodregdate) AS production_date, foliary_production_year(prodyear) AS production_year, foliary_first_token(all_org_nm) AS department FROM {items}", items=frame(spark, sf, "items"))


@query()
def sql_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of all documents by a table function, in SQL."""
    registered.register(spark)
    docs = registered.prepared(frame(spark, sf, "doc_extracts").withColumnRenamed("idx", "extract_idx"), "sql_chunks_sources")
    return spark.sql("SELECT s.extract_idx, c.chunk_seq, s.doc_type, c.chunk_text, foliary_token_estimate(c.chunk_text) AS token_count FROM {docs} s, LATERAL foliary_chunks(s.t, s.doc_type, 3500, 350) c", docs=docs)


# Keyed writes

_SUMMED = "SELECT rc_code, rc_rfile_no, rc_ritem_no, {} FROM items"


@query(_SUMMED.format("CASE WHEN o_error IS NULL THEN code ELSE policy_cd END AS policy_cd, CASE WHEN o_error IS NULL THEN name ELSE policy_nm END AS policy_nm, CASE WHEN o_error IS NULL THEN 'PASS' ELSE 'FAIL' END AS llm_policy_status, CASE WHEN o_error IS NOT NULL THEN substr(o_error, 1, 100) WHEN name IN ('제외', '검토 필요', '간접 관련 없음') THEN 'because ' || rc_code END AS llm_policy_err_msg").replace("FROM items", "FROM (SELECT *, CASE WHEN llm_event_status = 'FAIL' THEN repeat(rc_ritem_no || ' ', 40) END AS o_error, 'N' || rc_code AS code, CASE rc_code WHEN 'C0' THEN '제외' WHEN 'C1' THEN '검토 필요' ELSE 'new' END AS name FROM items)"), ("items",))
def status_update_case(spark: SparkSession, sf: str) -> DataFrame:
    items = frame(spark, sf, "items")
    results = items.select(*S.ITEM_KEY, F.when(F.col("llm_event_status") == S.FAIL, F.repeat(F.concat("rc_ritem_no", F.lit(" ")), 40)).alias("error"), F.concat(F.lit("N"), "rc_code").alias("code"), F.when(F.col("rc_code") == "C0", "제외").when(F.col("rc_code") == "C1", "검토 필요").otherwise("new").alias("name"), F.concat(F.lit("because "), "rc_code").alias("reason"))
    return merge.item_results(items, results).select(*S.ITEM_KEY, *merge.RESULT_COLUMNS[S.POLICY])


@query(", ".join(["WITH " + ctes("items"), "decided AS (SELECT rc_rfile_no, min(policy_cd) AS code, min(policy_nm) AS name FROM items WHERE policy_cd <> '' AND policy_nm <> '해당없음' GROUP BY rc_rfile_no)"]) + " SELECT rc_code, i.rc_rfile_no, rc_ritem_no, coalesce(d.code, policy_cd) AS policy_cd, coalesce(d.name, policy_nm) AS policy_nm, CASE WHEN d.code IS NULL THEN llm_policy_status ELSE 'PASS' END AS llm_policy_status FROM items i LEFT JOIN decided d ON d.rc_rfile_no = i.rc_rfile_no")
def file_decision_propagate(spark: SparkSession, sf: str) -> DataFrame:
    items = frame(spark, sf, "items")
    decided = items.where(Q.determined(F.col("policy_cd"), F.col("policy_nm"))).groupBy("rc_rfile_no").agg(F.min("policy_cd").alias("code"), F.min("policy_nm").alias("name"))
    return merge.propagate_files(items, decided).select(*S.ITEM_KEY, "policy_cd", "policy_nm", "llm_policy_status")


@query("SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, CASE WHEN n.doc_id IS NULL THEN o.lang ELSE n.lang END AS lang, CASE WHEN o.doc_id IS NULL THEN n.summary ELSE o.summary END AS summary FROM (SELECT doc_id, 'old' AS lang, 'kept' AS summary FROM labels) o FULL JOIN (SELECT doc_id, lang, 'new' AS summary FROM documents) n ON o.doc_id = n.doc_id")
def upsert_documents(spark: SparkSession, sf: str) -> DataFrame:
    old = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.lit("old").alias("lang"), F.lit("kept").alias("summary"))
    new = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", F.lit("new").alias("summary"))
    return merge.merged(old, new, ("doc_id",), keep=("summary",))


# Files, letters and columns


@query(ORACLES["upsert_documents"])
def bucketed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The same upsert into a table of buckets, of which those without a change stay as they are."""
    old = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.lit("old").alias("lang"), F.lit("kept").alias("summary"))
    new = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", F.lit("new").alias("summary"))
    table = keyed.KeyedTable(spark, shared.scratch(spark), old.schema, "doc_id", 16).create(old)
    table.merge(new, lambda before, changes, flag: merge.merged(before, changes, ("doc_id",), keep=("summary",), flag=flag))
    return table.read()


@query()
def html_text(spark: SparkSession, sf: str) -> DataFrame:
    return files.page_text(spark.read.parquet(f"{sf}/pages.parquet"), keep=("page_id", "url"))


@query()
def page_chunks(spark: SparkSession, sf: str) -> DataFrame:
    text = files.page_text(spark.read.parquet(f"{sf}/pages.parquet"), keep=("page_id",))
    sources = text.select(F.col("page_id").alias("extract_idx"), F.lit("page.html").alias("file_name"), F.lit(None).cast("string").alias("zip_entry_file_name"), F.col("text").alias("indexing_contents"))
    return chunking.chunk_documents(sources)


_LETTER = "concat('제목 | ', jemok, ' | 1. 본문', chr(10), '시행 | ', rc_code, '-', substr(rc_ritem_no, 2), ' | (', prodregdate, '.) | 접수 | ', all_org_nm, chr(10), bnd_ttl, ' 끝.', chr(10), 'tail')"
_DATED = "prodregdate LIKE '____-__-__' OR prodregdate LIKE '____.__.__'"


@query(f"SELECT rc_ritem_no, jemok AS hwp_sub_title, CASE WHEN {_DATED} THEN rc_code || '-' || substr(rc_ritem_no, 2) END AS implement_org, CASE WHEN {_DATED} THEN replace(prodregdate, '.', '-') END AS implement_date, CAST(NULL AS VARCHAR) AS receipt_org, 'File ' || substr(rc_rfile_no, 2) || ' 끝.' AS body FROM items", ("items",))
def letter_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Letters written from all items, with their date as it stands, and read again: a number whose date can't be read isn't one."""
    rows = frame(spark, sf, "items").select("rc_ritem_no", F.lit("1_2_N01.hwp").alias("name"), F.expr(_LETTER).alias("text"))
    found = letters.with_letters(rows.withColumn("body", F.col("text")), file_name="name", contents="text", indexing="body")
    return found.select("rc_ritem_no", "hwp_sub_title", "implement_org", "implement_date", "receipt_org", "body")


_SIDES = "SELECT l_orderkey AS doc_id, l_linenumber AS n, 'p' || l_partkey AS text, CAST(CAST(floor(round(l_discount * 5000, 6)) AS INTEGER) AS DOUBLE) AS x FROM lineitem"
_SIDES = f"SELECT *, x - max(x + 90) OVER (PARTITION BY doc_id, n ORDER BY x, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 72 AS new FROM ({_SIDES})"
_SIDES = f"SELECT *, count(*) FILTER (new) OVER (PARTITION BY doc_id, n ORDER BY x, text ROWS UNBOUNDED PRECEDING) AS s FROM ({_SIDES})"
_SIDES = f"SELECT doc_id, n, string_agg(text, ' ' ORDER BY x, text) AS text, min(x) AS min_x, max(x + 90) AS max_x FROM ({_SIDES}) GROUP BY doc_id, n, s"
_SIDES = f"SELECT *, CASE WHEN max_x < 300 THEN 1 WHEN min_x > 300 THEN 2 ELSE 0 END AS side FROM ({_SIDES})"
_SIDES = f"SELECT *, count(*) FILTER (side = 1) OVER p AS lefts, count(*) FILTER (side = 2) OVER p AS rights, min(n) FILTER (side > 0) OVER p AS top FROM ({_SIDES}) WINDOW p AS (PARTITION BY doc_id)"
_SIDES = f"SELECT *, CASE WHEN least(lefts, rights) < 3 THEN 0 WHEN side > 0 THEN side WHEN n < top THEN 0 ELSE 3 END AS part FROM ({_SIDES})"


@query(f"SELECT doc_id, 1 AS page, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY part, n, min_x, text) AS INTEGER) AS line, text, min_x, max_x, n * 10.0::DOUBLE AS min_y, n * 10.0::DOUBLE + 8 AS max_y FROM ({_SIDES})")
def pdf_column_order(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as text runs of pages: an order is a page."""
    rows = spark.read.parquet(f"{sf}/lineitem.parquet")
    x = F.floor(F.round(F.col("l_discount") * 5000, 6)).cast("double")
    runs = rows.select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page"), F.concat(F.lit("p"), "l_partkey").alias("text"), x.alias("min_x"), (x + 90).alias("max_x"), (F.col("l_linenumber") * 10.0).alias("min_y"), (F.col("l_linenumber") * 10.0 + 8).alias("max_y"), F.lit(600.0).alias("page_width"))
    return columns.reading_order(runs)


@query("SELECT conv_id, turn, 1 AS zip_seq, role || '.txt' AS entry_name, 'PASS' AS status, length(regexp_replace(text, '[\\x00-\\x20]+$', '')) > 0 AS has_text FROM conversations")
def zip_expand(spark: SparkSession, sf: str) -> DataFrame:
    """Turns packed as archives of one file and opened again."""
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    done = files.parse_files(rows.withColumn("save_file_name", F.lit("turn.zip")), keep=("conv_id", "turn"), inputs=("role", "text"), content=files.parsers.packed)
    return done.select("conv_id", "turn", "zip_seq", "entry_name", "status", X.has_text(F.col("contents")).alias("has_text"))


# Prompts and answers

_JSON_ESCAPED = "replace(replace(replace(replace(replace({}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't')"


@query(f"SELECT conv_id, turn, 'Q ' || coalesce(role, '') || ' raw ' || coalesce(text, '') || ' json \"' || {_JSON_ESCAPED.format("coalesce(text, '')")} || '\" none {{gap}}' AS prompt, substr(coalesce(text, ''), 1, 12000) AS cut FROM conversations")
def prompt_render(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    made = prompting.render('Q {ROLE} raw ${TEXT} json "{{TEXT}}" none {gap}', {"ROLE": F.col("role"), "TEXT": F.col("text")})
    return rows.select("conv_id", "turn", made.alias("prompt"), X.cut(F.col("text"), S.CONTENT_CHARS).alias("cut"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN 'Y' ELSE 'N' END AS flag, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN 'k is ' || json_extract_string(props, '$.k') ELSE '' END AS summary, event_type = 'error' AS failed FROM events")
def llm_json_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Answers written from events: fenced, wrapped and broken ones."""
    k = F.get_json_object("props", "$.k")
    inner = F.concat(F.lit('```json\n{"flag": "'), F.when(F.col("event_type") == "click", "y").otherwise("no"), F.lit('", "summary": " k is '), k, F.lit('"}\n```'))
    body = F.to_json(F.struct(F.array(F.struct(F.struct(inner.alias("content")).alias("message"))).alias("choices")))
    wrapped = F.concat(F.lit("response_data: "), F.to_json(F.struct(body.alias("response_data"))))
    response = F.when(F.col("event_type") == "error", "no json").when(F.col("event_type") == "view", wrapped).otherwise(body)
    answers = spark.read.parquet(f"{sf}/events.parquet").select("event_id", response.alias("response"), F.lit(None).cast("string").alias("call_error"))
    return responses.parse_summaries(answers).select("event_id", "flag", "summary", F.col("error").isNotNull().alias("failed"))


_RULES = "(SELECT DISTINCT detail_task_cd, direct_mapping_terms AS d, conditional_mapping_terms AS c, expand_candidate_terms AS e FROM codes WHERE cls_cd = 'POLICY' AND prev_gov_cd = 'LMB' AND lead_agency LIKE 'Brand#1%')"


@query(f"SELECT rc_code, rc_rfile_no, rc_ritem_no, coalesce(max(CASE r WHEN 0 THEN '직접' WHEN 1 THEN '검토' ELSE '제외' END) FILTER (r = m), '후보없음') AS decision FROM (SELECT i.*, r, min(r) OVER (PARTITION BY rc_ritem_no) AS m FROM items i LEFT JOIN LATERAL (SELECT CASE WHEN contains(t.ttl, lower(d)) THEN CASE WHEN contains(t.ttl, 'lease') THEN 1 ELSE 0 END WHEN contains(t.ttl, 'lease') THEN 2 WHEN contains(t.ttl, lower(c)) AND contains(t.ttl, 'plan') THEN 0 ELSE 1 END AS r FROM (SELECT lower(i.bnd_ttl || ' ' || i.jemok) AS ttl) t, {_RULES} z WHERE contains(t.ttl, lower(d)) OR contains(t.ttl, lower(c)) OR contains(t.ttl, lower(e))) ON true) GROUP BY rc_code, rc_rfile_no, rc_ritem_no", ("items", "codes"))
def rule_mapping(spark: SparkSession, sf: str) -> DataFrame:
    found = rules.map_by_rules(frame(spark, sf, "items"), Q.mapping_dictionary(frame(spark, sf, "codes"), "Brand#1"))
    return found.select(*S.ITEM_KEY, "decision")


# Runs

_EVENT_STATUS = "CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAIL' ELSE 'RUNNING' END"


@query(f"SELECT user_id AS run_id, status, CAST(loop_count AS BIGINT) AS loop_count FROM (SELECT user_id, {_EVENT_STATUS} AS status, event_id AS loop_count, row_number() OVER (PARTITION BY user_id ORDER BY {_EVENT_STATUS} = 'RUNNING', CASE WHEN {_EVENT_STATUS} = 'RUNNING' THEN -epoch_us(ts) ELSE epoch_us(ts) END) AS n FROM events) WHERE n = 1")
def run_ledger_status(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a ledger: each user a run, purchases and errors its ends."""
    zero = F.lit(0).cast("bigint")
    events = spark.read.parquet(f"{sf}/events.parquet").select(F.col("user_id").alias("run_id"), F.col("ts").alias("at"), F.expr(_EVENT_STATUS).alias("status"), F.col("event_id").alias("loop_count"), zero.alias("total_target_count"), zero.alias("total_success_count"), zero.alias("total_fail_count"), F.lit(None).cast("string").alias("error_msg"))
    return ledger.run_states(events).select("run_id", "status", "loop_count")


@query("SELECT event_type AS subject, count(*) AS total_target_count, count(*) FILTER (value >= 5) AS total_success_count, count(*) FILTER (value < 5) AS total_fail_count FROM events GROUP BY event_type")
def run_tally(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_type").alias("subject"), F.when(F.col("value") >= 5, S.PASS).otherwise(S.FAIL).alias("status"))
    return ledger.tally(rows, "subject")


@query()
def subject_run(spark: SparkSession, sf: str) -> DataFrame:
    """A run of one subject with a client that answers from the prompt itself."""
    items, catalog = frame(spark, sf, "items"), frame(spark, sf, "catalog")
    targets = Q.item_targets(items, catalog, Q.Params())
    after, _ = workflow.subject_run(items, targets, '{"title": "{{JEMOK}}"}', workflow_client, S.POLICY)
    return after.select(*S.ITEM_KEY, *merge.RESULT_COLUMNS[S.POLICY])


def workflow_client():
    """A stub: the policy is the title's last word."""

    def send(body: str) -> str:
        title = json.loads(json.loads(body)["messages"][1]["content"])["title"]
        return json.dumps({"choices": [{"text": json.dumps({"ITEM_CD": "X", "POLICY": title.split()[-1], "REASON": "stub"})}]})

    return send


_ASKED = "(SELECT DISTINCT a.rc_ritem_no FROM items a JOIN catalog b ON a.rc_rfile_no = b.rc_rfile_no AND a.rc_ritem_no = b.rc_ritem_no WHERE b.transferyear = '2023' AND a.llm_policy_status IS NULL)"
ORACLES["subject_run"] = f"WITH {ctes('items', 'catalog')} SELECT rc_code, rc_rfile_no, i.rc_ritem_no, CASE WHEN q.rc_ritem_no IS NULL THEN policy_cd ELSE 'X' END AS policy_cd, CASE WHEN q.rc_ritem_no IS NULL THEN policy_nm ELSE string_split(jemok, ' ')[-1] END AS policy_nm, CASE WHEN q.rc_ritem_no IS NULL THEN llm_policy_status ELSE 'PASS' END AS llm_policy_status, CASE WHEN q.rc_ritem_no IS NULL THEN llm_policy_err_msg END AS llm_policy_err_msg FROM items i LEFT JOIN {_ASKED} q ON q.rc_ritem_no = i.rc_ritem_no"


def careful_client():
    """A stub that fails on leases; the code is the subject's, the name the title's last word."""
    answer = workflow_client()

    def send(body: str) -> str:
        if "lease" in body:
            raise TimeoutError("no answer")
        return answer(body)

    return send


_LEASE = "jemok LIKE '%lease%'"
_WANTED = f"(SELECT DISTINCT rc_code, rc_rfile_no, i.rc_ritem_no, {_LEASE} AS bad FROM items i JOIN {_ASKED} q ON q.rc_ritem_no = i.rc_ritem_no)"


@query(f"SELECT 'run' AS kind, CASE WHEN bool_or(bad) THEN 'PARTIAL' ELSE 'SUCCESS' END AS status, count(*) AS targets, count(*) FILTER (NOT bad) AS passed, count(*) FILTER (bad) AS failed FROM {_WANTED} UNION ALL SELECT 'log', CASE WHEN bad THEN 'FAIL' ELSE 'PASS' END, count(*), count(*) FILTER (NOT bad), count(*) FILTER (bad) FROM {_WANTED} GROUP BY bad UNION ALL SELECT 'calls', CASE WHEN bad THEN 'TimeoutError: no answer' ELSE 'PASS' END, count(*), count(*) FILTER (NOT bad), count(*) FILTER (bad) FROM {_WANTED} GROUP BY bad UNION ALL SELECT 'items', coalesce(CASE WHEN bad THEN 'FAIL' WHEN NOT bad THEN 'PASS' ELSE llm_policy_status END, 'OPEN'), count(*), count(*) FILTER (coalesce(NOT bad, false)), count(*) FILTER (coalesce(bad, false)) FROM items i LEFT JOIN {_WANTED} w USING (rc_code, rc_rfile_no, rc_ritem_no) GROUP BY 2", ("items", "catalog"))
def accounted_run(spark: SparkSession, sf: str) -> DataFrame:
    """A run of one subject under the ledger: what its ledger, its log, its journal of calls and the items after it say."""
    items, catalog, path = frame(spark, sf, "items"), frame(spark, sf, "catalog"), shared.scratch(spark)
    targets = Q.item_targets(items, catalog, Q.Params())
    after = workflow.accounted(
        spark, ledger.Registry(), ledger.RunKey("POLICY_ALL", S.POLICY, "2023"), path,
        lambda run: workflow.subject_answers(targets, '{"title": "{{JEMOK}}"}', careful_client, S.POLICY, journal=run.journal, after_slice=run.progress),
        lambda results: merge.item_results(items, results, S.POLICY),
        lambda results, run_id: ledger.item_log(results.withColumnRenamed("error", "error_msg"), run_id, S.POLICY),
    )
    own = targets.select(*S.ITEM_KEY).distinct().withColumn("asked", F.lit(True))
    count = lambda ok, bad: (F.count("*").alias("targets"), F.sum(F.when(ok, 1).otherwise(0)).alias("passed"), F.sum(F.when(bad, 1).otherwise(0)).alias("failed"))
    runs = ledger.run_states(spark.read.parquet(f"{path}/runs")).select(F.lit("run").alias("kind"), "status", F.col("total_target_count").alias("targets"), F.col("total_success_count").alias("passed"), F.col("total_fail_count").alias("failed"))
    log = spark.read.parquet(f"{path}/items").groupBy("status").agg(*count(F.col("status") == S.PASS, F.col("status") == S.FAIL)).select(F.lit("log").alias("kind"), "*")
    calls = _journal(spark, path).groupBy(F.coalesce("call_error", F.lit(S.PASS)).alias("status")).agg(*count(F.col("call_error").isNull(), F.col("call_error").isNotNull())).select(F.lit("calls").alias("kind"), "*")
    told = after.join(own, list(S.ITEM_KEY), "left").withColumn("status", F.coalesce("llm_policy_status", F.lit("OPEN")))
    told = told.groupBy("status").agg(*count(F.col("asked") & (F.col("status") == S.PASS), F.col("asked") & (F.col("status") == S.FAIL))).select(F.lit("items").alias("kind"), "*")
    return runs.unionByName(log).unionByName(calls).unionByName(told)


def _journal(spark: SparkSession, path: str) -> DataFrame:
    """The answers in the journals of all runs of a ledger."""
    return spark.read.schema("rc_code string, rc_rfile_no string, rc_ritem_no string, request string, response string, call_error string").parquet(f"{path}/journal/*/answers/slice=*")



@query("SELECT id, title, description FROM (SELECT doc_id AS id, CASE WHEN l.labelled IS NULL THEN lang ELSE 'changed' END AS title, source AS description FROM documents d LEFT JOIN (SELECT DISTINCT doc_id AS labelled FROM labels WHERE toxic = 0) l ON l.labelled = d.doc_id WHERE d.doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))")
def records_crud(spark: SparkSession, sf: str) -> DataFrame:
    """Records updated and deleted by id."""
    records = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("id"), F.col("lang").alias("title"), F.col("source").alias("description"))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    changed = labels.where("toxic = 0").select(F.col("doc_id").alias("id"), F.lit("changed").alias("title")).distinct()
    gone = labels.where("toxic = 1").select(F.col("doc_id").alias("id"))
    return merge.merged(records, changed, ("id",), insert=False).join(gone, "id", "left_anti")


# Sorted pages, logs, maps and messages


@query("SELECT id, lang FROM (SELECT doc_id AS id, lang FROM documents ORDER BY doc_id DESC LIMIT 50)")
def records_newest(spark: SparkSession, sf: str) -> DataFrame:
    """The page is the feature: the fifty records with the greatest ids."""
    return Q.page(spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("id"), "lang"), ("-id",), 50)


@query("SELECT rc_code, rc_rfile_no, rc_ritem_no, 'run' AS run_id, 'POLICY' AS subject_type, CASE WHEN llm_policy_status = 'FAIL' THEN 'FAIL' ELSE 'PASS' END AS status, substr(repeat(all_org_nm || ' ', 60), 1, 500) AS org_nm, substr(prodyear || '-12', 1, 4) AS prod_year, substr(repeat(policy_cd || ',', 30), 1, 50) AS detail_task_cd, substr(repeat(policy_nm || ',', 30), 1, 100) AS detail_task_nm, CASE WHEN llm_policy_status = 'FAIL' THEN repeat('e' || rc_code, 1333) || 'e' END AS error_msg, CAST(NULL AS VARCHAR) AS matching_terms FROM items", ("items",))
def item_log_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Log rows of all items, cut to the log's widths."""
    long = lambda c, end, n: F.repeat(F.concat(F.col(c), F.lit(end)), n)
    results = frame(spark, sf, "items").select(*S.ITEM_KEY, long("all_org_nm", " ", 60).alias("org_nm"), F.concat("prodyear", F.lit("-12")).alias("prod_year"), long("policy_cd", ",", 30).alias("detail_task_cd"), long("policy_nm", ",", 30).alias("detail_task_nm"), F.when(F.col("llm_policy_status") == S.FAIL, F.repeat(F.concat(F.lit("e"), "rc_code"), 2000)).alias("error_msg"))
    return ledger.item_log(results, "run", S.POLICY).select(*S.ITEM_KEY, "run_id", "subject_type", "status", "org_nm", "prod_year", "detail_task_cd", "detail_task_nm", "error_msg", "matching_terms")


@query("SELECT rc_rfile_no, rc_ritem_no, 'TEXT' AS subject_type, CASE WHEN extract_status = 'FAIL' THEN 'FAIL' ELSE 'PASS' END AS status, file_gubun AS detail_task_cd, file_name || coalesce(' / ' || zip_entry_file_name, '') AS detail_task_nm, CASE WHEN extract_status = 'FAIL' THEN 'broken' END AS error_msg FROM extracts", ("extracts",))
def text_log_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = frame(spark, sf, "extracts").withColumn("extract_err_msg", F.when(F.col("extract_status") == S.FAIL, "broken"))
    return ledger.text_log(rows, "run").select("rc_rfile_no", "rc_ritem_no", "subject_type", "status", "detail_task_cd", "detail_task_nm", "error_msg")


@query("SELECT o_orderkey, coalesce('{' || string_agg('\"img' || n || '\":\"/img/' || l_orderkey || '/' || l_linenumber || '.png\"', ',' ORDER BY n) FILTER (n IS NOT NULL) || '}', '[]') AS img_datas FROM orders LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS n FROM lineitem) ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def image_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as pictures of their order."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_linenumber")).alias("n"))
    paths = F.transform(F.coalesce("n", F.array().cast("array<int>")), lambda n: F.concat(F.lit("/img/"), F.col("o_orderkey").cast("string"), F.lit("/"), n.cast("string"), F.lit(".png")))
    return spark.read.parquet(f"{sf}/orders.parquet").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", X.image_map(paths).alias("img_datas"))


_AGENCY = "CASE user_id % 6 WHEN 0 THEN '환경부 ' WHEN 1 THEN '복지부' WHEN 2 THEN '보건복지부 ' WHEN 3 THEN ' 환경부' WHEN 4 THEN '' ELSE 'x복지부' END || event_type"


@query(f"SELECT event_id, CASE user_id % 6 WHEN 0 THEN '환경부' WHEN 1 THEN '복지부' WHEN 2 THEN '복지부' END AS agency, CASE user_id % 6 WHEN 0 THEN '환경부' WHEN 1 THEN '복지부' END AS strict FROM events")
def lead_agencies(spark: SparkSession, sf: str) -> DataFrame:
    name = F.expr(_AGENCY)
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", X.lead_agency(name).alias("agency"), X.lead_agency(name, strict=True).alias("strict"))


_ENTRIES = "SELECT gov_task_no, gov_task_nm, detail_task_cd, detail_task_nm, direct_mapping_terms, conditional_mapping_terms, expand_candidate_terms, required_combine_terms, block_terms, note, lead_agency FROM codes WHERE cls_cd = 'POLICY' AND prev_gov_cd = 'LMB' AND lead_agency LIKE 'Brand#1%'"
_ENTRY = "'{' || " + " || ',' || ".join(f"""'"{c.upper()}":' || coalesce('"' || {c} || '"', 'null')""" for c in "gov_task_no gov_task_nm detail_task_cd detail_task_nm direct_mapping_terms conditional_mapping_terms expand_candidate_terms required_combine_terms block_terms note lead_agency".split()) + " || '}'"


@query(f"SELECT coalesce('[' || string_agg({_ENTRY}, ',' ORDER BY detail_task_cd) || ']', '[]') AS dictionary FROM ({_ENTRIES})", ("codes",))
def dictionary_json(spark: SparkSession, sf: str) -> DataFrame:
    return Q.dictionary_json(dictionary_prefix(spark, sf))


@query(f"SELECT conv_id, turn, '{{\"model\":\"m\",\"messages\":[{{\"role\":\"system\",\"content\":\"sum up\"}},{{\"role\":\"user\",\"content\":\"File: ' || coalesce(role, '') || '\\nItem: ' || turn || '\\n\\n' || {_JSON_ESCAPED.format("substr(coalesce(text, ''), 1, 12000)")} || '\\n\\nas JSON\"}}],\"temperature\":0.2,\"stream\":false}}' AS request FROM conversations")
def summary_requests(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    user = prompting.summary_message(F.col("role"), F.col("turn").cast("string"), F.col("text"), "as JSON")
    return rows.select("conv_id", "turn", prompting.chat_request("m", F.lit("sum up"), user).alias("request"))


@query("SELECT rc_ritem_no, 'File ' || rc_rfile_no || ' of ' || coalesce(all_org_nm, '') || ': , {CANDIDATES}' AS of_file, 'Item ' || rc_ritem_no || ': ' || jemok AS of_item FROM items", ("items",))
def file_level_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """The same variables for a file as a whole, without the item's number and title, and for the item; a costly variable that no template names isn't made."""
    items = frame(spark, sf, "items")
    own = prompting.variables(items, prompting.ITEM_VARIABLES)
    of_file, of_item = "File {RC_RFILE_NO} of {{ALL_ORG_NM}}: ${RC_RITEM_NO}{JEMOK}, {CANDIDATES}", "Item {RC_RITEM_NO}: {JEMOK}"
    if prompting.mentions(of_item, "CANDIDATES"):
        raise AssertionError("the item's prompt names no candidates")
    return items.select("rc_ritem_no", prompting.render(of_file, prompting.file_level(own)).alias("of_file"), prompting.render(of_item, own).alias("of_item"))


# More answers and writes

_K = "json_extract_string(props, '$.k')"


def _answers(spark: SparkSession, sf: str, content) -> DataFrame:
    """Answers to events: content in a response's first choice, but for errors."""
    body = F.to_json(F.struct(F.array(F.struct(content.alias("text"))).alias("choices")))
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.when(F.col("event_type") == "error", "sorry").otherwise(body).alias("response"), F.lit(None).cast("string").alias("call_error"))


def _parsed(spark: SparkSession, sf: str, subject: str, name: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    content = F.concat(F.lit('so: {"item_cd": "I'), k, F.lit(f'", "{name}": "  N '), k, F.lit(' ", "reason": '), k, F.lit("} ok"))
    return responses.parse_subjects(_answers(spark, sf, content), subject).select("event_id", "error", "code", "name", "reason")


_PARSED = f"SELECT event_id, CASE WHEN event_type = 'error' THEN '{{}} response can''t be read: sorry' END AS error, CASE WHEN event_type <> 'error' THEN 'I' || {_K} END AS code, CASE WHEN event_type <> 'error' THEN 'N ' || {_K} END AS name, CASE WHEN event_type <> 'error' THEN {_K} END AS reason FROM events"


@query(_PARSED.format("EVENT"))
def event_answers(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf, S.EVENT, "event_name")


@query(_PARSED.format("ACTIVITY"))
def activity_answers(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf, S.ACTIVITY, "ACTIVITY_NAME")


@query(f"SELECT event_id, CASE WHEN event_type = 'error' THEN 'POLICY_DEPT response can''t be read: sorry' END AS error, CASE WHEN event_type <> 'error' THEN 'D ' || {_K} END AS name, CASE WHEN event_type <> 'error' THEN {_K} END AS code, CASE WHEN event_type <> 'error' THEN '[\"a\",\"' || {_K} || '\"]' END AS matching_terms, CASE WHEN event_type <> 'error' THEN '직접' END AS decision_value, CASE WHEN event_type <> 'error' THEN '' END AS criteria_type FROM events")
def department_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays whose first object counts, with names of fields in two languages."""
    k = F.get_json_object("props", "$.k")
    content = F.concat(F.lit('```json\n[1, {"후보 세부실천과제": "D '), k, F.lit('", "DETAIL_TASK_CD": '), k, F.lit(', "매칭어": ["a", "'), k, F.lit('"], "판정값": " 직접"}, {"DETAIL_TASK_CD": 0}]\n```'))
    return responses.parse_departments(_answers(spark, sf, content)).select("event_id", "error", "name", "code", "matching_terms", "decision_value", "criteria_type")


def _subject_update(spark: SparkSession, sf: str, subject: str) -> DataFrame:
    code, name, status, message = merge.RESULT_COLUMNS[subject]
    none = F.lit(None).cast("string")
    items = frame(spark, sf, "items").withColumns({code: F.lit("old"), name: none, message: F.lit("before")})
    results = items.where(F.col("llm_policy_status").isNotNull()).select(*S.ITEM_KEY, F.when(F.col("llm_policy_status") == S.FAIL, F.repeat(F.col("rc_ritem_no"), 200)).alias("error"), F.lit("new").alias("code"), F.lit("제외").alias("name"), F.lit("because").alias("reason"))
    return merge.item_results(items, results, subject).select(*S.ITEM_KEY, code, name, status, message)


_UPDATED = "SELECT rc_code, rc_rfile_no, rc_ritem_no, CASE WHEN llm_policy_status = 'PASS' THEN 'new' ELSE 'old' END AS {0}, CASE WHEN llm_policy_status = 'PASS' THEN '제외' END AS {1}, coalesce(llm_policy_status, {2}) AS {2}, CASE WHEN llm_policy_status = 'FAIL' THEN substr(repeat(rc_ritem_no, 200), 1, 500) WHEN llm_policy_status IS NULL THEN 'before' END AS {3} FROM items"


@query(_UPDATED.format(*merge.RESULT_COLUMNS[S.EVENT]), ("items",))
def event_update(spark: SparkSession, sf: str) -> DataFrame:
    return _subject_update(spark, sf, S.EVENT)


@query(_UPDATED.format(*merge.RESULT_COLUMNS[S.ACTIVITY]), ("items",))
def activity_update(spark: SparkSession, sf: str) -> DataFrame:
    return _subject_update(spark, sf, S.ACTIVITY)


@query("SELECT idx, CASE WHEN idx % 4 = 1 THEN 'old' WHEN idx % 4 = 0 THEN 'new' WHEN idx % 4 = 2 THEN NULL ELSE 'old' END AS implement_org, CASE WHEN idx % 4 IN (1, 3) THEN 'before' WHEN idx % 4 = 2 THEN '2020' END AS receipt_date, 'done' AS extract_status FROM extracts", ("extracts",))
def letter_update(spark: SparkSession, sf: str) -> DataFrame:
    """Extracts written again: the letter's columns change only where any of them has text."""
    old = frame(spark, sf, "extracts").withColumns({"implement_org": F.lit("old"), "implement_date": F.lit("old"), "receipt_org": F.lit("old"), "receipt_date": F.lit("before")})
    kind = F.col("idx") % 4
    new = old.select(*S.EXTRACT_KEY, F.lit("done").alias("extract_status"), F.when(kind == 0, "new").when(kind == 3, " ").alias("implement_org"), F.when(kind == 2, "2020").alias("receipt_date")).distinct()
    extra = {c: F.lit(None).cast("string") for c in ("summary", "llm_summary_err_msg", "create_date")}
    return merge.upsert_extracts(old.withColumns(extra), new).select("idx", "implement_org", "receipt_date", "extract_status")


@query(f"SELECT rc_ritem_no, file_name, CASE WHEN missing THEN '' ELSE {_PLAIN_TEXT} END AS contents, CASE WHEN missing THEN 'FAIL' ELSE 'PASS' END AS extract_status, CASE WHEN missing THEN 'FILE_NOT_FOUND: no such file: ' || file_name END AS extract_err_msg, CASE WHEN missing OR NOT regexp_matches({_PLAIN_TEXT}, '\\S') THEN 'N' ELSE 'Y' END AS has_contents FROM (SELECT 'R' || conv_id AS rc_ritem_no, turn || '_N01.txt' AS file_name, turn % 7 = 3 AS missing, coalesce(text, '') AS text FROM conversations)")
def file_extracts(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as stored text files, some of which are gone: each gives a row, whatever becomes of it."""
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    gone = F.col("turn") % 7 == 3
    given = rows.select(F.lit("2023").alias("transferyear"), F.lit("F").alias("rc_rfile_no"), F.concat(F.lit("R"), "conv_id").alias("rc_ritem_no"), F.lit("2020").alias("prodyear"), F.concat("turn", F.lit("_N01.txt")).alias("save_file_name"), F.when(~gone, F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("content"))
    return files.extract_files(given).select("rc_ritem_no", "file_name", F.coalesce("contents", F.lit("")).alias("contents"), "extract_status", "extract_err_msg", "has_contents")


@query(ORACLES["file_extracts"])
def stored_extracts(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as files of their own, put into a store by their paths and read by the catalogue's; those that were never put there are rows too."""
    rows, base = spark.read.parquet(f"{sf}/conversations.parquet"), shared.scratch(spark)
    turns = rows.select(F.lit("2023").alias("transferyear"), F.lit("F").alias("rc_rfile_no"), F.concat(F.lit("R"), "conv_id").alias("rc_ritem_no"), F.lit("2020").alias("prodyear"), F.lit(None).cast("string").alias("org_file_path"), F.concat("turn", F.lit("_N01.txt")).alias("save_file_name"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"), "turn")
    path = X.resolved_path(F.col("org_file_path"), F.col("save_file_name"), F.col("transferyear"), F.col("rc_rfile_no"), F.col("rc_ritem_no"), base, "2023")
    stored.put_files(turns.where("turn % 7 <> 3").select(path.alias("path"), "data"), base)
    found = files.extract_files(files.scan_catalogued(turns.drop("data", "turn"), base))
    return found.select("rc_ritem_no", "file_name", F.coalesce("contents", F.lit("")).alias("contents"), "extract_status", "extract_err_msg", "has_contents")


@query("SELECT conv_id, turn, 'PASS' AS status, 'Conversation ' || conv_id || chr(10) || 'Turn (' || turn || ')' || chr(10) || 'by ' || role AS text FROM conversations")
def pdf_text(spark: SparkSession, sf: str) -> DataFrame:
    """Turns written as PDF files and read again; a small table is dealt over all cores first, since rows are short and files take long to read."""
    rows = files.spread(spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role"))
    lines = rows.select("conv_id", "turn", F.array(F.concat(F.lit("Conversation "), "conv_id"), F.concat(F.lit("Turn ("), "turn", F.lit(")")), F.concat(F.lit("by "), "role")).alias("lines"), F.lit("turn.pdf").alias("name"))
    done = files.parse_files(lines, keep=("conv_id", "turn"), name="name", inputs=("lines",), content=files.parsers.pdf.written)
    return done.select("conv_id", "turn", "status", F.regexp_replace(X.normalize_extracted(F.col("contents")), r"\s+$", "").alias("text"))


# More runs


@query()
def summary_run(spark: SparkSession, sf: str) -> DataFrame:
    """Summaries by a client that answers from the message itself."""
    none = F.lit(None).cast("string")
    extracts = frame(spark, sf, "extracts").withColumns({"summary": none, "llm_summary_err_msg": none})
    after, _ = workflow.summary_run(extracts, frame(spark, sf, "catalog"), frame(spark, sf, "items"), prompting.template("summary"), "as JSON", summary_client, Q.Params())
    return after.select(*S.EXTRACT_KEY, "summary_flag", "summary", "llm_summary_status", "llm_summary_err_msg")


def summary_client():
    """A stub: the summary is the message's first line, asked for where the item is a plan; leases are answered without JSON."""

    def send(body: str) -> str:
        first, item = json.loads(body)["messages"][1]["content"].split("\n")[:2]
        answer = "none" if "lease" in item else json.dumps({"flag": "y" if "plan" in item else "n", "summary": first})
        return json.dumps({"choices": [{"message": {"content": answer}}]})

    return send


_SUMMED_UP = "(SELECT z.file_name, z.rc_rfile_no, z.rc_ritem_no, z.zip_seq, min(a.bnd_ttl) AS bnd_ttl, min(a.jemok) AS jemok FROM " + _SUMMARY.format("z.summary_flag IS NULL AND z.llm_summary_status IS NULL").split(" FROM ", 1)[1] + " GROUP BY ALL)"
ORACLES["summary_run"] = f"WITH {ctes('extracts', 'catalog', 'items')} SELECT e.file_name, e.rc_rfile_no, e.rc_ritem_no, e.zip_seq, CASE WHEN jemok IS NULL THEN summary_flag WHEN jemok LIKE '%plan%' THEN 'Y' ELSE 'N' END AS summary_flag, CASE WHEN jemok LIKE '%lease%' THEN NULL WHEN jemok LIKE '%plan%' THEN 'File: ' || bnd_ttl WHEN jemok IS NOT NULL THEN '' END AS summary, CASE WHEN jemok IS NULL THEN llm_summary_status WHEN jemok LIKE '%lease%' THEN 'FAIL' ELSE 'PASS' END AS llm_summary_status, CASE WHEN jemok LIKE '%lease%' THEN 'SUMMARY response can''t be read: {{\"choices\": [{{\"message\": {{\"content\": \"none\"}}}}]}}' END AS llm_summary_err_msg FROM extracts e LEFT JOIN {_SUMMED_UP} q USING (file_name, rc_rfile_no, rc_ritem_no, zip_seq)"


@query()
def subjects_run(spark: SparkSession, sf: str) -> DataFrame:
    """Policy, event and activity, each where its own status is open."""
    none = F.lit(None).cast("string")
    extra = {c: none for s in (S.EVENT, S.ACTIVITY) for c in merge.RESULT_COLUMNS[s] if not c.endswith("status")}
    clients = {s: (lambda s=s: subject_client(s)) for s in S.SUBJECTS}
    after, _ = workflow.subjects_run(frame(spark, sf, "items").withColumns(extra), frame(spark, sf, "catalog"), dict.fromkeys(S.SUBJECTS, '{"title": "{{JEMOK}}"}'), clients, Q.Params())
    return after.select(*S.ITEM_KEY, *[c for s in S.SUBJECTS for c in merge.RESULT_COLUMNS[s][:3]])


def subject_client(subject: str):
    """A stub: the name is the title's last word, the code the subject."""
    name = {S.POLICY: "POLICY", S.EVENT: "event_name", S.ACTIVITY: "activity_name"}[subject]

    def send(body: str) -> str:
        title = json.loads(json.loads(body)["messages"][1]["content"])["title"]
        return json.dumps({"choices": [{"text": json.dumps({"ITEM_CD": subject, name: title.split()[-1]})}]})

    return send


_OPEN = {s: f"(q.rc_ritem_no IS NOT NULL AND coalesce(trim(llm_{s.lower()}_status), '') = '')" for s in S.SUBJECTS}
_THREE = ", ".join(f"CASE WHEN {_OPEN[s]} THEN '{s}' ELSE {old[0]} END AS {c[0]}, CASE WHEN {_OPEN[s]} THEN string_split(jemok, ' ')[-1] ELSE {old[1]} END AS {c[1]}, CASE WHEN {_OPEN[s]} THEN 'PASS' ELSE {c[2]} END AS {c[2]}" for s, c in merge.RESULT_COLUMNS.items() for old in [c if s == S.POLICY else ("NULL", "NULL")])
ORACLES["subjects_run"] = f"WITH {ctes('items', 'catalog')} SELECT rc_code, rc_rfile_no, i.rc_ritem_no, {_THREE} FROM items i LEFT JOIN (SELECT DISTINCT a.rc_ritem_no FROM items a JOIN catalog b ON a.rc_rfile_no = b.rc_rfile_no AND a.rc_ritem_no = b.rc_ritem_no WHERE b.transferyear = '2023' AND (a.llm_policy_status IS NULL OR a.llm_event_status IS NULL OR a.llm_activity_status IS NULL)) q ON q.rc_ritem_no = i.rc_ritem_no"


@query()
def department_run(spark: SparkSession, sf: str) -> DataFrame:
    """Files with an even number are decided as a whole; then the open items, of which those whose number ends with 7 fail."""
    even = F.col("rc_rfile_no").rlike("[02468]$")

    def of_files(rows: DataFrame) -> DataFrame:
        return rows.select("rc_rfile_no", F.lit(None).cast("string").alias("error"), F.when(even, "P").alias("code"), F.when(even, "whole").otherwise(S.NOT_APPLICABLE).alias("name"))

    def of_items(rows: DataFrame) -> DataFrame:
        return rows.select(*S.ITEM_KEY, F.when(F.col("rc_ritem_no").endswith("7"), "failed").alias("error"), F.lit("").alias("code"), F.lit("").alias("name"), F.lit("open").alias("reason"))

    after, _ = workflow.department_run(frame(spark, sf, "items"), frame(spark, sf, "catalog"), _DEPARTMENTS, of_files, of_items, _YEAR)
    return after.select(*S.ITEM_KEY, *merge.RESULT_COLUMNS[S.POLICY])


_WHOLE = f"SELECT rc_rfile_no FROM items WHERE {_FIRST} IN {_IN} AND rc_rfile_no IN (SELECT rc_rfile_no FROM catalog WHERE transferyear = '2023' AND prodyear = '1998') AND regexp_matches(rc_rfile_no, '[02468]$')"
_LEFT = f"(rc_rfile_no NOT IN ({_WHOLE}) AND policy_cd IS NULL AND (llm_policy_status IS NULL OR llm_policy_status <> 'PASS') AND {_FIRST} IN {_IN} AND (rc_rfile_no, rc_ritem_no) IN (SELECT (rc_rfile_no, rc_ritem_no) FROM catalog WHERE transferyear = '2023' AND prodyear = '1998'))"
ORACLES["department_run"] = f"WITH {ctes('items', 'catalog')} SELECT rc_code, rc_rfile_no, rc_ritem_no, CASE WHEN whole THEN 'P' WHEN late AND NOT bad THEN '' ELSE policy_cd END AS policy_cd, CASE WHEN whole THEN 'whole' WHEN late AND NOT bad THEN '' ELSE policy_nm END AS policy_nm, CASE WHEN whole THEN 'PASS' WHEN late AND bad THEN 'FAIL' WHEN late THEN 'PASS' ELSE llm_policy_status END AS llm_policy_status, CASE WHEN NOT whole AND late AND bad THEN 'failed' END AS llm_policy_err_msg FROM (SELECT *, rc_rfile_no IN ({_WHOLE}) AS whole, {_LEFT} AS late, rc_ritem_no LIKE '%7' AS bad FROM items)"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages to chunks, as statistics of each kind of document."""
    found = page_chunks(spark, sf_dir).groupBy("doc_type")
    return found.agg(F.count("*").alias("n_chunks"), F.countDistinct("extract_idx").alias("n_pages"), F.sum("char_count").alias("chars"), F.sum("token_count").alias("tokens"))
