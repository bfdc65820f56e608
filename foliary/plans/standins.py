"""The archive's tables out of the driver's test tables: one SQL text each, read by Spark and by the SQL that checks it.

They only rename and combine columns. All rows of the source table are there, but for `extracts`, which leaves out line items
whose l_returnflag is 'N' (catalogued files that nothing has been extracted from yet), and `doc_chunks`, which has the labels with toxic = 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_FILE = "CAST(CAST(floor({k} / 4) AS BIGINT) AS STRING)"
_NAME = "'R' || l_orderkey || '_' || l_linenumber || '_' || CASE WHEN l_returnflag = 'A' THEN 'N' WHEN l_returnflag = 'R' THEN 's' ELSE 'x' END || '0' || l_linenumber || CASE l_suppkey % 6 WHEN 0 THEN '.hwp' WHEN 1 THEN '.PDF' WHEN 2 THEN '.docx' WHEN 3 THEN '.html' WHEN 4 THEN '.zip' ELSE '' END"

CATALOG = f"""SELECT CASE WHEN l_linestatus = 'O' THEN '2023' ELSE '2022' END AS transferyear, 'F' || {_FILE.format(k="l_orderkey")} AS rc_rfile_no, 'R' || l_orderkey AS rc_ritem_no,
  'M' || (l_suppkey % 3) AS mngno, CAST(l_linenumber AS INT) AS detno, 'K' || (l_partkey % 2) AS kikwancode, CAST(year(l_shipdate) AS STRING) AS prodyear,
  CASE WHEN l_tax >= 0.06 THEN NULL WHEN l_tax >= 0.04 THEN '' WHEN l_tax >= 0.02 THEN 'arc' || chr(92) || l_linenumber || chr(92) ELSE 'arc/' || l_linenumber END AS org_file_path,
  CASE WHEN l_discount >= 0.095 THEN NULL ELSE {_NAME} END AS save_file_name FROM {{lineitem}}"""

EXTRACTS = f"""SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS idx, {_NAME} AS file_name, 'F' || {_FILE.format(k="l_orderkey")} AS rc_rfile_no, 'R' || l_orderkey AS rc_ritem_no,
  CAST(0 AS INT) AS zip_seq, CAST(NULL AS STRING) AS zip_entry_file_name, 'HWP' AS file_type, 'HWP' AS file_gubun, CASE WHEN l_extendedprice < 20000 THEN '' WHEN l_extendedprice < 25000 THEN '  ' ELSE 'line ' || l_partkey END AS indexing_contents,
  CAST(NULL AS STRING) AS hwp_sub_title, CAST(year(l_shipdate) AS INT) AS data_year, CASE WHEN l_quantity < 20 THEN 'Y' ELSE 'N' END AS has_contents,
  CASE WHEN l_quantity < 25 THEN 'PASS' WHEN l_quantity < 40 THEN 'FAIL' ELSE NULL END AS extract_status,
  CASE WHEN l_tax < 0.03 THEN 'Y' WHEN l_tax < 0.05 THEN 'N' ELSE NULL END AS summary_flag, CASE WHEN l_tax < 0.02 THEN 'PASS' WHEN l_tax < 0.04 THEN 'FAIL' ELSE NULL END AS llm_summary_status
  FROM {{lineitem}} WHERE l_returnflag <> 'N'"""

_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
ITEMS = f"""SELECT 'C' || (o_custkey % 5) AS rc_code, 'F' || {_FILE.format(k="o_orderkey")} AS rc_rfile_no, 'R' || o_orderkey AS rc_ritem_no, 'File ' || {_FILE.format(k="o_orderkey")} AS bnd_ttl,
  'On a ' || CASE o_custkey % 4 WHEN 0 THEN 'small ring' WHEN 1 THEN 'infrared widgets' WHEN 2 THEN 'blue bolt' ELSE 'leave' END || ' and ' || CASE o_custkey % 3 WHEN 0 THEN 'lease' WHEN 1 THEN 'plan' ELSE 'old anvil' END AS jemok,
  replace(o_orderpriority, '-', ' ') AS all_org_nm,
  CASE o_custkey % 5 WHEN 0 THEN {_DAY} WHEN 1 THEN replace({_DAY}, '-', '.') WHEN 2 THEN replace({_DAY}, '-', '') WHEN 3 THEN substr({_DAY}, 1, 4) ELSE ' ' END AS prodregdate,
  CASE WHEN o_custkey % 7 = 0 THEN ' ' WHEN o_custkey % 7 = 1 THEN 'y' || CAST(year(o_orderdate) AS STRING) ELSE CAST(year(o_orderdate) AS STRING) END AS prodyear,
  CASE WHEN o_orderstatus = 'F' AND o_totalprice < 150000 THEN '' WHEN o_orderstatus = 'F' THEN 'P' || (o_custkey % 9) ELSE NULL END AS policy_cd,
  CASE WHEN o_orderstatus = 'F' AND o_totalprice >= 400000 THEN '해당없음' WHEN o_orderstatus = 'F' THEN 'Policy ' || (o_custkey % 9) ELSE NULL END AS policy_nm,
  CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'P' THEN 'FAIL' ELSE NULL END AS llm_policy_status, CAST(NULL AS STRING) AS llm_policy_err_msg,
  CASE o_custkey % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' WHEN 2 THEN '' ELSE NULL END AS llm_event_status, CASE WHEN o_totalprice < 200000 THEN 'PASS' ELSE NULL END AS llm_activity_status FROM {{orders}}"""

_PART = "CASE p_partkey % 4 WHEN 0 THEN '-' WHEN 1 THEN '.' WHEN 2 THEN '/' ELSE ' ' END"
CODES = f"""SELECT CASE p_size % 3 WHEN 0 THEN 'POLICY' WHEN 1 THEN 'EVENT' ELSE 'ACTIVITY' END AS cls_cd, 'I' || p_partkey AS item_cd, CASE WHEN p_retailprice < 1500 THEN 'LMB' ELSE 'NMH' END AS prev_gov_cd, 'Gov ' || p_size AS prev_gov_nm,
  p_type AS sub_cls_cd, CASE WHEN p_type = 'PROMO' THEN NULL ELSE 'Class ' || p_type END AS sub_cls_nm, p_name AS topic_cd, 'Topic ' || p_name AS topic_nm,
  CASE WHEN p_size = 50 THEN NULL ELSE CAST(1993 + p_size % 5 AS STRING) || {_PART} || lpad(CAST(1 + p_size % 12 AS STRING), 2, '0') || {_PART} || '01' END AS tern_start,
  CAST(1993 + p_size % 5 + CASE WHEN p_size % 10 = 0 THEN 2 ELSE 0 END AS STRING) || {_PART} || lpad(CAST(1 + p_size % 12 AS STRING), 2, '0') || {_PART} || '28' AS tern_end,
  CASE WHEN p_size = 49 THEN NULL ELSE CAST(1993 + p_size % 5 AS STRING) END AS start_year, CAST(1993 + p_size % 5 + CASE WHEN p_size % 10 = 0 THEN 2 ELSE 0 END AS STRING) AS end_year, 'About "' || p_name || '"' AS description,
  'G' || (p_size % 10) AS gov_task_no, 'Task ' || (p_size % 10) AS gov_task_nm, 'T' || p_partkey AS detail_task_cd, 'Detail ' || p_name AS detail_task_nm, p_name AS direct_mapping_terms, substr(p_name, 1, instr(p_name, ' ') - 1) AS conditional_mapping_terms,
  substr(p_name, instr(p_name, ' ') + 1) AS expand_candidate_terms, 'plan' AS required_combine_terms, 'lease' AS block_terms, CAST(NULL AS STRING) AS note, p_brand AS lead_agency FROM {{part}}"""

#: Documents as extracted texts; those with a quality label of 0 have failed, those with a toxicity label have chunks already.
DOCUMENTS = """SELECT doc_id AS idx, source || '_' || lang || '.txt' AS file_name, 'D' || source AS rc_rfile_no, 'L' || lang AS rc_ritem_no, CAST(0 AS INT) AS zip_seq, CAST(NULL AS STRING) AS zip_entry_file_name, 'TEXT' AS file_type, 'TEXT' AS file_gubun,
  text AS indexing_contents, CAST(NULL AS STRING) AS hwp_sub_title, CASE WHEN lang = 'en' THEN 2023 WHEN lang IS NULL THEN NULL ELSE 2022 END AS data_year, CASE WHEN l.quality = 0 THEN 'FAIL' ELSE 'PASS' END AS extract_status
  FROM {documents} d LEFT JOIN (SELECT doc_id AS labelled, min(quality) AS quality FROM {labels} GROUP BY doc_id) l ON d.doc_id = l.labelled"""
DOCUMENT_CHUNKS = "SELECT doc_id AS extract_idx FROM {labels} WHERE toxic = 0"

TABLES = {"catalog": CATALOG, "extracts": EXTRACTS, "items": ITEMS, "codes": CODES, "doc_extracts": DOCUMENTS, "doc_chunks": DOCUMENT_CHUNKS}
_SOURCES = ("lineitem", "orders", "part", "documents", "labels")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = TABLES[name]
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _SOURCES if f"{{{t}}}" in text})


def ctes(*names: str) -> str:
    """WITH clauses of these tables for the checking SQL."""
    return ", ".join(f"{n} AS ({TABLES[n].format(**{t: t for t in _SOURCES})})" for n in names)
