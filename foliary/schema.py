"""Tables of the archive: Spark schemas, keys and the words that status columns hold."""

from __future__ import annotations

from pyspark.sql import types as T

PASS, FAIL = "PASS", "FAIL"
RUNNING, SUCCESS, PARTIAL = "RUNNING", "SUCCESS", "PARTIAL"
READY, SKIP = "READY", "SKIP"
POLICY, EVENT, ACTIVITY, ALL = "POLICY", "EVENT", "ACTIVITY", "ALL"
SUBJECTS = (POLICY, EVENT, ACTIVITY)
UNKNOWN = "UNKNOWN"
#: Text of the marker of a document without chunks.
NO_CONTENT = "No content to split"

#: Names of a policy that say that none was found.
NOT_APPLICABLE = "해당없음"
REASONED = ("제외", "검토 필요", "간접 관련 없음")

#: Defaults of the run parameters.
CHUNK_SIZE, OVERLAP, MIN_CHUNK, SHORT_CONTENT, COVER_CHARS, TYPE_SAMPLE = 3500, 350, 120, 300, 1500, 20_000
MAX_LOOP, BATCH = 10_000, 100
CONTENT_CHARS, SUMMARY_CHARS = 12_000, 500


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "timestamp": T.TimestampType()}


def _table(columns: str) -> T.StructType:
    """name type, name type, ... (a schema that needs no session)"""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(","))])


CATALOG = _table("transferyear string, rc_rfile_no string, rc_ritem_no string, mngno string, detno int, kikwancode string, prodyear string, org_file_path string, save_file_name string")
ITEMS = _table(
    "rc_code string, rc_rfile_no string, rc_ritem_no string, bnd_ttl string, jemok string, all_org_nm string, prodregdate string, prodyear string, "
    "policy_cd string, policy_nm string, llm_policy_status string, llm_policy_err_msg string, ex_event_cd string, ex_event_nm string, llm_event_status string, llm_event_err_msg string, "
    "activity_cd string, activity_nm string, llm_activity_status string, llm_activity_err_msg string"
)
EXTRACTS = _table(
    "idx bigint, file_name string, rc_rfile_no string, rc_ritem_no string, zip_seq int, zip_entry_file_name string, contents string, img_datas string, file_type string, file_gubun string, "
    "indexing_contents string, hwp_sub_title string, data_year int, has_contents string, extract_status string, extract_err_msg string, "
    "implement_org string, implement_date string, receipt_org string, receipt_date string, summary string, summary_flag string, llm_summary_status string, llm_summary_err_msg string"
)
CHUNKS = _table(
    "extract_idx bigint, chunk_seq int, doc_role string, doc_type string, section_path string, law_chapter string, law_section string, law_article_no string, law_article_title string, "
    "law_article_content string, chunk_text string, start_offset int, end_offset int, char_count int, token_count int, chunk_status string"
)
RUNS = _table(
    "run_id string, process_type string, transfer_year string, prod_year string, retry_fail string, batch_size int, max_loop int, loop_count int, status string, started_at timestamp, ended_at timestamp, "
    "total_target_count bigint, total_success_count bigint, total_fail_count bigint, error_msg string"
)
EXTRACT_KEY = ("file_name", "rc_rfile_no", "rc_ritem_no", "zip_seq")
ITEM_KEY = ("rc_code", "rc_rfile_no", "rc_ritem_no")

#: Widths at which the item log cuts its columns.
LOG_WIDTHS = {
    "org_nm": 500,
    "prod_year": 4,
    "gov_task_no": 500,
    "gov_task_nm": 500,
    "detail_task_cd": 50,
    "detail_task_nm": 100,
    "matching_terms": 500,
    "matching_source": 100,
    "criteria_type": 100,
    "decision_value": 50,
    "decision_reason": 500,
    "review_exclude_reason": 500,
    "error_msg": 4000,
}
#: Widths of error messages by sink.
ERROR_WIDTHS = {POLICY: 100, EVENT: 500, ACTIVITY: 500, "SUMMARY": 2000}
