"""What is still to be done: selections over the catalogue, the items and the extracts, each one plan of joins.

All take and return DataFrames in the schemas of foliary.schema (extra columns are ignored). Order and page belong to the caller's
choice: without a limit a selection is the whole set, unordered; `page` sorts it and takes a slice (a top-k, no full sort).
Names compare by their bytes; a null name is never equal to another.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from foliary import schema as S
from foliary.functions.text import department, has_text, term_date
from foliary.sources import shared

FILE, ITEM = "rc_rfile_no", "rc_ritem_no"
_ITEM_COLUMNS = ("rc_code", FILE, ITEM, "bnd_ttl", "jemok", "all_org_nm", "prodregdate")


@dataclass(frozen=True)
class Params:
    """Parameters of a run, with the defaults that blank or out-of-range ones take."""

    transfer_year: str = "2023"
    prod_year: str | None = None
    retry: bool = False
    limit: int | None = None
    offset: int | None = None
    max_loop: int | None = None

    def resolved(self, year: str = "2023", limit: int = S.BATCH) -> Params:
        text = lambda s: s if s and s.strip() else None
        positive = lambda n, default: n if n is not None and n > 0 else default
        return Params(text(self.transfer_year) or year, text(self.prod_year), self.retry, positive(self.limit, limit), max(self.offset or 0, 0), positive(self.max_loop, S.MAX_LOOP))


def page(rows: DataFrame, order: Sequence[str], limit: int, offset: int = 0) -> DataFrame:
    """A slice of the rows by these columns (a minus before a name: from the greatest down), then by all others, so that it is the same in every run."""
    rest = [c for c in rows.columns if c not in {o.removeprefix("-") for o in order}]
    return rows.orderBy(*[F.col(o[1:]).desc() if o.startswith("-") else F.col(o) for o in order], *rest).offset(offset).limit(limit)


def unfinished(status: Column, retry: bool) -> Column:
    """Not yet tried; on retry, whatever hasn't passed."""
    return status.isNull() | (status != S.PASS) if retry else status.isNull()


#: How the archive's database compares names: without regard to case and to blanks at the end.
COLLATION = "UTF8_LCASE_RTRIM"


def collated(rows: DataFrame, *columns: str, collation: str = COLLATION) -> DataFrame:
    """rows with these text columns (none named: all) under a collation, which every comparison, grouping, join and order by them then follows; plain() takes it
    away. Names compare by bytes otherwise."""
    texts = [f.name for f in rows.schema if isinstance(f.dataType, StringType) and (not columns or f.name in columns)]
    return rows.withColumns({c: F.collate(F.col(f"`{c}`"), collation) for c in texts})


def plain(rows: DataFrame) -> DataFrame:
    return collated(rows, collation="UTF8_BINARY")


def extract_targets(catalog: DataFrame, extracts: DataFrame, p: Params) -> DataFrame:
    """Files of a transfer year that no extract row has settled."""
    settled = (S.PASS,) if p.retry else (S.PASS, S.FAIL)
    done = extracts.where(F.col("extract_status").isin(*settled)).select(FILE, ITEM, F.col("file_name").alias("save_file_name"))
    rows = catalog.where((F.col("transferyear") == p.transfer_year) & F.col("save_file_name").isNotNull())
    return rows.join(done, [FILE, ITEM, "save_file_name"], "left_anti").select("transferyear", FILE, ITEM, "mngno", "detno", "prodyear", "org_file_path", "save_file_name")


def chunk_targets(extracts: DataFrame, catalog: DataFrame, chunks: DataFrame, *, data_year: int | None = None, transfer_year: str | None = None, recreate: bool = False) -> DataFrame:
    """Extracted texts of a year or transfer that have no chunks yet (all of them if chunks are to be made anew)."""
    rows = extracts.where((F.col("extract_status") == S.PASS) & (F.trim("indexing_contents") != ""))
    if data_year is not None:
        rows = rows.where(F.col("data_year") == data_year)
    if transfer_year:
        rows = rows.join(catalog.where(F.col("transferyear") == transfer_year).select(FILE, ITEM), [FILE, ITEM], "left_semi")
    if not recreate:
        rows = rows.join(chunks.select(F.col("extract_idx").alias("idx")), "idx", "left_anti")
    return rows.select(F.col("idx").alias("extract_idx"), "file_name", "zip_entry_file_name", FILE, ITEM, "zip_seq", "file_type", "file_gubun", "indexing_contents", "hwp_sub_title", "data_year")


def summary_targets(extracts: DataFrame, catalog: DataFrame, items: DataFrame, p: Params) -> DataFrame:
    """Extracted texts with their file and item that have no summary yet."""
    z = extracts.where((F.col("extract_status") == S.PASS) & (F.col("has_contents") == "Y") & (F.col("indexing_contents") != ""))
    z = z.where(unfinished(F.col("llm_summary_status"), True) if p.retry else F.col("summary_flag").isNull() & F.col("llm_summary_status").isNull())
    z = z.select(FILE, ITEM, "file_name", "indexing_contents", "zip_seq", "zip_entry_file_name", "file_type", "file_gubun")
    b = catalog.where(F.col("transferyear") == p.transfer_year).select(FILE, ITEM, F.col("save_file_name").alias("file_name"), "prodyear", "org_file_path")
    a = items.select(*_ITEM_COLUMNS)
    return z.join(b, [FILE, ITEM, "file_name"]).join(a, [FILE, ITEM])


def _files(catalog: DataFrame, p: Params, *keys: str) -> DataFrame:
    """The distinct keys of the transfer's (and production year's) files."""
    rows = catalog.where(F.col("transferyear") == p.transfer_year)
    if p.prod_year:
        rows = rows.where(F.col("prodyear") == p.prod_year)
    return rows.select(*keys).distinct()


def item_targets(items: DataFrame, catalog: DataFrame, p: Params, subject: str = S.POLICY) -> DataFrame:
    """Items without a result for the subject, once for each management number, agency and year of their files (so an item can
    stand there more than once)."""
    status = {S.POLICY: "llm_policy_status", S.EVENT: "llm_event_status", S.ACTIVITY: "llm_activity_status"}[subject]
    files = _files(catalog, p, FILE, ITEM, "mngno", "kikwancode", "prodyear").select(FILE, ITEM, "prodyear")
    return items.where(unfinished(F.col(status), p.retry)).select(*_ITEM_COLUMNS).join(files, [FILE, ITEM])


def subject_targets(items: DataFrame, catalog: DataFrame, p: Params) -> DataFrame:
    """Items that lack a result for any subject, with their statuses."""
    names = ("llm_policy_status", "llm_event_status", "llm_activity_status")
    files = _files(catalog, p, FILE, ITEM, "mngno", "kikwancode", "prodyear").select(FILE, ITEM, "prodyear")
    pending = unfinished(F.col(names[0]), p.retry) | unfinished(F.col(names[1]), p.retry) | unfinished(F.col(names[2]), p.retry)
    return items.where(pending).select(*_ITEM_COLUMNS, *names).join(files, [FILE, ITEM])


def subject_work(targets: DataFrame, *, retry: bool = False) -> DataFrame:
    """A row for each target and subject that is to be worked on. Here a blank status counts as none, unlike in the selection."""
    each = F.array(*[F.struct(F.lit(s).alias("subject"), F.col(f"llm_{s.lower()}_status").alias("status")) for s in S.SUBJECTS])
    rows = targets.select("*", F.explode(each).alias("__s")).select(*targets.columns, "__s.subject", "__s.status")
    gate = F.coalesce(F.col("status") != S.PASS, F.lit(True)) if retry else ~has_text(F.col("status"))
    return rows.where(gate)


def department_items(items: DataFrame, catalog: DataFrame, departments: Sequence[str], p: Params) -> DataFrame:
    """Items of these departments with files of the transfer and production year; prodyear is the one asked for."""
    files = _files(catalog, p, FILE, ITEM)
    rows = items.where(department(F.col("all_org_nm")).isin(*departments)).join(files, [FILE, ITEM], "left_semi")
    return rows.select(*_ITEM_COLUMNS, department(F.col("all_org_nm")).alias("dept_nm"), F.lit(p.prod_year).alias("prodyear"))


def department_sample(items: DataFrame, catalog: DataFrame, departments: Sequence[str], p: Params) -> DataFrame:
    """The same, once for each management number, with the item's own year; statuses don't matter."""
    files = _files(catalog, p, FILE, ITEM, "mngno").select(FILE, ITEM)
    rows = items.where(department(F.col("all_org_nm")).isin(*departments)).select(*_ITEM_COLUMNS, department(F.col("all_org_nm")).alias("dept_nm"), "prodyear")
    return rows.join(files, [FILE, ITEM])


def department_unmapped(items: DataFrame, catalog: DataFrame, departments: Sequence[str], p: Params) -> DataFrame:
    """Department items whose policy is open: no code, no name, or the name that says so."""
    code, name = F.col("policy_cd"), F.col("policy_nm")
    return department_items(items.where(code.isNull() | (code == "") | name.isNull() | (name == S.NOT_APPLICABLE)), catalog, departments, p)


def department_compare(items: DataFrame, catalog: DataFrame, departments: Sequence[str], p: Params) -> DataFrame:
    """Department items that the file's decision has left open, with their own year and status."""
    rows = items.where(F.col("policy_cd").isNull() & unfinished(F.col("llm_policy_status"), True) & department(F.col("all_org_nm")).isin(*departments))
    rows = rows.join(_files(catalog, p, FILE, ITEM), [FILE, ITEM], "left_semi")
    return rows.select(*_ITEM_COLUMNS, department(F.col("all_org_nm")).alias("dept_nm"), "prodyear", "policy_cd", "llm_policy_status", "llm_policy_err_msg")


def department_files(items: DataFrame, catalog: DataFrame, departments: Sequence[str], p: Params) -> DataFrame:
    """One row for each file of these departments: least code, title and department of its items."""
    rows = items.where(department(F.col("all_org_nm")).isin(*departments)).join(_files(catalog, p, FILE), FILE, "left_semi")
    least = rows.groupBy(FILE).agg(*[F.min(c).alias(c) for c in ("rc_code", "bnd_ttl", "all_org_nm")])
    return least.select("rc_code", FILE, "bnd_ttl", "all_org_nm", department(F.col("all_org_nm")).alias("dept_nm"), F.lit(p.prod_year).alias("prodyear"))


def file_items(items: DataFrame, catalog: DataFrame, files: DataFrame, p: Params) -> DataFrame:
    """All items of the files given, once for each production year of the file."""
    years = _files(catalog, p, FILE, "prodyear").join(files.select(FILE).distinct(), FILE, "left_semi")
    return items.select(*_ITEM_COLUMNS, department(F.col("all_org_nm")).alias("dept_nm")).join(years, FILE)


def item_targets_of_files(items: DataFrame, catalog: DataFrame, p: Params) -> DataFrame:
    """rc_code, rc_rfile_no, rc_ritem_no of all items of the files of a transfer year, and of a production year if one is given."""
    files = catalog.where(F.col("transferyear") == p.transfer_year)
    if p.prod_year:
        files = files.where(F.col("prodyear") == p.prod_year)
    return items.select("rc_code", "rc_rfile_no", "rc_ritem_no").join(files.select("rc_rfile_no", "rc_ritem_no").distinct(), ["rc_rfile_no", "rc_ritem_no"], "left_semi")


_GROUP = ("cls_cd", "__by_date")


def _keyed(keys: DataFrame) -> DataFrame:
    """Distinct keys with the point that decides: their date if they have one, else their year."""
    date, year = F.col("production_date"), F.col("production_year")
    by_date = F.coalesce(date != "", F.lit(False))
    keyed = keys.select("cls_cd", "production_date", "production_year").distinct()
    return keyed.select("*", by_date.alias("__by_date"), F.when(by_date, term_date(date)).when(year != "", year).alias("__p")).where("__p IS NOT NULL AND cls_cd IS NOT NULL")


def _ranges(codes: DataFrame) -> DataFrame:
    """Codes with their bounds, by date and by year."""
    lo, hi = term_date(F.col("tern_start")), term_date(F.col("tern_end"))
    dated = codes.where(F.col("tern_start").isNotNull() & F.col("tern_end").isNotNull() & (lo <= hi)).select("*", lo.alias("__lo"), hi.alias("__hi"), F.lit(True).alias("__by_date"))
    lo, hi = F.col("start_year"), F.col("end_year")
    return dated.unionByName(codes.where(lo.isNotNull() & hi.isNotNull() & (lo <= hi)).select("*", lo.alias("__lo"), hi.alias("__hi"), F.lit(False).alias("__by_date")))


def _swept(keyed: DataFrame, ranges: DataFrame) -> DataFrame:
    """Points (kind 1) among lower and upper bounds (0 and 2) with the numbers of points and of bounds up to each."""
    points = keyed.select(*_GROUP, F.col("__p").alias("__at")).distinct()
    bounds = ranges.select(*_GROUP, F.explode(F.array(F.struct(F.col("__lo").alias("at"), F.lit(0).alias("kind")), F.struct(F.col("__hi").alias("at"), F.lit(2).alias("kind")))).alias("b")).select(*_GROUP, F.col("b.at").alias("__at"), F.col("b.kind").alias("__kind")).distinct()
    order = Window.partitionBy(*_GROUP).orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_point = F.col("__kind") == 1
    return points.withColumn("__kind", F.lit(1)).unionByName(bounds).withColumns({"__n": F.sum(F.when(is_point, 1).otherwise(0)).over(order).cast("long"), "__bounds": F.sum(F.when(is_point, 0).otherwise(1)).over(order).cast("long")})


def candidates(codes: DataFrame, keys: DataFrame) -> DataFrame:
    """For each distinct (cls_cd, production_date, production_year) of keys the codes that were in force: by date if the key has one
    (bounds and date compared as eight characters), else by year.

    The points of a class (its distinct dates or years) are numbered in their order, and one sweep over points and bounds gives each code the numbers from the first
    to the last point within its bounds. Such a stretch falls apart into few aligned stretches of 1, 2, 4, 8, ... points, and each point lies in one
    of either size, so points and codes are joined by equality on these: what meets is in force, each pair once, and there is nothing left to filter.
    """
    keyed, ranges, group = _keyed(keys), _ranges(codes), _GROUP
    swept = _swept(keyed, ranges)
    numbered = keyed.join(swept.where("__kind = 1").select(*group, F.col("__at").alias("__p"), (F.col("__n") - 1).alias("__i")), [*group, "__p"])
    first = swept.where("__kind = 0").select(*group, F.col("__at").alias("__lo"), F.col("__n").alias("__a"))
    past = swept.where("__kind = 2").select(*group, F.col("__at").alias("__hi"), F.col("__n").alias("__z"))
    placed = ranges.join(first, [*group, "__lo"]).join(past, [*group, "__hi"]).where("__a < __z")
    shifted = lambda x, k: F.call_function("shiftright", x, k)
    sizes = F.sequence(F.lit(0), F.lit(_SIZES - 1))
    whole = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1

    def ends(k: Column) -> Column:
        """The odd stretches of 2**k points at either end of what larger ones leave."""
        first_, past_ = shifted(F.col("__a") + whole(k), k), shifted(F.col("__z"), k)
        one = lambda yes, s: F.when((first_ < past_) & (yes % 2 == 1), F.struct(k.alias("k"), s.alias("s")))
        return F.array(one(first_, first_), one(past_, past_ - 1))

    dealt = placed.select("*", F.explode(F.array_compact(F.flatten(F.transform(sizes, ends)))).alias("__s")).drop("__lo", "__hi", "__a", "__z")
    levels = F.transform(sizes, lambda k: F.struct(k.alias("k"), shifted(F.col("__i"), k).alias("s")))
    met = numbered.select("*", F.explode(levels).alias("__s")).join(dealt, [*group, "__s"])
    return met.drop("__by_date", "__p", "__i", "__s")


#: Stretches of 1 to 2**31 points.
_SIZES = 32


#: Columns and order of the candidate list that a prompt holds.
CANDIDATE_COLUMNS = ("item_cd", "sub_cls_nm", "topic_nm", "prev_gov_nm", "tern_start", "tern_end", "description")
CANDIDATE_ORDER = ("prev_gov_cd", "sub_cls_cd", "topic_cd", "item_cd")


#: Bytes of lists that one task gives out; a longer list goes out alone.
LIST_BYTES = 1 << 26


def candidate_lists(codes: DataFrame, keys: DataFrame) -> DataFrame:
    """For each key with candidates() these as one JSON array of objects, nulls written, in the order of their codes.

    Keys between the same two bounds of validity have the same candidates, so a list is made once for each such stretch: its rows come sorted, and a task joins
    them one list after the other. The lists are written, and go from there to tasks of about LIST_BYTES each, with the keys that they are for."""
    spark, folder = keys.sparkSession, shared.scratch(keys.sparkSession)
    keyed = _keyed(keys)
    points = _swept(keyed, _ranges(codes)).where("__kind = 1").select(*_GROUP, F.col("__at").alias("__p"), "__bounds")
    placed, by_date, blank = keyed.join(points, [*_GROUP, "__p"]), F.col("__by_date"), F.lit("")
    least = placed.groupBy(*_GROUP, "__bounds").agg(F.when(by_date, F.min("production_date")).otherwise(blank).alias("__date"), F.when(by_date, blank).otherwise(F.min("production_year")).alias("__year"))
    placed.join(least, [*_GROUP, "__bounds"]).select("cls_cd", "production_date", "production_year", "__date", "__year").write.parquet(f"{folder}/keys")
    own = ("cls_cd", "__date", "__year")
    placed = spark.read.schema("cls_cd string, production_date string, production_year string, __date string, __year string").parquet(f"{folder}/keys")

    told = F.to_json(F.struct(*[F.col(c).alias(c.upper()) for c in CANDIDATE_COLUMNS]), {"ignoreNullFields": "false"})
    found = candidates(codes, placed.select("cls_cd", F.col("__date").alias("production_date"), F.col("__year").alias("production_year")))
    rows = found.select("cls_cd", F.col("production_date").alias("__date"), F.col("production_year").alias("__year"), *CANDIDATE_ORDER, told.alias("row"))
    rows = rows.repartition(*own).sortWithinPartitions(*own, *CANDIDATE_ORDER, "row").select(*own, "row")
    rows.mapInArrow(_joined, "cls_cd string, __date string, __year string, candidates string, bytes bigint").write.parquet(f"{folder}/lists")
    lists = spark.read.schema("cls_cd string, __date string, __year string, candidates string, bytes bigint").parquet(f"{folder}/lists")

    dealt, n = [], 0
    for r in lists.select(*own, "bytes").join(placed.groupBy(*own).count(), list(own)).collect():  # a row for each stretch, of which there are as many as bounds at most
        each = max(1, LIST_BYTES // r["bytes"])
        dealt.append((*[r[c] for c in own], each, n))
        n += -(-r["count"] // each)
    dealt = spark.createDataFrame(dealt, "cls_cd string, __date string, __year string, each bigint, first bigint")
    place = F.row_number().over(Window.partitionBy(*own).orderBy("production_date", "production_year")) - 1
    asked = placed.join(F.broadcast(dealt), list(own)).withColumn("task", (F.col("first") + F.floor(place / F.col("each"))).cast("int"))
    asked = asked.groupBy(*own, "task").agg(F.collect_list(F.struct("production_date", "production_year")).alias("keys"))
    given = lists.drop("bytes").join(F.broadcast(asked), list(own)).repartitionById(max(n, 1), F.col("task"))
    return given.select("cls_cd", "candidates", F.explode("keys").alias("k")).select("cls_cd", "k.production_date", "k.production_year", "candidates")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that come sorted by three columns: the fourth of those with the same three as one array, and its length in bytes."""
    at, held = None, []

    def made() -> pa.RecordBatch:
        text = f"[{','.join(held)}]"
        return pa.RecordBatch.from_arrays([*(pa.array([x], pa.string()) for x in (*at, text)), pa.array([len(text.encode())], pa.int64())], names=["cls_cd", "__date", "__year", "candidates", "bytes"])

    for batch in batches:
        for *own, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != at:
                if held:
                    yield made()
                at, held = own, []
            held.append(row)
    if held:
        yield made()


def mapping_dictionary(codes: DataFrame, agency: str) -> DataFrame:
    """The policy codes of a government whose lead agency starts with the prefix."""
    rows = codes.where((F.col("cls_cd") == S.POLICY) & (F.col("prev_gov_cd") == "LMB") & F.startswith(F.col("lead_agency"), F.lit(agency)))
    return rows.select(*DICTIONARY_COLUMNS)


def dictionaries(codes: DataFrame, agencies: DataFrame, agency: str = "agency") -> DataFrame:
    """For each distinct agency of a table its own mapping dictionary: the policy codes of a government whose lead agency starts with it. A code is met under the
    beginnings of its lead agency that have the length of some agency, so the join is by equality and a record costs no scan."""
    wanted = agencies.select(F.col(f"`{agency}`").alias("agency")).where("agency IS NOT NULL").distinct()
    lengths = sorted(r[0] for r in wanted.select(F.length("agency")).distinct().collect())  # of names: some dozens
    rows = codes.where((F.col("cls_cd") == S.POLICY) & (F.col("prev_gov_cd") == "LMB") & F.col("lead_agency").isNotNull())
    starts = F.array_compact(F.array(*[F.when(F.length("lead_agency") >= n, F.substring("lead_agency", 1, n)) for n in lengths])) if lengths else F.array().cast("array<string>")
    return rows.select(F.explode(F.array_distinct(starts)).alias("agency"), *DICTIONARY_COLUMNS).join(wanted, "agency")


DICTIONARY_COLUMNS = ("gov_task_no", "gov_task_nm", "detail_task_cd", "detail_task_nm", "direct_mapping_terms", "conditional_mapping_terms", "expand_candidate_terms", "required_combine_terms", "block_terms", "note", "lead_agency")


def dictionary_json(rows: DataFrame) -> DataFrame:
    """dictionary: the mapping dictionary's rows as one JSON array of objects, nulls written, in the order of their codes. A prompt holds it, so it is
    what one prompt can hold."""
    row = F.struct(F.col("detail_task_cd"), F.struct(*[F.col(c).alias(c.upper()) for c in rows.columns]).alias("row"))
    lists = rows.agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return lists.select(F.to_json(F.transform("rows", lambda r: r["row"]), {"ignoreNullFields": "false"}).alias("dictionary"))


def determined(code: Column, name: Column) -> Column:
    """A policy was found: it has a code, and a name that doesn't say otherwise."""
    return has_text(code) & has_text(name) & (F.trim(name) != S.NOT_APPLICABLE)
