"""A deterministic mapper of records to policy tasks, by the terms of the mapping dictionary. Decisions: direct, review, excluded, none."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.functions.text import null_to_blank

#: The decisions, by rank.
DIRECT, REVIEW, EXCLUDED, NONE = "직접", "검토", "제외", "후보없음"
_TERMS = ("direct_mapping_terms", "conditional_mapping_terms", "expand_candidate_terms", "required_combine_terms", "block_terms")


def terms(c: Column) -> Column:
    """A list of terms, parted by commas, semicolons or line ends."""
    return F.filter(F.transform(F.split(null_to_blank(c), r"[,;\n]"), F.trim), lambda t: t != "")


#: Distinct terms that are looked up at once: each costs some hundred bytes in the automaton that the tasks get.
MOST_TERMS = 200_000


def _automaton(terms_: list[tuple[int, str]]):
    """All terms as one trie with failure links, so a text is read once whatever their number."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for i, term in terms_:
        machine.add_word(term, i)
    machine.make_automaton()
    return machine


def met_terms(rows: DataFrame, text: str, distinct: DataFrame, met: str = "met") -> DataFrame:
    """rows with `met`, the sorted numbers of the terms (distinct: term_id, term) that the text holds anywhere, inside compound words too.

    The terms go to the tasks in blocks of MOST_TERMS at most, all looked up in one pass over the rows; nothing is joined, so no word is a hot key."""
    spark, n = rows.sparkSession, distinct.count()
    blocks = max(1, -(-n // MOST_TERMS))
    dealt = [distinct.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == b) if blocks > 1 else distinct for b in range(blocks)]
    sent = [spark.sparkContext.broadcast([(r["term_id"], r["term"]) for r in d.select("term_id", "term").collect()]) for d in dealt]
    names, at = rows.columns, rows.columns.index(text)

    def run(batches):
        machines = [_automaton(b.value) for b in sent if b.value]
        for batch in batches:
            found = [sorted({i for m in machines for _, i in m.iter(t)}) if t else [] for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], names=[*names, met])

    return rows.mapInArrow(run, rows.withColumn(met, F.lit(None).cast("array<bigint>")).schema)


def map_by_rules(items: DataFrame, dictionary: DataFrame, key: tuple[str, ...] = ("rc_code", "rc_rfile_no", "rc_ritem_no"), file_title: str = "bnd_ttl", item_title: str = "jemok") -> DataFrame:
    """One row for each item: key, decision, detail_task_cd, detail_task_nm, matched (terms), criteria (kind of the deciding term).

    A term is met wherever the title holds it, inside a compound word too, and case doesn't matter. A direct term in the title decides for the task (a
    blocking term beside it: for a review); a conditional term with a required one beside it too, else for a review; an expansion term for a review; a
    blocking term without a direct one excludes. Of several tasks the surest wins, then a match in the item's title, then the lower code. Terms are
    numbered once, by the dictionary alone; items are read once and never shuffled by a word.
    """
    tasks = dictionary.select("detail_task_cd", "detail_task_nm", *[F.transform(terms(F.col(c)), F.lower).alias(c) for c in _TERMS])
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(c).alias("terms")) for i, c in enumerate(_TERMS[:3])])
    each = tasks.select("detail_task_cd", "detail_task_nm", "required_combine_terms", "block_terms", F.explode(kinds).alias("k")).select("detail_task_cd", "detail_task_nm", "required_combine_terms", "block_terms", "k.kind", F.explode("k.terms").alias("term"))
    alike = ("required_combine_terms", "block_terms", "kind", "term")  # tasks that only differ by code decide alike, so the least stands for them
    each = each.groupBy(*alike).agg(F.min(F.struct("detail_task_cd", "detail_task_nm")).alias("t")).select(*alike, "t.*")
    distinct = each.select("term").distinct().select(F.xxhash64("term").alias("term_id"), "term")
    title = F.lower(F.concat_ws(" ", file_title, item_title))
    rows = items.select(*key, title.alias("__t"), F.lower(null_to_blank(F.col(item_title))).alias("__i"))
    met = met_terms(rows, "__t", distinct).select(*key, "__t", "__i", F.explode("met").alias("term_id"))
    met = met.join(F.broadcast(each) if each.count() <= MOST_TERMS else each, met["term_id"] == F.xxhash64(each["term"])).where(F.contains("__t", F.col("term")))
    within = lambda c: F.exists(c, lambda t: F.contains(F.col("__t"), t))
    blocked, combined = within("block_terms"), within("required_combine_terms")
    decision = F.when(F.col("kind") == 0, F.when(blocked, REVIEW).otherwise(DIRECT)).when(blocked, EXCLUDED).when((F.col("kind") == 1) & combined, DIRECT).otherwise(REVIEW)
    rank = reduce(lambda e, x: e.when(decision == x[1], x[0]), enumerate((DIRECT, REVIEW)), F.when(F.lit(False), 9)).otherwise(2)
    scored = met.select(*key, F.struct(rank.alias("rank"), F.col("kind"), (~F.contains("__i", F.col("term"))).alias("beyond"), "detail_task_cd", "detail_task_nm", "term", decision.alias("decision")).alias("s"))
    best = scored.groupBy(*key).agg(F.min("s").alias("s"), F.array_sort(F.collect_set("s.term")).alias("matched"))
    criteria = F.element_at(F.array(*map(F.lit, ("direct", "conditional", "expand"))), F.col("s.kind") + 1)
    out = items.select(*key).join(best, list(key), "left")
    return out.select(*key, F.coalesce("s.decision", F.lit(NONE)).alias("decision"), F.col("s.detail_task_cd").alias("detail_task_cd"), F.col("s.detail_task_nm").alias("detail_task_nm"), F.coalesce("matched", F.array().cast("array<string>")).alias("matched"), criteria.alias("criteria"))
