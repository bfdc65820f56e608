"""Spans of a pattern as Column expressions: places in code points, without Python on the executors, in n log n steps for n matches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_SPANS = "array<struct<start:bigint,end:bigint,hit:string>>"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once, however often a lambda in body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """The array whose place i holds join over the first i + 1 values: each round joins every place with that 1, 2, 4, ... before it."""
    rounds = F.sequence(F.lit(0), F.greatest(F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))), F.lit(0)).cast("int"))
    step = lambda acc, k: F.transform(acc, lambda x, i: F.coalesce(join(x, F.get(acc, i - F.pow(F.lit(2), k).cast("int"))), x))
    return F.aggregate(rounds, values, step)


def spans(text: Column, pattern: Column) -> Column:
    """array<struct<start, end, hit>> of the leftmost non-overlapping matches (none may be empty), from 0, end exclusive.

    The text between matches (split) and the matches themselves lie in turn, so their lengths add up to the places.
    """
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    return bound(hits, lambda found: F.zip_with(found, _ends(text, pattern, found), lambda hit, end: F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit"))))


def _ends(text: Column, pattern: Column, found: Column) -> Column:
    sizes = F.zip_with(found, F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), lambda hit, gap: (F.length(gap) + F.length(hit)).cast("long"))
    return bound(sizes, lambda own: running(own, lambda a, b: a + b))


def gated(gate: Column, found: Column) -> Column:
    """The spans where the gate holds; none elsewhere, without a look at the text."""
    return F.when(gate, found).otherwise(F.array().cast(NO_SPANS))
