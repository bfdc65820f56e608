"""Reading order of page lines: text runs with places become lines, lines of two-column pages are read column by column."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How far runs of one line lie apart in height, the share of the page's width that parts columns, lines that make a column.
SAME_LINE, COLUMN_GAP, COLUMN_LINES = 3.0, 0.12, 3

Run = tuple[float, float, str, float, float]
Line = tuple[str, float, float, float, float]


def _rows(runs: Sequence[Run]) -> Iterator[list[Run]]:
    """Runs (min_y, min_x, text, max_x, max_y), from the top, in groups of one height."""
    held, y = [], 0.0
    for run in runs:
        if held and abs(run[0] - y) > SAME_LINE:
            yield held
            held = []
        y = min(y, run[0]) if held else run[0]
        held.append(run)
    if held:
        yield held


def ordered(runs: Sequence[Run], width: float) -> list[Line]:
    """The lines of one page (text, min_x, max_x, min_y, max_y) in reading order.

    Runs are one line while no step down from one to the next is more than SAME_LINE beyond the line's first; a gap of more than
    COLUMN_GAP of the page parts a line. A page with COLUMN_LINES on either side of the middle is read as full-width
    lines above the columns, left column, right column, the rest.
    """
    lines: list[Line] = []
    for row in _rows(sorted(r for r in runs if r[2].strip(" "))):
        part, reach = [], 0.0
        for run in [*sorted(row, key=lambda r: (r[1], r[0], r[2])), None]:
            if part and (run is None or run[1] - reach > width * COLUMN_GAP):
                lines.append((" ".join(r[2] for r in part), part[0][1], max(r[3] for r in part), part[0][0], max(r[4] for r in part)))
                part = []
            if run is not None:
                reach = max(reach, run[3]) if part else run[3]
                part.append(run)
    sides = [1 if x[2] < width / 2 else 2 if x[1] > width / 2 else 0 for x in lines]
    top = min((x[3] for x, side in zip(lines, sides, strict=True) if side), default=0.0)
    if min(sides.count(1), sides.count(2)) < COLUMN_LINES:
        parts = [0] * len(lines)
    else:
        parts = [side or (0 if x[3] < top else 3) for x, side in zip(lines, sides, strict=True)]
    order = sorted(range(len(lines)), key=lambda i: (parts[i], lines[i][3], lines[i][1], lines[i][0]))
    return [lines[i] for i in order]


_PLACE = ("text", "min_x", "max_x", "min_y", "max_y")
_KINDS = (pa.int32(), pa.string(), *[pa.float64()] * 4)


def reading_order(runs: DataFrame, *, page: tuple[str, ...] = ("doc_id", "page")) -> DataFrame:
    """runs: page keys, text, min_x, max_x, min_y, max_y, page_width. One row for each line: page keys, line (from 1, in reading order), text
    and its place. Blank runs and runs without a place go. Pages are independent: one shuffle brings a page's runs together, and a task takes one page at a time."""
    given = runs.where(F.length(F.trim("text")) > 0).select(*page, "text", *[F.col(c).cast("double") for c in (*_PLACE[1:], "page_width")])
    given = given.dropna(subset=[*_PLACE, "page_width"])
    n = len(page)

    def lines_of(key: tuple, held: list) -> Iterator[tuple]:
        for i, line in enumerate(ordered([r[:5] for r in held], held[0][5]), 1):
            yield (*key, i, *line)

    def run(batches):
        key, held = None, []
        for batch in batches:
            out, columns = [], [c.to_pylist() for c in batch.columns]
            keys = list(zip(*columns[:n], strict=True))
            text, min_x, max_x, min_y, max_y, width = columns[n:]
            for own, *r in zip(keys, min_y, min_x, text, max_x, max_y, width, strict=True):
                if own != key:
                    if held:
                        out += lines_of(key, held)
                    key, held = own, []
                held.append(tuple(r))
            yield made(out, batch.schema)
            last = batch.schema
        if held:
            yield made(list(lines_of(key, held)), last)

    def made(out: list, schema: pa.Schema) -> pa.RecordBatch:
        kinds = [*(schema.field(i).type for i in range(n)), *_KINDS]
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=[*page, "line", *_PLACE])

    schema = given.select(*page, F.lit(0).alias("line"), *_PLACE).schema
    return given.repartition(*page).sortWithinPartitions(*page).mapInArrow(run, schema)


def page_text(lines: DataFrame, *, doc: tuple[str, ...] = ("doc_id",), page: str = "page") -> DataFrame:
    """Documents' text: lines in order, an empty line after each page."""
    rows = lines.groupBy(*doc, page).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), "\n").alias("t"))
    return rows.groupBy(*doc).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(page, "t"))), lambda x: F.concat(x["t"], F.lit("\n"))), "\n").alias("text"))
